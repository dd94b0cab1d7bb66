"""Near-duplicate documents by DartMinHash.

The elements of a document are its distinct runs of `SHINGLE` words, each with a
weight (one, or any positive number the caller gives). Over each element lies a
region, as wide as its weight and open in rank. Hashes throw darts into it: a
number that follows from the region's area, each with a place, a rank and one of
`BANDS * ROWS` coordinates. Regions are split into slabs of rank that double in
height; the slabs of a document are played from the lowest rank until every
coordinate has a dart, and each keeps its earliest. Two documents keep the same
dart in a coordinate with the probability of their weighted Jaccard similarity,
at a cost of the elements times some slabs instead of times the coordinates.

Documents with the same elements are one class from the start and take part
once. The kept darts are joined in bands of `ROWS`; of documents at a similarity
of 0.8, one pair in 10**4 shares no band, of those at 0.9 one in 10**13. A bucket
of documents that share a band gives no pairs of all with all: each is compared
with a leader, by its exact elements. What the links with leaders leave in
several components is compared in blocks of a bucket, as a product of matrices
of the exact elements, which gives no more than the links that connect
components. So no candidate is dropped, and what is written for a group of near
copies is about its size. A bucket of n documents meets in tasks of at most two
blocks of `BLOCK` documents.

A class is a component of the links of at least `SIMILAR`; its id is the least
doc_id in it. A text without words is like texts of the same characters only.
Null texts are empty, null ids take part and never name a class that has others.
Rows that repeat are in one class; other columns are not read. An empty table
gives no rows.

Each step is a table in the shared folder, so a lost executor costs its own part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.columns import packed, unpacked
from tidemark.llm.graph import Steps, components, sent_if_small

SHINGLE = 5
SIMILAR = 0.8
BANDS = 32
ROWS = 6
#: Documents of a bucket in a block.
BLOCK = 1000

#: Height of the lowest slab of rank, and of the highest; they double in between.
LOWEST, HIGHEST = 1 / 64, 32.0

_U = np.uint64
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)


def _poisson_table(area: float) -> np.ndarray:
    """Cumulative chances of 0, 1, 2, ... darts in a region of an area."""
    terms, n, term = [], 0, np.exp(-area)
    while n < area + 12 * np.sqrt(area) + 20:
        terms.append(term)
        n += 1
        term *= area / n
    return np.cumsum(terms)


def _unit(h: np.ndarray) -> np.ndarray:
    """Numbers from 0 to 1 out of the high bits of hashes."""
    return (h >> _U(11)).astype(np.float64) / (1 << 53)


def darts(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, k: int) -> np.ndarray:
    """The earliest dart in each of k coordinates of n weighted sets: an n by k matrix of hashes.

    `owner` is the set each element is in. A set without elements keeps none.
    Regions wider than one are played in cells of width one, and a dart beyond
    the weight in the last cell misses.
    """
    cells = np.ceil(weights).astype(np.int64)
    cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
    seed = W.mix(np.repeat(elements, cells) + W.mix(cell.astype(np.uint64) + _U(1)))
    width = np.repeat(weights, cells) - cell
    owner = np.repeat(owner, cells)
    kept = np.full(n * k, _EMPTY)
    open_sets = np.zeros(n, bool)
    open_sets[owner] = True
    slab, low, height = 0, 0.0, LOWEST
    while open_sets.any():
        playing = np.flatnonzero(open_sets[owner])
        here = W.mix(seed[playing] ^ W.mix(np.array([slab + 1], np.uint64)))
        count = np.searchsorted(_poisson_table(height), _unit(here), "right")
        hit = np.flatnonzero(count)
        number = count[hit]
        region = np.repeat(hit, number)
        order = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        dart = W.mix(here[region] + W.mix(order.astype(np.uint64) + _U(3)))
        inside = _unit(W.mix(dart + _U(5))) < width[playing[region]]
        dart, who = dart[inside], owner[playing[region[inside]]]
        slot = who * k + ((dart >> _U(32)) % _U(k)).astype(np.int64)
        free = kept[slot] == _EMPTY  # the darts of lower slabs are earlier than these
        # The rank within a slab is a hash of the dart, and names it.
        np.minimum.at(kept, slot[free], W.mix(dart[free] + _U(7)))
        open_sets &= (kept.reshape(n, k) == _EMPTY).any(axis=1)
        slab, low = slab + 1, low + height
        height = min(low, HIGHEST)
    return kept.reshape(n, k)


def elements(column: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of k words: owner, hash and how often it occurs, by owner and hash."""
    found = W.Words(column)
    owner, values = W.shingles(found.hashes(), found.first, k)
    bare = np.flatnonzero(found.counts == 0)
    if len(bare):
        own = [int.from_bytes(hashlib.sha256(found.raw[found.offsets[r]:found.offsets[r + 1]].tobytes())
                              .digest()[:8], "little") for r in bare.tolist()]
        owner, values = np.r_[owner, bare], np.r_[values, np.array(own, np.uint64)]
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    return owner[at], values[at], np.diff(np.r_[at, len(owner)])


def _signed(bands: int, rows: int):
    """A hash of the element set, which names the node, and the keys of its bands, for each document."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, values, _ = elements(batch.column("text"))
        n = batch.num_rows
        first = np.searchsorted(owner, np.arange(n + 1))
        kept = darts(values, np.ones(len(values)), owner, n, bands * rows)
        keys = np.zeros((n, bands), np.uint64)
        for j in range(rows):
            keys = keys * _U(0x9E3779B97F4A7C15) + kept[:, j::rows]
        keys = W.mix(keys + np.arange(bands, dtype=np.uint64))
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "row": batch.column("row"),
            "node": pa.array(_set_hash(values, first, 11).view(np.int64)),
            "bands": W.list_column(keys.view(np.int64).ravel(), np.arange(n + 1) * bands)})
    return W.per_slice("text", work, 1_000_000)


def _sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The elements of each text, and the hash of their set."""
    owner, values, _ = elements(batch.column("text"))
    first = np.searchsorted(owner, np.arange(batch.num_rows + 1))
    return pa.RecordBatch.from_pydict({
        "node": batch.column("node"), "hash": pa.array(_set_hash(values, first, 11).view(np.int64)),
        "elements": W.list_column(values.view(np.int64), first)})


def _set_hash(values: np.ndarray, first: np.ndarray, salt: int) -> np.ndarray:
    return W.range_hash(W.mix(values + _U(salt)), first[:-1], first[1:])


def _element_sets(steps: Steps, docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, elements) of the nodes that are wanted."""
    chosen = steps.keep(nodes.join(wanted, "node", "left_semi").select(
        "node", F.col("doc_id").alias("of")))
    texts = docs.select("doc_id", "text").join(
        sent_if_small(chosen), F.col("doc_id").eqNullSafe(F.col("of"))).select("node", "text")
    # An id may have several texts; the node's is the one with its elements.
    return steps.keep(texts.mapInArrow(W.per_slice("text", _sets), "node long, hash long, elements array<long>")
                      .where("hash = node").dropDuplicates(["node"]).drop("hash"))


def _linked(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) of nodes that are similar by their exact elements."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("elements").alias("y")), "b"))
    common = F.size(F.array_intersect("x", "y"))
    shared = both.select("a", "b", (common / (F.size("x") + F.size("y") - common)).alias("j"))
    return shared.where(F.col("j") >= similar).select("a", "b")


def connecting(nodes: np.ndarray, component: np.ndarray, sets: list[np.ndarray], similar: float,
               columns: int = 2048) -> list[tuple[int, int]]:
    """Links of similar sets that connect all components which any such links connect."""
    sizes = np.array([len(x) for x in sets])
    values, where = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = np.bincount(where, minlength=len(values)) > 1
    number = np.cumsum(shared) - 1
    keep = shared[where]
    row, column = row[keep], number[where[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(shared.sum()), columns):
        a, b = np.searchsorted(column, (start, start + columns))
        part = np.zeros((len(sets), columns), np.float32)
        part[row[a:b], column[a:b] - start] = 1
        common += part @ part.T
    total = sizes[:, None] + sizes[None, :] - common
    near = np.triu(common >= similar * total - 1e-6, 1) & (component[:, None] != component[None, :])
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    out = []
    for i, j in np.argwhere(near).tolist():
        a, b = root(int(component[i])), root(int(component[j]))
        exact = int(round(float(common[i, j])))
        if a != b and exact / (int(sizes[i]) + int(sizes[j]) - exact) >= similar:
            parent[a] = b
            out.append((int(nodes[i]), int(nodes[j])))
    return out


def _blocks(similar: float):
    """Links within each block group of sorted rows."""
    def links(held: list[pa.RecordBatch]) -> list[tuple[int, int]]:
        table = pa.Table.from_batches(held)
        elements = [np.array(x, np.int64) for x in table.column("elements").to_pylist()]
        return connecting(table.column("node").to_numpy(), table.column("component").to_numpy(), elements, similar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        name = None
        for batch in batches:
            names = np.stack([batch.column(c).to_numpy() for c in ("key", "i", "j")], 1)
            cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
            out = []
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(names)]):
                if b <= a:
                    continue
                if name is not None and tuple(names[a]) != name:
                    out += links(held)
                    held = []
                name = tuple(names[a])
                held.append(batch.slice(a, b - a))
            yield _pairs_batch(out)
        if held:
            yield _pairs_batch(links(held))
    return run


def _pairs_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in pairs], pa.int64()),
                                       "b": pa.array([b for _, b in pairs], pa.int64())})


def classes(docs: DataFrame, similar: float = SIMILAR, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, class_id) of every document."""
    return _classed(docs.select("doc_id", "text", F.lit(0).cast("long").alias("row")), similar, bands, rows).select(
        "doc_id", "class_id")


def _classed(docs: DataFrame, similar: float, bands: int, rows: int) -> DataFrame:
    """(doc_id, row, class_id, class) of every document with a hash `row`; `class` names also classes without an id."""
    spark = docs.sparkSession
    steps = Steps(spark, "near-dups")
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = steps.keep(docs.select("doc_id", "text", "row").mapInArrow(
        _signed(bands, rows), f"doc_id {kind}, row long, node long, bands array<long>"))
    nodes = steps.keep(signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")))
    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = steps.keep(banded.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("n"))
                        .where("n > 1").drop("n"))
    members = steps.keep(banded.join(shared, "key").where("node <> leader"))
    pairs = steps.keep(members.select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct())
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _element_sets(steps, docs, nodes, wanted)
    links = steps.keep(_linked(pairs, sets, similar))
    named = components(steps, links)
    # Members of a bucket in several components have not been compared with each other.
    apart = members.join(named, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component"))
    several = apart.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                       F.count("*").alias("n")).where("low < high").select("key", "n")
    cut = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (apart.join(several.withColumn("blocks", cut), "key").withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                     "node", "component"))
    more = (dealt.join(sets, "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(_blocks(similar), "a long, b long"))
    named = components(steps, links.unionByName(steps.keep(more.distinct())))
    ids = (nodes.select("node", "doc_id").join(named, "node")
           .groupBy("component").agg(F.min("doc_id").alias("class_id")))
    named = steps.keep(named.join(ids, "component").select("node", "component", F.col("class_id").alias("found")))
    least = nodes.select("node", F.col("doc_id").alias("own"))
    node_class = steps.keep(least.join(named, "node", "left").select(
        "node", F.coalesce("found", "own").alias("class_id"), F.coalesce("component", "node").alias("class")))
    return signed.select("doc_id", "row", "node").join(node_class, "node").select("doc_id", "row", "class_id", "class")


def first_of_each(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One row of each class: of the least id, and of those the row of the least hash.

    Rows go by a hash of all their columns, so an id that is null or repeats loses
    only its copies. Of rows that are equal in every column one stays.
    """
    steps = Steps(docs.sparkSession, "near-dups-gone")
    rows = packed(docs).withColumn("row", F.xxhash64("doc_id", "text", "rest"))
    found = steps.keep(_classed(rows, similar, BANDS, ROWS).groupBy("class", "doc_id", "row").agg(
        F.count("*").alias("n")))
    least = found.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("least"))
    marked = found.join(least, "class").select(
        F.col("row").alias("of"), (F.col("row") == F.col("least.row")).alias("first"), "n")
    marked = steps.keep(marked.where("not first or n > 1").select("of", "first"))
    sent = sent_if_small(marked)
    left = rows.join(sent, F.col("row") == F.col("of"), "left")
    one = left.where("of is null")
    if marked.where("first").head(1):
        columns = ("doc_id", "text", "rest")
        copies = left.where("first").groupBy("row").agg(F.first(F.struct(*columns)).alias("one"))
        one = one.select(*columns).unionByName(copies.select("one.*"))
    return unpacked(one, docs)
