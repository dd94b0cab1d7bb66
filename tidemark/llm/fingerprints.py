"""Document fingerprints by one-permutation MinHash.

The shingles of a text are its runs of `SHINGLE` words; the runs of fewer words
that start the text count too, so that short texts have shingles to share. Each
shingle is hashed once: the high bits choose one of `BINS` bins, of which the
least hash is kept. An empty bin takes the value of a bin drawn for it by a
sequence of hashes of its own number, the first of which that is not empty
(optimal densification): two texts draw alike, so filled bins agree as often as
others. `BITS` low bits of each bin are stored, packed into hex digits. Agreeing
bins are a share of J + (1 - J) / 2**BITS of all; the likeness undoes that bias.

A text without words has the fingerprint of its bytes as one shingle, so equal
texts have equal fingerprints, and an empty one is like no text but an empty one.

The next document in descending order of id is found without sorting in one
place: places in the order (id, then hash of the text, both descending) are cut
at rows of a sample into ranges, each range is sorted by itself, and the row at
the upper end of a range is sent to the range before it as well. The sample only
decides where ranges start.

A null text is empty; a null id comes last in the descending order. Ids may be
text. Rows of one id follow each other by the hash of their text, so one id may
span ranges; only rows that repeat whole meet in one task, where they are read
one slice at a time, each answered by the next. A long text is a slice of its
own. An empty table gives no rows; columns other than id and text are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StructField, StructType

from tidemark.llm import words as W

SHINGLE = 5
BINS = 256
BITS = 4
#: A range beyond this many is sorted with others of its task, which spills.
MOST_RANGES = 4096
#: Rows of the sample for each range; cuts that are looked through at once.
SAMPLED, STEP = 50, 64
#: Bytes of text worked on at once.
SLICE_BYTES = 500_000

_U = np.uint64
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)
_DRAWS = np.random.default_rng(7).integers(0, BINS, (BINS, 64))


def _draw(bins: np.ndarray, attempt: int) -> np.ndarray:
    """The bin that an empty bin looks at in an attempt; the same for all texts."""
    if attempt < _DRAWS.shape[1]:
        return _DRAWS[bins, attempt]
    return (W.mix(bins.astype(np.uint64) * _U(1 << 32) + _U(attempt)) % _U(BINS)).astype(np.int64)


def bin_minima(column: pa.Array) -> np.ndarray:
    """The densified bins of each text: a matrix of 64-bit values."""
    found = W.Words(column)
    hashes, first = found.hashes(), found.first
    table = np.full(len(column) * BINS, _EMPTY)

    def put(rows: np.ndarray, values: np.ndarray) -> None:
        np.minimum.at(table, rows * BINS + (values >> _U(56)).astype(np.int64), values)

    counts = found.counts
    rows = found.rows
    place = np.arange(len(found)) - np.repeat(first[:-1], counts)  # of a word in its row
    rolled = np.zeros(len(found), np.uint64)
    for j in range(SHINGLE - 1, -1, -1):
        inner = place >= j
        rolled[inner] = rolled[inner] * _U(0x9E3779B97F4A7C15) + hashes[np.flatnonzero(inner) - j]
    put(rows, W.mix(rolled + np.minimum(place, SHINGLE - 1).astype(np.uint64)))
    bare = np.flatnonzero(counts == 0)
    if len(bare):
        own = [int.from_bytes(hashlib.sha256(found.raw[found.offsets[r]:found.offsets[r + 1]].tobytes())
                              .digest()[:8], "little") for r in bare.tolist()]
        put(bare, W.mix(np.array(own, np.uint64)))
    empty = np.flatnonzero(table == _EMPTY)
    source, target, attempt = table.copy(), empty, 0
    while len(target):
        value = source[target // BINS * BINS + _draw(target % BINS, attempt)]
        table[target] = value
        target = target[value == _EMPTY]
        attempt += 1
    return table.reshape(len(column), BINS)


def pack(minima: np.ndarray) -> list[str]:
    """Low bits of each bin as hex digits."""
    low = (minima & _U((1 << BITS) - 1)).astype(np.uint8)
    packed = low[:, 0::2] << 4 | low[:, 1::2]
    return [row.tobytes().hex() for row in packed]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of texts from the stored bits, row by row, from 0 to 1."""
    low = _U((1 << BITS) - 1)
    agree = ((a & low) == (b & low)).mean(axis=1)
    chance = 1 / (1 << BITS)
    return np.clip((agree - chance) / (1 - chance), 0, 1)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many characters from the start of the next."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _answers(rows: pa.RecordBatch, own: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Results for the rows at some places, each of which has its next document below it; `own` are their bins."""
    texts = rows.column("text").to_pylist()
    changed = [edited(texts[i], texts[i + 1]) for i in at.tolist()]
    sizes = [len(texts[i]) for i in at.tolist()]
    del texts
    new = bin_minima(pa.array(changed, pa.large_string()))
    return pa.RecordBatch.from_pydict({
        "doc_id": rows.column("doc_id").take(pa.array(at)),
        "n_chars": pa.array(sizes, pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        "fingerprint": pa.array(pack(own[at]), pa.string()),
        "edited_fingerprint": pa.array(pack(new), pa.string()),
        "near_edited": pa.array(likeness(own[at], new)),
        "near_next": pa.array(likeness(own[at], own[at + 1]))})


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range with each range's sentinel last; a row's next is the row below it."""
    held = None
    for batch in batches:
        for rows in W.slices(batch, "text", SLICE_BYTES):
            own = bin_minima(rows.column("text"))
            if held is not None:
                rows = pa.Table.from_batches([held[0], rows]).combine_chunks().to_batches()[0]
                own = np.r_[held[1], own]
            held = rows.slice(rows.num_rows - 1), own[-1:].copy()
            at = np.flatnonzero(~rows.column("sentinel").to_numpy(zero_copy_only=False)[:-1])
            if len(at):
                yield _answers(rows, own, at)


def _cuts(places: DataFrame, ranges: int) -> list:
    """Places at which ranges start, the greatest first, from a sample by hash; the greatest of all is one."""
    row = places.agg(F.count("*").alias("n"), F.max("place").alias("top")).first()
    if not row["n"]:
        return []
    share = max(1, row["n"] // (SAMPLED * ranges))
    sample = places.where(F.pmod(F.xxhash64("place"), F.lit(share)) == 0).distinct()
    found = [r["place"] for r in sample.orderBy(F.desc("place")).collect()]
    step = max(1, len(found) // ranges)
    return [row["top"], *[p for p in found[step::step] if p != row["top"]]]


def _numbers(cuts: list, id_type: DataType) -> Column:
    """How many cuts are at or above the place, less one: found among blocks of cuts, then within one."""
    def reached(some: Column) -> Column:
        return F.size(F.filter(some, lambda c: c >= F.col("place")))

    def listed(some: list) -> Column:
        return F.array(*[F.struct(F.lit(p["doc_id"]).cast(id_type).alias("doc_id"), F.lit(p["h"]).alias("h"))
                         for p in some])
    blocks = [cuts[i:i + STEP] for i in range(0, len(cuts), STEP)]
    block = F.greatest(reached(listed([b[0] for b in blocks])), F.lit(1))
    inside = F.element_at(F.array(*map(listed, blocks)), block)
    return ((block - 1) * STEP + reached(inside) - 1).cast("int")


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likenesses."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    ranges = ranges or min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_RANGES)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"),
                       F.struct("doc_id", F.xxhash64(text).alias("h")).alias("place"))
    cuts = _cuts(rows.select("place"), ranges)
    schema = (f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    if not cuts:
        return spark.createDataFrame([], schema)
    place = rows.schema["place"].dataType
    starts = F.broadcast(spark.createDataFrame(
        [(p, (i - 1) % len(cuts)) for i, p in enumerate(cuts)], StructType(
            [StructField("start", place), StructField("range", IntegerType())])))
    # The first row of each range goes to the range before it; that of the first to the last.
    sentinels = (rows.join(starts, F.col("place").eqNullSafe(F.col("start"))).groupBy("place", "range")
                 .agg(F.min("text").alias("text"))
                 .select("place.doc_id", "text", "place", "range", F.lit(True).alias("sentinel")))
    numbered = rows.select("*", _numbers(cuts, docs.schema["doc_id"].dataType).alias("range"), F.lit(False).alias("sentinel"))
    ordered = (numbered.unionByName(sentinels).repartition("range")
               .sortWithinPartitions("range", "sentinel", F.desc("place"), "text"))
    return ordered.select("doc_id", "text", "sentinel").mapInArrow(_followed, schema)
