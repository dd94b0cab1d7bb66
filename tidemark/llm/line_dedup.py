"""Line dedup by a deletion-neighbourhood join, within an edit distance of one character.

Lines are what newlines part. Of equal lines the earliest stays. Two different
lines of at least `LEAST` characters are near when one edit (a character put in,
left out or changed) turns one into the other; a line goes if an earlier one is
near. Earlier is by doc_id, then by the text's hash, then by line. Shorter lines
are compared for equality only, and blank lines always stay.

A line's variants are the line with one character deleted. Two lines that differ
by a changed character have a variant in common with the same place deleted; of
two that differ by one character more, the shorter is a variant of the longer.
Variants and lines are hashed keys. A first join finds the keys that different
lines share; a second one tells for these whether the places agree, and each key
needs no more than its earliest line: groups are never expanded into pairs. The
pair of a line and the earliest of its key is verified by edit distance on the
texts.

Only lines that can have a partner make variants, and only in the half that can
have the edit: an edit leaves either the first or the second half of a line as it
is, so a line none of whose halves (cut for its own length and for one less)
occurs in another line has no partner, and one whose first half does has its edit
in the second.

Nulls: a null text has no lines and stays null; null ids come last. Rows equal in
id and text are one document and keep the same lines. `dedup` keeps other columns
and replaces any called `n_lines` or `n_kept`; `deduped_documents` keeps all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.columns import OWN, packed, unpacked
from tidemark.llm.graph import Steps, sent_if_small

LEAST = 10
#: Survivors and keys that may be sent to every executor: narrow rows.
SENDABLE_ROWS = 1_000_000

_U = np.uint64


class Lines:
    """Lines of a slice of texts, as ranges of code points."""

    def __init__(self, column: pa.Array):
        self.null = pc.is_null(column).to_numpy(zero_copy_only=False)
        filled = pc.fill_null(column, "")
        raw, _ = W.column_bytes(filled)
        self.points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        lengths = pc.utf8_length(filled).to_numpy(zero_copy_only=False)
        begins = np.r_[0, np.cumsum(lengths)].astype(np.int64)
        breaks = np.flatnonzero(self.points == 10)
        row_of_break = np.searchsorted(begins, breaks, "right") - 1
        self.counts = np.bincount(row_of_break, minlength=len(column)) + 1
        self.rows = np.repeat(np.arange(len(column)), self.counts)
        first = np.r_[0, np.cumsum(self.counts)]
        self.starts = np.empty(first[-1], np.int64)
        self.ends = np.empty(first[-1], np.int64)
        place = np.arange(len(breaks)) + row_of_break  # of the line a break ends
        self.starts[first[:-1]] = begins[:-1]
        self.starts[place + 1] = breaks + 1
        self.ends[first[1:] - 1] = begins[1:]
        self.ends[place] = breaks
        self.numbers = np.arange(first[-1]) - np.repeat(first[:-1], self.counts)
        black = np.r_[0, np.cumsum(~np.isin(self.points, _BLANK))]
        self.black = black[self.ends] > black[self.starts]


# White space of Unicode.
_BLANK = np.array([9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
                   0x205F, 0x3000], np.uint32)


def _values(points: np.ndarray, salt: int = 1) -> np.ndarray:
    return W.mix(points.astype(np.uint64) + _U(salt << 32))


def _line_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Hash, place and half keys of each line that is not blank."""
    lines = Lines(batch.column("text"))
    at = np.flatnonzero(lines.black & ~lines.null[lines.rows])
    starts, ends, rows = lines.starts[at], lines.ends[at], lines.rows[at]
    values = _values(lines.points)
    n = ends - starts
    half = n // 2
    odd = n % 2 == 1
    front = W.range_hash(values, starts, starts + half)
    back = ~W.range_hash(values, ends - half, ends)
    third = W.range_hash(values, np.where(odd, ends - half - 1, starts),
                         np.where(odd, ends, starts + np.maximum(half - 1, 0)))
    third = np.where(odd, ~third, third)
    near = n >= LEAST
    keys = np.c_[front, back, third].view(np.int64)
    first = np.r_[0, np.cumsum(np.where(near, 3, 0))]
    return pa.RecordBatch.from_pydict({
        "line": pa.array(W.range_hash(values, starts, ends).view(np.int64)),
        "check": pa.array(W.range_hash(_values(lines.points, 2), starts, ends).view(np.int64)),
        "doc_id": batch.column("doc_id").take(pa.array(rows)),
        "row": batch.column("row").take(pa.array(rows)),
        "number": pa.array(lines.numbers[at].astype(np.int32)), "odd": pa.array(odd),
        "halves": W.list_column(keys[near].ravel(), first)})


def _picked(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The lines of a document that are asked for, with their hashes."""
    out = {"line": [], "text": []}
    for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
        lines = text.split("\n")
        for w in wanted:
            out["line"].append(w["line"])
            out["text"].append(lines[w["number"]])
    return pa.RecordBatch.from_pydict({"line": pa.array(out["line"], pa.int64()),
                                       "text": pa.array(out["text"], pa.string())})


#: What a key says of its line: it has the variant, or is the variant.
LONGER, WHOLE = 0, 1


def _variants(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Keys of a line and of its variants, with the place that is deleted."""
    texts = pc.fill_null(batch.column("text"), "")
    raw, _ = W.column_bytes(texts)
    points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    n = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.r_[0, np.cumsum(n)]
    values = _values(points)
    front = batch.column("front").to_numpy(zero_copy_only=False)
    back = batch.column("back").to_numpy(zero_copy_only=False)
    # The edit lies before the shared second half, or from the shared first half on.
    low, high = np.where(front, 0, (n - 1) // 2), np.where(back, n, n - n // 2)
    size = np.maximum(high - low, 0)
    owner = np.repeat(np.arange(len(n)), size)
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + low[owner]
    at = starts[owner] + place
    bare = W.range_hash_without(values, starts[owner], starts[owner + 1], at)
    whole = W.range_hash(values, starts[:-1], starts[1:])
    lines = batch.column("line").to_numpy()
    return pa.RecordBatch.from_pydict({
        "key": pa.array(np.r_[bare, whole].view(np.int64)),
        "role": pa.array(np.r_[np.full(len(at), LONGER, np.int8), np.full(len(n), WHOLE, np.int8)]),
        "place": pa.array(np.r_[place, np.full(len(n), -1)].astype(np.int32)),
        "line": pa.array(np.r_[lines[owner], lines])})


def within_one_edit(a: str, b: str) -> bool:
    """Whether at most one character put in, left out or changed turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def _verified(batch: pa.RecordBatch) -> pa.RecordBatch:
    near = [within_one_edit(a, b) for a, b in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
    return pa.RecordBatch.from_pydict({"line": batch.column("later").filter(pa.array(near, pa.bool_()))})


def _near_lines(steps: Steps, docs: DataFrame, unique: DataFrame) -> DataFrame:
    """Hashes of the lines that are near an earlier one."""
    halves = unique.select("line", "odd", F.posexplode("halves").alias("which", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    # Halves are a first half, a second half, and a first one again if its hash is not inverted.
    second = (F.col("which") == 1) | (F.col("which") == 2) & F.col("odd")
    found = (halves.withColumn("second", second).select("line", "half", "second").join(shared, "half", "left_semi")
             .groupBy("line").agg(F.max("second").alias("front"), F.max(~F.col("second")).alias("back")))
    survivors = steps.keep(unique.drop("halves", "odd").join(found, "line"))
    wanted = steps.keep(survivors.groupBy("place.doc_id", "place.row").agg(
        F.collect_list(F.struct("line", "place.number")).alias("wanted")))
    wanted = wanted.select(F.col("doc_id").alias("of"), F.col("row").alias("of_row"), "wanted")
    texts = docs.select("doc_id", "text", "row").join(
        sent_if_small(wanted, SENDABLE_ROWS), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row")))
    texts = steps.keep(texts.select("text", "wanted").mapInArrow(
        W.per_slice("text", _picked, 500_000), "line long, text string").dropDuplicates(["line"])
        .join(survivors.select("line", "front", "back", F.col("place").alias("order")), "line"))
    variants = texts.select("line", "text", "front", "back").mapInArrow(
        W.per_slice("text", _variants, 200_000), "key long, role byte, place int, line long")
    met = steps.keep(variants.groupBy("key").agg(F.min("line").alias("low"), F.max("line").alias("high"))
                     .where("low <> high").select("key"))
    # The order of a line is its place among all; the earliest of a group is the least.
    order = texts.select("line", "order")
    shown = steps.keep(variants.join(sent_if_small(met, SENDABLE_ROWS), "key").join(order, "line"))
    least = F.min(F.struct("order", "line")).alias("first")
    changed = shown.where(F.col("role") == LONGER).groupBy("key", "place").agg(least)
    changed = shown.where(F.col("role") == LONGER).join(changed, ["key", "place"])
    longer = shown.where(F.col("role") == WHOLE).join(
        shown.where(F.col("role") == LONGER).groupBy("key").agg(least), "key")
    whole = shown.where(F.col("role") == LONGER).join(
        shown.where(F.col("role") == WHOLE).groupBy("key").agg(least), "key")
    columns = (F.col("line").alias("later"), "order", "first")
    pairs = steps.keep(changed.select(*columns).unionByName(longer.select(*columns)).unionByName(whole.select(*columns))
                       .where(F.col("first.order") < F.col("order"))
                       .select("later", F.col("first.line").alias("earlier")).distinct())
    text = texts.select("line", "text")
    both = (pairs.join(text.select(F.col("line").alias("later"), F.col("text").alias("x")), "later")
            .join(text.select(F.col("line").alias("earlier"), F.col("text").alias("y")), "earlier"))
    return both.select("later", "x", "y").mapInArrow(W.per_slice("x", _verified), "line long").distinct()


def _rebuilt(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts, n_lines, n_kept = [], [], []
    for text, kept in zip(batch.column("text").to_pylist(), batch.column("kept").to_pylist()):
        if text is None:
            texts.append(None)
            n_lines.append(0)
            n_kept.append(0)
            continue
        lines, stay = text.split("\n"), set(kept or ())
        out = [x for i, x in enumerate(lines) if i in stay or not x.strip(_WHITE)]
        texts.append("\n".join(out))
        n_lines.append(len(lines))
        n_kept.append(len(out))
    columns = {n: batch.column(n) for n in batch.schema.names if n != "kept"}
    columns |= {"text": pa.array(texts, pa.string()), "n_lines": pa.array(n_lines, pa.int64()),
                "n_kept": pa.array(n_kept, pa.int64())}
    return pa.RecordBatch.from_pydict(columns)


_WHITE = "".join(map(chr, _BLANK.tolist()))


def dedup(docs: DataFrame) -> DataFrame:
    """The documents with the text their lines leave, `n_lines` before and `n_kept` after.

    Other columns stay as they are, whatever their names; those two are replaced.
    """
    others = [c for c in docs.columns if c not in (*OWN, "n_lines", "n_kept")]
    return _deduped(packed(docs.select(*OWN, *[F.col(f"`{c}`") for c in others]))).select(
        *OWN, *[F.col("rest").getField(c).alias(c) for c in others], "n_lines", "n_kept")


def _deduped(plain: DataFrame) -> DataFrame:
    """As `dedup`, of packed documents."""
    steps = Steps(plain.sparkSession, "line-dedup")
    kind = plain.schema["doc_id"].dataType.simpleString()
    keyed = plain.select("doc_id", "text").withColumn("row", F.xxhash64("text"))
    place = F.struct(F.isnull("doc_id").alias("without"), "doc_id", "row", "number")
    unique = steps.keep(
        keyed.mapInArrow(W.per_slice("text", _line_rows, 500_000),
                         f"line long, check long, doc_id {kind}, row long, number int, odd boolean, halves array<long>")
        .groupBy("line", "check").agg(F.min(place).alias("place"), F.first("halves").alias("halves"),
             F.first("odd").alias("odd")))
    near = steps.keep(_near_lines(steps, keyed, unique))
    kept = (unique.join(near, "line", "left_anti").groupBy("place.doc_id", "place.row")
            .agg(F.collect_list("place.number").alias("kept")))
    kept = kept.select(F.col("doc_id").alias("of"), F.col("row").alias("of_row"), "kept")
    joined = plain.join(kept, F.col("doc_id").eqNullSafe(F.col("of"))
                        & (F.xxhash64("text") == F.col("of_row")), "left").drop("of", "of_row")
    schema = joined.drop("kept").withColumn("n_lines", F.lit(0).cast("long")).withColumn(
        "n_kept", F.lit(0).cast("long")).schema
    return joined.mapInArrow(W.per_slice("text", _rebuilt, 500_000), schema)


def deduped_documents(docs: DataFrame) -> DataFrame:
    """The documents with their columns and the text left; those that lost every line but blank ones go.

    `n_chars`, if there, is counted anew where a text changed.
    """
    out = _deduped(packed(docs))
    bare = F.btrim("text", F.lit(_WHITE + "\n")) == ""
    out = out.where(~((F.col("n_kept") < F.col("n_lines")) & F.coalesce(bare, F.lit(False))))
    return unpacked(out, docs, F.col("n_kept") < F.col("n_lines"))
