"""Toxicity by class-conditional Kneser-Ney models of the letters of words.

Two models, of toxic and of ordinary documents, give each word a likelihood,
letter by letter (UTF-8 bytes, with a mark where the word starts and ends). The
two highest orders have counts of their own class: how often a run of `ORDER`
letters occurs in labelled words, and for the order below in how many contexts.
All lower orders are shared: they count, over every word of every document,
labelled or not, the distinct contexts of a run of letters. A word form that
neither class has seen so falls back to the stem it shares with others, and
where both classes back off fully their shared part cancels.

The log-likelihoods are compared per word and normalised by length: the mean
over a document, the best mean over `SPAN` consecutive words, the best single
word, and the means of what the words' ratios exceed each of `MARKS` by. A
logistic regression turns these into the chance of the label; it is fitted on
labelled documents held back from the counts, then the counts of these are added.

All counts, of classes and shared, grow with the input; none is left out. One pass
over the documents emits the distinct runs of letters of each task, with their counts
by class, packed by bucket of the three letters before the last; a bucket meets in one
task, where everything that the chances of its runs depend on, down to the fourth
order, is at hand. Tasks pack few buckets, so that a piece holds thousands of runs and
the number of pieces grows with the text, not with its square; where a sample of the
runs shows that a bucket would hold too many distinct ones, the pieces are cut into more
buckets before they meet. The pieces of a bucket are summed as they come. The three
lowest orders, over runs of at most three letters, go there as an array; each task names
the short runs that these are counted from, so that the pieces are read once. The
ratios of runs go to the executors as two arrays up to `SENT_RUNS`; beyond that each
text gets the ratios of its words by joins. Labels of whole-number ids go to the tasks as
arrays up to `SENT_LABELS`, else by a join. Only the regression is bounded: it is fitted
on at most `MAX_LABELLED` of the documents held back, by hash order.

Nulls: a null or empty text has no words and the score of a document without
evidence. A null id has no label and is not held out. Labels that repeat count
as toxic if any says so; null labels are ignored. Without both labels all scores
are the share of toxic labels, or 0. Repeated documents are scored row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.llm import words as W
from tidemark.llm.graph import Steps, sent_if_small

ORDER = 8
#: Order up to which counts are shared by the classes.
SHARED = ORDER - 2
DISCOUNT = 0.75
SPAN = 8
#: Ratios above which a word counts as a mark of toxicity, for the features.
MARKS = (0.5, 1.0, 2.0, 3.0)
MAX_LABELLED = 200_000
#: Runs with a ratio (12 bytes each) that are sent to every executor; more are joined to the texts.
SENT_RUNS = 10_000_000
#: Distinct runs that a task holds before it passes them on.
HELD_RUNS = 600_000
#: Letters before the last by which runs meet, and the highest order below, which is sent.
MEET = 3
#: Bytes of text worked on at once.
SLICE_BYTES = 500_000
#: Labels (9 bytes each) that are sent to every executor; more are joined to the texts.
SENT_LABELS = 10_000_000
#: Bytes of text for each bucket that tasks pack, and distinct runs that a bucket may hold where they meet.
BUCKET_BYTES = 256_000_000
BUCKET_RUNS = 500_000
LEAST_BUCKETS = 64
#: One of so many distinct runs is in the sample that they are counted by.
SAMPLE = 1024
#: Ratios are summed as whole numbers of this part where the order of rows is not fixed.
UNIT = 2.0**-32
#: Score from which a document counts as toxic.
THRESHOLD = 0.3

_U = np.uint64


FEATURES = 5 + 2 * len(MARKS)
#: Labelled documents are of two classes, counted or kept back.
PARTS = 4
#: Packed runs of a bucket: sorted runs and their counts, or their ratios.
_COUNTS = "bucket int, runs binary, counts binary"
#: Besides, in one row of all that a task passes on at once: short runs it has not named before, sampled runs.
_NAMED = "short binary, sampled binary"
_RATIOS = "n long, runs binary, fitted binary, whole binary"


def _mask(order: int) -> int:
    return (1 << 8 * order) - 1


class Spelled:
    """The distinct words of a slice, letter by letter, with packed runs of the last letters."""

    def __init__(self, found: W.Words):
        hashes = found.hashes()
        _, at, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        self.times = np.bincount(self.word, minlength=len(at))
        starts, sizes = found.starts[at], found.ends[at] - found.starts[at]
        # Each word takes ORDER zeros and its letters; the zero behind it is the next word's first.
        first = np.r_[0, np.cumsum(sizes + ORDER)].astype(np.int64)
        letters = np.zeros(first[-1] + 1, np.uint64)
        inner = np.repeat(starts - first[:-1] - ORDER, sizes)
        places = np.ones(first[-1] + 1, bool)
        for j in range(ORDER):
            places[first[:-1] + j] = False
        places[-1] = False
        at = np.flatnonzero(places)
        letters[at] = W.LOWER[found.raw[at + inner]]
        runs = np.zeros(len(letters), np.uint64)
        for j in range(ORDER):
            runs[j:] |= letters[:len(letters) - j] << _U(8 * j)
        places[first[1:]] = len(sizes) > 0  # the end of each word is foretold too
        at = np.flatnonzero(places)
        self.runs = runs[at]
        self.owner = np.repeat(np.arange(len(sizes)), sizes + 1)


def _squeezed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed bytes, place by place, as high places are mostly zero."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize)
    return zstandard.compress(raw.T.tobytes(), 1)


def _spread(data: bytes, kind: np.dtype | type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(kind)


def _packed(runs: np.ndarray) -> bytes:
    return _squeezed(np.diff(runs, prepend=_U(0)))


def _unpacked(runs: bytes) -> np.ndarray:
    return np.cumsum(_spread(runs, np.uint64), dtype=np.uint64)


def _counted(runs: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return _unpacked(runs), _spread(counts, np.int32).reshape(-1, PARTS)


def _bucket_rows(runs: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Sorted distinct runs with their counts, packed by bucket."""
    bucket = (W.mix((runs >> _U(8)) & _U(_mask(MEET))) % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    present, first = np.unique(bucket[order], return_index=True)
    parts = np.split(order, first[1:])
    return pa.RecordBatch.from_pydict({
        "bucket": pa.array(present.astype(np.int32)),
        "runs": pa.array([_packed(runs[p]) for p in parts], pa.binary()),
        "counts": pa.array([_squeezed(counts[p].astype(np.int32).reshape(-1)) for p in parts], pa.binary())})


def _run_counts(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Distinct runs of ORDER letters in the words of all documents, and how often labelled parts hold each.

    A part is 2 * toxic + kept_back; documents without a label have none and count 0.
    """
    def passed_on(runs: np.ndarray, counts: np.ndarray, named: np.ndarray) -> pa.RecordBatch:
        rows = _bucket_rows(runs, counts, buckets)
        sampled = runs[W.mix(runs) % _U(SAMPLE) == 0]
        for name, found in (("short", named), ("sampled", sampled)):
            cells = [_packed(found)] + [None] * (rows.num_rows - 1) if rows.num_rows else []
            rows = rows.append_column(name, pa.array(cells, pa.binary()))
        return rows

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        seen = np.zeros(0, np.uint64)

        def unnamed(runs: np.ndarray) -> np.ndarray:
            nonlocal seen
            short = np.unique(runs & _U(_mask(MEET + 1)))
            short = short[~_find(seen, short)[1]]
            seen = np.sort(np.r_[seen, short])
            return short

        for batch in batches:
            for rows in W.slices(batch, "text", SLICE_BYTES):
                found = W.Words(rows.column("text"))
                spelled = Spelled(found)
                part = rows.column("part").fill_null(PARTS).to_numpy()[found.rows]
                n = np.bincount(spelled.word * (PARTS + 1) + part, minlength=len(spelled.times) * (PARTS + 1))
                held.append((spelled.runs, n.reshape(-1, PARTS + 1)[:, :PARTS].astype(np.int32)[spelled.owner]))
                if sum(len(runs) for runs, _ in held) > HELD_RUNS:
                    runs, counts = _summed(held)
                    held = [(runs, counts.astype(np.int32))]
                    del runs, counts
                    if len(held[0][0]) > HELD_RUNS // 2:
                        yield passed_on(*held[0], unnamed(held.pop()[0]))
        if held:
            runs, counts = _summed(held)
            yield passed_on(runs, counts, unnamed(runs))
    return count


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs in order with the sums of their counts."""
    runs, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.concatenate([p[1] for p in parts])
    return runs, np.stack([np.bincount(where, weights=c, minlength=len(runs)) for c in counts.T], 1).astype(np.int64)


def _with_parts(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The texts with the part of their id, from sorted ids and the part of each."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts = sent.value
        for batch in batches:
            wanted = batch.column("doc_id")
            at, known = _find(ids, wanted.fill_null(0).to_numpy(zero_copy_only=False))
            known &= wanted.is_valid().to_numpy(zero_copy_only=False)
            part = pa.array(parts[at].astype(np.int32), mask=~known)
            yield pa.RecordBatch.from_pydict({"text": batch.column("text"), "part": part})
    return add


def _named_runs(name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The runs packed in a column, as rows."""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column(name).drop_null():
                yield pa.RecordBatch.from_pydict({"run": pa.array(_unpacked(cell.as_py()).view(np.int64))})
    return runs


#: Distinct runs, for each task, of one letter more than the lowest orders have.
_short_runs = _named_runs("short")


def _cut(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packed counts, cut into more buckets."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for runs, counts in zip(batch.column("runs"), batch.column("counts")):
                yield _bucket_rows(*_counted(runs.as_py(), counts.as_py()), buckets)
    return cut


def _distinct_words(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The distinct words of a slice, lower-cased."""
    found = W.Words(batch.column("text"))
    _, at = np.unique(found.hashes(), return_index=True)
    starts, sizes = found.starts[at], found.ends[at] - found.starts[at]
    ends = np.cumsum(sizes)
    raw = W.LOWER[found.raw[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]]
    offsets = pa.py_buffer(np.r_[0, ends].astype(np.int32).tobytes())
    return pa.RecordBatch.from_pydict({
        "text": pa.StringArray.from_buffers(len(sizes), offsets, pa.py_buffer(raw.tobytes()))})


def _spellings(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(word, run) for each letter of each distinct word, the word as its hash."""
    found = W.Words(batch.column("text"))
    spelled = Spelled(found)
    words = np.zeros(len(spelled.times), np.uint64)
    words[spelled.word] = found.hashes()
    return pa.RecordBatch.from_pydict({"word": pa.array(words[spelled.owner].view(np.int64)),
                                       "run": pa.array(spelled.runs.view(np.int64))})


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted key in sorted keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _share(runs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own part of the chance of each distinct run after its context, and the weight of the backoff."""
    _, context = np.unique(runs >> _U(8), return_inverse=True)
    total = np.bincount(context, weights=n)[context]
    kinds = np.bincount(context, weights=n > 0)[context]
    known = np.maximum(total, 1)
    return (np.where(total > 0, np.maximum(n - DISCOUNT, 0) / known, 0),
            np.where(total > 0, DISCOUNT * kinds / known, 1))


def lowest(runs: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Chances of the last letters of distinct runs of MEET letters, counted by the letters before them."""
    if not len(runs):
        return np.zeros(0)
    levels = [(runs, n, np.zeros(0, np.int64))]
    for order in range(MEET - 1, 0, -1):
        below, where, count = np.unique(levels[-1][0] & _U(_mask(order)), return_inverse=True, return_counts=True)
        levels.append((below, count, where))
    chance = np.full(1, 1 / 256)
    for at, (level, count, _) in reversed(list(enumerate(levels))):
        own, weight = _share(level, count)
        rest = chance[levels[at + 1][2]] if at + 1 < len(levels) else chance
        chance = own + weight * rest
    return chance


def run_ratios(runs: np.ndarray, counts: np.ndarray, low_runs: np.ndarray, low_chances: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
    """Log ratios of the classes' chances for distinct runs: without and with the parts kept back.

    Holds all runs that share the MEET letters before the last of any of them.
    """
    levels, wheres = [(runs, None)], []
    for order in range(ORDER - 1, MEET, -1):
        below, where, count = np.unique(levels[-1][0] & _U(_mask(order)), return_inverse=True, return_counts=True)
        levels.append((below, count))
        wheres.append(where)
    chance = low_chances[_find(low_runs, levels[-1][0] & _U(_mask(MEET)))[0]]
    for level in range(len(levels) - 1, 1, -1):  # shared orders, from the lowest
        own, weight = _share(*levels[level])
        chance = (own + weight * chance)[wheres[level - 1]]
    below, where = levels[1][0], wheres[0]

    def class_chance(n: np.ndarray) -> np.ndarray:
        own, weight = _share(below, np.bincount(where, weights=n > 0, minlength=len(below)))
        low = (own + weight * chance)[where]
        own, weight = _share(runs, n)
        return own + weight * low
    fitted = np.log(class_chance(counts[:, 2]) / class_chance(counts[:, 0]))
    whole = np.log(class_chance(counts[:, 2] + counts[:, 3]) / class_chance(counts[:, 0] + counts[:, 1]))
    return fitted, whole


def _ratio_rows(low_runs, low_chances) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packed counts sorted by bucket to packed ratios, a bucket at a time."""
    def work(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        runs, counts = _summed(parts)
        found = run_ratios(runs, counts, low_runs.value, low_chances.value)
        some = np.flatnonzero((found[0] != 0) | (found[1] != 0))
        cells = [runs[some], *(r[some].astype(np.float32) for r in found)]
        return pa.RecordBatch.from_pydict({"n": [len(some)], **{
            name: pa.array([c.tobytes()], pa.binary()) for name, c in zip(("runs", "fitted", "whole"), cells)}})

    def ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, size, most = [], None, 0, HELD_RUNS
        for batch in batches:
            for bucket, runs, counts in zip(*(batch.column(n) for n in ("bucket", "runs", "counts"))):
                if held and bucket.as_py() != last:
                    yield work(held)
                    held, size, most = [], 0, HELD_RUNS
                last = bucket.as_py()
                held.append(_counted(runs.as_py(), counts.as_py()))
                size += len(held[-1][0])
                if size > most:
                    held = [_summed(held)]
                    size = len(held[0][0])
                    most = max(HELD_RUNS, 2 * size)
        if held:
            yield work(held)
    return ratios


def _ratio_cells(kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packed ratios as rows (run, ratio), in whole parts of UNIT."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for runs, ratios in zip(batch.column("runs"), batch.column(kind)):
                whole = np.round(np.frombuffer(ratios.as_py(), np.float32).astype(float) / UNIT)
                yield pa.RecordBatch.from_pydict({"run": np.frombuffer(runs.as_py(), np.int64),
                                                  "ratio": whole.astype(np.int64)})
    return cells


@dataclass
class Ratios:
    """Log ratios of runs, packed by bucket: `fitted` without the documents kept back and `whole` with them."""

    runs: DataFrame

    @classmethod
    def of(cls, steps: Steps, counts: DataFrame, buckets: int) -> Ratios:
        """From counts packed by `buckets`, which are cut where the distinct runs are too many for these."""
        spark = counts.sparkSession
        named = {n: counts.select(n).where(F.col(n).isNotNull()).mapInArrow(_named_runs(n), "run long").distinct()
                 for n in ("short", "sampled")}
        short = (named["short"]
                 .groupBy(F.col("run").bitwiseAND(_mask(MEET)).alias("run")).agg(F.count("*").alias("n"))).collect()
        runs = np.array([r["run"] for r in short], np.uint64)
        order = np.argsort(runs)
        runs, n = runs[order], np.array([r["n"] for r in short], np.int64)[order]
        low = spark.sparkContext.broadcast(runs), spark.sparkContext.broadcast(lowest(runs, n))
        counts = counts.select("bucket", "runs", "counts")
        wanted = named["sampled"].count() * SAMPLE // BUCKET_RUNS
        if wanted > buckets:
            counts = counts.mapInArrow(_cut(wanted), _COUNTS)
        return cls(steps.keep(counts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
            _ratio_rows(*low), _RATIOS)))

    def sorted_arrays(self, kind: str, size: int) -> tuple[np.ndarray, np.ndarray]:
        """All `size` runs and their ratios, fetched a partition at a time: the driver holds them about twice."""
        runs, ratios, at = np.empty(size, np.uint64), np.empty(size, np.float32), 0
        for row in self.runs.select("runs", F.col(kind).alias("ratios")).toLocalIterator():
            found = np.frombuffer(row["runs"], np.uint64)
            runs[at:at + len(found)] = found
            ratios[at:at + len(found)] = np.frombuffer(row["ratios"], np.float32)
            at += len(found)
        ratios = ratios[np.argsort(runs)]
        runs.sort()
        return runs, ratios

    def word_ratios(self, steps: Steps, docs: DataFrame, kind: str) -> DataFrame:
        """(word, ratio) of the distinct words of texts, the word as its hash; words without a ratio are left out.

        Every word shares its first runs with many, so those, which are few, are broadcast.
        """
        ratios = self.runs.mapInArrow(_ratio_cells(kind), "run long, ratio long").where("ratio <> 0")
        start = F.shiftrightunsigned("run", 8 * MEET) == 0
        spelled = steps.keep(_words(docs).mapInArrow(W.per_slice("text", _spellings, 500_000), "word long, run long"))
        found = spelled.where(start).join(F.broadcast(ratios.where(start)), "run").unionByName(
            spelled.where(~start).join(ratios.where(~start), "run"))
        return steps.keep(found.groupBy("word").agg((F.sum("ratio") * UNIT).cast("float").alias("ratio"))
                          .where("ratio <> 0"))


def _words(docs: DataFrame) -> DataFrame:
    return docs.select("text").mapInArrow(W.per_slice("text", _distinct_words), "text string").distinct()


@dataclass
class Model:
    """Ratios of runs, if there are labels of both kinds, and the weights of the features."""

    ratios: Ratios | None
    weights: np.ndarray
    base: float

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -30, 30)))


def by_runs(found: W.Words, runs: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """The ratio of each word: the sum over its letters; `runs` are sorted."""
    spelled = Spelled(found)
    distinct, where = np.unique(spelled.runs, return_inverse=True)
    at, seen = _find(runs, distinct)
    each = np.zeros(len(distinct))
    each[seen] = ratios[at[seen]]
    return np.bincount(spelled.owner, weights=each[where], minlength=len(spelled.times))[spelled.word]


def by_words(found: W.Words, words: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """The ratio of each word, found by its hash; `words` are sorted."""
    distinct, where = np.unique(found.hashes(), return_inverse=True)
    at, seen = _find(words, distinct)
    each = np.zeros(len(distinct))
    each[seen] = ratios[at[seen]]
    return each[where]


def features(column: pa.Array, word_ratios: Callable[[W.Words], np.ndarray]) -> np.ndarray:
    """A one, the mean ratio, the best mean of SPAN words, the best word, the logarithm of the
    length, and for each mark the excess by length and by its square root."""
    found = W.Words(column)
    out = np.zeros((len(column), FEATURES))
    out[:, 0] = 1
    if not len(found):
        return out
    ratios = word_ratios(found)
    sums = np.r_[0.0, np.cumsum(ratios)]
    first, counts = found.first, found.counts
    some = np.flatnonzero(counts)
    out[some, 1] = (sums[first[some + 1]] - sums[first[some]]) / counts[some]
    # A span is cut at the end of its document.
    stop = np.minimum(np.arange(len(found)) + SPAN, np.repeat(first[1:], counts))
    size = np.minimum(SPAN, np.repeat(counts, counts))
    spans = np.where(stop - np.arange(len(found)) == size, (sums[stop] - sums[:-1]) / size, -np.inf)
    out[some, 2] = np.maximum.reduceat(spans, first[some])
    out[some, 3] = np.maximum.reduceat(ratios, first[some])
    out[some, 4] = np.log(counts[some])
    for j, mark in enumerate(MARKS):
        over = np.add.reduceat(np.maximum(ratios - mark, 0), first[some])
        out[some, 5 + 2 * j] = over / counts[some]
        out[some, 6 + 2 * j] = over / np.sqrt(counts[some])
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; the first column of x is one."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    mean[0], scale[0] = 0, 1
    z, w = (x - mean) / scale, np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    w /= scale
    w[0] -= w[1:] @ mean[1:]
    return w


def _counts_by_part(texts: DataFrame, parts: DataFrame, labelled: int, buckets: int) -> DataFrame:
    """Packed counts of the texts' runs; `parts` has the part of each of the `labelled` ids."""
    count, kind = _run_counts(buckets), f"{_COUNTS}, {_NAMED}"
    whole = all(isinstance(frame.schema["doc_id"].dataType, IntegralType) for frame in (texts, parts))
    if not whole or labelled > SENT_LABELS:
        return texts.join(sent_if_small(parts), "doc_id", "left").select("text", "part").mapInArrow(count, kind)
    ids = F.col("doc_id").cast("long").alias("doc_id")
    found = parts.select(ids, F.col("part").cast("byte").alias("part")).toArrow()
    keys, values = (found.column(c).to_numpy() for c in ("doc_id", "part"))
    order = np.argsort(keys)
    add = _with_parts(texts.sparkSession.sparkContext.broadcast((keys[order], values[order])))
    return texts.select(ids, "text").mapInArrow(lambda batches: count(add(batches)), kind)


def remainder() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """The model, from all labels outside the held-out quarter and from all texts."""
    steps = Steps(docs.sparkSession, "toxicity")
    marked = steps.keep(labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
                        .where(remainder() != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    shares = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    base = shares.get(1, 0) / max(1, sum(shares.values()))
    if len(shares) < 2:
        return Model(None, np.zeros(FEATURES), base)
    part = (2 * F.col("toxic") + (remainder() == 3).cast("int")).cast("int").alias("part")
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES)
    counts = steps.keep(_counts_by_part(texts, marked.select("doc_id", part), sum(shares.values()), buckets))
    ratios = Ratios.of(steps, counts, buckets)
    sample = steps.keep(marked.where(remainder() == 3).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    # Texts of at most max_labelled ids.
    kept_back = steps.keep(texts.join(F.broadcast(sample), "doc_id").select("text", "toxic"))

    def work(batch: pa.RecordBatch, word_ratios: Callable[[W.Words], np.ndarray]) -> pa.RecordBatch:
        x = np.c_[features(batch.column("text"), word_ratios), batch.column("toxic").to_numpy(zero_copy_only=False)]
        return pa.RecordBatch.from_pydict({"x": pa.array([x.astype(np.float64).tobytes()], pa.binary())})

    width = FEATURES + 1
    rows = _with_ratios(kept_back, ratios, "fitted", work, "x binary").collect()
    found = np.concatenate([np.zeros((0, width)), *(np.frombuffer(r["x"]).reshape(-1, width) for r in rows)])
    found = found[np.lexsort(found.T)]  # the sums of the regression shall not follow the order of tasks
    return Model(ratios, logistic(found[:, :-1], found[:, -1]) if len(found) else np.zeros(FEATURES), base)


def _text_words(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The words of each text, with the key of the text."""
    found = W.Words(batch.column("text"))
    return pa.RecordBatch.from_pydict({"key": batch.column("key").take(pa.array(found.rows)),
                                       "word": pa.array(found.hashes().view(np.int64))})


def _with_ratios(docs: DataFrame, ratios: Ratios, kind: str, work: Callable[..., pa.RecordBatch], schema,
                 sent: int | None = None) -> DataFrame:
    """The documents by `work`, which gets a slice of them and a function from its words to their ratios."""
    runs = ratios.runs.agg(F.sum("n")).first()[0] or 0
    if runs <= (SENT_RUNS if sent is None else sent):
        shared = docs.sparkSession.sparkContext.broadcast(ratios.sorted_arrays(kind, runs))
        return docs.mapInArrow(W.per_slice(
            "text", lambda batch: work(batch, lambda found: by_runs(found, *shared.value)), SLICE_BYTES), schema)
    words = ratios.word_ratios(Steps(docs.sparkSession, "toxicity-words"), docs, kind)
    key = F.xxhash64("text").alias("key")
    found = (docs.select(key, "text").mapInArrow(W.per_slice("text", _text_words), "key long, word long").distinct()
             .join(words, "word").groupBy("key").agg(F.collect_list(F.struct("word", "ratio")).alias("found")))
    rows = docs.select(key, "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).join(
        found, "key", "left")

    def joined(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = batch.column("found").flatten()
        hashes, at = np.unique(pairs.field("word").to_numpy().view(np.uint64), return_index=True)
        each = pairs.field("ratio").to_numpy()[at]
        return work(pa.RecordBatch.from_struct_array(batch.column("row")),
                    lambda found: by_words(found, hashes, each))
    return rows.select("row", "text", "found").mapInArrow(W.per_slice("text", joined), schema)


def scores(docs: DataFrame, model: Model, sent: int | None = None) -> DataFrame:
    """The documents with `score`; a column of that name is replaced."""
    docs = docs.drop("score")
    if not model.weights.any():
        return docs.withColumn("score", F.lit(float(model.base)))
    judge = Model(None, model.weights, model.base)

    def work(batch: pa.RecordBatch, word_ratios: Callable[[W.Words], np.ndarray]) -> pa.RecordBatch:
        found = judge.score(features(batch.column("text"), word_ratios))
        return pa.RecordBatch.from_pydict({**{n: batch.column(n) for n in batch.schema.names},
                                           "score": pa.array(found)})
    return _with_ratios(docs, model.ratios, "whole", work, docs.withColumn("score", F.lit(0.0)).schema, sent)
