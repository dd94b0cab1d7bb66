"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' words are numbered and put into one automaton (a state stands for all
runs of words that end at the same places of the items). The words of a document
are streamed through it; the matching length after each word is the longest run
ending there that any item contains. A run of `window` words is hit where that
length reaches `window`; an item of fewer words is hit where it occurs whole.

Items are put into blocks of about `BLOCK_WORDS` words by a hash of their text,
so an automaton has a bounded size; each block is met by all documents in a pass
of its own. Only parts of a document that can hold a match are streamed: runs of
words all of whose neighbouring pairs occur in the items.

Nulls: a null text has no words; a null item id is hit like any other and counts
as no item. Rows that repeat are answered row by row; an empty item table hits
nothing. Other columns of the documents are kept as they are, also when they
are called like a column made here, which is then replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.columns import packed, unpacked
from tidemark.sources import work_dir

WINDOW = 10
#: Words of items in one automaton: two states a word, about 500 bytes each.
BLOCK_WORDS = 150_000
#: Bytes of text that are worked on at once.
SLICE_BYTES = 500_000


class Automaton:
    """Suffix automaton of several sequences of word numbers."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, parent: int, word: int) -> int:
        """The state reached from `parent`, made to hold no longer run than that."""
        target = self.next[parent][word]
        if self.length[target] == self.length[parent] + 1:
            return target
        clone = self._state(self.length[parent] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = clone
        while parent >= 0 and self.next[parent].get(word) == target:
            self.next[parent][word] = clone
            parent = self.link[parent]
        return clone

    def add(self, sequence: list[int]) -> None:
        last = 0
        for word in sequence:
            if word in self.next[last]:
                last = self._split(last, word)
                continue
            at, new = last, self._state(self.length[last] + 1, {}, 0)
            while at >= 0 and word not in self.next[at]:
                self.next[at][word] = new
                at = self.link[at]
            if at >= 0:
                self.link[new] = self._split(at, word)
            last = new

    def stream(self, sequence: list[int]) -> Iterator[tuple[int, int]]:
        """State and matching length after each word."""
        state = length = 0
        for word in sequence:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(word, 0)
            length = length + 1 if state else 0
            yield state, length

    def shorten(self, state: int, length: int) -> int:
        """The state of the last `length` words of a match in `state`."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state


class Items:
    """The automaton of a block of items, with the items that each window belongs to."""

    def __init__(self, rows: list[tuple[str | None, list[int]]], window: int):
        self.window = window
        sequences = [(i, np.array(h, np.int64).view(np.uint64)) for i, h in rows if h]
        self.vocabulary = np.unique(np.concatenate([h for _, h in sequences])) if sequences else np.zeros(0, np.uint64)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.vocabulary & np.uint64((1 << 20) - 1)] = True
        self.least = min([window, *(len(h) for _, h in sequences)])
        self.automaton = Automaton()
        numbered = [(i, np.searchsorted(self.vocabulary, h)) for i, h in sequences]
        pairs = [n[:-1] * len(self.vocabulary) + n[1:] for _, n in numbered]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        for _, numbers in numbered:
            self.automaton.add(numbers.tolist())
        #: State of a window: (length, items).
        self.windows: dict[int, dict[int, set]] = {}
        for item, numbers in numbered:
            size = min(window, len(numbers))
            for state, length in self.automaton.stream(numbers.tolist()):
                if length >= size:
                    at = self.automaton.shorten(state, size)
                    self.windows.setdefault(at, {}).setdefault(size, set()).add(item)
        self.sizes = sorted({size for x in self.windows.values() for size in x})

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, -1 for one that no item has."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.seen[hashes & np.uint64((1 << 20) - 1)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
            same = self.vocabulary[at] == hashes[maybe]
            out[maybe[same]] = at[same]
        return out

    def runs(self, numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of words in which a window can lie."""
        known = numbers >= 0
        joined = np.zeros(len(numbers) + 1, bool)  # joined[i]: words i-1 and i are neighbours in an item
        if len(numbers) > 1 and len(self.pairs):
            at = np.flatnonzero(known[:-1] & known[1:])
            codes = numbers[at] * len(self.vocabulary) + numbers[at + 1]
            place = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
            joined[at[self.pairs[place] == codes] + 1] = True
            joined[first] = False
        starts = np.flatnonzero(known & ~joined[:-1])
        ends = np.flatnonzero(known & ~joined[1:]) + 1
        long = ends - starts >= self.least
        return starts[long], ends[long]

    def hits(self, numbers: list[int]) -> Iterator[tuple[int, int, set]]:
        """(start, end, items) of every window in a run of words."""
        for i, (state, length) in enumerate(self.automaton.stream(numbers)):
            for size in self.sizes:
                if size > length:
                    break
                at = self.automaton.shorten(state, size)
                if found := self.windows.get(at, {}).get(size):
                    yield i + 1 - size, i + 1, found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _matching(items, finish: Callable[[W.Words, pa.RecordBatch], pa.RecordBatch] | None = None):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        index: Items = items.value
        found = W.Words(batch.column("text"))
        numbers = index.numbers(found.hashes())
        spans = [[(s["start"], s["end"]) for s in x] for x in batch.column("spans").to_pylist()]
        ids = [set(x) for x in batch.column("items").to_pylist()]
        starts, ends = index.runs(numbers, found.first)
        rows = np.searchsorted(found.first, starts, "right") - 1
        for a, b, row in zip(starts.tolist(), ends.tolist(), rows.tolist()):
            base = a - int(found.first[row])
            for s, e, which in index.hits(numbers[a:b].tolist()):
                spans[row].append((base + s, base + e))
                ids[row] |= which
        columns = {n: batch.column(n) for n in batch.schema.names}
        columns["n_words"] = pa.array(found.counts)
        columns["spans"] = pa.array([[{"start": a, "end": b} for a, b in merged(x)] for x in spans],
                                       pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
        columns["items"] = pa.array([sorted(x - {None}) for x in ids], pa.list_(pa.string()))
        out = pa.RecordBatch.from_pydict(columns)
        return finish(found, out) if finish else out
    return W.per_slice("text", work, SLICE_BYTES)


def _item_words(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = W.Words(batch.column("text"))
    return pa.RecordBatch.from_pydict({
        "item": batch.column("item"),
        "words": W.list_column(found.hashes().view(np.int64), found.first)})


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW,
            block_words: int = BLOCK_WORDS,
            finish: Callable[[W.Words, pa.RecordBatch], pa.RecordBatch] | None = None) -> DataFrame:
    """Documents with their number of words, hit spans of words and hit items.

    `items` has `item_id` and `text`; `docs` has `text`. Adds `n_words`, `spans`
    (word numbers, end exclusive, apart from each other) and `items` (sorted ids).
    `finish` gets the words and rows of each slice in the last pass and returns rows
    of the same columns: a task has one Python worker then, not one for each step.
    """
    spark = docs.sparkSession
    worded = (items.select(F.col("item_id").cast("string").alias("item"), "text")
              .mapInArrow(W.per_slice("text", _item_words), "item string, words array<long>"))
    total = worded.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = -(-total // block_words) or 1
    out = (docs.drop("n_words").withColumn("spans", F.array().cast("array<struct<start:int,end:int>>"))
           .withColumn("items", F.array().cast("array<string>")))
    for block in range(blocks):
        rows = worded.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast(Items([(r["item"], r["words"]) for r in rows], window))
        schema = (out.drop("n_words").withColumn("n_words", F.lit(0).cast("long")).schema)
        out = out.drop("n_words").withColumn("n_words", F.lit(0).cast("long")).mapInArrow(
            _matching(shared, finish if block + 1 == blocks else None), schema)
        if block + 1 < blocks:  # else every block's automaton would be held at once
            path = work_dir(spark, "decontamination")
            out.write.parquet(path)
            out = spark.read.parquet(path)
    return out


def digest(matched: DataFrame) -> DataFrame:
    """Counts and the digest of the hit items of each document."""
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return matched.select(
        "doc_id", "n_words", length.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (length > 0).alias("contaminated"))


def _cleaning(min_words: int) -> Callable[[W.Words, pa.RecordBatch], pa.RecordBatch]:
    """Takes the spans of at least `min_words` words out of the texts."""
    def clean(found: W.Words, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for row, spans in enumerate(batch.column("spans").to_pylist()):
            a, b = found.offsets[row], found.offsets[row + 1]
            spans = [s for s in spans if s["end"] - s["start"] >= min_words]
            if not spans:
                texts.append(batch.column("text")[row].as_py())
                continue
            parts, at, base = [], a, found.first[row]
            for s in spans:
                parts.append(found.raw[at:found.starts[base + s["start"]]].tobytes())
                at = found.ends[base + s["end"] - 1]
            parts.append(found.raw[at:b].tobytes())
            texts.append(b"".join(parts).decode().strip())
        columns = {n: batch.column(n) for n in batch.schema.names}
        columns["text"] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_pydict(columns)
    return clean


def remove_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                 min_words: int = 1, max_coverage: float = 0.5) -> DataFrame:
    """Documents without the spans of at least `min_words` hit words.

    A document of which more than `max_coverage` of the words are hit goes as a
    whole. `n_chars`, if there, is counted anew where a text changed. A document
    without a hit stays as it is.
    """
    found = matches(packed(docs), items, window, finish=_cleaning(min_words))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    kept = found.where((hit == 0) | (hit <= F.col("n_words") * max_coverage))
    return unpacked(kept, docs, F.exists("spans", lambda s: s["end"] - s["start"] >= min_words))
