"""Exact token counts of whole texts with a byte-level BPE vocabulary file.

A document of at most `CHUNK` characters is encoded whole. A longer one is
encoded in overlapping chunks with offsets. Two chunks are spliced at a stable
common boundary: a place in the overlap where a pre-token starts in both
encodings, at least `MARGIN` characters and one whole pre-token before the end
of the first. Up to there the first chunk has seen all that decides its tokens
(the pre-tokeniser and the search for special strings look ahead, never back),
and from there on the second one reads the same characters from a start, so the
tokens of the whole text are those of the first before it and of the second
after it. Where the overlap has no such place it is doubled, until the two
chunks have become one.

Chunks and whole texts are encoded by the library. Texts are long sequences of
few distinct pieces, so a piece between two spaces that stand alone (a place
where a pre-token starts whatever is around) is encoded once for each worker.

A null text is empty and has no tokens. Repeated rows are answered row by row;
other columns are not read.
"""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W

CHUNK = 32_768
OVERLAP = 512
#: Characters of the longest special string a vocabulary may have, at least.
MARGIN = 64
#: Pieces a worker remembers; a full memory starts anew.
REMEMBERED = 1_000_000

_UNSTABLE = 1 << 40
#: Not white space to Python, but perhaps to a tokeniser.
_DOUBTFUL = "᠎​﻿"


def stable_end(piece: str) -> bool:
    """Whether a space beside the piece, and alone there, starts a pre-token."""
    return bool(piece) and not (piece[0].isspace() or piece[-1].isspace()
                                or piece[0] in _DOUBTFUL or piece[-1] in _DOUBTFUL)


class Counter:
    """Token counts with one vocabulary file."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap = chunk, overlap
        self.margin = max([MARGIN, *(len(t.content) for t in
                                     self.tokenizer.get_added_tokens_decoder().values())])
        self.heads: dict[str, int] = {}
        self.inner: dict[str, int] = {}

        self.newline, self.stop = self._encode(["\n", "."])

    def _encode(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, memory: dict[str, int], before: str, pieces: set[str]) -> None:
        """Counts of new pieces as they stand behind `before`."""
        new = [p for p in pieces if p not in memory]
        if len(memory) + len(new) > REMEMBERED:
            memory.clear()
            new = list(pieces)
        # A stop or comma behind an ASCII letter is a pre-token of its own at the end of a piece.
        bare = {p: p[:-1] if p[-1:] in (".", ",") and p[-2:-1].isascii() and p[-2:-1].isalpha() else p
                for p in new}
        roots = [p for p in set(bare.values()) if p not in memory]
        for p, n in zip(roots, self._encode([before + p for p in roots])):
            memory[p] = n if stable_end(p) else _UNSTABLE
        for p, root in bare.items():
            if p is not root:
                memory[p] = memory[root] + self.stop

    def whole(self, texts: list[str]) -> list[int]:
        """Counts of whole texts, each piece of which is encoded once."""
        lines = [[line.split(" ") for line in text.split("\n")] for text in texts]
        self._learn(self.heads, "", {pieces[0] for cut in lines for pieces in cut})
        self._learn(self.inner, " ", set().union(*(pieces[1:] for cut in lines for pieces in cut)))
        head, inner = self.heads.__getitem__, self.inner.__getitem__
        out = [sum(head(p[0]) + sum(map(inner, p[1:])) for p in cut) + (len(cut) - 1) * self.newline
               for cut in lines]
        return [n if n < _UNSTABLE else self._merged(text) for n, text in zip(out, texts)]

    def _merged(self, text: str) -> int:
        """Count of a text in which spaces meet: encoded in parts cut at the stable ones."""
        pieces = text.split(" ")
        fine = list(map(stable_end, pieces))
        parts, at = [], 0
        for i in range(1, len(pieces)):
            if fine[i - 1] and fine[i] and "\n" not in pieces[i]:
                parts.append((" " if at else "") + " ".join(pieces[at:i]))
                at = i
        parts.append((" " if at else "") + " ".join(pieces[at:]))
        return sum(self._encode(parts))

    def _starts(self, text: str) -> tuple[dict[int, int], int, int]:
        """Where pre-tokens start, with the tokens before each; all tokens; the last start."""
        encoded = self.tokenizer.encode(text, add_special_tokens=False)
        starts, last = {}, None
        for i, (word, (a, _)) in enumerate(zip(encoded.word_ids, encoded.offsets)):
            if word != last:
                starts[a] = i
                last = word
        return starts, len(encoded.ids), max(starts, default=0)

    def spliced(self, text: str) -> int:
        """Count of a long text from overlapping chunks."""
        total, begin, skipped = 0, 0, 0  # skipped: tokens of this chunk that the one before has counted
        end = min(len(text), begin + self.chunk)
        starts, tokens, last = self._starts(text[begin:end])
        while end < len(text):
            overlap = self.overlap
            while True:
                after = max(begin + 1, end - overlap)
                stop = min(len(text), after + self.chunk + overlap)
                if after == begin + 1:  # nothing to share: the two become one
                    end = stop
                    starts, tokens, last = self._starts(text[begin:end])
                    break
                following = self._starts(text[after:stop])
                limit = min(end - begin - self.margin, last)
                common = next((a for a in sorted(starts) if a > after - begin and a < limit
                               and a - (after - begin) in following[0]), None)
                if common is None:
                    overlap *= 2
                    continue
                total += starts[common] - skipped
                skipped = following[0][common - (after - begin)]
                begin, end, (starts, tokens, last) = after, stop, following
                break
        return total + tokens - skipped

    def counts(self, texts: list[str]) -> list[int]:
        short = iter(self.whole([t for t in texts if len(t) <= self.chunk]))
        return [next(short) if len(t) <= self.chunk else self.spliced(t) for t in texts]


_counters: dict[tuple, Counter] = {}


def counter(file: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Counter:
    """The process's counter for a vocabulary file of the installed tokenisers."""
    if (file, chunk, overlap) not in _counters:
        import public_tokenizers
        path = file if os.path.isabs(file) else public_tokenizers.path(file)
        _counters[file, chunk, overlap] = Counter(path, chunk, overlap)
    return _counters[file, chunk, overlap]


def token_counts(docs: DataFrame, file: str = "byte_bpe_50k.json", limit: int = 512,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Bytes and tokens of each document, and whether it has more than `limit` tokens."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(batch.column("text"), "")
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"),
            "n_bytes": pc.binary_length(texts).cast(pa.int64()),
            "n_tokens": pa.array(counter(file, chunk, overlap).counts(texts.to_pylist()), pa.int64())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(
        W.per_slice("text", work), f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
