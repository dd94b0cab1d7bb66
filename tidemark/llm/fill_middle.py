"""Fill-in-the-middle texts, cut at units found in 64-bit words of the UTF-8 bytes.

A unit is a run of white space with the run of other characters behind it; what
white space ends a text is a unit too. So a unit ends with a byte that is no
white space and stands before white space, and with the last byte of a text.
Eight bytes at a time, viewed as one uint64, are tested by arithmetic, which
leaves bit 7 of every byte that ends a unit. Counting the bits of each word and
summing them up gives the word that holds a given unit's end by binary search;
the end within that word is the r-th bit that is set in it.

Order and draws follow from the id alone, so reruns and lost tasks change nothing.

* A null text is empty; an empty text, and one that contains a sentinel, stays as it is.
* A null id is drawn as if its digits were missing; rows of one id have the same draws.
* Texts of any length are cut whole; a long text is a slice of its own.
* Repeated rows give repeated rows, an empty table an empty one. Columns other
  than id and text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import column_bytes, slices

#: Bytes of text that are worked on at once.
SLICE_BYTES = 4_000_000

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass(frozen=True)
class Rates:
    """Seed of the draws, and the shares of texts that are rearranged and of those led by the suffix."""

    seed: int = 42
    rearranged: int = 50
    suffix_first: int = 80


def _repeated(byte: int) -> np.uint64:
    return np.uint64(int.from_bytes(bytes([byte]) * 8, "little"))


_TOP, _LOW = _repeated(0x80), _repeated(0x7F)
_SPACES, _FROM_TAB, _FROM_SO = _repeated(0x20), _repeated(0x80 - 0x09), _repeated(0x80 - 0x0E)
_ONE, _SEVEN, _EIGHT = np.uint64(1), np.uint64(7), np.uint64(8)


def as_words(raw: np.ndarray) -> np.ndarray:
    """Bytes as little-endian uint64, with at least one byte of zeros behind them."""
    whole = np.zeros((len(raw) // 8 + 1) * 8, np.uint8)
    whole[:len(raw)] = raw
    return whole.view("<u8")


def space_bits(words: np.ndarray) -> np.ndarray:
    """Bit 7 of every byte that is 0x20 or 0x09 to 0x0D; no sum carries into the next byte."""
    other = words ^ _SPACES
    equal = ~(((other & _LOW) + _LOW) | other)
    low = words & _LOW
    between = (low + _FROM_TAB) & ~(low + _FROM_SO) & ~words
    return (equal | between) & _TOP


def end_bits(words: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Bit 7 of every byte that ends a unit; `last` are the places of the last bytes of texts."""
    space = space_bits(words)
    after = space >> _EIGHT
    after[:-1] |= space[1:] << np.uint64(56)
    ends = ~space & after & _TOP
    ends.view(np.uint8)[last] = 0x80
    return ends


def head_bits(words: np.ndarray) -> np.ndarray:
    """Bit 7 of every byte that starts a code point."""
    return (~words | (words << _ONE)) & _TOP


class Marks:
    """Marked bytes, counted by word: how many stand before a place, and where the i-th stands."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.upto = np.cumsum(np.bitwise_count(bits), dtype=np.int64)

    def before(self, places: np.ndarray) -> np.ndarray:
        word = places >> 3
        below = (_ONE << ((places & 7).astype(np.uint64) * _EIGHT)) - _ONE
        inside = self.bits[word]
        return self.upto[word] - np.bitwise_count(inside) + np.bitwise_count(inside & below)

    def select(self, numbers: np.ndarray) -> np.ndarray:
        """Places of the marks with these numbers, from 1."""
        word = np.searchsorted(self.upto, numbers)
        bits = self.bits[word]
        ahead = numbers - (self.upto[word] - np.bitwise_count(bits)) - 1
        for step in range(int(ahead.max(initial=0))):
            bits = np.where(ahead > step, bits & (bits - _ONE), bits)
        lowest = bits & (~bits + _ONE)
        return word * 8 + (np.bitwise_count(lowest - _ONE) >> 3)


class Units:
    """Units of a column of texts: how many each row has, and the byte at which the first k of them end."""

    def __init__(self, column: pa.Array):
        self.raw, self.offsets = column_bytes(column)
        words = as_words(self.raw)
        starts, ends = self.offsets[:-1], self.offsets[1:]
        self._ends = Marks(end_bits(words, ends[ends > starts] - 1))
        self._heads = Marks(head_bits(words))
        self._base = self._ends.before(starts)
        self.counts = self._ends.before(ends) - self._base

    def cut(self, k: np.ndarray) -> np.ndarray:
        """The byte behind the first k[i] units of row i."""
        at = self.offsets[:-1].copy()
        some = np.flatnonzero(k > 0)
        at[some] = self._ends.select(self._base[some] + k[some]) + 1
        return at

    def characters(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self._heads.before(ends) - self._heads.before(starts)


def _draw(key: Column, i: int) -> Column:
    return F.conv(F.substring(key, 8 * i + 1, 8), 16, 10).cast("long")


def rearranged(docs: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and `output`, the text as trained on.

    The prefix is the first min(h1, h2) units and the middle reaches to the
    greater of them, both modulo n + 1. The form is plain, psm (prefix, suffix,
    middle) or spm (suffix, prefix, middle).
    """
    text = F.coalesce("text", F.lit(""))
    digits = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    key = F.sha2(F.concat(F.lit(f"{rates.seed}:"), digits), 256)
    kept = (text == "") | F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(
        text, F.lit(MIDDLE)) | (_draw(key, 2) % 100 >= rates.rearranged)
    form = F.when(kept, "plain").when(_draw(key, 3) % 100 < rates.suffix_first, "spm").otherwise("psm")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", text.alias("text"), form.alias("form"), _draw(key, 0).alias("h1"),
                        _draw(key, 1).alias("h2"))
            .mapInArrow(_rearrange, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, "
                                    "output binary")
            .withColumn("output", F.col("output").cast("string")))


def _rearrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    p, s, m = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            units = Units(part.column("text"))
            draws = np.stack([part.column(c).to_numpy() for c in ("h1", "h2")]) % (units.counts + 1)
            first, second = units.cut(draws.min(0)), units.cut(draws.max(0))
            starts, ends = units.offsets[:-1], units.offsets[1:]
            raw, outputs = memoryview(units.raw), []
            forms = part.column("form").to_pylist()
            for form, a, b, c, d in zip(forms, starts.tolist(), first.tolist(), second.tolist(), ends.tolist()):
                if form == "plain":
                    outputs.append(bytes(raw[a:d]))
                elif form == "psm":
                    outputs.append(b"".join((p, raw[a:b], s, raw[c:d], m, raw[b:c])))
                else:
                    outputs.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c])))
            plain = np.array([form == "plain" for form in forms], bool)
            yield pa.record_batch({
                "doc_id": part.column("doc_id"),
                "n": pa.array(units.counts),
                "form": part.column("form"),
                "prefix_chars": pa.array(units.characters(starts, first), mask=plain),
                "middle_chars": pa.array(units.characters(first, second), mask=plain),
                "output": pa.array(outputs, pa.binary()),
            })


def restored(output: Column, form: Column) -> Column:
    """The text that was rearranged, from its output and form alone.

    A rearranged text holds no sentinel, and none can arise where a piece meets
    one, so each sentinel stands once in the output.
    """
    pieces = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    first, second, last = (F.get(pieces, F.lit(i)) for i in (1, 2, 3))
    return (F.when(form == "plain", output).when(form == "psm", F.concat(first, last, second))
            .otherwise(F.concat(second, last, first)))


def digest(frame: DataFrame) -> DataFrame:
    """Counts with hashes of the output and of the text rebuilt from it."""
    return frame.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


_SPACE = r"\x20\x09-\x0D"

ORACLE = rf"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+') AS u,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents
), draws AS (
  SELECT *, len(u) AS n,
    ('0x' || substr(k, 1, 8))::UBIGINT % (len(u) + 1) AS d1, ('0x' || substr(k, 9, 8))::UBIGINT % (len(u) + 1) AS d2,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR ('0x' || substr(k, 17, 8))::UBIGINT % 100 >= 50 THEN 'plain'
         WHEN ('0x' || substr(k, 25, 8))::UBIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), parts AS (
  SELECT doc_id, n, form, text, array_to_string(u[1:least(d1, d2)::BIGINT], '') AS prefix,
    array_to_string(u[(least(d1, d2) + 1)::BIGINT:greatest(d1, d2)::BIGINT], '') AS middle,
    array_to_string(u[(greatest(d1, d2) + 1)::BIGINT:n], '') AS suffix
  FROM draws
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(prefix || middle || suffix) AS restored_sha256
FROM parts
"""
