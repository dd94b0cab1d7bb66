"""Fill-in-the-middle texts against regular expressions."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fill_middle as M
from tidemark.llm.queries import ORACLES
from tidemark.llm.shipping import ship

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = [None, "", " ", "\n\t", "a", " a ", "a b", "über  naïve text 日本語 x\x0b\x0cy\x1f\x85 z ", "x" * 4000,
       "one <P> two", "<S>", "tail <M", "<", "P>", "a\x00b c", "𝒳 😀😀 \r\n😀"]


def texts(n=200):
    rng = random.Random(9)
    letters = "ab é日😀\t\n \x08\x0e\x0d\x20\x7f <>PSM"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def expected(doc_id, text, rates=M.Rates()):
    text = text or ""
    units = UNIT.findall(text)
    key = hashlib.sha256(f"{rates.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(p) for p in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rates.rearranged:
        return doc_id, len(units), "plain", None, None, text
    spm = h[3] % 100 < rates.suffix_first
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, len(units), "spm" if spm else "psm", len(prefix), len(middle), output


def test_units_of_bytes():
    rows = texts()
    units = M.Units(pa.array(rows))
    want = [UNIT.findall(t or "") for t in rows]
    assert units.counts.tolist() == [len(u) for u in want]
    for k in range(6):
        at = units.cut(np.array([min(k, len(u)) for u in want]))
        assert (at - units.offsets[:-1]).tolist() == [len("".join(u[:k]).encode()) for u in want]
    ends = units.cut(units.counts)
    assert units.characters(units.offsets[:-1], ends).tolist() == [len(t or "") for t in rows]


def test_every_byte_class():
    raw = np.arange(256, dtype=np.uint8).repeat(3)
    found = np.flatnonzero(M.space_bits(M.as_words(raw)).view(np.uint8)[:len(raw)])
    assert set(raw[found].tolist()) == {0x20, *range(0x09, 0x0E)} and len(found) == 18


@pytest.mark.parametrize("rates", [M.Rates(), M.Rates(7, 100, 30)])
def test_rearranged(spark, rates):
    ship(spark)
    rows = [(i, t, f"o{i}") for i, t in enumerate(texts())]
    rows += [(None, "no id at all", "x"), rows[20], rows[20], (20, "same id, other text", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string").repartition(3)
    frame = M.rearranged(docs, rates).withColumn("back", M.restored(F.col("output"), F.col("form")))
    found = [tuple(r) for r in frame.collect()]
    want = [(*expected(i, t, rates), t or "") for i, t, _ in rows]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}


def test_long_text_and_text_ids(spark, monkeypatch):
    ship(spark)
    long = " ".join(f"wört{i}" for i in range(400_000))
    rows = [(f"id{i}", t) for i, t in enumerate([long, "a b c", long + " ", ""])]
    found = [tuple(r) for r in M.rearranged(spark.createDataFrame(rows, "doc_id string, text string"),
                                            M.Rates(rearranged=100)).collect()]
    assert sorted(found) == sorted(expected(i, t, M.Rates(rearranged=100)) for i, t in rows)


def test_query_equals_sql(spark):
    ship(spark)
    rows = [(i, t) for i, t in enumerate(texts()) if "\x00" not in (t or "")] + [(None, "a b"), (3, "c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in M.digest(M.rearranged(docs)).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(found, key=repr) == sorted(con.execute(ORACLES["op12_fill_middle"]).fetchall(), key=repr)
    assert all(r[6] == hashlib.sha256((rows[i][1] or "").encode()).hexdigest()
               for r in found for i in [r[0]] if i is not None and i > 3 and i < 10)


def test_empty_table(spark):
    ship(spark)
    frame = M.digest(M.rearranged(spark.createDataFrame([], "doc_id long, text string")))
    assert frame.collect() == [] and frame.columns[:3] == ["doc_id", "n", "form"]
