"""Archives read back whole, and past every kind of damage."""

import gzip
import hashlib
import io
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc as M
from tidemark.llm.queries import ORACLES
from tidemark.llm.shipping import ship

DATE = "2026-01-01T00:00:00Z"
SCHEMA = "page_id long, url string, html string, file string, offset int"


def members(n=12, packed=True, seed=1):
    rng = random.Random(seed)
    records = [M.capture(DATE, str(i), f"http://h/{i}", rng.randbytes(rng.randint(0, 3000)), None, None)
               for i in range(n)]
    return [gzip.compress(r, 6, mtime=0) if packed else r for r in records]


def found_in(data):
    return list(M.salvage(M.Source(io.BytesIO(data), len(data))))


def ids(found):
    return [f.fields["source-id"] for f in found if f.fault is None]


def covered(found, data):
    at = 0
    for f in found:
        assert f.offset == at
        at += f.length
    assert at == len(data)


@pytest.mark.parametrize("packed", [True, False])
def test_sound_archive(packed, monkeypatch):
    parts = members(packed=packed)
    for piece in (64, 1 << 20):
        monkeypatch.setattr(M, "READ_BYTES", piece)
        found = found_in(b"".join(parts))
        assert ids(found) == [str(i) for i in range(12)] and [f.length for f in found] == [len(p) for p in parts]


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("seed", range(6))
def test_changed_bytes_lose_only_their_records(packed, seed, monkeypatch):
    monkeypatch.setattr(M, "READ_BYTES", 512)
    parts, rng = members(packed=packed, seed=seed), random.Random(seed)
    hit = sorted(rng.sample(range(12), 3))
    for i in hit:
        part = bytearray(parts[i])
        part[rng.randrange(len(part) // 2, len(part) - 9)] ^= 0x55
        parts[i] = bytes(part)
    found = found_in(b"".join(parts))
    assert ids(found) == [str(i) for i in range(12) if i not in hit]
    covered(found, b"".join(parts))
    lost = {i: sum(map(len, parts[:i])) for i in hit}
    gaps = [(f.offset, f.offset + f.length) for f in found if f.fault]
    assert all(any(a <= at < b for a, b in gaps) for at in lost.values())
    assert sum(b - a for a, b in gaps) == sum(len(parts[i]) for i in hit)


@pytest.mark.parametrize("packed", [True, False])
def test_cut_joined_and_foreign_bytes(packed):
    a, b, c, d = members(4, packed)
    data = a[:-20] + b + b"\x1f\x8b\x08 not a member WARC/1.x" + c + gzip.compress(b"no record") + d[:len(d) // 2]
    found = found_in(data)
    assert ids(found) == ["1", "2"]
    covered(found, data)
    assert len([f for f in found if f.fault]) == 3
    assert found_in(b"") == [] and [f.length for f in found_in(b"junk")] == [4]


def test_wrong_length_and_digest_are_quarantined():
    good = M.capture(DATE, "1", None, b"<p>text</p>", None, None)
    bad = [good.replace(b"<p>text</p>", b"<p>tEXt</p>"), good.replace(b"Content-Length: 11", b"Content-Length: 9"),
           good.replace(b"WARC-Type", b"WARC-Tipe"), good.replace(b"WARC/1.1", b"WARC/9.1")]
    for record in bad:
        found = found_in(record + good)
        assert [f.fault is None for f in found] == [False, True] and found[0].length == len(record)


def test_several_records_of_a_member_and_folded_fields():
    a, b = members(2, False)
    a = a.replace(b"WARC-Date: ", b"WARC-Date:\r\n  ")
    found = found_in(gzip.compress(a + b))
    assert ids(found) == ["0", "1"] and found[0].fields["warc-date"] == DATE


def test_record_within_a_payload_is_not_read_from_a_sound_one():
    inner = M.capture(DATE, "inner", None, b"x", None, None)
    outer = M.capture(DATE, "outer", None, inner, None, None)
    assert ids(found_in(outer)) == ["outer"]


def pages(n=60):
    rng = random.Random(2)
    rows = [(i, f"http://h{i % 3}/a b\r\n{i}", f"<p>{rng.randint(0, 9)} é</p>" * (1 + i % 4), "f", 1) for i in range(n)]
    rows += [(100 + i, None, None, "f", 1) for i in range(3)] + [(99, "u", "", None, None)]
    rows += [(None, "u", "<b>no id</b>", "", 2), (None, None, rows[5][2], "", 2), (300, "long", "word " * 200_000, "", 0)]
    return rows + [rows[7], (7, "u", "<i>same id, other page</i>", "", 0)] + [(400 + i, "c", "copy", "", 0) for i in range(99)]


def key(row):
    return repr(tuple(row))


@pytest.mark.parametrize("limit", [1, 4000, 1 << 28])
def test_round_trip(spark, limit):
    ship(spark)
    rows = pages()
    records = M.archived(spark.createDataFrame(rows, SCHEMA).repartition(4), archive_bytes=limit).cache()
    assert records.where("fault IS NOT NULL").count() == 0
    least = {}
    for i, _, html, *_ in rows:
        if i is not None:
            least[html or ""] = min(least.get(html or "", i), i)
    want = [(i, len((h or "").encode()), M.sha1_base32((h or "").encode()),
             "response" if i == least.get(h or "") else "revisit",
             None if i == least.get(h or "") else least.get(h or "")) for i, _, h, *_ in rows]
    found = M.digest(records).collect()
    assert sorted(map(key, found)) == sorted(map(key, want))
    stored = {r["sha"]: r["n"] for r in records.where("record_type = 'response'").groupBy(
        F.sha1("payload").alias("sha")).agg(F.count("*").alias("n")).collect()}
    texts = {(h or "") for _, _, h, *_ in rows}
    assert set(stored) == {hashlib.sha1(t.encode()).hexdigest() for t in texts}
    answers = {r["record_id"] for r in records.where("record_type = 'response'").collect()}
    assert {r["fields"]["warc-refers-to"] for r in records.where("record_type = 'revisit'").collect()} <= answers


def test_more_repeated_payloads_than_are_sent(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(M, "SENDABLE_ROWS", 2)
    frame = spark.createDataFrame(pages(), SCHEMA)
    few = sorted(map(key, M.digest(M.archived(frame)).collect()))
    monkeypatch.undo()
    assert few == sorted(map(key, M.digest(M.archived(frame)).collect()))


def test_damaged_file_among_archives(spark, tmp_path):
    ship(spark)
    whole, broken = b"".join(members(5)), bytearray(b"".join(members(5, seed=8)))
    broken[40] ^= 1
    (tmp_path / "a.warc.gz").write_bytes(whole)
    (tmp_path / "b.warc.gz").write_bytes(broken)
    (tmp_path / "c.warc").write_bytes(b"".join(members(5, False)))
    names = spark.createDataFrame([(f"file://{tmp_path}/{n}",) for n in ("a.warc.gz", "b.warc.gz", "c.warc")], "file string")
    rows = M.read(spark, names).collect()
    gaps = [(r["file"][-9:], r["offset"], r["fault"]) for r in rows if r["fault"]]
    assert gaps == [("b.warc.gz", 0, "member does not inflate to its checksum")] and len(rows) == 15


def test_query_equals_sql(spark):
    ship(spark)
    rows = [r[:3] for r in pages()]
    rows.remove(rows[7])
    found = M.digest(M.archived(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert sorted(map(key, found)) == sorted(map(key, con.execute(ORACLES["op11_warc"]).fetchall()))


def test_no_pages(spark):
    ship(spark)
    frame = M.digest(M.archived(spark.createDataFrame([], "page_id long, url string, html string")))
    assert frame.collect() == []
