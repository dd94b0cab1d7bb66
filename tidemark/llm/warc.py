"""WARC archives: written once per payload, and read back past damage.

Writing: each task writes archives of its rows, one gzip member a record, and
names them in a manifest. A file of a lost attempt is named by none and so is
never read. The first capture of a payload is a `response`, later ones are
`revisit` records that refer to it and hold no payload.

Reading salvages: a record counts only if every check holds (the member
inflates and its checksum agrees, version line, length, end of record, digests).
After a failed check the reader looks for the next member or version line from
which a record reads without fault, and goes on there. The bytes between are a
row of their own: file, offset, length and the check that failed. One task reads
an archive, a record at a time.

* A null or empty payload is a payload of no bytes; an empty table gives no records.
* Records of one id and payload are all `response` if the id is the payload's
  smallest; null ids come after all others, so they are `response` only among themselves.
* A null uri is left out of the record; control characters in it are percent-encoded.
* A record of any length is read whole; it has to fit into one cell of a row, as its page did.
* A record found within the payload of a damaged record, if complete, is salvaged too.
* Columns other than those named are not read, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.graph import SENDABLE_ROWS, Steps

#: Compressed bytes after which a task starts another archive.
ARCHIVE_BYTES = 256_000_000
LEVEL = 6
#: Bytes asked of a file at once, and of rows given back at once.
READ_BYTES, GIVEN_BYTES = 1 << 20, 4 << 20

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_RESPONSE = "application/http; msgtype=response"
GZIP_START, VERSION_START = b"\x1f\x8b\x08", b"WARC/1."
LINE, BLANK = b"\r\n", b"\r\n\r\n"

MANIFEST = "file string, records long, bytes long"
RECORDS = ("file string, offset long, length long, fault string, record_type string, record_id string, "
           "target_uri string, fields map<string,string>, payload binary, payload_bytes long, payload_digest string")

Batches = Iterator[pa.RecordBatch]


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path within it."""
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", path)
    return fs.FileSystem.from_uri(path)


# -- writing ----------------------------------------------------------------------------

def first_captures(captures: DataFrame) -> DataFrame:
    """`captures` (id, uri, payload) with `refers_to` and `refers_uri` of the first capture where it is another.

    Payloads are compared by their SHA-1. Payload bytes are shuffled only if more
    payloads repeat than can be sent to the executors: the most frequent ones are
    sent always, so no group of copies meets in one task.
    """
    hashed = captures.withColumns({"payload": F.coalesce("payload", F.lit(b"")),
                                   "sha1": F.unhex(F.sha1(F.coalesce("payload", F.lit(b""))))})
    repeated = hashed.groupBy("sha1").agg(
        F.count("*").alias("n"), F.min("id").alias("first_id"), F.min_by("uri", "id").alias("first_uri")).where("n > 1")
    steps = Steps(captures.sparkSession, "captures")
    repeated = steps.keep(repeated)
    sent = repeated.orderBy(F.desc("n"), "sha1").limit(SENDABLE_ROWS)
    found = hashed.join(F.broadcast(sent.drop("n")), "sha1", "left")
    if repeated.count() > SENDABLE_ROWS:
        rest = repeated.join(sent.select("sha1"), "sha1", "left_anti").select(
            "sha1", F.col("first_id").alias("late_id"), F.col("first_uri").alias("late_uri"))
        found = found.join(rest, "sha1", "left").withColumns({
            "first_id": F.coalesce("first_id", "late_id"), "first_uri": F.coalesce("first_uri", "late_uri")})
    other = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("id"))
    return found.select("id", "uri", "payload", F.when(other, F.col("first_id")).alias("refers_to"),
                        F.when(other, F.col("first_uri")).alias("refers_uri"))


def written(captures: DataFrame, folder: str, date: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write `captures` (id, uri, payload, refers_to, refers_uri); the manifest, to be kept before it is read."""
    def write(batches: Batches) -> Batches:
        context = TaskContext.get()
        archive = _Archives(f"{folder}/{context.partitionId():05d}-{context.taskAttemptId()}", date, archive_bytes)
        for batch in batches:
            for i in range(batch.num_rows):
                archive.add(*(batch.column(c)[i].as_py() for c in ("id", "uri", "payload", "refers_to", "refers_uri")))
        done = archive.close()
        yield pa.record_batch(dict(zip(("file", "records", "bytes"), map(list, zip(*done))))
                              if done else {"file": pa.array([], pa.string()), "records": pa.array([], pa.int64()),
                                            "bytes": pa.array([], pa.int64())})
    return captures.select(F.col("id").cast("string").alias("id"), "uri", "payload",
                           F.col("refers_to").cast("string").alias("refers_to"), "refers_uri"
                           ).mapInArrow(write, MANIFEST)


def record_id(*parts: str | None) -> str:
    """The same parts name the same record, in every run."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, repr(parts))}>"


def record(fields: dict[str, str | None], block: bytes) -> bytes:
    """One record with its block; fields without a value are left out."""
    fields = fields | {"WARC-Block-Digest": f"sha1:{sha1_base32(block)}", "Content-Length": str(len(block))}
    lines = [VERSION, *(f"{name}: {value}" for name, value in fields.items() if value is not None)]
    return b"".join(("\r\n".join(lines).encode(), BLANK, block, BLANK))


def _uri(uri: str | None) -> str | None:
    return None if uri is None else re.sub(r"[\x00-\x20\x7F]", lambda c: f"%{ord(c[0]):02X}", uri)


def capture(date: str, source_id: str | None, uri: str | None, payload: bytes, refers_to: str | None,
            refers_uri: str | None) -> bytes:
    """A response record, or a revisit without payload where it refers to another capture."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    sha1 = sha1_base32(payload)
    fields = {"WARC-Type": "response" if refers_to is None else "revisit",
              "WARC-Record-ID": record_id(source_id, uri, sha1), "WARC-Date": date, "WARC-Target-URI": _uri(uri),
              "Content-Type": HTTP_RESPONSE, "WARC-Payload-Digest": f"sha1:{sha1}", "Source-ID": source_id}
    if refers_to is None:
        return record(fields, http + payload)
    return record(fields | {
        "WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(refers_to, refers_uri, sha1),
        "WARC-Refers-To-Date": date,
        "WARC-Refers-To-Target-URI": _uri(refers_uri), "Refers-To-Source-ID": refers_to}, http)


class _Archives:
    """The archives of one task, one open at a time."""

    def __init__(self, stem: str, date: str, limit: int):
        self._stem, self._date, self._limit = stem, date, limit
        self._out, self._done = None, []

    def add(self, *cells) -> None:
        if self._out is None:
            self._file = f"{self._stem}-{len(self._done):05d}.warc.gz"
            system, path = _opened(self._file)
            if isinstance(system, fs.LocalFileSystem):
                system.create_dir(path.rsplit("/", 1)[0])
            self._out, self._records, self._bytes = system.open_output_stream(path, compression=None), 0, 0
            self._put(record({"WARC-Type": "warcinfo", "WARC-Record-ID": record_id(path.rsplit("/", 1)[1]),
                              "WARC-Date": self._date, "Content-Type": "application/warc-fields"},
                             b"format: WARC File Format 1.1\r\n"))
        self._put(capture(self._date, *cells))
        self._records += 1
        if self._bytes >= self._limit:
            self._shut()

    def _put(self, data: bytes) -> None:
        member = gzip.compress(data, LEVEL, mtime=0)
        self._out.write(member)
        self._bytes += len(member)

    def _shut(self) -> None:
        self._out.close()
        self._done.append((self._file, self._records, self._bytes))
        self._out = None

    def close(self) -> list[tuple[str, int, int]]:
        if self._out is not None:
            self._shut()
        return self._done


# -- reading ----------------------------------------------------------------------------

class Damaged(Exception):
    """A check that failed."""


class Source:
    """Bytes of a file by place, with the last piece read at hand."""

    def __init__(self, file, size: int):
        self._file, self.size, self._at, self._piece = file, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        """Up to n bytes at a place; fewer only at the end of the file."""
        n = min(n, self.size - at)
        if not (self._at <= at and at + n <= self._at + len(self._piece)):
            self._file.seek(at)
            self._at, self._piece = at, self._file.read(max(n, READ_BYTES))
        return self._piece[at - self._at:at - self._at + n]

    def find(self, at: int) -> int:
        """Place of the next gzip or version start; the size of the file if there is none."""
        while at < self.size:
            piece = self.get(at, READ_BYTES)
            found = [i for i in (piece.find(GZIP_START), piece.find(VERSION_START)) if i >= 0]
            if found:
                return at + min(found)
            if at + len(piece) >= self.size:
                break
            at += len(piece) - len(VERSION_START) + 1
        return self.size


@dataclass
class Found:
    """A record, or the bytes given up between two of them."""

    offset: int
    length: int
    fault: str | None = None
    fields: dict[str, str] = field(default_factory=dict)
    block: bytes = b""


def salvage(source: Source) -> Iterator[Found]:
    """All records of an archive in order, and the gaps that are none; every byte is in one of them."""
    at, gap, fault = 0, None, ""
    while at < source.size:
        try:
            start = source.get(at, len(VERSION_START))
            if start.startswith(GZIP_START):
                found, end = _member(source, at)
            elif start == VERSION_START:
                found, end = _plain(source, at)
            else:
                raise Damaged("no member or version line")
        except Damaged as damage:
            if gap is None:
                gap, fault = at, str(damage)
            at = source.find(at + 1)
            continue
        if gap is not None:
            yield Found(gap, at - gap, fault)
            gap = None
        yield from found
        at = end
    if gap is not None:
        yield Found(gap, at - gap, fault)


def _member(source: Source, at: int) -> tuple[list[Found], int]:
    """The records of a gzip member, usually one, and the place behind it."""
    inflate, pieces, begun, place = zlib.decompressobj(31), [], b"", at
    while not inflate.eof:
        data = source.get(place, READ_BYTES // 16)
        if not data:
            raise Damaged("member ends early")
        place += len(data)
        try:
            pieces.append(inflate.decompress(data))
        except zlib.error:
            raise Damaged("member does not inflate to its checksum") from None
        if len(begun) < len(VERSION_START):
            begun += pieces[-1][:len(VERSION_START)]
            if not VERSION_START.startswith(begun[:len(VERSION_START)]):
                raise Damaged("member holds no record")
    end, whole = place - len(inflate.unused_data), b"".join(pieces)
    found, inside = [], 0
    while inside < len(whole) or not found:
        head = whole.find(BLANK, inside)
        if head < 0:
            raise Damaged("head of a record does not end")
        fields, length = _fields(whole[inside:head])
        body = head + len(BLANK)
        _ended(whole[body + length:body + length + len(BLANK)])
        found.append(Found(at, end - at, None, fields, _sound(fields, whole[body:body + length])))
        inside = body + length + len(BLANK)
    return found, end


def _plain(source: Source, at: int) -> tuple[list[Found], int]:
    """The record at a version line and the place behind it."""
    size, head = 1 << 12, -1
    while head < 0:
        piece = source.get(at, size)
        head = piece.find(BLANK)
        if head < 0 and at + size >= source.size:
            raise Damaged("head of a record does not end")
        size *= 2
    fields, length = _fields(piece[:head])
    body = at + head + len(BLANK)
    if body + length > source.size:
        raise Damaged("record ends early")
    end = body + length + len(BLANK)
    _ended(source.get(body + length, len(BLANK)))
    return [Found(at, end - at, None, fields, _sound(fields, source.get(body, length)))], end


def _fields(head: bytes) -> tuple[dict[str, str], int]:
    """Named fields of a record's head, names in lower case, and the length of its block."""
    version, _, rest = head.partition(LINE)
    if not re.fullmatch(rb"WARC/1\.\d", version):
        raise Damaged("no version line")
    fields: dict[str, str] = {}
    for line in re.sub(r"\r\n[ \t]+", " ", rest.decode(errors="replace")).split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("a line of the head names no field")
        name, value = name.strip().lower(), value.strip()
        fields[name] = f"{fields[name]}, {value}" if name in fields else value
    length = fields.get("content-length", "")
    if not re.fullmatch("[0-9]+", length) or not {"warc-type", "warc-record-id"} <= fields.keys():
        raise Damaged("a field that every record has is missing")
    return fields, int(length)


def _ended(tail: bytes) -> None:
    if tail != BLANK:
        raise Damaged("record does not end where its length says")


def payload_of(fields: dict[str, str], block: bytes) -> bytes:
    """What a block carries: behind the head of an HTTP message, else all of it."""
    if fields.get("content-type", "").lower().startswith("application/http"):
        return block.partition(BLANK)[2]
    return block


def _sound(fields: dict[str, str], block: bytes) -> bytes:
    """The block, if it has the digests that the record names."""
    stated = fields.get("warc-block-digest", "")
    if stated.lower().startswith("sha1:") and stated[5:].upper() != sha1_base32(block):
        raise Damaged("block has another digest")
    stated = fields.get("warc-payload-digest", "")
    if fields["warc-type"] == "response" and stated.lower().startswith("sha1:"):
        if stated[5:].upper() != sha1_base32(payload_of(fields, block)):
            raise Damaged("payload has another digest")
    return block


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Records and gaps of the archives that `manifest` names in its column `file`.

    A gap has a fault and no record type. A revisit has no payload; its length
    and digest are what its HTTP head and its fields state of the full payload.
    """
    files = manifest.select("file")
    return files.repartitionByRange(max(files.count(), 1), "file").mapInArrow(_read, RECORDS)


def _read(batches: Batches) -> Batches:
    kinds = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("fault", pa.string()),
                       ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
                       ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
                       ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
    for batch in batches:
        for name in batch.column("file").to_pylist():
            system, path = _opened(name)
            rows, held = [], 0
            with system.open_input_file(path) as file:
                for found in salvage(Source(file, file.size())):
                    rows.append({"file": name} | _row(found))
                    held += len(found.block) + 500
                    if held >= GIVEN_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, kinds)
                        rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, kinds)


def _row(found: Found) -> dict:
    where = {"offset": found.offset, "length": found.length}
    if found.fault is not None:
        return where | {"fault": found.fault}
    fields = found.fields
    row = where | {"record_type": fields["warc-type"], "record_id": fields["warc-record-id"],
                   "target_uri": fields.get("warc-target-uri"), "fields": list(fields.items())}
    if fields["warc-type"] == "revisit":
        full = re.search(rb"(?im)^content-length:\s*([0-9]+)", found.block)
        digest = fields.get("warc-payload-digest", "")
        return row | {"payload_bytes": int(full[1]) if full else None,
                      "payload_digest": digest.partition(":")[2] or None}
    payload = payload_of(fields, found.block)
    return row | {"payload": payload, "payload_bytes": len(payload), "payload_digest": sha1_base32(payload)}


def archived(pages: DataFrame, date: str = "2026-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Pages (page_id, url, html) written to archives and read back: records and gaps, see `read`."""
    spark = pages.sparkSession
    steps = Steps(spark, "warc")
    captures = first_captures(pages.select(
        F.col("page_id").alias("id"), F.col("url").alias("uri"), F.col("html").cast("binary").alias("payload")))
    manifest = steps.keep(written(captures, f"{steps.path}/archives", date, archive_bytes))
    return read(spark, manifest)


def digest(records: DataFrame, id_type: str = "long") -> DataFrame:
    """A row for each capture read: id, length and digest of the payload, type, and the id it refers to."""
    return records.where(F.col("record_type").isin("response", "revisit")).select(
        F.col("fields")["source-id"].cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("fields")["refers-to-source-id"].cast(id_type).alias("refers_to"))


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4)) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p
"""
