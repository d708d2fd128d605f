"""WARC archives: writing pages as records, and a splittable reader of gzip-compressed archives.

Every record is a gzip member of its own. Of pages with equal payloads, that with the largest page_id is stored as a
response; the others become revisit records without a body that refer to it.

The reader deals byte ranges of the archives to tasks, not whole files. A task scans its range for the gzip magic,
takes a place as a member only if decoding there yields a WARC header, and owns the records that start inside its
range, reading on past its end for the last one. No index and no cooperation between tasks is needed.

Writing goes through Spark's text writer, so that task retries and commits are Spark's own: the row's bytes are a member
without its last byte, and the line separator is that byte, 0. (A member ends with its length's highest byte, which is
0 below 16 MB; longer ones are followed by an empty member, which ends with 0 as well.)

Defined results: a null html is the empty payload; a null url is the empty URI; of rows with equal page_id and payload
all are responses if one is; rows with a null page_id are responses when no row of their payload has one; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.llm.common import scratch_path, small_batches, staged
from harvestry.llm.neardup import hot_join

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a task's range, bytes read at once, and bytes of a decoded header that decide about a candidate.
RANGE_BYTES, READ_BYTES, PROBE_BYTES = 16 << 20, 1 << 20, 5
LEVEL = 6
_EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + bytes(8)
CRLF = b"\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(data: bytes) -> bytes:
    """A gzip member that ends with a zero byte."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    own = packer.compress(data) + packer.flush()
    return own if own[-1] == 0 else own + _EMPTY_MEMBER


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP header with the payload's length, but no body."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + str(len(payload)).encode() + CRLF + CRLF
    body = http + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(body))),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    head = b"WARC/1.1" + CRLF + b"".join(f"{k}: {v}".encode("utf-8", "surrogatepass") + CRLF for k, v in fields)
    return head + CRLF + body + CRLF + CRLF


def _members(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, html, refers_to in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                payload = html.encode("utf-8", "surrogatepass")
                out.append(member(record(page_id, url, payload, payload_digest(payload), refers_to, date))[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["bytes"])

    return run


def write(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write pages(page_id, url, html) as gzip-compressed WARC files in the folder `path`."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    size = F.octet_length("html")
    rows = rows.withColumn("payload", F.when(size >= min_bytes, F.concat_ws(":", F.sha1("html"), size)))
    first = rows.where("payload is not null").groupBy("payload").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    first = staged(first.where("n > 1 and first is not null").select("payload", "first"), "payloads")
    rows = hot_join(rows, first, "payload", "page_id", "left")  # one payload may be on a third of all pages
    refers = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    members = rows.select("page_id", "url", "html", refers.alias("refers_to")).mapInArrow(_members(date), "bytes binary")
    members.select(F.col("bytes").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


def _open(path: str):
    """A random-access file in any store that Arrow knows by the path's scheme."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else "file://" + path[5:])
    return system.open_input_file(name)


def _header(data: bytes) -> tuple[dict[str, str], int] | None:
    """Fields of a WARC or HTTP header and where the body begins."""
    end = data.find(CRLF + CRLF)
    if end < 0:
        return None
    fields = {}
    for line in data[:end].split(CRLF)[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("ascii", "replace")] = value.strip().decode("utf-8", "replace")
    return fields, end + 4


class _Range:
    """Bytes of a file from an offset on, read as far as they are asked for and dropped once passed."""

    def __init__(self, file, start: int):
        self.file, self.base, self.data = file, start, bytearray()

    def upto(self, end: int) -> bool:
        """Whether the bytes before `end` are there."""
        while self.base + len(self.data) < end:
            more = self.file.read_at(READ_BYTES, self.base + len(self.data))
            if not more:
                return False
            self.data += more
        return True

    def drop(self, before: int) -> None:
        if before - self.base >= READ_BYTES:
            del self.data[: before - self.base]
            self.base = before


def _unpacked(source: _Range, at: int, limit: int | None = None) -> tuple[bytes, int] | None:
    """The gzip member at `at`, or its first `limit` bytes, and where it ends; None if there is none."""
    unpack, out, seen = zlib.decompressobj(31), [], at
    total = 0
    try:
        while not unpack.eof:
            if not source.upto(seen + 1):
                return None
            piece = source.data[seen - source.base : seen - source.base + (64 if limit else READ_BYTES)]
            out.append(unpack.decompress(piece))
            total += len(out[-1])
            seen += len(piece)
            if limit and total >= limit:
                return b"".join(out), seen
    except zlib.error:
        return None
    return b"".join(out), seen - len(unpack.unused_data)


def members_in(file, start: int, end: int) -> Iterator[tuple[int, bytes | None]]:
    """Offset and content of the WARC records of a file that start in [start, end); no content if one doesn't unpack."""
    source, at = _Range(file, start), start
    while at < end:
        if not source.upto(min(end, at + READ_BYTES) + len(MAGIC) - 1) and len(source.data) + source.base - at < len(MAGIC):
            return
        found = source.data.find(MAGIC, at - source.base, end + len(MAGIC) - 1 - source.base)
        if found < 0:
            at = min(end, source.base + len(source.data) - len(MAGIC) + 1)
            source.drop(at)
            continue
        at = source.base + found
        probe = _unpacked(source, at, PROBE_BYTES)
        record = bool(probe) and probe[0].startswith(b"WARC/")
        whole = _unpacked(source, at) if record else None
        if whole is None:
            if record:
                yield at, None
            at += 1
            continue
        yield at, whole[0]
        at = whole[1]
        source.drop(at)


def parse(data: bytes) -> dict:
    """Type, URI, page, payload and digest of a record's content."""
    fields, at = _header(data)
    body = data[at : at + int(fields["content-length"])]
    http, body_at = _header(body) or ({}, 0)
    number = lambda name: int(v) if (v := fields.get(name, "")[10:-1]) else None  # noqa: E731  <urn:page:N>
    revisit = fields["warc-type"] == "revisit"
    payload = None if revisit else body[body_at:]
    return {
        "page_id": number("warc-record-id"),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "payload": payload,
        "payload_bytes": int(http.get("content-length", 0)) if revisit else len(payload),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else payload_digest(payload),
        "declared_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:"),
        "refers_to": number("warc-refers-to"),
    }


def parsed(data: bytes | None) -> dict:
    """parse(), or for a damaged record its type alone."""
    try:
        if data is not None:
            return parse(data)
    except (TypeError, KeyError, ValueError):
        pass
    return dict.fromkeys(["page_id", "url", "payload", "payload_bytes", "payload_digest", "declared_digest", "refers_to"]) | {"record_type": "damaged"}


SCHEMA = "path string, record_offset long, page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, declared_digest string, refers_to long"


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in SCHEMA.split(", ")])
        for batch in batches:
            for path, start, end in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                rows, held = [], 0
                with _open(path) as file:
                    for offset, data in members_in(file, start, end):
                        row = {"path": path, "record_offset": offset} | parsed(data)
                        if not with_payload:
                            row["payload"] = None
                        rows.append([row[n] for n in names])
                        held += len(row["payload"] or b"") + 200
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return run


def read(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """Records of all archives in a folder: path, record_offset, page_id, url, record_type, payload (null for revisits),
    payload_bytes, payload_digest (computed for responses), declared_digest, refers_to. Digests of responses are checked
    by comparing payload_digest with declared_digest. A record that doesn't unpack or has no sound header is a row of
    type damaged, with its place alone."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")  # lists; reads no content
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.select("path", "length", starts.alias("start")).select("path", "start", F.least(F.col("start") + range_bytes, "length").alias("end"))
    ranges = staged(ranges, "ranges")
    tasks = max(1, ranges.count())
    return ranges.repartition(tasks, F.xxhash64("path", "start")).mapInArrow(_read(with_payload), SCHEMA)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write pages to new archives and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages, path, min_bytes)
    found = read(spark, path, with_payload=False)
    sound = F.when(F.col("payload_digest") == F.col("declared_digest"), F.col("payload_digest"))
    return found.select("page_id", "payload_bytes", sound.alias("payload_digest"), "record_type", "refers_to")


def oracle() -> str:
    """DuckDB SQL of round_trip's rows: base 32 from the digest's hexadecimal digits, five at a time."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    value = "CAST('0x' || substr(h, {}, 5) AS BIGINT)"
    digest = " || ".join(f"substr('{alphabet}', CAST(({value.format(1 + 5 * g)} >> {s}) & 31 AS INT) + 1, 1)" for g in range(8) for s in (15, 10, 5, 0))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, {digest} AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM q
"""
