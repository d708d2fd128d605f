import gzip
import io
import random

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from harvestry.llm import warc
from harvestry.llm.common import scratch_path, table
from tests.conftest import SF


def check(pages):
    con = duckdb.connect()
    con.register("pages", pages.toArrow())
    want = con.execute(warc.oracle()).fetchall()
    got = warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_whole_table(spark):
    check(table(spark, SF, "pages"))


def test_edges(spark):
    rows = [(1, "u", "a"), (2, "u", "a"), (3, None, "a"), (4, "x\r\ny", None), (5, "", ""), (6, "u", "é" * 5000), (None, "u", "b"), (7, "u", "WARC/1.1\r\n\r\n"), (8, "u", "c"), (8, "u", "c")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, size int")
    check(pages)
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_ranges_of_any_size_find_every_record_once(spark):
    rng = random.Random(4)
    records = []
    for i in range(60):  # payloads that look like members themselves
        payload = rng.randbytes(rng.randrange(3000)) + warc.member(b"WARC/1.1\r\nfake") + warc.MAGIC * 3
        records.append(warc.record(i, "http://x/", payload, warc.payload_digest(payload), None, "2024-01-01T00:00:00Z"))
    stored = [warc.zlib.compressobj(0, warc.zlib.DEFLATED, 31) for _ in records]
    data = b"".join(c.compress(r) + c.flush() for c, r in zip(stored, records))
    assert gzip.decompress(data) == b"".join(records)
    file = pa.BufferReader(data)
    whole = list(warc.members_in(file, 0, len(data)))
    assert [d for _, d in whole][0] == records[0]
    for size in (997, 20_000, 1 << 20):
        parts = [x for s in range(0, len(data), size) for x in warc.members_in(file, s, min(s + size, len(data)))]
        own = {o: d for o, d in parts}
        assert all(own.get(o) == d for o, d in whole)


def test_archives_are_plain_gzip_files(spark):
    pages = table(spark, SF, "pages")
    path = scratch_path(spark, "warc-test")
    warc.write(pages, path)
    files = spark.read.format("binaryFile").load(path).select("content").collect()
    text = b"".join(gzip.GzipFile(fileobj=io.BytesIO(f.content)).read() for f in files)
    assert text.count(b"WARC-Record-ID: <urn:page:") == pages.count()
    got = {r.page_id: r.payload.decode() for r in warc.read(spark, path, range_bytes=5000).where("payload is not null").collect()}
    want = {r.page_id: r.html for r in pages.collect()}
    assert all(want[i] == t for i, t in got.items()) and len(set(want.values())) == len(got)
    assert warc.read(spark, path, range_bytes=5000).select(F.count("*")).head()[0] == len(want)


def test_a_damaged_record_is_a_row(spark, tmp_path):
    records = [warc.record(i, "http://x/", f"text {i} ".encode() * 200, warc.payload_digest(f"text {i} ".encode() * 200), None, "2024-01-01T00:00:00Z") for i in range(5)]
    members = [bytearray(warc.member(r)) for r in records]
    members[2][-6] ^= 1  # its checksum
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members) + warc.member(b"WARC/1.1\r\nno header"))
    got = warc.read(spark, str(tmp_path)).collect()
    assert sorted(r.page_id for r in got if r.record_type == "response") == [0, 1, 3, 4]
    assert sorted(r.record_offset for r in got if r.record_type == "damaged") == [sum(map(len, members[:2])), sum(map(len, members))]
