import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from harvestry.llm import mpegts
from harvestry.llm.common import table
from tests.conftest import SF


@given(st.integers(1, 9000), st.integers(0, 2**32 - 1))
@settings(max_examples=80, deadline=None)
def test_round_trip(n, seed):
    payload = np.random.default_rng(seed).bytes(n)
    stream = mpegts.encode(payload)
    got = mpegts.decode(stream)
    units = -(-n // mpegts.UNIT)
    assert got.payload == payload and got.lost == 0
    assert got.pts.tolist() == [90_000 + k * 34_560 for k in range(units)]
    assert got.offsets.tolist() == [k * mpegts.UNIT for k in range(units)]
    assert got.random_access.tolist() == [k % 4 == 0 for k in range(units)]


def test_packets_one_by_one():
    """Parse the stream with a plain reader of the standard's fields."""
    payload = bytes(range(256)) * 40
    stream = mpegts.encode(payload)
    es, last = b"", None
    for k in range(0, len(stream), 188):
        p = stream[k : k + 188]
        assert p[0] == 0x47
        pid, control, counter = (p[1] & 0x1F) << 8 | p[2], p[3] >> 4 & 3, p[3] & 15
        if pid != 0x101:
            continue
        assert last is None or counter == (last + 1) % 16
        last = counter
        body = p[4:]
        if control & 2:
            body = body[1 + body[0] :]
        if p[1] & 0x40:
            assert body[:4] == b"\x00\x00\x01\xbd" and body[7] == 0x80
            body = body[9 + body[8] :]
        es += body
    assert es == payload
    assert mpegts.crc32_mpeg(b"123456789") == 0x0376E6E7


def test_damage_is_seen():
    stream = mpegts.encode(b"x" * 20_000)
    cut = stream[: 188 * 10] + stream[188 * 11 :]
    assert mpegts.decode(cut).lost == 1
    twice = stream[: 188 * 10] + stream[188 * 9 :]
    assert mpegts.decode(twice).lost == 0 and mpegts.decode(twice).payload == b"x" * 20_000
    with pytest.raises(ValueError):
        mpegts.decode(b"\x00" + stream[1:])
    with pytest.raises(ValueError):
        mpegts.decode(stream[:10] + b"\xaa" + stream[11:])


def check(docs):
    got = mpegts.digest(docs).collect()
    want = []
    for r in docs.select("doc_id", "text").collect():
        data = (r.text or "").encode()
        padded = data + b" " * (-len(data) % 192 or (0 if data else 192))
        want.append((r.doc_id, len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]), hashlib.sha256(mpegts.encode(padded)).hexdigest()))
    assert sorted(((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_sha256) for r in got), key=str) == sorted(want, key=str)


def test_whole_table(spark):
    check(table(spark, SF, "documents"))


def test_edges(spark):
    rows = [(1, None), (1, ""), (None, "é" * 96), (2, "x" * 200_000), (2, "x" * 192)]
    docs = spark.createDataFrame([(i, t, b"m") for i, t in rows], "doc_id long, text string, media binary")
    check(docs)
    assert mpegts.digest(docs.limit(0)).collect() == []
    unit = mpegts.read_media(mpegts.media_column(docs.where("text like 'xxx%' and length(text) > 192"))).head()
    assert len(unit.units) == 66 and unit.units[4].random_access and unit.lost == 0


def test_a_damaged_stream_is_a_row_with_an_error(spark):
    good = mpegts.encode(b"x" * 192)
    rows = [(1, 192, bytearray(good)), (2, 192, bytearray(good[:-1])), (3, 192, bytearray(b"\x00" * 188)), (4, 192, None)]
    got = {r.doc_id: r for r in mpegts.read_media(spark.createDataFrame(rows, "doc_id long, n_bytes long, media binary")).collect()}
    assert bytes(got[1].payload) == b"x" * 192 and got[1].error is None and got[1].units[0].random_access
    assert all(got[i].error and got[i].payload is None and got[i].units is None for i in (2, 3, 4))
