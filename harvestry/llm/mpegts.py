"""Media columns of MPEG transport streams.

encode() muxes a payload of 8-bit samples into a transport stream: a program association table, a program map table
and one elementary stream of packets of 188 bytes, in which every access unit is a PES packet with a presentation
timestamp, and every RANDOM_ACCESS_EVERYth unit is marked as a random-access point. decode() parses the program tables,
checks continuity counters, reassembles the elementary stream and returns its bytes with the timestamps and
random-access points of the units. Both are vectorised over packets; Spark deals the rows.

Defined results: a null text is the empty text, whose payload is one block of spaces; equal texts give equal bytes; rows
with equal or null doc_id are rows of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import dataclasses
import functools
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import small_batches, staged, text_or_empty

# Fixed values of the format: packet length, sync byte, and the identifiers used here.
PACKET, SYNC, PAT_PID, PMT_PID, ES_PID, NULL_PID = 188, 0x47, 0x0000, 0x0100, 0x0101, 0x1FFF
PROGRAM, STREAM_TYPE, STREAM_ID = 1, 0x06, 0xBD  # private data in PES packets
CLOCK = 90_000

PAD, BLOCK = 32, 192
#: Samples of an access unit, its duration in clock ticks (8000 samples a second), and units between random-access points.
UNIT, SAMPLE_RATE, RANDOM_ACCESS_EVERY = 16 * BLOCK, 8000, 4
FIRST_PTS = CLOCK


@functools.lru_cache(maxsize=64)
def crc32_mpeg(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = (crc << 1 ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


def _section(table_id: int, number: int, body: bytes) -> bytes:
    """A program table of one section, with its CRC, as a packet's payload behind a pointer field."""
    head = bytes([table_id]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\x00\x00"
    own = head + body
    return b"\x00" + own + crc32_mpeg(own).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> bytes:
    return (bytes([SYNC]) + (0x4000 | pid).to_bytes(2, "big") + b"\x10" + section).ljust(PACKET, b"\xff")


@functools.lru_cache(maxsize=1)
def tables() -> bytes:
    pat = _section(0x00, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
    pmt = _section(0x02, PROGRAM, (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([STREAM_TYPE]) + (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00")
    return _table_packet(PAT_PID, pat) + _table_packet(PMT_PID, pmt)


@functools.lru_cache(maxsize=64)
def _layout(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Packets of an access unit of `size` samples with all fields that units share, and where its samples go."""
    fixed, spots, at = [], [], 0
    header = b"\x00\x00\x01" + bytes([STREAM_ID]) + (size + 8).to_bytes(2, "big") + b"\x84\x80\x05" + bytes(5)
    while at < size or not fixed:
        first = not fixed
        adaptation = b"\x07\x10" + bytes(6) if first else b""  # flags and clock reference
        room = PACKET - 4 - len(adaptation) - (len(header) if first else 0)
        n = min(room, size - at)
        if n < room:  # stuffing fills the rest
            short = room - n
            if adaptation:
                adaptation = bytes([7 + short]) + adaptation[1:] + b"\xff" * short
            else:
                adaptation = bytes([short - 1]) + (b"\x00" + b"\xff" * (short - 2) if short > 1 else b"")
        head = bytes([SYNC]) + ((0x4000 if first else 0) | ES_PID).to_bytes(2, "big") + bytes([0x30 if adaptation else 0x10])
        start = len(head) + len(adaptation) + (len(header) if first else 0)
        fixed.append((head + adaptation + (header if first else b"")).ljust(PACKET, b"\x00"))
        spots.append(np.arange(start, start + n) + PACKET * (len(fixed) - 1))
        at += n
    return np.frombuffer(b"".join(fixed), np.uint8), np.concatenate(spots)


def _units(samples: np.ndarray, first: int, counter: int) -> np.ndarray:
    """Packets of units (rows of samples), numbered from `first`, with continuity counters from `counter`."""
    n, size = samples.shape
    fixed, spots = _layout(size)
    out = np.tile(fixed, (n, 1))
    out[:, spots] = samples
    packets = len(fixed) // PACKET
    out[:, 3::PACKET] |= ((counter + np.arange(n * packets).reshape(n, packets)) & 15).astype(np.uint8)
    number = np.arange(first, first + n)
    pts = (FIRST_PTS + number * (UNIT * CLOCK // SAMPLE_RATE)) & (2**33 - 1)
    pcr = (pts - FIRST_PTS // 2) & (2**33 - 1)
    out[number % RANDOM_ACCESS_EVERY == 0, 5] |= 0x40
    for k, shift in enumerate((25, 17, 9, 1)):
        out[:, 6 + k] = pcr >> shift & 0xFF
    out[:, 10] = (pcr & 1) << 7 | 0x7E
    at = 5 + int(fixed[4])  # the PES header stands behind the adaptation field
    for k, part in enumerate((0x21 | pts >> 29 & 0x0E, pts >> 22, pts >> 14 & 0xFE | 1, pts >> 7, pts << 1 & 0xFE | 1)):
        out[:, at + 9 + k] = part & 0xFF
    return out.reshape(-1, PACKET)


def encode(payload: bytes) -> bytes:
    """The transport stream of a payload of at least one sample."""
    samples = np.frombuffer(payload, np.uint8)
    whole = len(samples) // UNIT
    parts = [np.frombuffer(tables(), np.uint8).reshape(-1, PACKET)]
    if whole:
        parts.append(_units(samples[: whole * UNIT].reshape(whole, UNIT), 0, 0))
    if len(samples) % UNIT:
        parts.append(_units(samples[whole * UNIT :][None, :], whole, sum(len(p) for p in parts[1:])))
    return np.concatenate(parts).tobytes()


@dataclasses.dataclass(frozen=True)
class Media:
    payload: bytes
    pts: np.ndarray
    offsets: np.ndarray
    random_access: np.ndarray
    lost: int


def _sections(packets: np.ndarray, starts: np.ndarray, pid: np.ndarray, wanted: int, table_id: int) -> list[bytes]:
    """Bodies of the single-packet sections of a PID; a wrong CRC is an error."""
    out = []
    for k in np.flatnonzero((pid == wanted) & (packets[:, 1] & 0x40 > 0)):
        data = packets[k, starts[k] :].tobytes()
        section = data[1 + data[0] :]
        length = 3 + (int.from_bytes(section[1:3], "big") & 0xFFF)
        section = section[:length]
        if section[:1] == bytes([table_id]):
            if crc32_mpeg(section) != 0:
                raise ValueError("a program table has a wrong CRC")
            out.append(section[8:-4])
    return out


def decode(stream: bytes) -> Media:
    """Payload, timestamps, unit offsets and random-access points of the first program's first elementary stream.
    `lost` counts breaks of its continuity counter; packets that repeat the one before are dropped."""
    if len(stream) % PACKET or not stream:
        raise ValueError("not a whole number of packets")
    packets = np.frombuffer(stream, np.uint8).reshape(-1, PACKET)
    if (packets[:, 0] != SYNC).any():
        raise ValueError("lost sync")
    pid = (packets[:, 1].astype(int) & 0x1F) << 8 | packets[:, 2]
    control = packets[:, 3] >> 4 & 3
    starts = np.where(control & 2, 5 + packets[:, 4].astype(int), 4)
    starts = np.where(control & 1, starts, PACKET)
    programs = {}
    for body in _sections(packets, starts, pid, PAT_PID, 0x00):
        for k in range(0, len(body), 4):
            programs[int.from_bytes(body[k : k + 2], "big")] = int.from_bytes(body[k + 2 : k + 4], "big") & 0x1FFF
    streams = []
    for number, where in sorted(programs.items()):
        for body in _sections(packets, starts, pid, where, 0x02) if number else []:
            at = 4 + (int.from_bytes(body[2:4], "big") & 0xFFF)
            while at < len(body):
                streams.append(int.from_bytes(body[at + 1 : at + 3], "big") & 0x1FFF)
                at += 5 + (int.from_bytes(body[at + 3 : at + 5], "big") & 0xFFF)
    if not streams:
        raise ValueError("no elementary stream")
    own = np.flatnonzero((pid == streams[0]) & (control & 1 > 0))
    counters = packets[own, 3] & 15
    step = (np.diff(counters.astype(int)) - 1) % 16
    repeated = np.concatenate(([False], (step == 15) & (packets[own[1:]] == packets[own[:-1]]).all(1)))
    lost = int(((step != 0) & ~repeated[1:]).sum())
    own = own[~repeated]
    rows, at = packets[own], starts[own].copy()
    first = np.flatnonzero(rows[:, 1] & 0x40)
    pts = np.zeros(len(first), np.int64)
    for k, row in enumerate(first):  # one step per access unit
        pes = rows[row, at[row] :]
        if pes[:3].tobytes() != b"\x00\x00\x01":
            raise ValueError("no PES header where a unit starts")
        b = pes[9:14].astype(np.int64)
        pts[k] = (b[0] >> 1 & 7) << 30 | b[1] << 22 | (b[2] >> 1) << 15 | b[3] << 7 | b[4] >> 1 if pes[7] & 0x80 else -1
        at[row] += 9 + int(pes[8])
    inside = np.arange(PACKET)[None, :] >= at[:, None]
    sizes = PACKET - at
    ends = np.concatenate(([0], np.cumsum(sizes)))
    access = (rows[first, 3] & 0x20 > 0) & (rows[first, 4] > 0) & (rows[first, 5] & 0x40 > 0)
    return Media(rows[inside].tobytes(), pts, ends[first], access, lost)


def payload_of(text: str) -> tuple[int, bytes]:
    """Length of the text in UTF-8, and its bytes padded with spaces to a positive multiple of BLOCK."""
    data = text.encode("utf-8", "surrogatepass")
    return len(data), data.ljust(max(1, -(-len(data) // BLOCK)) * BLOCK, bytes([PAD]))


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [payload_of(t) for t in batch.column(1).to_pylist()]
        media = pa.array([encode(p) for _, p in both], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in both], pa.int64()), media], names=["doc_id", "n_bytes", "media"])


def media_column(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media (the transport stream) of docs(doc_id, text)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_stored, "doc_id long, n_bytes long, media binary")


UNIT_TYPE = pa.list_(pa.struct([("pts", pa.int64()), ("offset", pa.int64()), ("random_access", pa.bool_())]))
UNITS = "doc_id long, n_bytes long, payload binary, units array<struct<pts:long,offset:long,random_access:boolean>>, lost int, media binary, error string"


def attempt(stream: bytes | None) -> tuple[Media | None, str | None]:
    """A decoded stream, or why it can't be."""
    try:
        return decode(stream or b""), None
    except (ValueError, IndexError) as wrong:
        return None, str(wrong)


def _units_of(media: Media) -> list[dict]:
    return [{"pts": p, "offset": o, "random_access": r} for p, o, r in zip(media.pts.tolist(), media.offsets.tolist(), media.random_access.tolist(), strict=True)]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tried = [attempt(m) for m in batch.column(2).to_pylist()]
        found, errors = [m for m, _ in tried], [e for _, e in tried]
        units = [m and _units_of(m) for m in found]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([m and m.payload for m in found], pa.binary()),
                pa.array(units, UNIT_TYPE),
                pa.array([m and m.lost for m in found], pa.int32()),
                batch.column(2),
                pa.array(errors, pa.string()),
            ],
            names=["doc_id", "n_bytes", "payload", "units", "lost", "media", "error"],
        )


def read_media(stored: DataFrame) -> DataFrame:
    """Payload and access units (pts, offset, random_access) of a table with a media column. A stream that can't be decoded
    gives a row with nulls and the reason in error."""
    small_batches(stored.sparkSession)
    return stored.select("doc_id", "n_bytes", "media").mapInArrow(_read, UNITS)


def _features(media: Media) -> str:
    """What a reader learns of the stream: units, span of timestamps, random-access points, samples' level and changes."""
    x = np.frombuffer(media.payload, np.uint8).astype(np.int64)
    turns = int(np.abs(np.diff(x)).sum())
    points = int(media.random_access.sum())
    return f"units={len(media.pts)};pts={media.pts[0]}-{media.pts[-1]};points={points};lost={media.lost};sum={int(x.sum())};square={int((x * x).sum())};turns={turns}"


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        streams = batch.column(2).to_pylist()
        tried = [attempt(s) for s in streams]
        found, errors = [m for m, _ in tried], [e for _, e in tried]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([m and len(m.payload) for m in found], pa.int64()),
                pa.array([m and hashlib.sha256(m.payload).hexdigest() for m in found], pa.string()),
                pa.array([m and zlib.crc32(m.payload[-16:]) for m in found], pa.int64()),
                pa.array([len(s) for s in streams], pa.int64()),
                pa.array([hashlib.sha256(s).hexdigest() for s in streams], pa.string()),
                pa.array([m and _features(m) for m in found], pa.string()),
                pa.array([m and _units_of(m) for m in found], UNIT_TYPE),
                pa.array(errors, pa.string()),
            ],
            names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "units", "error"],
        )


def digest(docs: DataFrame) -> DataFrame:
    """Store docs' payloads as a media column, read the stored bytes back and describe them, one row per row of docs: with its
    access units (timestamp, place, random access), and an error instead of a description if the stream is damaged."""
    stored = staged(media_column(docs), "media")
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, "
    schema += "units array<struct<pts:long,offset:long,random_access:boolean>>, error string"
    return stored.select("doc_id", "n_bytes", "media").mapInArrow(_digested, schema)
