"""MPEG transport streams as media columns: build, parse and describe.

``mux`` stores a byte payload losslessly in 188-byte packets: a program
association table, a program map table and one private elementary stream whose
access units carry a presentation timestamp each and a random-access flag at
regular places. ``demux`` reads such bytes back: it parses the program tables,
checks every continuity counter, reassembles the elementary packets and
returns payload, timestamps and random-access points.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PACKET = 188
PMT_PID, ES_PID, STREAM_TYPE, STREAM_ID = 0x100, 0x101, 0x06, 0xBD
FIRST, REST, UNIT_PACKETS = 162, 184, 23
UNIT = FIRST + REST * (UNIT_PACKETS - 1)
TICKS, CLOCK = 3003, 1 << 33
RANDOM_ACCESS_EVERY = 8


@lru_cache(4096)
def crc32_mpeg(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = ((crc << 1) ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


def _table_packet(pid: int, table_id: int, body: bytes) -> bytes:
    length = len(body) + 4
    section = bytes([table_id, 0xB0 | length >> 8, length & 0xFF]) + body
    section += crc32_mpeg(section).to_bytes(4, "big")
    head = bytes([0x47, 0x40 | pid >> 8, pid & 0xFF, 0x10, 0])
    return (head + section).ljust(PACKET, b"\xff")


TABLES = _table_packet(0, 0, bytes([0, 1, 0xC1, 0, 0, 0, 1, 0xE0 | PMT_PID >> 8, PMT_PID & 0xFF])) + _table_packet(
    PMT_PID, 2, bytes([0, 1, 0xC1, 0, 0, 0xE0 | ES_PID >> 8, ES_PID & 0xFF, 0xF0, 0, STREAM_TYPE, 0xE0 | ES_PID >> 8, ES_PID & 0xFF, 0xF0, 0]),
)


def _clock_bytes(pts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """PES timestamp (5 bytes) and program clock reference (6 bytes) of each unit."""
    p = pts.astype(np.uint64)
    stamp = np.stack([0x21 | (p >> 30 & 7) << 1, p >> 22 & 255, 1 | (p >> 15 & 127) << 1, p >> 7 & 255, 1 | (p & 127) << 1], 1)
    clock = np.stack([p >> 25 & 255, p >> 17 & 255, p >> 9 & 255, p >> 1 & 255, (p & 1) << 7 | 0x7E, p * 0], 1)
    return stamp.astype(np.uint8), clock.astype(np.uint8)


def _units(data: np.ndarray, first_unit: int, packets: int) -> np.ndarray:
    """Packets of equally long units that fill ``packets`` packets exactly."""
    n = len(data)
    out = np.zeros((n, packets, PACKET), np.uint8)
    out[:, :, 0], out[:, :, 1], out[:, :, 2] = 0x47, ES_PID >> 8, ES_PID & 0xFF
    out[:, :, 3] = 0x10
    index = np.arange(first_unit, first_unit + n)
    stamp, clock = _clock_bytes(index * TICKS % CLOCK)
    head = out[:, 0]
    head[:, 1] |= 0x40
    head[:, 3] = 0x30
    head[:, 4] = 7
    head[:, 5] = np.where(index % RANDOM_ACCESS_EVERY == 0, 0x50, 0x10)
    head[:, 6:12] = clock
    size = 8 + data.shape[1]
    head[:, 12:21] = [0, 0, 1, STREAM_ID, size >> 8, size & 0xFF, 0x80, 0x80, 5]
    head[:, 21:26] = stamp
    head[:, 26:] = data[:, :FIRST]
    if packets > 1:
        out[:, 1:, 4:] = data[:, FIRST:].reshape(n, packets - 1, REST)
    return out.reshape(-1, PACKET)


def _stuff(packet: np.ndarray, spare: int) -> None:
    """Makes room of ``spare`` stuffing bytes in front of a packet's payload."""
    has = packet[3] & 0x20
    start = 5 + packet[4] if has else 4
    payload = packet[start : PACKET - spare].copy()
    if has:
        packet[4] += spare
        packet[start : start + spare] = 0xFF
    else:
        packet[3] |= 0x20
        packet[4] = spare - 1
        if spare > 1:
            packet[5] = 0
        packet[6 : 4 + spare] = 0xFF
    packet[start + spare :] = payload


def mux(payload: bytes) -> bytes:
    """The payload (at least one byte) as a transport stream."""
    data = np.frombuffer(payload, np.uint8)
    full = len(data) // UNIT
    parts = [_units(data[: full * UNIT].reshape(full, UNIT), 0, UNIT_PACKETS)]
    tail = data[full * UNIT :]
    if len(tail):
        packets = 1 + max(0, -(-(len(tail) - FIRST) // REST))
        room = FIRST + REST * (packets - 1)
        padded = np.zeros((1, room), np.uint8)
        padded[0, : len(tail)] = tail
        last = _units(padded, full, packets)
        if room > len(tail):
            _stuff(last[-1], room - len(tail))
        at = 5 + int(last[0, 4])
        last[0, at + 4 : at + 6] = [(8 + len(tail)) >> 8, (8 + len(tail)) & 0xFF]
        parts.append(last)
    stream = np.concatenate(parts)
    stream[:, 3] |= (np.arange(len(stream)) & 15).astype(np.uint8)
    return TABLES + stream.tobytes()


@dataclass
class Stream:
    payload: bytes
    packets: int
    pts: np.ndarray
    random_access: np.ndarray
    continuity_errors: int
    programs: dict[int, dict[int, int]]


def _section(packet: np.ndarray, table_id: int) -> bytes:
    raw = packet.tobytes()
    at = 5 + raw[4] if not raw[3] & 0x20 else 6 + raw[4] + raw[5 + raw[4]]
    if raw[at] != table_id:
        raise ValueError(f"table {raw[at]} where {table_id} was due")
    end = at + 3 + ((raw[at + 1] & 15) << 8 | raw[at + 2])
    if crc32_mpeg(raw[at:end]):
        raise ValueError("a program table's checksum is wrong")
    return raw[at + 8 : end - 4]


def demux(stream: bytes) -> Stream:
    """Reads the first program's first elementary stream.

    Lost sync bytes, missing tables, wrong checksums and units whose length
    differs from their header raise ``ValueError``; continuity gaps are counted.
    """
    if not stream or len(stream) % PACKET:
        raise ValueError("not a whole number of packets")
    p = np.frombuffer(stream, np.uint8).reshape(-1, PACKET)
    if (p[:, 0] != 0x47).any():
        raise ValueError("sync byte lost")
    pid = (p[:, 1].astype(np.int32) & 0x1F) << 8 | p[:, 2]
    programs: dict[int, dict[int, int]] = {}
    if not (pid == 0).any():
        raise ValueError("no program association table")
    body = _section(p[pid == 0][0], 0)
    for i in range(0, len(body), 4):
        number, table = body[i] << 8 | body[i + 1], (body[i + 2] & 0x1F) << 8 | body[i + 3]
        if not number or not (pid == table).any():
            continue
        pmt = _section(p[pid == table][0], 2)
        at, found = 4 + ((pmt[2] & 15) << 8 | pmt[3]), {}
        while at < len(pmt):
            found[(pmt[at + 1] & 0x1F) << 8 | pmt[at + 2]] = pmt[at]
            at += 5 + ((pmt[at + 3] & 15) << 8 | pmt[at + 4])
        programs[number] = found
    es_pid = next((e for f in programs.values() for e in f), None)
    if es_pid is None:
        raise ValueError("no elementary stream")
    es = p[(pid == es_pid) & (p[:, 3] & 0x10 > 0)]
    counters = es[:, 3] & 15
    gaps = int(((counters[1:].astype(np.int32) - counters[:-1]) % 16 != 1).sum())
    adapted = es[:, 3] & 0x20 > 0
    start = np.where(adapted, 5 + es[:, 4].astype(np.int32), 4)
    unit = es[:, 1] & 0x40 > 0
    rows = np.flatnonzero(unit)
    heads = es[rows[:, None], np.minimum(start[rows][:, None] + np.arange(14), PACKET - 1)].astype(np.uint64)
    if len(rows) == 0 or rows[0] != 0 or (heads[:, 0] | heads[:, 1]).any() or (heads[:, 2] != 1).any():
        raise ValueError("an elementary packet doesn't begin where it should")
    pts = (heads[:, 9] >> 1 & 7) << 30 | heads[:, 10] << 22 | (heads[:, 11] >> 1) << 15 | heads[:, 12] << 7 | heads[:, 13] >> 1
    start[rows] += 9 + heads[:, 8].astype(np.int32)
    sizes = np.add.reduceat(PACKET - start, rows)
    if (sizes + 3 + heads[:, 8].astype(np.int64) != (heads[:, 4] << 8 | heads[:, 5]).astype(np.int64)).any():
        raise ValueError("an elementary packet's length is wrong")
    payload = es[np.arange(PACKET) >= start[:, None]].tobytes()
    access = np.flatnonzero(adapted[rows] & (es[rows, 4] > 0) & (es[rows, 5] & 0x40 > 0))
    return Stream(payload, len(p), pts.astype(np.int64), access, gaps, programs)


def padded(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode()
    return raw + bytes(-len(raw) % 64 or (0 if raw else 64)), len(raw)


SCHEMA = (
    "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, "
    "pts array<long>, random_access array<long>"
)


def transport_columns(df: DataFrame, key: str = "doc_id", text: str = "text", keep_media: bool = False) -> DataFrame:
    """Stores every text as a transport stream and describes what is read back.

    One output row per input row: ``key``, the columns of SCHEMA, of which
    ``pts`` holds every unit's timestamp and ``random_access`` the numbers of
    the units that are entry points, and with ``keep_media`` also ``media``
    (the stream). Null and empty texts become 64 zero bytes; repeated rows repeat;
    other columns are left out. Rows are independent, so no rows move.
    """
    kind = dict(df.dtypes)[key]
    schema = f"`{key}` {kind}, {SCHEMA}" + ", media binary" * keep_media

    def run(batches):
        for batch in batches:
            keys, rows = batch.column(0), []
            for value in batch.column(1):
                payload, n = padded(value.as_py())
                media = mux(payload)
                back = demux(media)
                feature = (
                    f"packets={back.packets};units={len(back.pts)};entries={len(back.random_access)};"
                    f"pts={back.pts[0]}..{back.pts[-1]};gaps={back.continuity_errors};types={sorted(t for f in back.programs.values() for t in f.values())}"
                )
                row = [n, len(back.payload), hashlib.sha256(back.payload).hexdigest(), zlib.crc32(back.payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature, back.pts.tolist(), back.random_access.tolist()]
                rows.append(row + [media] * keep_media)
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "pts", "random_access"]
            types, names = types + [pa.binary()] * keep_media, names + ["media"] * keep_media
            columns = list(zip(*rows)) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([keys, *(pa.array(c, t) for c, t in zip(columns, types))], [key, *names])

    return df.select(key, text).mapInArrow(run, schema)
