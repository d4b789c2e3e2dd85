"""Exact substring dedup by a logarithmic family of sparse suffix arrays.

A byte is removed if a ``length``-byte string covers it that also starts
earlier (smaller document id, or same document and smaller offset).

Every window of ``length`` bytes picks an anchor: its smallest 16-byte string
by hash, the leftmost of equals; strings known to be very common (from a
bounded sample of documents) come last. The choice depends on the window's
bytes alone, so equal windows have equal anchors at equal offsets and comparing
windows that share an anchor loses no match. Consecutive windows of one anchor
form an entry: the anchor's suffix, the bytes before it, and its owner (where
it starts). Entries are dealt out by their anchor's hash.

In each bucket the entries arrive in batches. A batch gets a suffix array (the
entries sorted by what follows the anchor, and by what precedes it, with
longest common prefixes). It is merge-scanned against an existing level, in
which every group of equal windows keeps its earliest owner and marks the
rest; levels of like size merge, so a bucket holds logarithmically many. Windows equal
to the one a short period before them (runs of one letter, of dashes, of a
repeated line) are found where they stand, by comparing the run with itself,
and only a run's first period makes entries. The
same scan runs over every map task's own entries first: what repeats there is
marked at once and shipped once, so a passage that a third of all documents
share reaches its bucket once a task, whatever its number of copies; windows
that reach out of such a passage find an anchor outside it, so they spread.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.textbytes import memory_of, segments, settle

K = 16
#: Text bytes that one bucket stands for, and the most shuffle partitions asked for.
BUCKET_BYTES, MAX_PARTITIONS = 8 << 20, 50_000
#: Text bytes that a map task gathers before it ships, and entries of a bucket's new batch.
TASK_BYTES, BATCH = 16 << 20, 20_000

#: Documents whose strings are counted to find the common ones, characters of each, and the share that makes a string common.
SAMPLE, SAMPLE_CHARS, COMMON_SHARE = 600, 1 << 15, 0.02
#: Longest period whose repeats are found where they stand.
MAX_PERIOD = 1024

_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POS = np.uint64(24)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(27))


def _hashes(buf: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``K`` bytes."""
    h, step, factor = _BYTE[buf], 1, int(_ODD)
    while step < K:
        h = h[:-step] * np.uint64(factor) + h[step:]
        factor = factor * factor & (1 << 64) - 1
        step *= 2
    return _mixed(h)


class Common:
    """A set of hashes with a bit table in front, for many lookups of which few succeed."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def places(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that are in the set."""
        if not len(self.hashes):
            return np.zeros(0, np.int64)
        some = np.flatnonzero(self.table[(h >> np.uint64(44)).astype(np.int32)])
        at = np.minimum(np.searchsorted(self.hashes, h[some]), len(self.hashes) - 1)
        return some[self.hashes[at] == h[some]]


def common_strings(docs: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Hashes of the strings that many documents share, from about ``sample`` documents drawn by hash.

    They only steer which anchors windows prefer, so that no bucket gets the
    surroundings of a passage that a large part of all documents has; the
    result doesn't depend on them. The sample's texts are bounded in number and
    length, and so is what comes back.
    """
    total, grain = docs.count(), 1 << 20
    part = docs.where(F.pmod(F.xxhash64("doc", F.lit("common")), F.lit(grain)) < int(grain * min(1.0, sample / max(total, 1))) + 1)
    texts = part.where("text is not null").select(F.substring("text", 1, SAMPLE_CHARS).alias("t"), F.xxhash64("doc", "text").alias("h")).orderBy("h").limit(2 * sample).toArrow()["t"].to_pylist()
    found = [np.unique(_hashes(np.frombuffer(t.encode(), np.uint8))) for t in texts if len(t.encode()) >= K]
    if len(found) < 50:
        return np.zeros(0, np.uint64)
    names, count = np.unique(np.concatenate(found), return_counts=True)
    return names[count >= max(5, COMMON_SHARE * len(found))]


def _edges(at: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of every run of valid windows of one anchor."""
    first, last = valid.copy(), valid.copy()
    first[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
    last[:-1] &= (at[1:] != at[:-1]) | ~valid[1:]
    return np.flatnonzero(first), np.flatnonzero(last)


def periodic(buf: np.ndarray, starts: np.ndarray, h: np.ndarray, j: np.ndarray, p0: np.ndarray, p1: np.ndarray, length: int) -> np.ndarray:
    """Windows that are equal to the one a period before them in their segment.

    In a run of period ``d`` anchors of one hash follow each other at that
    distance; a run of such entries is compared with the bytes ``d`` before it.
    """
    out = np.zeros(len(buf), bool)
    which = np.searchsorted(starts, p0, side="right") - 1
    order = np.argsort(h, kind="stable")
    d = np.zeros(len(h), np.int64)
    close = (h[order[1:]] == h[order[:-1]]) & (which[order[1:]] == which[order[:-1]]) & (j[order[1:]] - j[order[:-1]] <= MAX_PERIOD)
    d[order[1:][close]] = (j[order[1:]] - j[order[:-1]])[close]
    go = np.concatenate([[False], (d[1:] == d[:-1]) & (which[1:] == which[:-1])])
    heads = np.flatnonzero((d > 0) & ~go)
    tails = np.flatnonzero((d > 0) & ~np.concatenate([go[1:], [False]]))
    for a, b in zip(heads.tolist(), tails.tolist()):
        gap = int(d[a])
        low, high = max(int(p0[a]), int(starts[which[a]]) + gap), int(p1[b]) + 1
        if low >= high:
            continue
        wrong = np.zeros(high - low + length, np.int32)
        np.cumsum(buf[low : high - 1 + length] != buf[low - gap : high - 1 + length - gap], out=wrong[1:])
        out[low:high] = wrong[length:] == wrong[:-length]
    return out


def anchors(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, common: Common) -> tuple[np.ndarray, ...]:
    """Entries of the segments ``[starts, ends)`` of ``buf``, and windows that repeat at once.

    Hash, anchor, first and last window of every entry; first and last window
    of every run that repeats what stands a short period before it. Those are
    in no entry: the run's first period stands for them all.
    """
    none = np.zeros(0, np.int64)
    if len(buf) < length:
        return np.zeros(0, np.uint64), none, none, none, none, none
    h = _hashes(buf)
    rank = h >> np.uint64(1)
    rank[common.places(h)] |= np.uint64(1 << 63)
    low = (rank >> _POS << _POS) | np.arange(len(h), dtype=np.uint64)
    width, span = length - K + 1, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    at = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
    valid = np.zeros(len(at) + 1, np.int8)
    fits = ends - starts >= length
    np.add.at(valid, starts[fits], 1)
    np.add.at(valid, ends[fits] - length + 1, -1)
    valid = np.cumsum(valid[:-1], dtype=np.int8) > 0
    p0, p1 = _edges(at, valid)
    j = at[p0]
    again = periodic(buf, starts, h[j], j, p0, p1, length)[: len(valid)] & valid
    if not again.any():
        return h[j], j, p0, p1, none, none
    p0, p1 = _edges(at, valid & ~again)
    j = at[p0]
    return h[j], j, p0, p1, *_edges(np.searchsorted(starts, np.arange(len(valid)), side="right"), again)


class Level:
    """Entries in the order of their owners, with the two suffix orders.

    ``left`` and ``right`` are the bytes that belong to the windows before and
    from the anchor on; ``done[i, l]`` marks the window of entry ``i`` that
    starts ``l`` bytes before its anchor as a repeat.
    """

    def __init__(self, doc, at, left, right, ctx, done=None, orders=None):
        self.doc, self.at, self.left, self.right, self.ctx = doc, at, left, right, ctx
        self.room = ctx.shape[1] - right_room(ctx.shape[1])
        self.done = np.zeros((len(doc), self.room + 1), bool) if done is None else done
        if orders is None:
            orders = [np.argsort(k, kind="stable") for k in self.keys()]
        self.orders = orders

    def __len__(self) -> int:
        return len(self.doc)

    def keys(self) -> list[np.ndarray]:
        """The bytes after and (reversed) before each anchor; a last byte keeps trailing zeros."""
        end = np.ones((len(self), 1), np.uint8)
        out = []
        for part in (self.ctx[:, self.room :], self.ctx[:, : self.room][:, ::-1]):
            part = np.ascontiguousarray(np.concatenate([part, end], 1))
            out.append(part.view(f"S{part.shape[1]}").ravel())
        return out

    @classmethod
    def merged(cls, a: Level, b: Level) -> Level:
        """Both levels' entries; the sorted runs are merged, not sorted anew."""
        cat = lambda n: np.concatenate([getattr(a, n), getattr(b, n)])
        doc, at = cat("doc"), cat("at")
        order = np.lexsort((at, doc))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        orders = []
        for ka, kb, oa, ob in zip(a.keys(), b.keys(), a.orders, b.orders):
            run = np.concatenate([oa, ob + len(a)])
            merge = np.argsort(np.concatenate([ka[oa], kb[ob]]), kind="stable")
            orders.append(place[run[merge]])
        return cls(doc[order], at[order], cat("left")[order], cat("right")[order], cat("ctx")[order], cat("done")[order], orders)

    def scan(self) -> Level:
        """Marks every window that an earlier owner in this level has too."""
        n = len(self)
        if n < 2:
            return self
        length = self.ctx.shape[1] - self.room
        commons = []
        for part, order in zip((self.ctx[:, self.room :], self.ctx[:, : self.room][:, ::-1]), self.orders):
            rows = part[order]
            differ = rows[1:] != rows[:-1]
            commons.append(np.where(differ.any(1), differ.argmax(1), part.shape[1]))
        ids = np.empty(n, np.int64)
        for l in range(self.room + 1):
            some = np.flatnonzero((self.left >= l) & (self.right >= length - l))
            if len(some) < 2:
                continue
            key = np.zeros(n, np.int64)
            for order, common, depth in zip(self.orders, commons, (length - l, l)):
                ids[order[0]] = 0
                ids[order[1:]] = np.cumsum(common < depth)
                key = key * n + ids
            _, first, back = np.unique(key[some], return_index=True, return_inverse=True)
            owner = some[first[back]]
            later = (self.doc[owner] != self.doc[some]) | (self.at[owner] != self.at[some])
            self.done[some[later], l] = True
        return self

    def split(self) -> tuple[Level, Level]:
        """What still may own a window, and what repeats entirely."""
        live = self.owning()
        return self.take(live), self.take(~live)

    def owning(self) -> np.ndarray:
        """Entries with a window that is not marked."""
        l = np.arange(self.room + 1)
        length = self.ctx.shape[1] - self.room
        return ((self.left[:, None] >= l) & (self.right[:, None] >= length - l) & ~self.done).any(1)

    def take(self, mask: np.ndarray) -> Level:
        place = np.cumsum(mask) - 1
        orders = [place[o[mask[o]]] for o in self.orders]
        return Level(self.doc[mask], self.at[mask], self.left[mask], self.right[mask], self.ctx[mask], self.done[mask], orders)

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, begin and end of every run of marked windows."""
        length = self.ctx.shape[1] - self.room
        edge = np.zeros((len(self), 1), np.int8)
        step = np.diff(np.concatenate([edge, self.done[:, ::-1].astype(np.int8), edge], 1), axis=1)
        row, begin = np.nonzero(step == 1)
        _, end = np.nonzero(step == -1)
        base = self.at[row] - self.room
        return self.doc[row], base + begin, base + end - 1 + length


def right_room(width: int) -> int:
    """Of a context of ``2 * length - K`` bytes, those from the anchor on."""
    return (width + K) // 2


class Family:
    """The logarithmic family of one bucket."""

    def __init__(self):
        self.levels: list[Level] = []
        self.out: list[tuple[np.ndarray, ...]] = []

    def _keep(self, level: Level) -> Level:
        live, gone = level.split()
        self.out.append(gone.spans())
        return live

    def add(self, batch: Level) -> None:
        level = self._keep(batch.scan())
        while self.levels and len(self.levels[-1]) <= 2 * len(level):
            level = self._keep(Level.merged(self.levels.pop(), level).scan())
        self.levels.append(level)

    def finish(self) -> tuple[np.ndarray, ...]:
        while len(self.levels) > 1:
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(self._keep(Level.merged(a, b).scan()))
        self.out += [x.spans() for x in self.levels]
        return tuple(np.concatenate(x) for x in zip(*self.out)) if self.out else tuple(np.zeros(0, np.int64) for _ in range(3))


_codec = pa.Codec("zstd", compression_level=3)


def _planes(x: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones: most planes are all zeros."""
    return x.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _pack(doc, at, left, right, body: np.ndarray) -> bytes:
    raw = b"".join([np.int64(len(doc)).tobytes(), _planes(doc), _planes(at), left.tobytes(), right.tobytes(), body.tobytes()])
    return np.int64(len(raw)).tobytes() + _codec.compress(raw, asbytes=True)


class Blob:
    """Entries as they were shipped; ``first`` is the anchors' first bytes."""

    def __init__(self, blob: bytes):
        raw = _codec.decompress(blob[8:], int(np.frombuffer(blob, np.int64, 1)[0]), asbytes=True)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        self.doc, self.at = (np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, o).reshape(8, n).T).view("<i8").ravel() for o in (8, 8 + 8 * n))
        self.left, self.right = (np.frombuffer(raw, np.uint8, n, o).astype(np.int64) for o in (8 + 16 * n, 8 + 17 * n))
        self.body = np.frombuffer(raw, np.uint8, offset=8 + 18 * n)
        self.begin = np.cumsum(self.left + self.right) - (self.left + self.right)

    def names(self) -> np.ndarray:
        """A number of each entry's anchor, from its bytes."""
        at = (self.begin + self.left)[:, None] + np.arange(K)
        word = np.ascontiguousarray(self.body[at]).view("<u8")
        return _mixed(_mixed(word[:, 0]) * _ODD + word[:, 1])

    def level(self, keep: np.ndarray, length: int) -> Level:
        return _gather(self.doc, self.at, self.left, self.right, self.body, self.begin, np.flatnonzero(keep), length)


def _gather(doc, at, left, right, body, begin, which: np.ndarray, length: int) -> Level:
    """A level of some entries, in the order of their owners."""
    which = which[np.lexsort((at[which], doc[which]))]
    left, right = left[which].astype(np.int32), right[which].astype(np.int32)
    reach = np.arange(-(length - K), length, dtype=np.int32)
    inside = (reach >= -left[:, None]) & (reach < right[:, None])
    ctx = np.zeros(inside.shape, np.uint8)
    for i in range(0, len(which), 4096):
        part = slice(i, i + 4096)
        from_ = (begin[which[part]] + left[part])[:, None] + reach
        ctx[part] = np.where(inside[part], body[np.clip(from_, 0, len(body) - 1)], np.uint8(0))
    return Level(doc[which], at[which], left, right, ctx)


OUT = "bucket int, doc long, begin long, end long, blob binary"
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
_NAMES = ["bucket", "doc", "begin", "end", "blob"]


def _rows(bucket, doc, begin, end, blob) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((bucket, doc, begin, end, blob), _TYPES)], _NAMES)


def _united(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of the same document that overlap or touch as one."""
    if not len(doc):
        return doc, begin, end
    names, rank = np.unique(doc, return_inverse=True)
    base = rank.astype(np.int64) << np.int64(40)
    order = np.argsort(base + begin, kind="stable")
    begin, top = (base + begin)[order], np.maximum.accumulate((base + end)[order])
    first = np.concatenate([[True], begin[1:] > top[:-1]])
    last = np.concatenate([first[1:], [True]])
    low = (1 << 40) - 1
    return names[begin[first] >> 40], begin[first] & low, top[last] & low


def _span_rows(spans, buckets: int):
    doc, begin, end = _united(*spans)
    for i in range(0, len(doc), 50_000):
        part = slice(i, i + 50_000)
        n = len(doc[part])
        yield _rows((doc[part] % buckets).astype(np.int32), doc[part], begin[part], end[part], [None] * n)


def _runs(source: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of runs laid end to end; their places, eight times as large, are made for some runs at a time."""
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for i in range(0, len(size), 4096):
        part = slice(i, i + 4096)
        low, high = int(ends[i] - size[i]), int(ends[part][-1])
        out[low:high] = source[np.repeat(begin[part] - (ends[part] - size[part]), size[part]) + np.arange(low, high)]
    return out


def _ship(gathered: list[tuple[np.ndarray, ...]], length: int, buckets: int):
    """Scans a task's own repeats, then yields spans and the buckets' blobs; empties the list."""
    bodies = [x[-1] for x in gathered]
    h, doc, at, left, right = (np.concatenate(x) for x in list(zip(*gathered))[:-1])
    gathered.clear()
    body, filled = np.empty(sum(map(len, bodies)), np.uint8), 0
    while bodies:  # each goes as soon as it is copied
        x = bodies.pop(0)
        body[filled : filled + len(x)] = x
        filled += len(x)
    size = left.astype(np.int64) + right
    begin = np.cumsum(size) - size
    order = np.argsort(h, kind="stable")
    same = np.zeros(len(h), bool)
    equal = h[order][1:] == h[order][:-1]
    same[order[1:]] |= equal
    same[order[:-1]] |= equal
    live = np.ones(len(h), bool)
    some = np.flatnonzero(same)
    # groups of equal anchors stay together; parts bound the memory
    some = some[np.argsort(h[some], kind="stable")]
    cuts, marked = [0], []
    while cuts[-1] < len(some):
        end = min(cuts[-1] + BATCH, len(some))
        while end < len(some) and h[some[end]] == h[some[end - 1]]:
            end += 1
        cuts.append(end)
    for a, b in zip(cuts, cuts[1:]):
        part = some[a:b]
        part = part[np.lexsort((at[part], doc[part]))]
        level = _gather(doc, at, left, right, body, begin, part, length).scan()
        marked.append(level.spans())
        live[part] = level.owning()
    if marked:
        yield from _span_rows([np.concatenate(x) for x in zip(*marked)], buckets)
    keep = np.flatnonzero(live)
    bucket = ((h[keep] >> np.uint64(11)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    keep, bucket = keep[order], bucket[order]
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(keep) else np.zeros(1, int)
    ids, blobs = [], []
    for a, b in zip(edges, edges[1:]):
        k = keep[a:b]
        ids.append(int(bucket[a]))
        blobs.append(_pack(doc[k], at[k], left[k], right[k], _runs(body, begin[k], size[k])))
        if len(ids) >= 64:
            yield _rows(ids, *([None] * len(ids) for _ in range(3)), blobs)
            ids, blobs = [], []
    if ids:
        yield _rows(ids, *([None] * len(ids) for _ in range(3)), blobs)


def _map(length: int, buckets: int, hashes: np.ndarray):
    def run(batches):
        common = Common(hashes)
        memory_of("suffix_dedup")
        gathered, held = [], 0
        for buf, doc, base, starts, ends in segments(batches, length - 1):
            h, j, p0, p1, r0, r1 = anchors(buf, starts, ends, length, common)
            if len(r0):
                which = np.searchsorted(starts, r0, side="right") - 1
                shift = base[which] - starts[which]
                yield from _span_rows((doc[which], r0 + shift, r1 + length + shift), buckets)
            which = np.searchsorted(starts, p0, side="right") - 1
            shift = base[which] - starts[which]
            left, right = (j - p0).astype(np.uint8), (p1 + length - j).astype(np.uint8)
            gathered.append((h, doc[which], j + shift, left, right, _runs(buf, p0, left.astype(np.int64) + right)))
            held += len(buf)
            if held >= TASK_BYTES:
                yield from _ship(gathered, length, buckets)
                held = 0
        if gathered:
            yield from _ship(gathered, length, buckets)
        settle()

    return run


def _reduce(length: int, buckets: int):
    """Rows come sorted by bucket. Spans pass; of blobs, only entries whose anchor repeats are unpacked."""

    def bucket_rows(blobs):
        names, counts = [], []
        for b in blobs:
            x, c = np.unique(Blob(b).names(), return_counts=True)
            names.append(x)
            counts.append(c)
        names, back = np.unique(np.concatenate(names), return_inverse=True)
        many = names[np.bincount(back, np.concatenate(counts)) > 1]
        if not len(many):
            return
        family, waiting = Family(), None
        for b in blobs:
            blob = Blob(b)
            own = blob.names()
            keep = many[np.minimum(np.searchsorted(many, own), len(many) - 1)] == own
            if not keep.any():
                continue
            level = blob.level(keep, length)
            waiting = level if waiting is None else Level.merged(waiting, level)
            if len(waiting) >= BATCH:
                family.add(waiting)
                waiting = None
        if waiting is not None:
            family.add(waiting)
        yield from _span_rows(family.finish(), buckets)

    def run(batches):
        current, blobs = None, []
        for batch in batches:
            passed = batch.filter(pa.compute.is_null(batch.column(4)))
            if passed.num_rows:
                yield passed
            ids, data = batch.column(0).to_pylist(), batch.column(4)
            for i, b in enumerate(ids):
                if not data[i].is_valid:
                    continue
                if b != current and blobs:
                    yield from bucket_rows(blobs)
                    blobs = []
                current = b
                blobs.append(data[i].as_py())
        if blobs:
            yield from bucket_rows(blobs)
        blobs = []
        settle()

    return run


def repeated_spans(df: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text",
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(doc, begin, end)``: byte spans of repeated strings, overlapping and in no order."""
    if not K <= length <= 127:
        raise ValueError("length must be from 16 to 127 bytes")
    docs = df.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")).where(F.col("doc").isNotNull())
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    parts = int(min(max(buckets, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), MAX_PARTITIONS))
    buckets = max(buckets, parts)
    shipped = docs.mapInArrow(_map(length, buckets, common_strings(docs)), OUT).repartition(parts, "bucket").sortWithinPartitions("bucket")
    return shipped.mapInArrow(_reduce(length, buckets), OUT).select("doc", "begin", "end")


def _squeezed(batches):
    for batch in batches:
        small = [t and np.int64(len(t)).tobytes() + _codec.compress(t, asbytes=True) for t in batch.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(small, pa.binary()), *batch.columns[2:]], batch.schema.names)


def _expand(small: bytes | None) -> bytes:
    return _codec.decompress(small[8:], int(np.frombuffer(small, np.int64, 1)[0]), asbytes=True) if small else b""


def union_spans(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union; touching spans are one run."""
    order = np.argsort(begin, kind="stable")
    begin, top = begin[order], np.maximum.accumulate(end[order])
    first = np.concatenate([[True], begin[1:] > top[:-1]])
    last = np.concatenate([first[1:], [True]])
    return begin[first], top[last]


def cut(raw: bytes, begin: np.ndarray, end: np.ndarray) -> bytes:
    edges = np.concatenate([[0], np.stack([begin, end], 1).ravel(), [len(raw)]])
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def dedup(df: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text", keep_text: bool = False,
          keep: tuple[str, ...] = (), bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row: ``key``, the columns of ``keep``, ``n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept_text`` with ``keep_text``).

    ``key`` is an integer and unique; rows that repeat a key count as one
    document and get the union of their spans. Rows with a null key neither
    remove nor lose anything. Null texts are empty. Bytes that a cut leaves
    without their character are dropped from ``kept_text`` alone. Columns
    not in ``keep`` are left out; an empty table stays empty.
    """
    spans = repeated_spans(df, length, key, text, bucket_bytes).groupBy("doc").agg(
        F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends"))
    made = {"n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"}
    keep = tuple(c for c in keep if c != key and c not in made)
    own = df.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)))
    # what is joined is moved: the texts go compressed
    own = own.mapInArrow(_squeezed, ", ".join(f"`{c}` {'binary' if c == '_text' else t}" for c, t in own.dtypes))
    joined = own.join(spans, F.col("_id") == F.col("doc"), "left").select("_id", "_text", "begins", "ends", *own.columns[2:])
    fields = "".join(f"`{c}` {t}, " for c, t in df.select(*keep).dtypes)
    schema = f"`{key}` long, {fields}n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * keep_text

    def run(batches):
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                raw = _expand(batch.column(1)[i].as_py())
                n, runs, kept = len(raw), 0, raw
                if batch.column(2)[i].is_valid:
                    begin = batch.column(2)[i].values.to_numpy(zero_copy_only=False)
                    begin, end = union_spans(begin, batch.column(3)[i].values.to_numpy(zero_copy_only=False))
                    runs, kept = len(begin), cut(raw, begin, np.minimum(end, n))
                rows.append((n, n - len(kept), runs, hashlib.sha256(kept).hexdigest(), *[kept.decode(errors="ignore")] * keep_text))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.string()] * keep_text]
            columns = list(zip(*rows)) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[4:], *(pa.array(c, t) for c, t in zip(columns, types))],
                                             [key, *keep, "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept_text"] * keep_text])

    return joined.mapInArrow(run, schema)
