"""Best-fit packing of token pieces by minimum bin slack.

``token_pieces`` tokenizes texts and cuts documents that exceed a sequence.
``pack_pieces`` packs pieces: a bin starts with the longest length left, and a
bitset subset-sum dynamic programme over the lengths still available finds the
fullest feasible combination for the rest of the bin, which is then removed.
Bins depend on lengths alone, so the programme runs on the histogram of
lengths (at most ``capacity`` numbers, whatever the corpus) and takes a found
combination as often as its scarcest length allows. The pieces then find their
place by their rank among the pieces of their length.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.llm.textbytes import memory_of, settle
from helixframe.session import materialize

CAPACITY = 4096
END_ID = 1
#: Pieces of text a Python worker remembers (about 30 bytes each), and the places they are looked up in.
CACHE_WORDS, SLOTS = 1_000_000, 1 << 21
_SHIFT = np.uint64(64 - 21)
#: Rows of one length that are ranked together: at least so many, and at most a share of all rows.
RANK_ROWS, RANK_SHARE = 2_000, 10_000

#: Bytes of text that are split into pieces at a time.
CHUNK = 2 << 20

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\n", b"abcdefghijklmnopqrstuvwxyz ")
# byte classes: space, letter, digit, other ASCII sign, and what may belong to either side (apostrophes,
# other white space and non-ASCII characters, which normalisation may join or the pre-tokenizer may class alike)
_SPACE, _LETTER, _DIGIT, _SIGN, _STICKY = range(5)
_CLASS = np.full(256, _STICKY, np.uint8)
_CLASS[33:127] = _SIGN
_CLASS[[39]] = _STICKY
_CLASS[32] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[97:123] = _LETTER
_PREV, _NEXT = np.divmod(np.arange(25), 5)
_INNER = ((_PREV != _NEXT) & (_PREV != _STICKY) & (_NEXT != _STICKY)) | ((_PREV == _DIGIT) & (_NEXT == _DIGIT))
_BEGINS = (_NEXT != _SPACE) & ((_PREV == _SPACE) | _INNER)
_ENDS = (_PREV != _SPACE) & ((_NEXT == _SPACE) | _INNER)
_LOWEST = np.array([0, *((1 << 8 * n) - 1 for n in range(1, 9))], np.uint64)
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

# fixed values: the normaliser and the pre-tokenizer for which texts may be cut into pieces
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def piece_keys(raw: bytes, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every piece; ``raw`` has eight spare bytes at its end."""
    words = np.ndarray(len(raw) - 7, np.dtype("<u8"), raw, strides=(1,))
    h = size.astype(np.uint64) * _ODD[1]
    some, at, left = np.arange(len(begin)), begin, size
    while len(some):
        h[some] = _scrambled(h[some] * _ODD[1] ^ (words[at] & _LOWEST[np.minimum(left, 8)]) * _ODD[0])
        more = left > 8
        some, at, left = some[more], at[more] + 8, left[more] - 8
    return h


def _cuts(text: bytes) -> Iterator[bytes]:
    """A long text in parts of about ``CHUNK`` bytes that begin at a space; without any space it is one part."""
    at = 0
    while len(text) - at > CHUNK:
        end = text.rfind(b" ", at + 1, at + CHUNK)
        end = text.find(b" ", at + CHUNK) if end < 0 else end
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


class WordIds:
    """Token ids of texts, each distinct piece of text being encoded by the tokenizer once.

    With the normaliser and pre-tokenizer above, a text may be cut at spaces
    and line ends, where two ASCII classes (letters, digits, signs) meet, and
    between digits: no pre-token spans such a place and none of the steps looks
    across it. Other tokenizers encode whole texts (``exact``), and so do
    texts with one of the added tokens in any case, which are looked for before
    normalisation. Pieces are known by a 64-bit hash of their bytes in a table
    of ``SLOTS`` places, of which a newcomer takes its own; beyond
    ``CACHE_WORDS`` everything is forgotten, so the memory is bounded.
    """

    def __init__(self, path: str, exact: bool = False, end_id: int = END_ID):
        # tasks fill the cores already
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model, added = told["model"], told["added_tokens"]
        plain = (
            told["normalizer"] == NORMALIZER and told["pre_tokenizer"] == PRE_TOKENIZER and model["type"] == "BPE"
            and not model.get("dropout") and not any(t["normalized"] or t["lstrip"] or t["rstrip"] for t in added)
        )
        self.exact = exact or not plain
        self.added = [t["content"].encode().translate(_LOWER) for t in added]
        self._reset()

    def _reset(self) -> None:
        self.keys, self.place = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int32)
        self.flat, self.starts, self.sizes = np.zeros(1 << 16, np.uint32), np.zeros(1 << 15, np.int64), np.zeros(1 << 15, np.int32)
        # entry 0 is the end of a document
        self.flat[0], self.sizes[0], self.count, self.used = self.end_id, 1, 1, 1

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> np.ndarray:
        """Encodes new pieces; their entries."""
        ids: list = [None] * len(words)
        others, model = [], self.tokenizer.model
        for i, w in enumerate(words):
            if w.isalpha():
                ids[i] = [t.id for t in model.tokenize(w.decode())]
            else:
                others.append(i)
        for a in range(0, len(others), 20_000):
            part = others[a : a + 20_000]
            for i, e in zip(part, self.tokenizer.encode_batch_fast([words[i].decode() for i in part], add_special_tokens=False)):
                ids[i] = e.ids
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        total, n = int(sizes.sum()), len(ids)
        while self.count + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.used + n > len(self.sizes):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        self.flat[self.count : self.count + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        at = np.arange(self.used, self.used + n)
        self.starts[at], self.sizes[at] = self.count + np.cumsum(sizes) - sizes, sizes
        slot = (keys >> _SHIFT).astype(np.int64)
        self.keys[slot], self.place[slot] = keys, at
        self.used += n
        self.count += total
        return at

    def _chunk(self, parts: list[bytes], ended: bool = True) -> list[np.ndarray]:
        """The ids of each lower-cased part, with the end of a document if ``ended``."""
        if self.used > CACHE_WORDS:
            self._reset()
        raw = b" " + b" ".join(parts) + b" " * 9
        kind = _CLASS[np.frombuffer(raw, np.uint8)]
        pair = kind[:-1] * np.uint8(5) + kind[1:]
        begin, end = np.flatnonzero(_BEGINS[pair]) + 1, np.flatnonzero(_ENDS[pair]) + 1
        key = piece_keys(raw, begin, end - begin)
        slot = (key >> _SHIFT).astype(np.int64)
        entry = self.place[slot].astype(np.int64)
        new = np.flatnonzero((self.keys[slot] != key) | (entry == 0))
        if len(new):
            names, first, back = np.unique(key[new], return_index=True, return_inverse=True)
            at = new[first]
            entry[new] = self._learn(names, [raw[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist())])[back]
        last = np.searchsorted(begin, np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1))
        if ended:
            entry = np.insert(entry, last, 0)
            last = last + np.arange(1, len(parts) + 1)
        sizes = self.sizes[entry].astype(np.int64)
        tops = np.cumsum(sizes)
        flat = self.flat[np.repeat(self.starts[entry] - (tops - sizes), sizes) + np.arange(int(sizes.sum()))]
        cuts = np.concatenate([[0], tops])[last]
        return [flat[a:b] for a, b in zip(np.concatenate([[0], cuts]), cuts)]

    def encode(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """The ids of each UTF-8 text and then the end of the document, in order."""
        group: list[bytes] = []
        held = 0
        for text in texts:
            low = text.translate(_LOWER)
            whole = self.exact or any(t in low for t in self.added)
            if whole or held + len(low) > CHUNK:
                yield from self._chunk(group) if group else ()
                group, held = [], 0
            if whole:
                ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
                yield np.append(np.asarray(ids, np.uint32), np.uint32(self.end_id))
            elif len(low) > CHUNK:
                parts = [self._chunk([part], ended=False)[0] for part in _cuts(low)]
                yield np.append(np.concatenate(parts), np.uint32(self.end_id))
            else:
                group.append(low)
                held += len(low)
        yield from self._chunk(group) if group else ()


def _word_ids(path: str, exact: bool, end_id: int) -> WordIds:
    known = memory_of("packing")
    if (path, exact, end_id) not in known:
        known[path, exact, end_id] = WordIds(path, exact, end_id)
    return known[path, exact, end_id]


def token_pieces(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                 end_id: int = END_ID, keep_ids: bool = False, exact: bool = False) -> DataFrame:
    """``key, piece, start, length, ids_crc32`` (and ``ids`` with ``keep_ids``).

    A document is its text's ids and then ``end_id``; null and empty texts are
    the end alone. Only documents longer than ``capacity`` are cut. Repeated
    rows give repeated pieces; other columns are left out.
    """
    kind = dict(df.dtypes)[key]
    names = [key, "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * keep_ids]

    def run(batches):
        words = _word_ids(tokenizer, exact, end_id)
        for big in batches:
            for at in range(0, big.num_rows, 2000):
                batch = big.slice(at, 2000)
                rows, owner = [], []
                texts = batch.column(1).fill_null("").cast(pa.binary()).to_pylist()
                for i, ids in enumerate(words.encode(texts)):
                    ids = ids.astype("<u4", copy=False)
                    for piece, begin in enumerate(range(0, len(ids), capacity)):
                        part = ids[begin : begin + capacity]
                        owner.append(i)
                        rows.append((piece, begin, len(part), zlib.crc32(part.tobytes()), *[part.tolist()] * keep_ids))
                columns = list(zip(*rows)) if rows else [[]] * len(types)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, types))], names)
        settle()

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * keep_ids)


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """The lengths (with repeats, at most ``counts`` each) whose sum comes nearest to ``room`` from below.

    ``lengths`` is in descending order. Bit ``s`` of the set says that some
    combination sums to ``s``; the search ends once ``room`` itself is reached.
    """
    reach, steps, mask = 1, [], (1 << room + 1) - 1
    goal = 1 << room
    for size in lengths:
        if size > room:
            continue
        for _ in range(min(counts[size], room // size)):
            grown = (reach | reach << size) & mask
            if grown == reach:
                break
            steps.append((size, reach))
            reach = grown
            if reach & goal:
                break
        if reach & goal:
            break
    at, chosen = reach.bit_length() - 1, []
    for size, before in reversed(steps):
        if not before >> at & 1:
            chosen.append(size)
            at -= size
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int, int]]:
    """``(lengths of a bin, how many such bins, number of the first)``.

    A combination is taken until its scarcest length runs short, after which
    that length is left fewer than ``capacity / length`` times; so there are at
    most about ``capacity * (ln capacity + 1)`` combinations.
    """
    counts = {k: v for k, v in histogram.items() if v}
    lengths = sorted(counts, reverse=True)
    plan, first = [], 0
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        bin_ = [longest, *fullest(lengths, counts, capacity - longest)]
        counts[longest] += 1
        need = {k: bin_.count(k) for k in set(bin_)}
        times = min(counts[k] // n for k, n in need.items())
        for k, n in need.items():
            counts[k] -= n * times
        lengths = [k for k in lengths if counts[k]] if any(not counts[k] for k in need) else lengths
        plan.append((bin_, times, first))
        first += times
    return plan


def pack_pieces(pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with ``length`` from 1 to ``capacity``.

    Pieces of a length are ranked in groups of bounded size (a hot length is
    split by hash; group counts give each group its first rank), so no length
    is gathered in one task. Null keys and repeated rows are packed like any
    other; columns named sequence_id or offset are replaced.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = max(1, -(-max(histogram.values(), default=1) // max(RANK_ROWS, sum(histogram.values()) // RANK_SHARE)))
    taken: dict[int, int] = {}
    slots = []
    for lengths, times, first in plan_bins(histogram, capacity):
        offset = 0
        for size in lengths:
            rank = taken.get(size, 0)
            slots.append((size, rank, rank + times, first, offset))
            taken[size] = rank + times
            offset += size
    table = spark.createDataFrame(slots, "_l long, _from long, _to long, _first long, offset long")
    salted = pieces.withColumn("_part", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = salted.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("length", "_part").orderBy(key, "piece", "ids_crc32")) - 1
    # the plan's size depends on capacity alone (see plan_bins), not on the corpus
    return (
        salted.withColumn("_within", within).join(starts, ["length", "_part"])
        .withColumn("_rank", F.col("_within") + F.col("_start"))
        .join(F.broadcast(table), (F.col("length") == F.col("_l")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
        .select(*pieces.columns, (F.col("_first") + F.col("_rank") - F.col("_from")).alias("sequence_id"), "offset")
    )


def pack_documents(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID) -> DataFrame:
    """Tokenizes, cuts and packs the texts of ``df``; one row per piece."""
    return pack_pieces(materialize(token_pieces(df, tokenizer, key, text, capacity, end_id), "pieces"), key, capacity)
