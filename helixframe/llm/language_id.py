"""Language identification of mixed-language text.

Every word is scored for every language by its character n-grams; the word's
script narrows which languages may take it. A Viterbi pass over the words, with
a penalty for switching, labels spans of one language; the text's language is
that of most letters.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.textbytes import memory_of, settle

GRAMS = (1, 2, 3, 4)
SLOTS = 1 << 16
#: Training rows used, at most (about): a sample by hash, whatever the input's size.
TRAIN_ROWS = 6_000
SWITCH = 12.0
#: A word's scores lie within this of its best.
WORST = 12.0
#: Share of a language's words that a script must have to count as its script.
SCRIPT_SHARE = 0.001
CACHE_WORDS = 400_000
#: Bytes of words that are held as objects at a time (by eight a word).
SLICE_BYTES = 2 << 20
#: Bytes that the Viterbi pass keeps for the way back, for one text at least.
PATH_BYTES = 48 << 20

# fixed values: first code points of script ranges (Unicode blocks) and the script's number
SCRIPT_STARTS = np.array([0x0, 0x370, 0x400, 0x530, 0x590, 0x600, 0x700, 0x900, 0x980, 0xE00, 0xE80, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x3100, 0x3400, 0xAC00, 0xD800, 0xF900, 0xFB00, 0xFF00, 0x20000, 0x30000])
SCRIPT_NUMBER = np.array([1, 2, 3, 4, 5, 6, 0, 7, 8, 9, 10, 11, 12, 0, 1, 2, 0, 13, 0, 14, 12, 0, 14, 0, 0, 14, 0])
SCRIPTS = 15

# digits, ASCII signs and white space part words
_BREAK = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_BREAK).split()


def grams(vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram slots of all words, and each one's word."""
    buf = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in vocabulary), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary)) + 2
    owner = np.repeat(np.arange(len(vocabulary)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(buf))
    slots, owners = [], []
    h = np.zeros(len(buf), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        if len(buf) < n:
            break
        h = (h[: len(buf) - n + 1] * np.uint64(0x100000001B3)) ^ (buf[n - 1 :] + np.uint64(n << 9))
        if n in GRAMS:
            whole = left[: len(h)] >= n
            mixed = h[whole] * np.uint64(0x9E3779B97F4A7C15)
            slots.append((mixed >> np.uint64(48)).astype(np.int64))
            owners.append(owner[: len(h)][whole])
    return np.concatenate(slots), np.concatenate(owners)


def script_of(word: bytes) -> int:
    """The script of a word's first letter; 0 unknown, -1 where the word has no letter."""
    for ch in word.decode(errors="replace"):
        if ch.isalpha():
            return int(SCRIPT_NUMBER[np.searchsorted(SCRIPT_STARTS, ord(ch), side="right") - 1])
    return -1


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # slots x languages, log probabilities
    scripts: np.ndarray  # scripts x languages, who uses which


def _counts(batches):
    memory_of("language_id")
    by: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by.setdefault(lang, Counter()).update(words(text))
    for lang, count in by.items():
        vocabulary = [w for w in count if script_of(w) >= 0]
        if not vocabulary:
            continue
        weight = np.fromiter((count[w] for w in vocabulary), np.float64, len(vocabulary))
        slots, owners = grams(vocabulary)
        sums = np.bincount(slots, weight[owners], SLOTS)
        script = np.bincount([script_of(w) for w in vocabulary], weight, SCRIPTS)
        keys = np.concatenate([np.flatnonzero(sums), SLOTS + np.flatnonzero(script)])
        values = np.concatenate([sums[sums > 0], script[script > 0]])
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.int32()), pa.array(values, pa.float64())], ["lang", "slot", "n"])


def train(df: DataFrame, lang: str = "lang", text: str = "text", order: str = "doc_id", max_rows: int = TRAIN_ROWS) -> Model:
    """Learns from rows with a language and a text; about ``max_rows`` of them, chosen by the hash of ``order`` (where that is null, of the text).

    The counts are summed on the cluster; what comes back is at most a fixed
    number of slots per language. Without usable rows no language is learned.
    """
    rows = df.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.coalesce(F.xxhash64(F.col(order)), F.lit(0)).alias("_o"), F.col(order).isNull().alias("_n")).where("lang is not null and text is not null")
    total = rows.count()
    grain = 1 << 20
    picked = rows.where(F.pmod(F.xxhash64("_o", F.when(F.col("_n"), F.col("text")), F.lit("lid")), F.lit(grain)) < math.ceil(grain * min(1.0, max_rows / max(total, 1)))).select("lang", "text")
    summed = picked.mapInArrow(_counts, "lang string, slot int, n double").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    names, slot, n = summed["lang"].to_pylist(), summed["slot"].to_numpy(), summed["n"].to_numpy()
    languages = sorted(set(names))
    which = np.array([languages.index(x) for x in names], np.int64)
    table = np.zeros((SLOTS + SCRIPTS, max(len(languages), 1)))
    np.add.at(table, (slot.astype(np.int64), which), n)
    sums, scripts = table[:SLOTS], table[SLOTS:]
    log = np.log((sums + 0.5) / (sums.sum(0) + 0.5 * SLOTS))
    return Model(languages, log.astype(np.float32), scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1))


class Scorer:
    """Word scores of a model, remembered within a task up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.used = 0
        self.scores = np.zeros((1 << 14, len(self.model.languages)), np.float32)
        self.letters = np.zeros(1 << 14, np.int32)

    def _learn(self, new: list[bytes]) -> None:
        slots, owners = grams(new)
        scores = np.empty((len(new), self.scores.shape[1]))
        for k in range(scores.shape[1]):
            scores[:, k] = np.bincount(owners, self.model.table[slots, k], len(new))
        script = np.fromiter(map(script_of, new), np.int64, len(new))
        allowed = self.model.scripts[np.maximum(script, 0)]
        allowed = allowed | ~allowed.any(1)[:, None]
        scores[~allowed] = -np.inf
        scores = np.maximum(scores - scores.max(1, keepdims=True), -WORST)
        scores[script < 0] = 0
        while self.used + len(new) > len(self.letters):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        self.scores[self.used : self.used + len(new)] = scores
        self.letters[self.used : self.used + len(new)] = [len(w.decode(errors="replace")) if s >= 0 else 0 for w, s in zip(new, script)]
        self.known.update(zip(new, range(self.used, self.used + len(new))))
        self.used += len(new)

    def rows(self, texts: pa.Array) -> list[np.ndarray]:
        """Each text's words as places in the tables; words are held for a slice of texts at a time."""
        if self.used > CACHE_WORDS:
            self._reset()
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            split, held = [], 0
            while at < len(texts) and (not split or held < SLICE_BYTES):
                split.append(words(texts[at].as_py()) if self.model.languages else [])
                held += len(split[-1]) * 8
                at += 1
            new = list(set().union(*split).difference(self.known))
            if new:
                self._learn(new)
            out += [np.fromiter(map(self.known.__getitem__, t), np.int32, len(t)) for t in split]
        return out


def viterbi(scores: np.ndarray, rows: list[np.ndarray], switch: float = SWITCH) -> list[np.ndarray]:
    """The best language path of every text; all texts step together, longest first."""
    sizes = np.array([len(r) for r in rows], np.int64)
    order = np.argsort(-sizes, kind="stable")
    kind = np.min_scalar_type(max(scores.shape[1] - 1, 0))
    paths = [np.zeros(n, kind) for n in sizes]
    steps = int(sizes.max(initial=0))
    if not steps:
        return paths
    active = np.searchsorted(-sizes[order], -np.arange(steps), side="left")
    flat = np.concatenate([rows[i] for i in order])
    starts = np.cumsum(sizes[order]) - sizes[order]
    value = scores[flat[starts[: active[0]]]].copy()
    ends = np.zeros(len(rows), kind)
    # what the way back needs, in flat arrays: step after step, a row for each text still active
    at = np.concatenate([[0], np.cumsum(active)])
    stays, bests = np.empty((int(at[-1]), scores.shape[1]), bool), np.empty(int(at[-1]), kind)
    for t in range(1, steps):
        n = active[t]
        ends[n : active[t - 1]] = value[n : active[t - 1]].argmax(1)
        value = value[:n]
        best = value.argmax(1)
        top = value[np.arange(n), best][:, None] - np.float32(switch)
        stays[at[t] : at[t + 1]] = value >= top
        bests[at[t] : at[t + 1]] = best
        value = np.maximum(value, top) + scores[flat[starts[:n] + t]]
    ends[: active[-1]] = value.argmax(1)
    out = np.zeros(len(flat), kind)
    state = ends.copy()
    for t in range(steps - 1, -1, -1):
        n = active[t]
        if t < steps - 1:
            m = active[t + 1]
            k = np.arange(m)
            state[:m] = np.where(stays[at[t + 1] + k, state[:m]], state[:m], bests[at[t + 1] : at[t + 2]])
        out[starts[:n] + t] = state[:n]
    for place, i in enumerate(order):
        paths[i] = out[starts[place] : starts[place] + sizes[i]]
    return paths


def paths(scores: np.ndarray, rows: list[np.ndarray], switch: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows with their best paths, as many texts at a time as the memory for the way back allows."""
    part: list[np.ndarray] = []
    for row in rows:
        if part and (sum(map(len, part)) + len(row)) * (scores.shape[1] + (1 if scores.shape[1] <= 256 else 2)) > PATH_BYTES:
            yield from zip(part, viterbi(scores, part, switch))
            part = []
        part.append(row)
    yield from zip(part, viterbi(scores, part, switch))


def identify(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (),
             spans: bool = False, switch: float = SWITCH) -> DataFrame:
    """Per row: ``key``, the columns of ``keep``, ``lang_pred`` and ``score``; with ``spans`` also ``lang_spans``.

    ``score`` is the share of the text's letters in spans of ``lang_pred``;
    ``lang_spans`` lists (lang, first word, end word). Texts that are null or
    without a letter are ``und`` with score 0 (so is every text if no language
    was learned). Ties go to the language first in the alphabet. Rows are
    independent: repeated rows repeat, an empty table stays empty, columns not
    named in ``keep`` are left out.
    """
    keep = tuple(c for c in keep if c not in (key, "lang_pred", "score", "lang_spans"))
    fields = ", ".join(f"`{c}` {t}" for c, t in df.select(key, *keep).dtypes)
    shipped = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        memory_of("language_id")
        scorer, names = Scorer(shipped.value), shipped.value.languages
        for batch in batches:
            rows = scorer.rows(batch.column(batch.num_columns - 1))
            preds, scores, found = [], [], []
            for row, path in paths(scorer.scores, rows, switch):
                letters = scorer.letters[row]
                weight = np.bincount(path, letters, len(names)) if len(row) else np.zeros(1)
                total = weight.sum()
                preds.append(names[int(weight.argmax())] if total else "und")
                scores.append(float(weight.max() / total) if total else 0.0)
                if spans:
                    edge = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1], [True]])) if len(path) else np.zeros(1, int)
                    found.append([{"lang": names[path[a]], "begin": int(a), "end": int(b)} for a, b in zip(edge, edge[1:])])
            kinds = pa.list_(pa.struct([("lang", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))
            extra = [pa.array(found, kinds)] if spans else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(preds, pa.string()), pa.array(scores, pa.float64()), *extra],
                                             [key, *keep, "lang_pred", "score", *["lang_spans"] * spans])
        del scorer
        settle()

    schema = f"{fields}, lang_pred string, score double" + ", lang_spans array<struct<lang string, begin long, end long>>" * spans
    return df.select(key, *keep, F.col(text).alias("_text")).mapInArrow(run, schema)
