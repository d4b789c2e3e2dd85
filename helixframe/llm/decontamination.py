"""Benchmark decontamination with a generalised suffix automaton of test items.

The words of all items go into one suffix automaton. A document's words are
streamed through it, which gives at every word the longest match that ends
there; a match of a window's length marks the window's words. An item shorter
than a window is one window as a whole.

An automaton holds at most about ``MAX_ITEM_WORDS`` words, so what is built and
shipped at once is bounded. A larger benchmark takes several automata, and the
documents a pass for each: every pass adds its marks to those of the passes
before, with a table written in between.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.textbytes import memory_of, settle
from helixframe.session import materialize, scratch

#: Item words that one automaton holds (about), and words of a piece of a longer item.
MAX_ITEM_WORDS, PIECE_WORDS = 1_000_000, 50_000

_WORD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else (c + 32 if 65 <= c <= 90 else 32) for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of digits, letters and non-ASCII characters."""
    return (text or "").encode().translate(_WORD).split()


class Automaton:
    """A generalised suffix automaton over word numbers, in flat arrays.

    Most states have one transition, kept in ``only`` and ``then``; further ones
    are in ``more``. ``owners`` names the items of every state in which a window
    ends, ``short`` the items that are one window as a whole.
    """

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int):
        self.window, self.vocabulary, self.names = window, {}, []
        self.only, self.then, self.link, self.length = array("i", [-1]), array("i", [0]), array("i", [-1]), array("i", [0])
        self.more: dict[int, dict[int, int]] = {}
        self.owners: dict[int, list[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        sequences = []
        for name, tokens in items:
            if tokens:
                sequences.append([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in tokens])
                self.names.append(name)
                last = 0
                for c in sequences[-1]:
                    last = self._extend(last, c)
        for number, ids in enumerate(sequences):
            state = 0
            for i, c in enumerate(ids, 1):
                state = self.step(state, c)
                while self.length[self.link[state]] >= window:
                    state = self.link[state]
                if i >= window:
                    own = self.owners.setdefault(state, [])
                    if not own or own[-1] != number:
                        own.append(number)
            if len(ids) < window:
                self.short.setdefault(state, []).append((len(ids), number))
        self.shortest = min([window, *(n for x in self.short.values() for n, _ in x)])

    def step(self, state: int, c: int) -> int:
        """The next state; 0 where there is none."""
        if self.only[state] == c:
            return self.then[state]
        return self.more[state].get(c, 0) if state in self.more else 0

    def _set(self, state: int, c: int, to: int) -> None:
        if self.only[state] in (-1, c):
            self.only[state], self.then[state] = c, to
        else:
            self.more.setdefault(state, {})[c] = to

    def _new(self, length: int, link: int, like: int | None = None) -> int:
        self.only.append(-1 if like is None else self.only[like])
        self.then.append(0 if like is None else self.then[like])
        self.length.append(length)
        self.link.append(link)
        state = len(self.only) - 1
        if like in self.more:
            self.more[state] = dict(self.more[like])
        return state

    def _split(self, q: int, p: int, c: int) -> int:
        """The state of ``q`` reached from ``p``: itself, or a copy for its shorter strings."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._new(self.length[p] + 1, self.link[q], q)
        self.link[q] = copy
        while p >= 0 and self.step(p, c) == q:
            self._set(p, c, copy)
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: int) -> int:
        q = self.step(last, c)
        if q:
            return self._split(q, last, c)
        new = self._new(self.length[last] + 1, 0)
        p = last
        while p >= 0 and not self.step(p, c):
            self._set(p, c, new)
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(self.step(p, c), p, c)
        return new

    def hits(self, tokens: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Marked words, and the numbers of the items whose windows occur."""
        n = len(tokens)
        ids = np.fromiter((self.vocabulary.get(w, -1) for w in tokens), np.int64, n)
        mark, found = np.zeros(n, bool), set()
        known = np.concatenate([[False], ids >= 0, [False]])
        edge = np.flatnonzero(known[1:] != known[:-1])
        for begin, end in zip(edge[::2], edge[1::2]):
            if end - begin < self.shortest:
                continue
            state, length = 0, 0
            for i, c in enumerate(ids[begin:end].tolist(), int(begin) + 1):
                to = self.step(state, c)
                while state and not to:
                    state = self.link[state]
                    length = self.length[state]
                    to = self.step(state, c)
                if to:
                    state, length = to, length + 1
                if length >= self.shortest:
                    self._close(state, length, i, mark, found)
        return mark, found

    def _close(self, state: int, length: int, end: int, mark: np.ndarray, found: set[int]) -> None:
        """Windows that end at ``end``: the walk up the suffix links meets each length once."""
        while state > 0:
            low, high = self.length[self.link[state]], min(self.length[state], length)
            if low < self.window <= high:
                mark[end - self.window : end] = True
                found.update(self.owners[state])
            for size, number in self.short.get(state, ()):
                if low < size <= high:
                    mark[end - size : end] = True
                    found.add(number)
            state = self.link[state]


def _item_pieces(window: int):
    """Items as their words; a long one in pieces that overlap by all but one word of a window."""

    def run(batches):
        for batch in batches:
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = words(text)
                for at in range(0, max(len(tokens) - window + 1, 1 if tokens else 0), PIECE_WORDS):
                    part = tokens[at : at + PIECE_WORDS + window - 1]
                    rows.append((name, b" ".join(part), len(part)))
            columns = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.binary(), pa.int64()))], ["item", "words", "n"])

    return run


def _parts(benchmark: DataFrame, item: str, text: str, window: int) -> Iterator[tuple[Automaton, bool]]:
    """The benchmark's automata, one at a time, and whether it is the last."""
    pieces = benchmark.select(F.col(item).cast("string"), text).mapInArrow(_item_pieces(window), "item string, words binary, n long")
    parts = max(1, -(-(pieces.agg(F.sum("n")).first()[0] or 0) // MAX_ITEM_WORDS))
    if parts > 1:
        pieces = materialize(pieces, "items", lasting=True)
    for k in range(parts):
        rows = pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == k).select("item", "words").collect()
        listed = sorted(((r[0], bytes(r[1]).split(b" ")) for r in rows), key=lambda x: (x[0] is None, x[0] or "", x[1]))
        yield Automaton(listed, window), k == parts - 1


def scan(df: DataFrame, benchmark: DataFrame, window: int = 10, key: str = "doc_id", text: str = "text",
         item: str = "item_id", item_text: str = "text", clean: bool = False, max_span: int = 0, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: ``key``, the columns of ``keep``, ``n_words, n_hit, n_items, items_sha256, contaminated``.

    A window is ``window`` consecutive words of an item, or a shorter item as a
    whole; ``n_hit`` counts the document's words inside any occurrence. With
    ``clean`` also ``items`` (array), ``coverage`` (share of words hit) and
    ``clean_text``: the text without hit spans of more than ``max_span`` words.

    Null and empty texts have no words; items without words match nothing;
    items with equal text are all reported; a repeated item_id counts once and
    a null one marks words but is not counted or named.
    Repeated rows repeat, columns not in ``keep`` are left out, an empty table stays
    empty and an empty benchmark hits nothing.
    """
    made = {"n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "coverage", "clean_text"}
    keep = tuple(c for c in keep if c != key and c not in made)
    rows = df.select(key, *keep, F.col(text).alias("_text"))
    fields = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:-1])
    done = f"{fields}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean" + ", items array<string>, coverage double, clean_text string" * clean
    width = 1 + len(keep)
    first = True
    with scratch(df.sparkSession):
        for automaton, last in _parts(benchmark, item, item_text, window):
            shipped = df.sparkSession.sparkContext.broadcast(automaton)
            rows = rows.mapInArrow(_marked(shipped, width, first, last, clean, max_span), done if last else f"{fields}, _text string, _mark binary, _items array<string>")
            # the last pass is for the caller to run
            rows = rows if last else materialize(rows, "marks", lasting=True)
            first = False
    return rows


def _marked(shipped, width: int, first: bool, last: bool, clean: bool, max_span: int):
    """One pass: marks of this automaton, added to those of the passes before."""
    kinds = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())]
    kinds += [("items", pa.list_(pa.string())), ("coverage", pa.float64()), ("clean_text", pa.string())] * clean
    if not last:
        kinds = [("_mark", pa.binary()), ("_items", pa.list_(pa.string()))]

    def run(batches):
        memory_of("decontamination")
        automaton = shipped.value
        for batch in batches:
            out = []
            for i, value in enumerate(batch.column(width).to_pylist()):
                tokens = words(value)
                mark, found = automaton.hits(tokens)
                names = {automaton.names[k] for k in found} - {None}
                if not first:
                    mark |= np.unpackbits(np.frombuffer(batch.column(width + 1)[i].as_py(), np.uint8), count=len(tokens)).astype(bool)
                    names.update(batch.column(width + 2)[i].as_py())
                names = sorted(names)
                if not last:
                    out.append((np.packbits(mark).tobytes(), names))
                    continue
                n = int(mark.sum())
                row = (len(tokens), n, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), n > 0)
                if clean:
                    row += (names, n / len(tokens) if tokens else 0.0, _without(value, mark, max_span) if n else value)
                out.append(row)
            columns = list(zip(*out)) if out else [[]] * len(kinds)
            kept = batch.columns[: width if last else width + 1]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, t) for c, (_, t) in zip(columns, kinds))],
                                             [*batch.schema.names[: len(kept)], *(n for n, _ in kinds)])
        settle()

    return run


_SPAN = re.compile(rb"[^ ]+")


def _without(text: str, mark: np.ndarray, max_span: int) -> str:
    """The text without the runs of marked words longer than ``max_span``."""
    raw = text.encode()
    places = [m.span() for m in _SPAN.finditer(raw.translate(_WORD))]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
    kept, at = [], 0
    for a, b in zip(edge[::2], edge[1::2]):
        if b - a > max_span:
            kept.append(raw[at : places[a][0]])
            at = places[b - 1][1]
    return b"".join([*kept, raw[at:]]).decode()
