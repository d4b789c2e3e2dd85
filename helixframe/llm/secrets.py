"""Secret scans with one combined deterministic automaton.

The rules' regexes become positions with their followers; subset construction
over all rules at once and minimisation give one transition array. Texts pass
through it byte by byte, many stretches side by side: a stretch starts as if
nothing came before it and is run again from its true state as far as the two
differ. A state says which rules end there. Between two bytes at which nothing
is under way, a rule that ended is settled: its reversed automaton marks the
starts, and the leftmost start with its longest end is taken, again and again.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of a stretch, and bytes that are scanned together.
LANE, BLOCK = 512, 1 << 20
#: Stands between documents; no UTF-8 text has it and no rule can match it.
BORDER = 0xFF


class Rule(NamedTuple):
    """Matches of ``pattern`` (leftmost, longest, non-overlapping) that ``keep`` matches whole, where it is given.

    The combined automaton counts the rule's repetitions up to ``count`` only,
    as the counters of several rules multiply its states; the rule's own
    automata, which settle what it finds, count in full. A rule without a rare
    beginning needs a higher count, or ordinary words have to be settled.
    """

    kind: str
    pattern: str
    keep: str | None = None
    count: int = 1


def any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in words)


_BEFORE = any_case("(password|passwd|secret|token|api_?key)") + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]"""
#: Spans of these kinds are the base; a run of one class that is too short has no part that is long enough.
BASE = (
    Rule("assign", _BEFORE + "+", _BEFORE + "{6,}"),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}", count=8),
)
#: Further kinds, after the published formats of such keys.
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{20,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{30,}"),
    Rule("stripe", "[rs]k_(live|test)_[A-Za-z0-9]{10,}"),
    Rule("private_key", "-----BEGIN ([A-Z0-9]+ )*PRIVATE KEY-----"),
)
RULES = BASE + MORE


# regexes


class _Part(NamedTuple):
    """A piece of a regex: whether it can be empty, and where it begins and ends."""

    empty: bool
    first: frozenset
    last: frozenset


class Positions:
    """A rule's byte sets, the positions that may follow each, and those that begin or end a match."""

    def __init__(self, pattern: str, most: int | None = None):
        """``most``: counted repetitions ask for no more than so many, which matches at the same places and more."""
        self._text, self._at, self._most = pattern, 0, most
        self.sets: list[frozenset] = []
        self.follow: list[set] = []
        whole = self._either()
        if self._at < len(pattern):
            raise ValueError(f"{pattern!r}: unexpected {pattern[self._at]!r} at {self._at}")
        if whole.empty:
            raise ValueError(f"{pattern!r} matches the empty text")
        self.first, self.last = whole.first, whole.last

    def reversed(self) -> Positions:
        back = object.__new__(Positions)
        back.sets, back.first, back.last = self.sets, self.last, self.first
        back.follow = [set() for _ in self.sets]
        for p, after in enumerate(self.follow):
            for q in after:
                back.follow[q].add(p)
        return back

    def _next(self) -> str:
        return self._text[self._at : self._at + 1]

    def _take(self) -> str:
        c = self._next()
        if not c:
            raise ValueError(f"{self._text!r} ends too early")
        self._at += 1
        return c

    def _either(self) -> _Part:
        out = self._row()
        while self._next() == "|":
            self._at += 1
            other = self._row()
            out = _Part(out.empty or other.empty, out.first | other.first, out.last | other.last)
        return out

    def _row(self) -> _Part:
        out = _Part(True, frozenset(), frozenset())
        while self._next() not in ("", "|", ")"):
            out = self._then(out, self._counted())
        return out

    def _then(self, a: _Part, b: _Part) -> _Part:
        for p in a.last:
            self.follow[p] |= b.first
        return _Part(a.empty and b.empty, a.first | (b.first if a.empty else frozenset()), b.last | (a.last if b.empty else frozenset()))

    def _again(self, a: _Part) -> _Part:
        for p in a.last:
            self.follow[p] |= a.first
        return a

    def _counted(self) -> _Part:
        start = self._at
        part = self._one()
        end, c = self._at, self._next()
        if c not in ("?", "*", "+", "{") or not c:
            return part
        self._at += 1
        if c == "{":
            stop = self._text.index("}", self._at)
            low, _, high = self._text[self._at : stop].partition(",")
            least, most = int(low), (None if "," in self._text[self._at : stop] and not high else int(high or low))
            if self._most is not None and least > self._most:
                least, most = self._most, None
            self._at = stop + 1
        else:
            least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        behind = self._at

        def copy() -> _Part:
            self._at = start
            out = self._one()
            assert self._at == end
            return out

        copies = [part] + [copy() for _ in range(max(least, most or 1, 1) - 1)]
        self._at = behind
        if most is None:
            self._again(copies[-1])
        out = _Part(True, frozenset(), frozenset())
        for i, x in enumerate(copies):
            out = self._then(out, x._replace(empty=True) if i >= least else x)
        return out

    def _one(self) -> _Part:
        c = self._take()
        if c == "(":
            out = self._either()
            if self._take() != ")":
                raise ValueError(f"{self._text!r}: a group is not closed")
            return out
        if c == "[":
            found = self._class()
        elif c == ".":
            found = frozenset(range(BORDER)) - {10}
        elif c in "?*+{":
            raise ValueError(f"{self._text!r}: nothing to repeat at {self._at - 1}")
        else:
            found = frozenset([self._byte(c)])
        self.sets.append(found)
        self.follow.append(set())
        at = frozenset([len(self.sets) - 1])
        return _Part(False, at, at)

    def _byte(self, c: str) -> int:
        if c == "\\":
            c = self._take()
            if c == "x":
                return int(self._take() + self._take(), 16)
            c = {"n": "\n", "r": "\r", "t": "\t"}.get(c, c)
        if ord(c) > 127:
            raise ValueError(f"{self._text!r}: only ASCII and \\xHH")
        return ord(c)

    def _class(self) -> frozenset:
        out: set[int] = set()
        inverse = self._next() == "^"
        self._at += inverse
        while (c := self._take()) != "]":
            low = high = self._byte(c)
            if self._next() == "-" and self._text[self._at + 1 : self._at + 2] not in ("]", ""):
                self._at += 1
                high = self._byte(self._take())
            out |= set(range(low, high + 1))
        return frozenset(range(BORDER)) - out if inverse else frozenset(out - {BORDER})


# automata


@dataclass
class Automaton:
    """``step[state * width + classes[byte]]`` is the next state, times ``width``; ``ends[state]`` has a bit for each rule.

    State 0 is where nothing has been read, and of a searching automaton also
    where nothing is under way. ``dead`` is a state nothing leads out of, or -1.
    """

    classes: np.ndarray
    step: np.ndarray
    width: int
    ends: np.ndarray
    dead: int

    @property
    def states(self) -> int:
        return len(self.ends)


def automaton(rules: list[Positions], search: bool) -> Automaton:
    """The minimal automaton of all ``rules``; ``search``: matches may begin anywhere."""
    sets, follow, first, ends = [], [], 0, []
    for k, r in enumerate(rules):
        base = len(sets)
        sets += r.sets
        follow += [sum(1 << (q + base) for q in f) for f in r.follow]
        first |= sum(1 << (q + base) for q in r.first)
        ends += [1 << k if p in r.last else 0 for p in range(len(r.sets))]
    # bytes that no set tells apart are one class; sets of positions are the bits of a number
    kinds: dict[int, int] = {}
    members = [sum(1 << p for p, s in enumerate(sets) if b in s) for b in range(256)]
    classes = np.array([kinds.setdefault(m, len(kinds)) for m in members], np.uint8)
    number, order, rows, bits = {0: 0} if search else {}, [0 if search else -1], [], []
    for state in order:
        here, reach, accepts = max(state, 0), first if search or state < 0 else 0, 0
        while here:
            p = here.bit_length() - 1
            here ^= 1 << p
            reach |= follow[p]
            accepts |= ends[p]
        row = []
        for m in kinds:
            to = reach & m
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        rows.append(row)
        bits.append(accepts)
    table, accept = np.array(rows, np.int32), np.array(bits, np.int64)
    # states stay together as long as no byte tells them apart
    _, block = np.unique(accept, return_inverse=True)
    count = block.max() + 1
    while True:
        _, block = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
        block = block.reshape(-1)
        if block.max() + 1 == count:
            break
        count = block.max() + 1
    # the first state keeps the number 0
    names = np.full(count, -1)
    _, seen = np.unique(block, return_index=True)
    names[block[np.sort(seen)]] = np.arange(count)
    block = names[block]
    small, final = np.empty((count, table.shape[1]), np.int32), np.empty(count, np.int64)
    small[block], final[block] = block[table], accept
    dead = [s for s in range(count) if not final[s] and (small[s] == s).all()]
    width = table.shape[1]
    return Automaton(classes, (small * width).ravel(), width, final, dead[0] * width if dead and not search else -1)


def run_states(buf: np.ndarray, a: Automaton, entry: int = 0) -> np.ndarray:
    """The state (times width) after each byte."""
    lanes = max(1, -(-len(buf) // LANE))
    kinds = np.full(lanes * LANE, a.classes[BORDER], np.uint8)
    kinds[: len(buf)] = a.classes[buf]
    kinds = np.ascontiguousarray(kinds.reshape(lanes, LANE).T)
    out = np.empty((LANE, lanes), np.int32)
    state = np.zeros(lanes, np.int32)
    for i in range(LANE):
        state = a.step.take(state + kinds[i])
        out[i] = state
    assumed = np.zeros(lanes, np.int32)
    while True:
        truth = np.concatenate([np.array([entry], np.int32), out[-1, :-1]])
        now = np.flatnonzero(truth != assumed)
        if not len(now):
            break
        assumed[now] = state = truth[now]
        for i in range(LANE):
            state = a.step.take(state + kinds[i, now])
            differs = state != out[i, now]
            if not differs.any():
                break
            now, state = now[differs], state[differs]
            out[i, now] = state
    return out.T.reshape(-1)[: len(buf)]


class Scanner:
    """Compiled rules."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        if len(rules) > 60:
            raise ValueError("an automaton takes 60 rules; scan with another for the rest")
        parts = [Positions(r.pattern) for r in rules]
        self.kinds = [r.kind for r in rules]
        self.all = automaton([Positions(r.pattern, r.count) for r in rules], search=True)
        self.forth = [automaton([p], search=False) for p in parts]
        self.back = [automaton([p.reversed()], search=True) for p in parts]
        self.keep = [automaton([Positions(r.keep)], search=False) if r.keep else None for r in rules]

    def episodes(self, buf: np.ndarray) -> list[tuple[int, int, int]]:
        """``(begin, end, rules)``: bytes in which something is under way, up to the last end of a rule, and the rules that end there."""
        out: dict[int, list[int]] = {}
        entry, quiet = 0, -1
        # by state times width
        ends = np.zeros(len(self.all.step), np.int64)
        ends[:: self.all.width] = self.all.ends
        for base in range(0, len(buf), BLOCK):
            states = run_states(buf[base : base + BLOCK], self.all, entry)
            entry = int(states[-1])
            bits = ends[states]
            hits = np.flatnonzero(bits)
            zeros = np.flatnonzero(states == 0)
            if len(hits):
                before = np.concatenate([[quiet], zeros + base])[np.searchsorted(zeros, hits)]
                edge = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
                masks = np.bitwise_or.reduceat(bits[hits], edge)
                last = hits[np.append(edge[1:], len(hits)) - 1] + base
                for b, e, m in zip(before[edge].tolist(), last.tolist(), masks.tolist()):
                    have = out.setdefault(b, [e, 0])
                    have[0], have[1] = e, have[1] | m
            if len(zeros):
                quiet = int(zeros[-1]) + base
        return [(b + 1, e + 1, m) for b, (e, m) in out.items()]

    def matches(self, raw: bytes, rule: int) -> list[tuple[int, int]]:
        """The rule's leftmost longest matches in ``raw``, one behind the other."""
        a, out = self.back[rule], []
        step, kinds, flags, state = a.step.tolist(), raw.translate(a.classes.tobytes()), bytearray(len(raw)), 0
        ends = [bool(x) for x in a.ends]
        for i in range(len(raw) - 1, -1, -1):
            state = step[state + kinds[i]]
            flags[i] = ends[state // a.width]
        at, f = 0, self.forth[rule]
        step, kinds, ends = f.step.tolist(), raw.translate(f.classes.tobytes()), [bool(x) for x in f.ends]
        while (at := flags.find(1, at)) >= 0:
            state, best = 0, at
            for i in range(at, len(raw)):
                state = step[state + kinds[i]]
                if state == f.dead:
                    break
                if ends[state // f.width]:
                    best = i + 1
            if self.keep[rule] is None or self._whole(raw[at:best], self.keep[rule]):
                out.append((at, best))
            at = best
        return out

    @staticmethod
    def _whole(raw: bytes, a: Automaton) -> bool:
        state, step = 0, a.step
        for c in raw.translate(a.classes.tobytes()):
            state = int(step[state + c])
        return bool(a.ends[state // a.width])

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Per text the ``(start, end, rule)`` of all spans in bytes, by start and rule."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        at = np.cumsum([0] + [len(t) + 1 for t in texts])
        raw = bytes([BORDER]).join([*texts, b""])
        for begin, end, rules in self.episodes(np.frombuffer(raw, np.uint8)):
            doc = int(np.searchsorted(at, begin, side="right")) - 1
            base = begin - int(at[doc])
            for k in range(len(self.kinds)):
                if rules >> k & 1:
                    found[doc] += [(base + s, base + e, k) for s, e in self.matches(raw[begin:end], k)]
        for f in found:
            f.sort(key=lambda x: (x[0], x[2]))
        return found


def code_points(raw: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans in code points."""
    if not spans or raw.isascii():
        return spans
    marks = sorted({x for s, e, _ in spans for x in (s, e)})
    heads = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    place, before, last = {}, 0, 0
    for m in marks:
        before += int(np.count_nonzero(heads[last:m]))
        place[m] = before
        last = m
    return [(place[s], place[e], k) for s, e, k in spans]


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with ``[kind]`` for every stretch that spans cover; a stretch has the kind of its first span."""
    out, at, open_to = [], 0, 0
    for start, end, kind in spans:
        if start >= open_to:
            out += [text[at:start], f"[{kind}]"]
        open_to = max(open_to, end)
        at = open_to
    return "".join([*out, text[at:]])


def scan(df: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text",
         keep: tuple[str, ...] = (), redacted: bool = False) -> DataFrame:
    """Per row: ``key``, the columns of ``keep``, ``spans`` (kind, start, end in code points, end exclusive) and, on demand, ``redacted``.

    Spans are in order of their start, then of the rules. Matches never cross
    documents. Null and empty texts have no spans (and a null text no
    ``redacted``); rows are independent, so repeated rows repeat and an empty
    table stays empty; columns not named in ``keep`` are left out.
    """
    new = ("spans", "redacted") if redacted else ("spans",)
    keep = tuple(c for c in keep if c != key and c not in new)
    fields = ", ".join(f"`{c}` {t}" for c, t in df.select(key, *keep).dtypes)
    shipped = df.sparkSession.sparkContext.broadcast(Scanner(rules))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        scanner = shipped.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            raws = [(t or "").encode() for t in texts]
            found = [code_points(r, s) for r, s in zip(raws, scanner.spans(raws))]
            named = [[(s, e, scanner.kinds[k]) for s, e, k in f] for f in found]
            columns = [pa.array([[{"kind": k, "start": s, "end": e} for s, e, k in n] for n in named], kind)]
            if redacted:
                columns.append(pa.array([t if t is None else redact(t, n) for t, n in zip(texts, named)], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [key, *keep, *new])

    schema = f"{fields}, spans array<struct<kind: string, start: bigint, end: bigint>>" + (", redacted string" if redacted else "")
    return df.select(key, *keep, df[text].alias("_text")).mapInArrow(run, schema)
