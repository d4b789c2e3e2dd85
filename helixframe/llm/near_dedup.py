"""Near-duplicate documents by a chosen-path set similarity join.

Every document's set of word shingles is sketched by minwise tokens. The join
builds independent trees: a node sends its documents to children by the values
of a few minwise tokens chosen for that node, so documents of similarity ``t``
share a child for each chosen token with probability ``t``. Small nodes are
compared exhaustively; nodes that stay large are branched on.

To find components it is enough to lose no link *between* components. So every
node's documents are first compared with the node's leader, the document whose
tokens are the most common (the original among its copies), as many pairs as
members. Those links are confirmed on full sets and merged, and only nodes
whose documents still belong to several components go on. A small one is
compared exhaustively. In a large one, documents close to the leader are
compared with the whole node, in blocks of bounded size, and leave it; the rest
is branched on. Comparisons take place where the sets are: a block yields the
links that merge components, never its pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm.textbytes import LOWER, memory_of, settle
from helixframe.operators.components import connected_components
from helixframe.session import materialize, scratch

SHINGLE = 5
TOKENS = 64
TREES, CHOSEN = 5, 2
#: Documents of a node that are compared exhaustively, and levels of branching beyond the root.
SMALL, DEPTH = 128, 4

_RNG = np.random.default_rng(77003311)
_MULT = _RNG.integers(1, 1 << 63, TOKENS, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = _RNG.integers(1, 1 << 63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = _RNG.integers(1, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


#: Bytes that are hashed at a time, and the powers of the base and its inverse up to there.
BLOCK = 1 << 18
_FORTH, _BACK = _powers(_BASE, BLOCK), _powers(_INVERSE, BLOCK + 1)


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of every word of lower-cased bytes; a word's hash doesn't depend on its place."""
    buf = np.frombuffer(raw, np.uint8)
    inside = np.concatenate([[False], ~_SPACE[buf], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edge[::2], edge[1::2]
    out = np.zeros(len(begin), np.uint64)
    for base in range(0, len(buf), BLOCK):
        part = buf[base : base + BLOCK]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * _FORTH[: len(part)], dtype=np.uint64)])
        a, b = np.searchsorted(end, base, side="right"), np.searchsorted(begin, base + len(part))
        # a word over a border is the sum of its parts, each shifted to its place in the word
        left, right = np.maximum(begin[a:b], base), np.minimum(end[a:b], base + len(part))
        shift = np.array([pow(_BASE, int(x), 1 << 64) for x in left - begin[a:b] if x], np.uint64)
        value = (sums[right - base] - sums[left - base]) * _BACK[left - base]
        value[left > begin[a:b]] *= shift
        out[a:b] += value
    return _scrambled(out + (end - begin).astype(np.uint64))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text."""
    words = word_hashes((text or "").encode().translate(LOWER))
    n = len(words)
    if n == 0:
        return words
    width = min(n, size)
    h = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        h = h + words[i : n - width + 1 + i] * _STEP[i]
    return np.unique(_scrambled(h))


def is_link(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _signatures(batches):
    memory_of("near_dedup")
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            s = shingles(text)
            sketch = [int((s * m).min() >> np.uint64(32)) - (1 << 31) for m in _MULT] if len(s) else []
            rows.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None, sketch))
        n, whole, sketch = zip(*rows) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(whole, pa.binary()), pa.array(sketch, pa.list_(pa.int32()))],
            ["id", "n", "whole", "sketch"])
    settle()


def _child(node: Column, token: Column, sketch: str = "sketch") -> Column:
    """The child of ``node`` by the value of one of its chosen tokens."""
    return F.xxhash64(node, token, F.element_at(sketch, token + 1))


#: A branched node's chosen tokens: those of least hash among the ones that its path hasn't used.
_CHOSEN = (
    f"slice(array_sort(transform(filter(sequence(0, {TOKENS - 1}), t -> getbit(used, t) = 0), "
    f"t -> struct(xxhash64(node, t) AS h, t AS t))), 1, {CHOSEN}).t"
)


def _agreement(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)


#: How a row takes part in its unit: with all others, as a pivot, or as a pivot's partner; a partner that
#: is a pivot elsewhere too meets pivots of smaller id only, so that such a pair is compared once.
ALL, PIVOT, PARTNER, BOTH = 3, 2, 0, 1


def _near(i: int, ids, labels, side, sketches, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Later rows of a unit that row ``i`` may be linked with across components, and all later agreements."""
    same = (sketches[i + 1 :] == sketches[i]).sum(1)
    theirs, smaller = side[i + 1 :], ids[i] < ids[i + 1 :]
    meets = {ALL: theirs == ALL, PIVOT: (theirs == PARTNER) | ((theirs == BOTH) & smaller), PARTNER: theirs == PIVOT, BOTH: (theirs == PIVOT) & ~smaller}[int(side[i])]
    return np.flatnonzero((same >= least) & (labels[i + 1 :] != labels[i]) & meets), same


def _by_unit(batches, width: int):
    """The rows of one unit after the other: arrays ``unit, id, label, side, sketches`` and lists of further columns."""
    held: list[tuple] = []

    def whole():
        return [np.concatenate([h[k] for h in held]) for k in range(5)] + [[v for h in held for v in h[k]] for k in range(5, 5 + width)]

    for batch in batches:
        if not batch.num_rows:
            continue
        unit, ids, labels, side = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        sketch = batch.column(4)
        sketches = sketch.values.slice(sketch.offsets[0].as_py(), batch.num_rows * TOKENS).to_numpy(zero_copy_only=False).reshape(-1, TOKENS)
        edges = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1], [True]]))
        for x, y in zip(edges, edges[1:]):
            if held and unit[x] != held[0][0][0]:
                yield whole()
                held = []
            held.append((unit[x:y], ids[x:y], labels[x:y], side[x:y], sketches[x:y], *(batch.column(5 + k).slice(x, y - x).to_pylist() for k in range(width))))
    if held:
        yield whole()


def _promising(least: int):
    """Of rows ``unit, id, label, side, sketch`` sorted by unit, those with a near one across components."""

    def run(batches):
        for unit, ids, labels, side, sketches in _by_unit(batches, 0):
            mark = np.zeros(len(ids), bool)
            if not (labels == labels[0]).all():
                for i in range(len(ids) - 1):
                    near, _ = _near(i, ids, labels, side, sketches, least)
                    mark[near + i + 1] = True
                    mark[i] |= len(near) > 0
            if mark.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[mark]) for x in (unit, ids, labels, side)], ["unit", "id", "label", "side"])
        settle()

    return run


def _across(least: int, percent: int):
    """Links that merge components within a unit: rows ``unit, id, label, side, sketch, body`` sorted by unit."""

    def links(ids, labels, side, sketches, bodies):
        agree, left, right = [], [], []
        for i in range(len(ids) - 1):
            near, same = _near(i, ids, labels, side, sketches, least)
            agree.append(same[near])
            left.append(np.full(len(near), i))
            right.append(near + i + 1)
        order = np.argsort(-np.concatenate(agree), kind="stable")
        left, right = np.concatenate(left)[order], np.concatenate(right)[order]
        root = {int(x): int(x) for x in labels}

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        sets: dict[int, np.ndarray] = {}

        def set_of(i):
            if i not in sets:
                sets[i] = shingles(_expand(bodies[i]))
            return sets[i]

        for i, j in zip(left.tolist(), right.tolist()):
            x, y = top(int(labels[i])), top(int(labels[j]))
            if x != y and is_link(set_of(i), set_of(j), percent):
                root[max(x, y)] = min(x, y)
                yield int(ids[i]), int(ids[j])

    def run(batches):
        for _, ids, labels, side, sketches, bodies in _by_unit(batches, 1):
            if len(ids) > 1:
                yield _pairs_batch(list(links(ids, labels, side, sketches, bodies)))
        settle()

    return run


def _pairs_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found) if found else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


_codec = pa.Codec("zstd", compression_level=3)


def _squeeze(batches):
    for batch in batches:
        raw = [(t or "").encode() for t in batch.column(1).to_pylist()]
        small = [np.int64(len(t)).tobytes() + _codec.compress(t, asbytes=True) for t in raw]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(small, pa.binary())], ["id", "body"])


def _expand(small: bytes) -> str:
    return _codec.decompress(small[8:], int(np.frombuffer(small, np.int64, 1)[0]), asbytes=True).decode()


def _confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that are links on their full sets."""
    # the many-sided end first: its texts move once; the leaders' come last and may be hot
    joined = (
        pairs.join(texts.select(F.col("id").alias("b"), F.col("body").alias("tb")), "b")
        .join(texts.select(F.col("id").alias("a"), F.col("body").alias("ta")), "a")
        .select("a", "b", "ta", "tb")
    )

    def run(batches):
        last, own = None, None
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, a in enumerate(batch.column(0).to_pylist()):
                if a != last:
                    last, own = a, shingles(_expand(batch.column(2)[i].as_py()))
                keep[i] = is_link(own, shingles(_expand(batch.column(3)[i].as_py())), percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return materialize(joined.mapInArrow(run, "a long, b long"), "nd-links")


def _mixed(rows: DataFrame, key: str) -> DataFrame:
    """Keys whose rows carry several labels, and their size."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select(key, "size")


def _cross_units(pivots: DataFrame, partners: DataFrame, key: str, block: int) -> DataFrame:
    """``unit, id, label, side``: every pivot of a key meets every partner, in units of at most two blocks.

    A pivot is repeated once for each block of partners and the other way round.
    """
    sizes = pivots.groupBy(key).agg(F.count(F.lit(1)).alias("_l")).join(partners.groupBy(key).agg(F.count(F.lit(1)).alias("_r")), key)
    parts = lambda c: F.ceil(F.col(c) / F.lit(block)).cast("int")
    own = lambda c: F.pmod(F.xxhash64("id"), parts(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), parts(c) - 1))
    left = pivots.join(sizes, key).select(key, "id", "label", F.lit(PIVOT).alias("side"), own("_l").alias("_p"), every("_r").alias("_q"))
    right = partners.join(sizes, key).select(key, "id", "label", "side", every("_l").alias("_p"), own("_r").alias("_q"))
    return left.unionByName(right).select(F.xxhash64(F.lit("block"), key, "_p", "_q").alias("unit"), "id", "label", "side")


def _pivot_units(rows: DataFrame, key: str, block: int) -> DataFrame:
    """Units for all pairs across components of a key's rows, one of which is ``close``.

    Most of a group of copies is one component by now. So pivots outside the
    key's most common component meet all rows, and the others meet only the
    rows outside it.
    """
    main = rows.groupBy(key).agg(F.mode("label").alias("_m"))
    rows = materialize(rows.join(main, key).withColumn("odd", F.col("label") != F.col("_m")).drop("_m"), "nd-pivots")
    side = F.when(F.col("close") & F.col("odd"), BOTH).otherwise(PARTNER).alias("side")
    first = _cross_units(rows.where("close and odd"), rows.select(key, "id", "label", side), key, block)
    second = _cross_units(rows.where("close and not odd"), rows.where("odd and not close").select(key, "id", "label", F.lit(PARTNER).alias("side")), key, block)
    return first.unionByName(second.select(first.columns))


def near_duplicates(df: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text", trees: int = TREES,
                    small: int = SMALL, depth: int = DEPTH) -> DataFrame:
    """Per row: ``key, n_shingles, component_id, kept``.

    Texts are lower-cased (A-Z) and split at ASCII white space; a set holds the
    distinct shingles of five words, of a shorter text the whole sequence.
    Documents with ``100 * intersection >= percent * union`` are linked;
    ``component_id`` is the smallest key reachable and ``kept`` marks it.
    Empty and null texts are linked with nothing. A link at similarity ``t``
    is missed by the roots with probability ``(1 - t) ** (trees * CHOSEN)``,
    each root choosing tokens of its own. In a node that is branched on, a link
    of two documents that are both far from its leader goes on with probability
    ``1 - (1 - t) ** CHOSEN`` a level, in each of the roots that it shares.

    ``key`` is an integer and unique; rows that repeat a key and its text are
    classed alike, a null key has no component and is kept. Other columns are
    left out; an empty table stays empty.
    """
    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    with scratch(df.sparkSession):
        classes = materialize(_classes(docs, percent, trees, small, depth), "near-duplicates", lasting=True)
    return classes.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def _classes(docs: DataFrame, percent: int, trees: int, small: int, depth: int) -> DataFrame:
    """``id, n, component`` of every row."""
    signed = materialize(docs.mapInArrow(_signatures, "id long, n long, whole binary, sketch array<int>"), "nd-sketch")
    alive = signed.where("n > 0 and id is not null")
    firsts = alive.groupBy("whole").agg(F.min("id").alias("first"))
    classes = materialize(signed.select("id", "n", "whole").join(firsts, "whole", "left").select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("first", "id")).alias("first"), (F.col("first").isNotNull() & F.col("id").isNotNull()).alias("live")), "nd-classes")
    sketches = materialize(
        alive.select("id", "sketch").join(classes.where("live and id = first").select("id").distinct(), "id", "left_semi").dropDuplicates(["id"]), "nd-firsts")

    # no two roots choose the same token, as long as there are enough
    picks = [int(t) for t in np.resize(np.random.default_rng(5150).permutation(TOKENS), trees * CHOSEN)]
    children = [F.struct(_child(F.xxhash64(F.lit("tree"), F.lit(k // CHOSEN)), F.lit(t)).alias("node"), F.expr(f"shiftleft(1L, {t})").alias("used")) for k, t in enumerate(picks)]
    spread = sketches.select("id", F.inline(F.array(*children))).distinct()
    sizes = spread.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialize(spread.join(sizes, "node").select("node", "used", "id", "size"), "nd-nodes")
    members = materialize(sketches.join(shared.select("id").distinct(), "id", "left_semi"), "nd-members")
    tokens = members.select("id", F.posexplode("sketch").alias("token", "value"))
    common = tokens.groupBy("token", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    weight = tokens.join(common, ["token", "value"]).groupBy("id").agg(F.sum("n").alias("weight"))
    ranked = shared.join(weight, "id").select("node", "id", F.struct("weight", (-F.col("id")).alias("id")).alias("rank"))
    leaders = ranked.groupBy("node").agg((-F.max("rank")["id"]).alias("a"))
    nodes = materialize(shared.join(leaders, "node"), "nd-led")

    # of 64 tokens a link agrees in at least percent less 5 standard deviations
    p = percent / 100
    least = max(1, int(TOKENS * (p - 5 * (p * (1 - p) / TOKENS) ** 0.5)))
    star = nodes.where("id <> a").select("a", F.col("id").alias("b")).distinct()
    own = members.select(F.col("id").alias("b"), F.col("sketch").alias("sb"))
    other = members.select(F.col("id").alias("a"), F.col("sketch").alias("sa"))
    stars = materialize(star.join(own, "b").join(other, "a").where(_agreement("sa", "sb") >= least).select("a", "b"), "nd-star")
    texts = docs.mapInArrow(_squeeze, "id long, body binary").join(members.select("id"), "id", "left_semi")
    texts = materialize(texts.dropDuplicates(["id"]), "nd-texts")
    links = _confirm(stars, texts, percent)
    groups = materialize(connected_components(links, "a", "b"), "nd-groups").withColumnRenamed("node", "id")

    rows = nodes.join(groups, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component", "size")
    rows = materialize(rows.join(_mixed(rows, "node"), "node"), "nd-mixed")
    units = [rows.where(F.col("size") <= small).select(F.col("node").alias("unit"), "id", "label", F.lit(ALL).alias("side"))]
    large = rows.where(F.col("size") > small)
    near = stars.select("a", F.col("b").alias("id"), F.lit(True).alias("close"))
    large = large.drop("size").join(near, ["a", "id"], "left").withColumn("close", F.coalesce("close", F.col("id") == F.col("a")))
    large = materialize(large, "nd-large")
    if not large.isEmpty():
        led = large.groupBy("a", "id").agg(F.min("label").alias("label"), F.max("close").alias("close"))
        some = led.groupBy("a").agg(F.sum(F.col("close").cast("int")).alias("n")).where("n > 1").select("a")
        units.append(_pivot_units(led.join(some, "a"), "a", 4 * small))
        rows = large.where("not close").select("node", "used", "id", "label")
        for level in range(depth + 1):
            mixed = _mixed(rows, "node")
            rows = materialize(rows.join(mixed, "node"), "nd-level")
            units.append(rows.where(F.col("size") <= small).select(F.col("node").alias("unit"), "id", "label", F.lit(ALL).alias("side")))
            rows = rows.where(F.col("size") > small)
            if rows.isEmpty():
                break
            if level == depth:  # what no token parts
                units.append(_pivot_units(rows.select("node", "id", "label", F.lit(True).alias("close")), "node", 4 * small))
            else:
                chosen = rows.select("node", "used").distinct().select("node", F.explode(F.expr(_CHOSEN)).alias("t"))
                rows = rows.join(chosen, "node").join(members, "id").select(
                    _child(F.col("node"), F.col("t")).alias("node"), F.col("used").bitwiseOR(F.expr("shiftleft(1L, t)")).alias("used"), "id", "label")
    todo = units[0]
    for more in units[1:]:
        todo = todo.unionByName(more)
    # which rows have anybody to compare with is seen from the sketches; only those move with their texts
    kind = ", ".join(f"{c} {t}" for c, t in todo.select("unit", "id", "label", "side").dtypes)
    sketched = todo.join(members, "id").select("unit", "id", "label", "side", "sketch").repartition("unit").sortWithinPartitions("unit")
    promising = materialize(sketched.mapInArrow(_promising(least), kind), "nd-near")
    crossing = (
        promising.join(members, "id").join(texts, "id").select("unit", "id", "label", "side", "sketch", "body")
        .repartition("unit").sortWithinPartitions("unit").mapInArrow(_across(least, percent), "a long, b long")
    )
    links = links.unionByName(materialize(crossing, "nd-cross"))
    final = connected_components(links, "a", "b").select(F.col("node").alias("first"), "component")
    return classes.join(final, "first", "left").select("id", "n", F.coalesce("component", "first").alias("component"))
