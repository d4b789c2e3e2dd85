"""Sequence routing and clustering."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.functions.codes import CDR_RANGES
from helixframe.operators.components import connected_components
from helixframe.session import materialize, scratch


def route_sequences(seqs: DataFrame, heavy: DataFrame, light: DataFrame, kind: str = "mol_type", sequence: str = "sequence", shortest: int = 10) -> DataFrame:
    """Adds ``route``: antibody_H, antibody_L, peptide, protein, protein_D, nucleotide or ligand.

    ``heavy`` and ``light`` hold antibody sequences in a column ``sequence``.
    """
    h = heavy.select(F.col("sequence").alias("_s")).distinct().withColumn("_h", F.lit(True))
    l = light.select(F.col("sequence").alias("_t")).distinct().withColumn("_l", F.lit(True))
    joined = seqs.join(h, F.col(sequence) == F.col("_s"), "left").join(l, F.col(sequence) == F.col("_t"), "left")
    protein = F.col(kind) == "P"
    route = (
        F.when(protein & F.col("_h"), "antibody_H").when(protein & F.col("_l"), "antibody_L")
        .when(protein & (F.length(sequence) < shortest), "peptide").when(protein, "protein")
        .when(F.col(kind) == "Q", "protein_D").when(F.col(kind).isin("N", "R", "D"), "nucleotide").otherwise("ligand")
    )
    return joined.withColumn("route", route).select(*seqs.columns, "route")


def _kmers(seqs: DataFrame, key: str, sequence: str, k: int) -> DataFrame:
    """``id, w``: the distinct k-mers of every sequence."""
    text = F.col(sequence)
    words = F.transform(F.sequence(F.lit(1), F.length(text) - (k - 1)), lambda i: F.substr(text, i, F.lit(k)))
    return seqs.where(F.length(text) >= k).select(F.col(key).alias("id"), F.explode(F.array_distinct(words)).alias("w"))


def shared_kmers(seqs: DataFrame, key: str, sequence: str, k: int = 6, hot: int | None = 1000) -> DataFrame:
    """``id1, id2, n``: pairs (id1 < id2) that share ``n`` distinct k-mers.

    K-mers in more than ``hot`` sequences are dealt over blocks of about that
    many sequences and every two blocks meet, so no pair is left out and no
    task holds a whole common word.
    """
    return _pairs_by_word(_kmers(seqs, key, sequence, k), hot)


def shared_shingles(docs: DataFrame, key: str, text: str, size: int = 8, hot: int | None = 1000) -> DataFrame:
    """As ``shared_kmers`` with runs of ``size`` words.

    Runs go by 128-bit digests, made once and packed, through one shuffle to
    ``RUN_BUCKETS`` parts. Those of exactly the same texts (a shared passage has
    many) are one word that counts for all of them, so a passage of any length
    makes the pairs of its texts once.
    """
    kind = dict(docs.dtypes)[key]
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("t")).where("id is not null and t is not null")
    packed = texts.mapInArrow(_packed_runs(size), f"part int, w binary, v binary, ids array<{kind}>")
    found = packed.groupBy("part").applyInArrow(_run_sets, f"w binary, _n long, _m long, ids array<{kind}>")
    sets = materialize(found.groupBy("w", "_n").agg(F.sum("_m").alias("_m"), F.first("ids").alias("ids")), "shingle-sets")
    pairs = _meet(sets.select("w", "_n", "_m", F.explode("ids").alias("id")), ["_m"], hot)
    pairs = pairs.select(F.least("id1", "id2").alias("id1"), F.greatest("id1", "id2").alias("id2"), "_m1")
    return pairs.groupBy("id1", "id2").agg(F.sum("_m1").alias("n"))


def _packed_runs(size: int):
    """A task over ``id, t``: a text's distinct runs of ``size`` words, a row a part of their digests with those of many texts."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            letters = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(texts), np.int64))])
            at = 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(letters, letters[at] + RUN_LETTERS, "right")) - 1)
                keys = batch.column(0).slice(at, to - at)
                w, v, of = _run_digests(texts.slice(at, to - at), np.arange(to - at), size)
                at = to
                if not len(w):
                    continue
                # digests are in order, so a part's are one stretch
                part = (w >> np.uint64(64 - (RUN_BUCKETS - 1).bit_length())).astype(np.int64)
                begins = _starts(part, part)
                cuts = np.append(begins, len(w))
                binary = lambda f: pa.array([f(a, b) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([
                    pa.array(part[begins], pa.int32()), binary(lambda a, b: _planes(w[a:b])), binary(lambda a, b: v[a:b].tobytes()),  # noqa: B023
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), keys.take(pa.array(of, pa.int64())))], ["part", "w", "v", "ids"])

    return run


def _key_digests(keys: pa.Array) -> list[np.ndarray]:
    """Two 64-bit hashes a key."""
    coded = keys.dictionary_encode()
    digests = np.frombuffer(b"".join(hashlib.md5(repr(k).encode()).digest() for k in coded.dictionary.to_pylist()), np.uint64).reshape(-1, 2)
    at = coded.indices.to_numpy(zero_copy_only=False)
    return [digests[at, 0], digests[at, 1]]


def _run_sets(table: pa.Table) -> pa.Table:
    """``w, _n, _m, ids``: the sets of ``_n`` texts that share runs of a part, each with a digest and the number ``_m`` of its runs."""
    ids = table.column("ids").combine_chunks()
    ids = pa.concat_arrays(ids.chunks) if isinstance(ids, pa.ChunkedArray) else ids
    w = np.concatenate([_from_planes(b) for b in table.column("w").to_pylist()])
    v = np.concatenate([np.frombuffer(b, np.uint64) for b in table.column("v").to_pylist()])
    keys = ids.flatten()
    order = np.argsort(w)
    same = w[order][1:] == w[order][:-1]
    met = order[np.append(same, False) | np.append(False, same)]
    met = met[np.lexsort((v[met], w[met]))]
    starts = _starts(w[met], v[met])
    n = np.diff(np.append(starts, len(met)))
    keys = keys.take(pa.array(met, pa.int64()))
    marks = [np.add.reduceat(h, starts) if len(starts) else h for h in _key_digests(keys)]
    shared = np.flatnonzero(n > 1)
    marks, starts, n = [m[shared] for m in marks], starts[shared], n[shared]
    order = np.lexsort((*marks, n))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in (*marks, n)])
    heads = np.flatnonzero(new)
    many, first = np.diff(np.append(heads, len(order))), order[heads]
    n, starts = n[first], starts[first]
    ends = np.concatenate([[0], np.cumsum(n)])
    own = np.repeat(starts - ends[:-1], n) + np.arange(ends[-1])
    names = [a.tobytes() + b.tobytes() for a, b in zip(marks[0][first], marks[1][first])]
    return pa.Table.from_arrays([pa.array(names, pa.binary()), pa.array(n, pa.int64()), pa.array(many, pa.int64()),
                                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), keys.take(pa.array(own, pa.int64())))], ["w", "_n", "_m", "ids"])


#: Letters of text whose runs go on together, and the parts that runs are dealt to by their digests.
RUN_LETTERS, RUN_BUCKETS = 1 << 23, 512


def _word_digests(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words between spaces and line feeds: number of the text, and two 64-bit halves of a digest a word."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    inside = (data != 0x20) & (data != 0x0A)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = ends[:-1][np.diff(ends) > 0]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    row = np.searchsorted(ends, starts, "right") - 1
    last = inside.copy()
    last[:-1] &= ~inside[1:] | begins[1:]
    # the words one after the other, without what parts them
    places = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - starts)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data[inside])])
    coded = words.dictionary_encode()
    digests = np.frombuffer(b"".join(hashlib.md5(w).digest() for w in coded.dictionary.to_pylist()), np.uint64).reshape(-1, 2)
    found = digests[coded.indices.to_numpy(zero_copy_only=False)]
    return row, found[:, 0], found[:, 1]


def _run_digests(texts: pa.Array, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of ``size`` words of every owner of texts, in order: two 64-bit halves of a run's digest, and the owner."""
    row, low, high = _word_digests(texts)
    n = len(row) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = row[:n] == row[size - 1 :]
    halves = []
    for words, factor in ((low, 0x9E3779B97F4A7C17), (high, 0xC2B2AE3D27D4EB4B)):
        h = words[:n].copy()
        for k in range(1, size):
            h *= np.uint64(factor)
            h += words[k : n + k]
        halves.append(h[whole])
    w, v = halves
    of = owner[row[:n][whole]]
    order = np.argsort(w, kind="stable")
    if (of[1:] < of[:-1]).any() or ((w[order][1:] == w[order][:-1]) & (v[order][1:] != v[order][:-1])).any():
        order = np.lexsort((of, v, w))
    w, v, of = w[order], v[order], of[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (v[1:] != v[:-1]) | (of[1:] != of[:-1])
    return w[new], v[new], of[new]


def _starts(w: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Where another digest begins."""
    return np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (v[1:] != v[:-1])])) if len(w) else np.zeros(0, np.int64)


def _planes(w: np.ndarray) -> bytes:
    """Bytes of numbers place by place, so that the upper ones of sorted numbers compress."""
    return w.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(np.uint64)


def shingle_links(docs: DataFrame, key: str, text: str, size: int = 8, salts: int = 32, common: int = 256) -> DataFrame:
    """``id, first, n``: ``id`` shares ``n`` distinct runs of ``size`` words whose smallest key is ``first``.

    Texts with a common run are in one component of these links, as they are in
    one of all pairs, but a run in m texts gives m - 1 links. Runs go by 128-bit
    digests, packed, through one shuffle to ``RUN_BUCKETS`` parts. Of a run in at
    least ``common`` texts of a batch the batch sends the smallest key alone to
    the run's part; the other keys are spread over ``salts`` parts and meet the
    run's first text in a join, so no task holds it whole. Texts that are null or of fewer
    words have no runs, null keys are left out, and rows of one key count as one text.
    """
    kind = dict(docs.dtypes)[key]
    kept = docs.select(F.col(key).alias("id"), F.col(text).alias("t")).where("id is not null and t is not null")
    # in order, so that a task that runs again makes the same batches
    texts = kept.groupBy("id").agg(F.collect_list("t").alias("t")).sortWithinPartitions("id")

    def pack(batches):
        turn = 0
        for batch in batches:
            lists = batch.column(1)
            if not len(lists):
                continue
            flat, sizes = lists.flatten(), np.asarray(lists.value_lengths())
            ends = np.concatenate([[0], np.cumsum(sizes)])
            letters = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(flat), np.int64))])[ends]
            at = 0
            while at < len(lists):
                to = max(at + 1, int(np.searchsorted(letters, letters[at] + RUN_LETTERS, "right")) - 1)
                keys = batch.column(0).slice(at, to - at)
                w, v, of = _run_digests(flat.slice(ends[at], ends[to] - ends[at]), np.repeat(np.arange(to - at), sizes[at:to]), size)
                at = to
                starts = _starts(w, v)
                lengths = np.diff(np.append(starts, len(w)))
                often = lengths >= max(common, 2)
                stays = np.repeat(~often, lengths)
                stays[starts[often]] = True  # keys are in order, so the smallest is the first
                lead = np.zeros(len(w), bool)
                lead[starts[often]] = True
                parts: list[tuple] = []
                for s, n in zip(starts[often], lengths[often]):
                    parts.append((-1 - turn % salts, w[s : s + 1], v[s : s + 1], np.zeros(0, np.int64), of[s + 1 : s + n]))
                    turn += 1
                w, v, of, lead = w[stays], v[stays], of[stays], lead[stays]
                # digests are in order, so a part's are one stretch
                part = (w >> np.uint64(64 - (RUN_BUCKETS - 1).bit_length())).astype(np.int64)
                cuts = np.append(_starts(part, part), len(part))
                for a, b in zip(cuts[:-1], cuts[1:]):
                    parts.append((int(part[a]), w[a:b], v[a:b], np.flatnonzero(lead[a:b]), of[a:b]))
                if not parts:
                    continue
                binary = lambda each: pa.array(list(each), pa.binary())
                owners = np.concatenate([p[4] for p in parts])
                places = np.cumsum([0] + [len(p[4]) for p in parts])
                yield pa.RecordBatch.from_arrays([
                    pa.array([p[0] for p in parts], pa.int32()), binary(_planes(p[1]) for p in parts), binary(p[2].tobytes() for p in parts),
                    binary(p[3].astype(np.uint32).tobytes() for p in parts), pa.ListArray.from_arrays(pa.array(places, pa.int32()), keys.take(pa.array(owners, pa.int64()))),
                ], ["part", "w", "v", "lead", "ids"])

    def settle(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("ids").combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
        keys, many = ids.type.value_type, pa.list_(ids.type.value_type)
        names = ["id", "first", "n", "w", "ids"]
        column = lambda name: table.column(name).to_pylist()
        if column("part")[0] < 0:
            none = pa.nulls(len(table))
            runs = pa.array([_from_planes(w).tobytes() + v for w, v in zip(column("w"), column("v"))], pa.binary())
            return pa.Table.from_arrays([none.cast(keys), none.cast(keys), none.cast(pa.int64()), runs, ids.cast(many)], names)
        w = np.concatenate([_from_planes(b) for b in column("w")])
        v = np.concatenate([np.frombuffer(b, np.uint64) for b in column("v")])
        begins = np.cumsum([0] + np.asarray(ids.value_lengths()).tolist())
        lead = np.zeros(len(w), bool)
        for begin, b in zip(begins, column("lead")):
            lead[begin + np.frombuffer(b, np.uint32)] = True
        order = np.argsort(w)
        same = w[order][1:] == w[order][:-1]
        met = order[np.append(same, False) | np.append(False, same) | lead[order]]
        known = ids.flatten().take(pa.array(met, pa.int64()))
        rank = np.asarray(pc.rank(known, "ascending", tiebreaker="dense"), np.int64)
        order = np.lexsort((rank, v[met], w[met]))
        met, rank = met[order], rank[order]
        named = np.zeros(int(rank.max(initial=0)) + 1, np.int64)
        named[rank] = order  # a place of every key in known
        starts = _starts(w[met], v[met])
        lengths = np.diff(np.append(starts, len(met)))
        first = np.repeat(rank[starts], lengths)
        later = rank > first
        pairs, n = np.unique(np.stack([rank[later], first[later]], 1), axis=0, return_counts=True)
        heads = starts[np.logical_or.reduceat(lead[met], starts)] if len(starts) else starts
        of = lambda ranks: known.take(pa.array(named[ranks], pa.int64()))
        runs = [np.uint64(x).tobytes() + np.uint64(y).tobytes() for x, y in zip(w[met][heads], v[met][heads])]
        size, more = len(pairs), len(heads)
        return pa.Table.from_arrays([
            pa.concat_arrays([of(pairs[:, 0]), pa.nulls(more, keys)]), pa.concat_arrays([of(pairs[:, 1]), of(rank[heads])]), pa.concat_arrays([pa.array(n, pa.int64()), pa.nulls(more, pa.int64())]),
            pa.concat_arrays([pa.nulls(size, pa.binary()), pa.array(runs, pa.binary())]), pa.nulls(size + more, many)], names)

    packed = texts.mapInArrow(pack, f"part int, w binary, v binary, lead binary, ids array<{kind}>")
    found = packed.groupBy("part").applyInArrow(settle, f"id {kind}, first {kind}, n long, w binary, ids array<{kind}>")
    found = materialize(found, "run-links")
    heads = found.where("w is not null and ids is null").select("w", "first")
    spread = found.where("ids is not null").select("w", "ids").join(heads.hint("merge"), "w").select(F.explode("ids").alias("id"), "first", F.lit(1).cast("long").alias("n"))
    links = found.where("id is not null").select("id", "first", "n").unionAll(spread)
    return links.groupBy("id", "first").agg(F.sum("n").alias("n"))


def _pairs_by_word(rows: DataFrame, hot: int | None) -> DataFrame:
    counts = rows.groupBy("w").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    pairs = _meet(rows.join(counts, "w"), [], hot).select(F.least("id1", "id2").alias("id1"), F.greatest("id1", "id2").alias("id2"))
    return pairs.groupBy("id1", "id2").agg(F.count(F.lit(1)).alias("n"))


def _meet(rows: DataFrame, columns: list[str], hot: int | None) -> DataFrame:
    """Every two rows ``id, w, _n`` of one word once: ``w, id1, id2`` and the columns with 1 and 2 at their end.

    A word of ``_n`` rows has ``_n / hot`` blocks; a row goes to every pair of blocks that its own is in.
    The rows are few bytes but their pairs many, so the join is not broadcast.
    """
    blocks = F.lit(1) if hot is None else F.ceil(F.col("_n") / hot).cast("int")
    dealt = rows.select("w", "id", *columns, blocks.alias("_b")).withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_b")).cast("int"))
    side = lambda k: [F.col(c).alias(f"{c}{k}") for c in ["id", *columns]]
    first = dealt.select("w", F.col("_own").alias("_i"), F.explode(F.sequence("_own", F.col("_b") - 1)).alias("_j"), *side(1))
    second = dealt.select("w", F.explode(F.sequence(F.lit(0), "_own")).alias("_i"), F.col("_own").alias("_j"), *side(2))
    return first.join(second.hint("merge"), ["w", "_i", "_j"]).where("_i < _j or id1 < id2").drop("_i", "_j")


def candidate_pairs(seqs: DataFrame, key: str, sequence: str, cover: float, k: int, least_shared: int, hot: int | None) -> DataFrame:
    """``id1, id2, _a, _b``: all pairs (id1 < id2) that share ``least_shared`` k-mers and whose lengths allow the coverage.

    A sequence's k-mers are ordered from rare to common. Two sequences with
    ``least_shared`` common k-mers have the first of these among all but the
    last ``least_shared - 1`` of both lists, so only those are joined, with ids
    and lengths alone; lists and sequences are fetched once for each pair left.
    """
    words = _kmers(seqs, key, sequence, k)
    ranked = words.join(words.groupBy("w").agg(F.count(F.lit(1)).alias("_n")), "w")
    lists = ranked.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("_n", "w"))).alias("ws")).where(F.size("ws") >= least_shared)
    texts = seqs.select(F.col(key).alias("id"), F.col(sequence).alias("s"))
    lists = materialize(lists.join(texts.select("id", F.length("s").alias("len")), "id"), "kmers")
    head = F.filter(F.slice("ws", F.lit(1), F.size("ws") - (max(least_shared, 1) - 1)), lambda x: x["_n"] > 1)
    rows = lists.select("id", "len", F.explode(head).alias("h")).select("id", "len", "h._n", "h.w")
    met = _meet(rows, ["len"], hot).where(F.least("len1", "len2") >= cover * F.greatest("len1", "len2"))
    met = met.select(F.least("id1", "id2").alias("id1"), F.greatest("id1", "id2").alias("id2")).distinct()
    side = lambda frame, i, c, out: frame.select(F.col("id").alias(f"id{i}"), F.col(c).alias(out))
    met = met.join(side(lists, 1, "ws.w", "ws1"), "id1").join(side(lists, 2, "ws.w", "ws2"), "id2")
    met = met.where(F.size(F.array_intersect("ws1", "ws2")) >= least_shared).select("id1", "id2")
    return met.join(side(texts, 1, "s", "_a"), "id1").join(side(texts, 2, "s", "_b"), "id2").select("id1", "id2", "_a", "_b")


def align(a: str, b: str, match: int = 2, mismatch: int = -1, open_: int = -5, extend: int = -1) -> tuple[str, str]:
    """Global affine-gap alignment of two strings; ties prefer a match, then a gap in ``b``."""
    n, m = len(a), len(b)
    x, y = (np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in (a, b))
    low = -(10**9)
    best = np.full((n + 1, m + 1), low, np.int64)
    down, right = best.copy(), best.copy()
    best[0, 0] = 0
    down[1:, 0] = open_ + extend * np.arange(n)
    right[0, 1:] = open_ + extend * np.arange(m)
    best[1:, 0], best[0, 1:] = down[1:, 0], right[0, 1:]
    reach = extend * np.arange(m + 1)
    for i in range(1, n + 1):
        down[i, 1:] = np.maximum(best[i - 1, 1:] + open_, down[i - 1, 1:] + extend)
        diag = best[i - 1, :-1] + np.where(y == x[i - 1], match, mismatch)
        top = np.maximum(diag, down[i, 1:])
        # a gap run along the row: the best start minus its distance, as a running maximum
        source = np.concatenate([[best[i, 0]], top]) - reach
        right[i, 1:] = np.maximum.accumulate(source)[:-1] + open_ + reach[1:] - extend
        best[i, 1:] = np.maximum(top, right[i, 1:])
    i, j, out_a, out_b, layer = n, m, [], [], 0
    while i or j:
        if layer == 0:
            if i and j and best[i, j] == best[i - 1, j - 1] + (match if x[i - 1] == y[j - 1] else mismatch):
                i, j = i - 1, j - 1
                out_a.append(a[i])
                out_b.append(b[j])
                continue
            layer = 1 if i and best[i, j] == down[i, j] else 2
        if layer == 1:
            layer = 1 if i > 1 and down[i, j] != best[i - 1, j] + open_ else 0
            i -= 1
            out_a.append(a[i])
            out_b.append("-")
        else:
            layer = 2 if j > 1 and right[i, j] != best[i, j - 1] + open_ else 0
            j -= 1
            out_a.append("-")
            out_b.append(b[j])
    return "".join(reversed(out_a)), "".join(reversed(out_b))


#: Cells of the score tables that are aligned together.
CELLS = 1 << 21


def align_many(xs: list[str], ys: list[str], match: int = 2, mismatch: int = -1, open_: int = -5, extend: int = -1) -> list[tuple[str, str]]:
    """``align`` for many pairs: scores and ways back of a batch of pairs step together."""
    out: list = [None] * len(xs)
    sizes = [((len(x) + 1) * (len(y) + 1), i) for i, (x, y) in enumerate(zip(xs, ys))]
    batch: list[int] = []
    n = m = 0

    def flush():
        for i, pair in zip(batch, _align_batch([xs[i] for i in batch], [ys[i] for i in batch], match, mismatch, open_, extend)):
            out[i] = pair

    for size, i in sorted(sizes):
        if size > CELLS // 16:  # a long pair: whole rows at once
            out[i] = align(xs[i], ys[i], match, mismatch, open_, extend)
            continue
        n, m = max(n, len(xs[i])), max(m, len(ys[i]))
        if batch and (n + 1) * (m + 1) * (len(batch) + 1) > CELLS:
            flush()
            batch, n, m = [], len(xs[i]), len(ys[i])
        batch.append(i)
    flush()
    return out


def _align_batch(xs: list[str], ys: list[str], match: int, mismatch: int, open_: int, extend: int) -> list[tuple[str, str]]:
    if not xs:
        return []
    p, la, lb = len(xs), np.array([len(x) for x in xs]), np.array([len(y) for y in ys])
    n, m = int(la.max()), int(lb.max())
    x, y = np.full((n, p), -1, np.int64), np.full((m, p), -2, np.int64)
    for c, (s, t) in enumerate(zip(xs, ys)):
        x[: la[c], c], y[: lb[c], c] = np.frombuffer(s.encode("utf-32-le"), np.uint32), np.frombuffer(t.encode("utf-32-le"), np.uint32)
    low = -(10**9)
    best = np.full((n + 1, m + 1, p), low, np.int32)
    down, right = best.copy(), best.copy()
    best[0, 0] = 0
    best[1:, 0] = down[1:, 0] = (open_ + extend * np.arange(n))[:, None]
    best[0, 1:] = right[0, 1:] = (open_ + extend * np.arange(m))[:, None]
    for i in range(1, n + 1):
        down[i, 1:] = np.maximum(best[i - 1, 1:] + open_, down[i - 1, 1:] + extend)
        top = np.maximum(best[i - 1, :-1] + np.where(y == x[i - 1], match, mismatch), down[i, 1:])
        for j in range(1, m + 1):
            right[i, j] = np.maximum(best[i, j - 1] + open_, right[i, j - 1] + extend)
            best[i, j] = np.maximum(top[j - 1], right[i, j])
    i, j, layer, c = la.copy(), lb.copy(), np.zeros(p, np.int64), np.arange(p)
    steps: list[np.ndarray] = []  # 0: both letters, 1: a gap in b, 2: a gap in a, 3: done
    while (live := (i > 0) | (j > 0)).any():
        k, q = np.maximum(i - 1, 0), np.maximum(j - 1, 0)
        now = best[i, j, c]
        score = np.where(x[np.minimum(k, max(n - 1, 0)), c] == y[np.minimum(q, max(m - 1, 0)), c], match, mismatch) if n and m else np.zeros(p, int)
        diagonal = (layer == 0) & (i > 0) & (j > 0) & (now == best[k, q, c] + score)
        kind = np.where(layer == 0, np.where((i > 0) & (now == down[i, j, c]), 1, 2), layer)
        stays = np.where(kind == 1, (i > 1) & (down[i, j, c] != best[k, j, c] + open_), (j > 1) & (right[i, j, c] != best[i, q, c] + open_))
        kind = np.where(diagonal, 0, kind)
        steps.append(np.where(live, kind, 3))
        layer = np.where(live & (kind > 0) & stays, kind, 0)
        i, j = i - (live & (kind != 2)), j - (live & (kind != 1))
    ways = np.array(steps[::-1]).reshape(len(steps), p).T
    out = []
    for s, t, way in zip(xs, ys, ways.tolist()):
        a, b = iter(s), iter(t)
        way = [w for w in way if w != 3]
        out.append(("".join("-" if w == 2 else next(a) for w in way), "".join("-" if w == 1 else next(b) for w in way)))
    return out


def align_pairs(pairs: DataFrame, a: str, b: str, keys: list[str]) -> DataFrame:
    """``keys..., aligned_a, aligned_b, matches, columns`` of every pair, aligned in Arrow batches."""
    types = dict(pairs.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", aligned_a string, aligned_b string, matches int, columns int"

    def run(frames):
        for pdf in frames:
            rows = align_many([x or "" for x in pdf[a]], [y or "" for y in pdf[b]])
            out = pdf[keys].copy()
            out["aligned_a"], out["aligned_b"] = [r[0] for r in rows], [r[1] for r in rows]
            out["matches"] = [sum(p == q for p, q in zip(*r)) for r in rows]
            out["columns"] = [sum(p != "-" and q != "-" for p, q in zip(*r)) for r in rows]
            yield out

    return pairs.select(*keys, a, b).mapInPandas(run, schema)


def align_counts(xs, ys, match: int = 2, mismatch: int = -1, open_: int = -5, extend: int = -1, batch: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Matches and columns without a gap of ``align(x, y)`` for many pairs at once.

    The counts follow the scores with the choices that ``align`` takes on its way back.
    """
    xs, ys = ([np.frombuffer((s or "").encode("utf-32-le"), np.int32) for s in side] for side in (xs, ys))
    la, lb = (np.array([len(s) for s in side], np.int64) for side in (xs, ys))
    out = np.zeros(len(xs), np.int64)  # matches in the upper half, columns in the lower
    order = np.lexsort((lb, la))
    for at in range(0, len(order), batch):
        part = order[at : at + batch]
        n, m = int(la[part].max()), int(lb[part].max())
        if len(part) * 8 < m:  # a few long pairs: whole rows at once
            for p in part:
                a, b = (v[p].tobytes().decode("utf-32-le").replace("-", "\uffff") for v in (xs, ys))  # a "-" of the text is no gap
                a, b = align(a, b, match, mismatch, open_, extend)
                out[p] = (sum(u == v for u, v in zip(a, b)) << 32) + sum(u != "-" and v != "-" for u, v in zip(a, b))
            continue
        x, y = np.full((n, len(part)), -1, np.int32), np.full((m, len(part)), -2, np.int32)
        for c, p in enumerate(part):
            x[: la[p], c], y[: lb[p], c] = xs[p], ys[p]
        best = np.empty((m + 1, len(part)), np.int32)
        best[0] = 0
        best[1:] = (open_ + extend * np.arange(m))[:, None]
        down, count = np.full_like(best, -(10**9)), np.zeros(best.shape, np.int64)
        dcount = count.copy()
        for i in range(1, n + 1):
            opened, longer = best + open_, down + extend
            dcount = np.where(opened >= longer, count, dcount)
            down = np.maximum(opened, longer)
            same = y == x[i - 1]
            diag = best[:-1] + np.where(same, match, mismatch).astype(np.int32)
            top = np.maximum(diag, down[1:])
            tcount = np.where(diag >= down[1:], count[:-1] + 1 + (same.astype(np.int64) << 32), dcount[1:])
            best, count = np.empty_like(best), np.empty_like(count)
            best[0], count[0] = down[0], 0
            right, rcount = np.full(len(part), -(10**9), np.int32), np.zeros(len(part), np.int64)
            for j in range(1, m + 1):
                opened, longer = best[j - 1] + open_, right + extend
                rcount = np.where(opened >= longer, count[j - 1], rcount)
                right = np.maximum(opened, longer)
                count[j] = np.where(top[j - 1] >= right, tcount[j - 1], rcount)
                best[j] = np.maximum(top[j - 1], right)
            ends = np.flatnonzero(la[part] == i)
            out[part[ends]] = count[lb[part[ends]], ends]
    return out >> 32, out & 0xFFFFFFFF


def similar_pairs(seqs: DataFrame, key: str, sequence: str, identity: float, cover: float, k: int = 6, least_shared: int = 1, hot: int | None = 1000) -> DataFrame:
    """``id1, id2, identity``: aligned pairs of enough identity that cover both sequences.

    Candidates are all pairs with ``least_shared`` common k-mers; lengths that
    can't reach the coverage are pruned before any alignment. ``hot`` is the
    block size of common k-mers and changes no result. Equal sequences pair up
    like any others: collapse them first with ``first_copies``.
    """
    pairs = candidate_pairs(seqs, key, sequence, cover, k, least_shared, hot)
    kind = dict(pairs.dtypes)["id1"]

    def run(frames):
        for pdf in frames:
            n, columns = align_counts(pdf["_a"], pdf["_b"])
            longest = np.maximum(pdf["_a"].str.len(), pdf["_b"].str.len())
            good = (columns >= cover * longest) & (n >= identity * columns)
            yield pdf[["id1", "id2"]].assign(identity=n / np.maximum(columns, 1))[good]

    return pairs.mapInPandas(run, f"id1 {kind}, id2 {kind}, identity double")


def first_copies(seqs: DataFrame, key: str, sequence: str) -> DataFrame:
    """``key, sequence, first``: ``first`` is the smallest key of an equal sequence; a null is equal to none."""
    firsts = seqs.where(F.col(sequence).isNotNull()).groupBy(F.col(sequence).alias("_s")).agg(F.min(key).alias("first"))
    return seqs.select(key, sequence).join(firsts.hint("merge"), F.col(sequence) == F.col("_s"), "left").select(key, sequence, F.coalesce("first", key).alias("first"))


def with_copies(clusters: DataFrame, copies: DataFrame, key: str, representative: str = "representative") -> DataFrame:
    """The clusters of first copies for every sequence: a copy goes with its first one."""
    found = clusters.select(F.col(key).alias("first"), representative)
    return copies.select(key, "first").join(found.hint("merge"), "first").select(key, representative)


def cluster_components(seqs: DataFrame, key: str, links: DataFrame, a: str = "id1", b: str = "id2") -> DataFrame:
    """``key, representative``: connected components; a sequence without a link stands alone."""
    found = connected_components(links, a, b)
    return seqs.select(F.col(key)).distinct().join(found, F.col(key) == F.col("node"), "left").select(key, F.coalesce("component", key).alias("representative"))


def greedy_clusters(seqs: DataFrame, key: str, sequence: str, links: DataFrame) -> DataFrame:
    """``key, representative``: longest-first greedy clustering over linked pairs.

    A sequence becomes a representative if no earlier (longer, then smaller
    key) representative is linked to it; the others join the linked
    representative of highest identity. Rounds settle every sequence whose
    earlier neighbours are settled, at least the earliest one left, until none
    is left: as many rounds as the longest chain of neighbours that depend on
    each other. A repeated key counts once, with its longest sequence; links
    whose ends are not among the sequences count for nothing. Rounds add what
    they settle; their tables go at the end. ``seqcluster.greedy_bands`` needs no
    links beforehand and fewer rounds.
    """
    with scratch(seqs.sparkSession):
        return materialize(_greedy_clusters(seqs, key, sequence, links), "greedy-clusters", lasting=True)


def _greedy_clusters(seqs: DataFrame, key: str, sequence: str, links: DataFrame) -> DataFrame:
    order = seqs.groupBy(F.col(key).alias("id")).agg(F.max(F.length(sequence)).alias("n"))
    both = links.select("id1", "id2", "identity").unionByName(links.select(F.col("id2").alias("id1"), F.col("id1").alias("id2"), "identity"))
    before = both.join(order.select(F.col("id").alias("id1"), F.col("n").alias("n1")), "id1").join(order.select(F.col("id").alias("id2"), F.col("n").alias("n2")), "id2")
    # edges from each sequence to its earlier neighbours
    early = materialize(before.where("n2 > n1 or (n2 = n1 and id2 < id1)").select(F.col("id1").alias("id"), F.col("id2").alias("head"), "identity"), "early")
    state = materialize(order.select("id").join(early.select("id").distinct(), "id", "left_anti").withColumn("rep", F.lit(True)), "greedy")
    total, count = order.count(), state.count()
    while count < total:
        known = early.join(state.withColumnRenamed("id", "head"), "head", "left")
        ready = known.groupBy("id").agg(F.max(F.coalesce("rep", F.lit(False))).alias("hit"), F.min(F.col("rep").isNotNull()).alias("whole"))
        ready = ready.where("hit or whole").join(state, "id", "left_anti").select("id", (~F.col("hit")).alias("rep"))
        new = materialize(ready, "greedy")
        count += new.count()
        state = state.unionByName(new)
    reps = state.where("rep").select(F.col("id").alias("head"))
    joined = early.join(reps, "head").join(state.where("not rep").select("id"), "id")
    w = Window.partitionBy("id").orderBy(F.desc("identity"), "head")
    member = joined.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("id", F.col("head").alias("representative"))
    return member.unionByName(state.where("rep").select("id", F.col("id").alias("representative"))).withColumnRenamed("id", key)


def extract_ranges(numbered: DataFrame, spark_ranges: DataFrame, key: str, number: str, residue: str) -> tuple[DataFrame, DataFrame]:
    """``key, region, sequence`` of the residues whose number is in a region, and keys without any; gaps and unknown residues (X) are none.

    ``spark_ranges(region, first, last)`` is a table of regions of whole numbers; it is joined
    number by number, so there may be any number of them.
    """
    numbers = spark_ranges.where("first <= last").select("region", F.explode(F.sequence(F.col("first").cast("long"), F.col("last").cast("long"))).alias("_at"))
    inside = numbered.where(~F.col(residue).isin("-", "X")).join(numbers, F.col(number).cast("long") == F.col("_at")).drop("_at")
    from helixframe.operators.sequences import ordered_join

    found = ordered_join(inside, [key, "region"], [number], residue, "sequence")
    failed = numbered.select(key).distinct().join(found.select(key).distinct(), key, "left_anti")
    return found, failed


def cdr_ranges(spark, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(n, *CDR_RANGES[n]) for n in names], "region string, first int, last int")


def with_singletons(clusters: DataFrame, ids: DataFrame, key: str, representative: str) -> DataFrame:
    """The clusters, and every id that is in none as its own."""
    alone = ids.select(key).distinct().join(clusters.select(key), key, "left_anti").withColumn(representative, F.col(key))
    return clusters.select(key, representative).unionByName(alone.select(key, representative))


def reroute(routed: DataFrame, failed: DataFrame, key: str, route: str, to: str) -> DataFrame:
    """Failed ids take another route."""
    marks = failed.select(F.col(key).alias("_k")).distinct().withColumn("_f", F.lit(True))
    return routed.join(marks, F.col(key) == F.col("_k"), "left").withColumn(route, F.when(F.col("_f"), to).otherwise(F.col(route))).select(*routed.columns)


def merge_clusterings(parts: list[DataFrame], key: str, representative: str) -> DataFrame:
    """One cluster an id: the first clustering in the list that has it."""
    ranked = None
    for i, p in enumerate(parts):
        p = p.select(key, representative).withColumn("_rank", F.lit(i))
        ranked = p if ranked is None else ranked.unionByName(p)
    best = F.min_by(representative, F.struct("_rank", representative))
    return ranked.groupBy(key).agg(best.alias(representative))
