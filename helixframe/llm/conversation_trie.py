"""The prefix trie of conversations from vertical bitmaps.

Conversations are dealt to shards by ranges of their ids. A shard indexes
(position, turn) to a bitset of its conversations; depth-first, the
intersection of a node's bitset with the postings at its depth yields its
children, and popcounts and end lists with them. A node's identity is the
digest of its turns, so the shards' nodes are summed by it.

What counts nodes of a subtree can't be summed over shards at once, as shards
share nodes. So every node is given to its smallest member. A conversation owns
the nodes of its own path from some depth on, and at most one childless node;
with these two numbers known for every conversation, a second pass sums over a
node's members: the childless nodes they own, and the tokens of the turns that
they don't own (those are saved).
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.llm.textbytes import settle
from helixframe.session import materialize

#: Conversations of a shard's bitsets, and turns that a shard holds before it ends (behind a whole conversation).
SHARD, SHARD_TURNS = 4096, 1 << 17
#: Parts that the children of one node are dealt over when they look up their parent.
SALTS = 16
ROOT = hashlib.blake2b(b"", digest_size=16).digest()


def turn_digest(role: Column, text: Column) -> Column:
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def turn_rows(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, at, digest, tokens`` of every turn, ``at`` from 0 by turn, null first; rows of one turn are ordered by their digest.

    Null roles and texts are empty ones; rows without a conversation are left
    out. Only digests and counts of words are shuffled, never texts.
    """
    words = F.regexp_count(F.coalesce(df[text], F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = df.where(df[conv].isNotNull()).select(
        df[conv].cast("long").alias("conv"), df[turn].alias("_turn"), turn_digest(df[role], df[text]).alias("digest"), words.alias("tokens"))
    order = Window.partitionBy("conv").orderBy(F.col("_turn").asc_nulls_first(), "digest")
    return rows.select("conv", (F.row_number().over(order) - 1).cast("long").alias("at"), "digest", "tokens")


def with_shared_heads(rows: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Conversations rebuilt to share beginnings: the first ``h`` turns come from the first conversation of their group.

    ``h`` is the crc32 of the decimal id modulo ``most``; a conversation's own
    turns follow behind its first ``h``. Every conversation also has a row at -1
    without a digest, so that one that loses all its turns remains.
    """
    rows = materialize(rows, "trie-turns")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    ids = rows.where("at = 0").select("conv", (F.col("conv") - F.col("conv") % group).alias("_base"), h.alias("_h"))
    heads = rows.where((F.col("conv") % group == 0) & (F.col("at") < most - 1)).select(F.col("conv").alias("_base"), "at", "digest", "tokens")
    shared = ids.join(heads, "_base").where("at < _h").select("conv", "at", "digest", "tokens")
    own = rows.where(F.col("at") >= h).select("conv", F.col("at") + most, "digest", "tokens")
    return shared.unionAll(own).unionAll(ids.select("conv", F.lit(-1).cast("long"), F.lit(None).cast("binary"), F.lit(0).cast("long")))


class _Shard:
    """Some whole conversations in order of their ids: turns, postings and end lists."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.ids: list[int] = []
        self.turns: list[list[tuple[bytes, int]]] = []
        self.facts: list[tuple[int | None, bool]] = []
        self.held = 0

    def add(self, conv: int, digest: bytes | None, tokens: int, top: int | None, leaf: bool) -> None:
        if not self.ids or self.ids[-1] != conv:
            self.ids.append(conv)
            self.turns.append([])
            self.facts.append((None, False))
        if digest is None:
            self.facts[-1] = (top, leaf)
        else:
            self.turns[-1].append((digest, tokens))
            self.held += 1

    def full(self) -> bool:
        return len(self.ids) >= self.size or self.held >= self.most

    def nodes(self):
        """``path, parent, depth, tokens, members, ended, place of the parent``, parents first."""
        postings: dict[tuple[int, bytes], int] = {}
        ends: dict[int, int] = {}
        for c, turns in enumerate(self.turns):
            bit = 1 << c
            ends[len(turns)] = ends.get(len(turns), 0) | bit
            for d, (digest, _) in enumerate(turns):
                postings[d, digest] = postings.get((d, digest), 0) | bit
        out, todo = [], [(ROOT, None, 0, 0, (1 << len(self.ids)) - 1, -1)]
        while todo:
            path, parent, depth, tokens, members, above = todo.pop()
            ended = members & ends.get(depth, 0)
            place = len(out)
            out.append((path, parent, depth, tokens, members, ended, above))
            rest = members ^ ended
            while rest:
                digest, n = self.turns[(rest & -rest).bit_length() - 1][depth]
                child = members & postings[depth, digest]
                rest &= ~child
                todo.append((hashlib.blake2b(path + digest, digest_size=16).digest(), path, depth + 1, n, child, place))
        return out

    def counts(self) -> pa.RecordBatch:
        ids = np.array(self.ids, np.int64)
        rows = []
        for path, parent, depth, tokens, members, ended, _ in self.nodes():
            first = self.ids[(members & -members).bit_length() - 1]
            packed = None
            if ended:
                bits = np.frombuffer(ended.to_bytes(-(-len(ids) // 8), "little"), np.uint8)
                packed = ids[np.flatnonzero(np.unpackbits(bits, bitorder="little"))].astype("<i8").tobytes()
            rows.append((path, parent, depth, tokens, members.bit_count(), first, packed))
        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["path", "parent", "depth", "tokens", "n_convs", "conv_id", "ends"])

    def sums(self) -> pa.RecordBatch:
        leaf, tops = 0, {}
        for c, (top, has_leaf) in enumerate(self.facts):
            leaf |= has_leaf << c
            if top is not None:
                tops[top] = tops.get(top, 0) | 1 << c
        # owners[k]: the conversations that own their nodes from some depth up to steps[k] on
        steps, owners = sorted(tops), [0]
        for s in steps:
            owners.append(owners[-1] | tops[s])
        nodes = self.nodes()
        saved = [0] * len(nodes)
        for i in range(len(nodes) - 1, -1, -1):
            _, _, depth, tokens, members, _, above = nodes[i]
            if tokens:
                saved[i] += tokens * (members & ~owners[bisect_right(steps, depth)]).bit_count()
            if above >= 0:
                saved[above] += saved[i]
        rows = [(n[0], (n[4] & leaf).bit_count(), s, bool(n[4] & tops.get(n[2], 0))) for n, s in zip(nodes, saved)]
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["path", "n_leaves", "saved_tokens", "owned_here"])


def _by_shard(table, size: int, most: int):
    """A task over rows ``conv, digest, tokens, top, leaf`` in order of conversations and turns."""

    def run(batches):
        shard = _Shard(size, most)
        for batch in batches:
            for conv, digest, tokens, top, leaf in zip(*(c.to_pylist() for c in batch.columns)):
                if shard.full() and shard.ids[-1] != conv:
                    yield table(shard)
                    shard = _Shard(size, most)
                shard.add(conv, digest, tokens, top, leaf)
        if shard.ids:
            yield table(shard)
        settle()

    return run


def _dealt(rows: DataFrame) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, "conv").sortWithinPartitions("conv", "at").select("conv", "digest", "tokens", "top", "leaf")


def _end_hashes(batches):
    """One hash a node over its shards' end lists, which come in order; a list is never held whole."""
    path, digest, first = None, None, True

    def table(done):
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["path", "ends_sha256"])

    for batch in batches:
        done = []
        for p, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if p != path:
                if path is not None:
                    done.append((path, digest.hexdigest()))
                path, digest, first = p, hashlib.sha256(), True
            digest.update((b"" if first else b",") + ",".join(map(str, np.frombuffer(packed, "<i8").tolist())).encode())
            first = False
        if done:
            yield table(done)
    if path is not None:
        yield table([(path, digest.hexdigest())])


def prefix_trie(rows: DataFrame, shard: int = SHARD, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie's nodes, one row each, from ``conv, at, digest, tokens``.

    A conversation's turns are its rows in order of ``at``; it must have one row
    with a null digest, before its turns, and needs no other. Returns
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the
    root), ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` of the
    subtree and ``ends_sha256`` of the members that end there. Without
    conversations there is no root. A task holds digests of one shard; a
    conversation of more turns than a shard has makes one of its own.
    """
    rows = materialize(rows, "trie-rows")
    known = rows.select("*", F.lit(None).cast("long").alias("top"), F.lit(False).alias("leaf"))
    parts = materialize(_dealt(known).mapInArrow(
        _by_shard(_Shard.counts, shard, shard_turns), "path binary, parent binary, depth long, tokens long, n_convs long, conv_id long, ends binary"), "trie-parts")
    merged = parts.groupBy("path").agg(F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    merged = materialize(merged, "trie-nodes")
    children = merged.where("parent IS NOT NULL").groupBy(F.col("parent").alias("path")).agg(F.count("*").alias("n_children"))
    nodes = materialize(merged.join(children, "path", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-children")
    owners = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.min("depth").alias("top"), F.max(F.col("n_children") == 0).alias("leaf"))
    marks = rows.where("digest IS NULL").join(owners, "conv", "left").select(*rows.columns, "top", F.coalesce("leaf", F.lit(False)).alias("leaf"))
    sums = _dealt(marks.unionAll(known.where("digest IS NOT NULL"))).mapInArrow(
        _by_shard(_Shard.sums, shard, shard_turns), "path binary, n_leaves long, saved_tokens long, owned_here boolean")
    sums = sums.groupBy("path").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("owned_here").alias("owned_here"))
    lists = parts.where("ends IS NOT NULL").repartition("path").sortWithinPartitions("path", "conv_id").select("path", "ends")
    ends = lists.mapInArrow(_end_hashes, "path binary, ends_sha256 string")
    whole = materialize(nodes.join(sums, "path").join(ends, "path", "left"), "trie-sums")
    # below its top a conversation's nodes have its own node for a parent; a top's parent has other members too
    first = whole.where("owned_here AND parent IS NOT NULL").select("path", "parent", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int").alias("_salt"))
    above = whole.where("n_children > 0 AND n_convs > 1").select(
        F.col("path").alias("parent"), F.col("conv_id").alias("_above"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    tops = first.join(above, ["parent", "_salt"]).select("path", "_above")
    return whole.join(tops, "path", "left").select(
        "conv_id", "depth", F.when(F.col("parent").isNotNull(), F.coalesce("_above", "conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
