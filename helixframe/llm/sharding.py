"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

A key's ring position is its 64-bit hash. The ring is cut into a fixed number
of cells; every shard owns ``vnodes`` of them as virtual nodes, and a cell
belongs to the next virtual node clockwise. Every shard has a capacity; keys
that find their shard full continue clockwise to the next shard with room.

With capacities that sum to the number of rows (the ``rows`` law) the counts
differ by one at most. Only the count of every cell (a fixed number of cells,
whatever the input) comes to the driver; it becomes a table of segments
``(cell, ranks) -> (shard, first slot)`` and the rows look their segment up.
"""

from __future__ import annotations

import bisect
import hashlib
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators.sequences import global_rank

CELL_BITS = 14


def ring(n_shards: int, vnodes: int, bits: int = CELL_BITS) -> list[tuple[int, int]]:
    """Sorted ``(cell, shard)`` of the virtual nodes; a shard's places don't depend on ``n_shards``."""
    places = []
    for s in range(n_shards):
        for v in range(vnodes):
            h = hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest()
            places.append((int.from_bytes(h, "big") >> (64 - bits), s))
    return sorted(places)


def segments(counts: dict[int, int], n_shards: int, vnodes: int, load: float = 1.0,
             bits: int = CELL_BITS) -> list[tuple[int, int, int, int, int]]:
    """``(cell, first rank, end rank, shard, first slot)`` covering all counted keys.

    ``load`` 1.0 gives capacities that sum to the total, so counts are at most
    one apart; above it every shard may hold ``ceil(load * total / n_shards)``.
    """
    total = sum(counts.values())
    if load <= 1.0:
        room = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    else:
        room = [-int(-load * total // n_shards)] * n_shards
    used = [0] * n_shards
    places = ring(n_shards, vnodes, bits)
    cells = [c for c, _ in places]
    out = []
    for cell in sorted(counts):
        start, rank, left = bisect.bisect_left(cells, cell), 0, counts[cell]
        for step in range(len(places)):
            if not left:
                break
            s = places[(start + step) % len(places)][1]
            take = min(left, room[s] - used[s])
            if take > 0:
                out.append((cell, rank, rank + take, s, used[s]))
                used[s] += take
                rank += take
                left -= take
    return out


def shard(df: DataFrame, key: str, n_shards: int, vnodes: int = 128, load: float = 1.0,
          order: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``shard`` and ``slot`` (gapless from 0 in each shard) to every row.

    ``order`` names further columns that break ties of equal keys; rows equal
    in all of them are interchangeable. Null keys share one ring position, and
    so do the rows of a repeated key. Ranks come from a range partitioning of
    all rows by ring position, key and ``order``, so a key that names many rows
    spreads over tasks; only rows equal in all of these stay together.
    Columns named shard or slot are replaced; an empty table stays empty.
    """
    spark = df.sparkSession
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    # the caller's columns travel in a struct, so no name of theirs can clash
    rows = df.select(F.xxhash64(F.col(key)).alias("h"), *(F.col(c).alias(f"o{i}") for i, c in enumerate((key, *order))), F.struct(*kept).alias("row"))
    rows = rows.withColumn("cell", F.shiftrightunsigned("h", 64 - CELL_BITS).cast("int"))
    counts = {r["cell"]: r["n"] for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts = dict(zip(sorted(counts), accumulate((counts[c] for c in sorted(counts)), initial=0)))
    plan = [(c, starts[c] + first, starts[c] + end, s, base) for c, first, end, s, base in segments(counts, n_shards, vnodes, load)]
    table = spark.createDataFrame(plan, "c int, first long, end long, shard int, base long")
    ranked = global_rank(rows, ["cell", "h", *(f"o{i}" for i in range(len(order) + 1))], "rank")
    # at most one segment more than cells and shards together: a bounded table
    return (
        ranked.join(F.broadcast(table), (F.col("cell") == F.col("c")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
        .select("row.*", "shard", (F.col("base") + F.col("rank") - F.col("first")).alias("slot"))
    )
