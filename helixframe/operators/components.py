"""Connected components over edge tables (iterative, no driver-side graph)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.session import materialize, scratch


def connected_components(
    edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60
) -> DataFrame:
    """Smallest reachable node of every node that has an edge: ``(node, component)``.

    Alternates a large-star and a small-star step: every round rewires each
    edge to the smallest neighbour, so the edge table becomes a forest of
    stars in a logarithmic number of rounds. Both steps are ``min`` aggregates
    with map-side combine and equi-joins, so a hub costs rows, not one task's
    memory. Each round is written to the shared folder to cut the lineage, and
    so is the result; the rounds' tables go at the end.

    Null endpoints are dropped, self-loops only name their node, repeated and
    reversed edges count once, an empty table gives an empty result.
    """
    with scratch(edges.sparkSession):
        pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull())
        links = materialize(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-links")
        nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        links = links.where("a <> b")
        mark = _signature(links)
        for _ in range(max_rounds):
            if mark[0] == 0:
                break
            links = materialize(_small_star(_large_star(links)), "cc-links")
            new = _signature(links)
            if new == mark:
                break
            mark = new
        else:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        found = nodes.join(links.withColumnRenamed("a", "node"), "node", "left").groupBy("node").agg(F.coalesce(F.min("b"), F.col("node")).alias("component"))
        return materialize(found, "components", lasting=True)


def _signature(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return (row["n"], row["h"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.join(low, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    low = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(low, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(low.select("a", F.col("m").alias("b"))).distinct()
