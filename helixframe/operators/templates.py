"""Template hits: candidate selection, alignment projection and backbone tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BACKBONE = ["N", "CA", "C", "CB"]


def candidate_hits(hits: DataFrame, query: str, rank: str, date: str, first_date: str, length: str | None = None, coverage: str | None = None,
                   cutoff: str | None = "2021-09-30", gap_days: int = 60, after: bool = True, shortest: int = 10,
                   cover: tuple[float, float] = (0.1, 0.95), most: int = 20) -> DataFrame:
    """The first ``most`` hits of each query, in hit order, that pass date, length and coverage.

    ``after`` keeps templates deposited at least ``gap_days`` after the query's
    first date; False asks for that long before it.
    """
    gap = F.datediff(F.col(date), F.col(first_date))
    keep = gap >= gap_days if after else gap <= -gap_days
    if cutoff is not None:
        keep &= F.col(date) <= F.lit(cutoff).cast("timestamp")
    if length is not None:
        keep &= F.col(length) >= shortest
    if coverage is not None:
        keep &= F.col(coverage).between(*cover)
    w = Window.partitionBy(query).orderBy(rank)
    return hits.where(keep).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most).drop("_r")


def alignment_columns(alignments: DataFrame, keys: list[str], a: str = "aligned_a", b: str = "aligned_b") -> DataFrame:
    """``keys..., q_pos, t_pos``: 0-based positions of both sides of every aligned column."""
    rows = alignments.select(*keys, F.posexplode(F.arrays_zip(F.split(a, "").alias("x"), F.split(b, "").alias("y"))).alias("_c", "_z"))
    rows = rows.select(*keys, "_c", F.col("_z.x").alias("x"), F.col("_z.y").alias("y")).where("x <> '' and y <> ''")
    w = Window.partitionBy(*keys).orderBy("_c").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = lambda c: F.sum((F.col(c) != "-").cast("long")).over(w) - 1
    return rows.withColumns({"q_pos": at("x"), "t_pos": at("y")}).where("x <> '-' and y <> '-'").select(*keys, "q_pos", "t_pos")


def coverage(columns: DataFrame, queries: DataFrame, keys: list[str], length: str) -> DataFrame:
    n = columns.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_aligned"))
    return queries.join(n, keys, "left").select(*keys, (F.coalesce("n_aligned", F.lit(0)) / F.col(length)).alias("coverage"))


def project(columns: DataFrame, template: DataFrame, keys: list[str], queries: DataFrame, length: str, values: dict[str, object]) -> DataFrame:
    """Template values at every query position; missing ones get ``values``' defaults.

    A side has a row a position, many more than its source's file size suggests, so neither is broadcast.
    """
    every = queries.select(*keys, F.explode(F.sequence(F.lit(0), F.col(length) - 1)).alias("q_pos"))
    placed = columns.join(template.hint("merge"), [*keys, "t_pos"]).select(*keys, "q_pos", *values)
    out = every.join(placed.hint("merge"), [*keys, "q_pos"], "left")
    for c, default in values.items():
        if default is not None:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(default)))
    return out


def backbone(atoms: DataFrame, keys: list[str], atom: str, value: str, names: list[str] = BACKBONE) -> DataFrame:
    """One column a backbone atom; the last falls back to the second (CB to CA). Null stays null."""
    table = atoms.where(F.col(atom).isin(names)).groupBy(*keys).agg(*(F.max(F.when(F.col(atom) == n, F.col(value))).alias(n) for n in names))
    has = atoms.where(F.col(atom) == names[-1]).select(*keys).distinct().withColumn("_has", F.lit(True))
    return table.join(has, keys, "left").withColumn(names[-1], F.when(F.col("_has"), F.col(names[-1])).otherwise(F.col(names[1]))).drop("_has")


def best_molecule(rows: DataFrame, group: list[str], molecule: str, weight: str, order: str | None = None) -> DataFrame:
    """``group..., molecule``: the largest summed weight; ties to the first molecule."""
    sums = rows.groupBy(*group, molecule).agg(F.sum(F.coalesce(weight, F.lit(0.0))).alias("_w"))
    w = Window.partitionBy(*group).orderBy(F.desc("_w"), order or molecule)
    return sums.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(*group, molecule, F.col("_w").alias("weight"))


def first_with_prefix(rows: DataFrame, group: list[str], name: str, prefix: str | Column, order: str) -> DataFrame:
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return rows.where(F.startswith(F.col(name), prefix)).groupBy(*group).agg(F.min_by(name, order).alias(name))


def length_check(rows: DataFrame, key: str, expected: Column, actual: Column) -> DataFrame:
    """``key, result``: ``passed``, or what differs."""
    message = F.concat(F.lit("length "), actual.cast("string"), F.lit(" instead of "), expected.cast("string"))
    return rows.select(key, F.when(expected.eqNullSafe(actual), "passed").otherwise(F.coalesce(message, F.lit("length missing"))).alias("result"))
