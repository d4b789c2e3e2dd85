"""Batch stages between stored tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_keys(incoming: DataFrame, stored: DataFrame, key: str, skip: tuple[str, ...] = ("UNL",)) -> DataFrame:
    """Incoming rows whose key isn't stored yet and isn't to be skipped."""
    return incoming.where(~F.col(key).cast("string").isin(list(skip))).join(stored.select(key), key, "left_anti")


def rebuild(entries: DataFrame, members: DataFrame, key: str, transform: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """The tables after a filter chain, without entries that lost all their members."""
    from helixframe.operators.filters import non_empty

    entries, members = transform(entries, members)
    entries = non_empty(entries, members, key)
    return entries, non_empty(members, entries, key)


def error_tally(results: DataFrame, error: str = "error", key: str = "key") -> DataFrame:
    """``error, n, sample``: failures by message with the smallest key as a sample."""
    return results.where(F.col(error).isNotNull()).groupBy(error).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("sample"))


def expand_molecules(rows: DataFrame, key: str, entries: DataFrame, entry_key: str) -> DataFrame:
    """``assembly_model_alt`` keys as columns, entry columns attached."""
    part = lambda i: F.split_part(key, F.lit("_"), F.lit(i))
    return rows.withColumns({"assembly_id": part(1), "model_id": part(2), "alt_id": part(3)}).join(entries, entry_key)


def remap_alignments(alignments: DataFrame, seqs: DataFrame, sequence: str = "sequence", shortest: int = 16) -> tuple[DataFrame, DataFrame]:
    """Alignments under the id of their sequence (type P, not all X, long enough), and those without an id."""
    wanted = alignments.where((F.length(sequence) >= shortest) & ~F.rlike(F.col(sequence), F.lit("^X*$")))
    ids = seqs.where(F.startswith(F.col("seq_id"), F.lit("P"))).select(F.col("sequence").alias(sequence), "seq_id")
    return wanted.join(ids, sequence), wanted.join(ids.select(sequence), sequence, "left_anti")
