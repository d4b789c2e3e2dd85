"""Entry, chain and residue filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions.codes import POLYMER_CODES, WATER


def by_resolution_and_date(df: DataFrame, value: str, cutoff: float, date: str, start=None, end=None) -> DataFrame:
    """Rows with ``value <= cutoff`` (null fails) and ``start <= date < end``.

    One bound may be open; both open raises. Plain comparisons, so they reach
    the scan as pushed filters.
    """
    if start is None and end is None:
        raise ValueError("give a start or an end")
    keep = F.col(value) <= cutoff
    if start is not None:
        keep &= F.col(date) >= F.lit(start).cast("timestamp")
    if end is not None:
        keep &= F.col(date) < F.lit(end).cast("timestamp")
    return df.where(keep)


def drop_components(members: DataFrame, column: str, names: list[str] = WATER) -> DataFrame:
    """Members whose component is not one of ``names``; a null component stays."""
    return members.where(~F.coalesce(F.col(column).isin(names), F.lit(False)))


def non_empty(owners: DataFrame, members: DataFrame, key: str, member_key: str | None = None) -> DataFrame:
    """Owners that still have a member."""
    left = members.select(F.col(member_key or key).alias("_k")).distinct()
    return owners.join(left, F.col(key) == F.col("_k"), "left_semi")


def trim_prefix(rows: DataFrame, key: str, position: str, cuts: DataFrame, cut_key: str, last: str) -> DataFrame:
    """Rows behind the annotated prefix: all of a key without annotation, else ``position > last``."""
    marks = cuts.select(F.col(cut_key).alias("_k"), F.col(last).alias("_last"))
    joined = rows.join(marks, F.col(key) == F.col("_k"), "left")
    return joined.where("_last is null or " + f"`{position}` > _last").select(*rows.columns)


def cap_members(owners: DataFrame, members: DataFrame, key: str, most: int, member_key: str | None = None,
                counted: Column | None = None) -> DataFrame:
    """Owners with at most ``most`` members (of those where ``counted`` holds)."""
    ok = F.lit(True) if counted is None else F.coalesce(counted, F.lit(False))
    over = (
        members.where(ok).groupBy(F.col(member_key or key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    )
    return owners.join(over, F.col(key) == F.col("_k"), "left_anti")


def cap_polymers(owners: DataFrame, chains: DataFrame, key: str, most: int, code: str) -> DataFrame:
    """Owners with at most ``most`` polymer chains (antibody clusters aside)."""
    return cap_members(owners, chains, key, most, counted=F.col(code).isin([c for c in POLYMER_CODES if c != "A"]))


def all_members_in(owners: DataFrame, members: DataFrame, key: str, value: str, allowed: DataFrame, allowed_value: str,
                   member_key: str | None = None) -> DataFrame:
    """Owners none of whose members is outside the allowed set; an owner without members stays."""
    good = allowed.select(F.col(allowed_value).alias("_v")).distinct()
    bad = members.join(good, F.col(value) == F.col("_v"), "left_anti").select(F.col(member_key or key).alias("_k")).distinct()
    return owners.join(bad, F.col(key) == F.col("_k"), "left_anti")


def pairs_with_type(pairs: DataFrame, a: str, b: str, types: list[str], place: int = 1) -> DataFrame:
    """Pairs of which either side's type character (at ``place``) is allowed."""
    return pairs.where(F.substring(a, place, 1).isin(types) | F.substring(b, place, 1).isin(types))


def train_filter(entries: DataFrame, chains: DataFrame, key: str, value: str, date: str, component: str, code: str,
                 cutoff: float = 9.0, end: str = "2021-09-30", chains_at_most: int = 300,
                 waters: list[str] = WATER, signals: tuple[DataFrame, str, str, str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Polymer cap, resolution and date, water, signal peptides: the training set's entries and their chains.

    ``signals`` is the table of annotated prefixes with the column names of
    ``trim_prefix``: the chains' key, the table's key, the position, the last position.
    """
    entries = cap_polymers(entries, chains, key, chains_at_most, code)
    entries = by_resolution_and_date(entries, value, cutoff, date, end=end)
    chains = drop_components(chains, component, waters)
    if signals:
        cuts, chain_key, cut_key, position, last = signals
        chains = trim_prefix(chains, chain_key, position, cuts, cut_key, last)
    entries = non_empty(entries, chains, key)
    return entries, non_empty(chains, entries, key)


def valid_filter(entries: DataFrame, chains: DataFrame, residues: DataFrame, key: str, value: str, date: str, component: str,
                 code: str, cutoff: float = 4.5, start: str = "2021-09-30", end: str = "2023-09-30", chains_at_most: int = 20,
                 tokens_at_most: int = 2560, waters: list[str] = WATER,
                 signals: tuple[DataFrame, str, str, str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """As the training filter, with a date window and a cap on residues that still counts water."""
    entries = by_resolution_and_date(entries, value, cutoff, date, start, end)
    entries = cap_polymers(entries, chains, key, chains_at_most, code)
    entries = cap_members(entries, residues, key, tokens_at_most)
    chains = drop_components(chains, component, waters)
    if signals:
        cuts, chain_key, cut_key, position, last = signals
        chains = trim_prefix(chains, chain_key, position, cuts, cut_key, last)
    entries = non_empty(entries, chains, key)
    return entries, non_empty(chains, entries, key)


def filter_protein_sequences(seqs: DataFrame, seq_id: str = "seq_id", sequence: str = "sequence") -> DataFrame:
    """Type-P sequences that are not all X; an id with several sequences raises when it is read."""
    one = seqs.where(F.startswith(F.col(seq_id), F.lit("P"))).groupBy(seq_id).agg(
        F.count_distinct(sequence).alias("_n"), F.min(sequence).alias(sequence))
    checked = one.withColumn(sequence, F.when(F.col("_n") == 1, F.col(sequence)).otherwise(
        F.raise_error(F.concat(F.lit("not one sequence: "), F.col(seq_id)))))
    return checked.where(~F.rlike(F.col(sequence), F.lit("^X*$"))).select(seq_id, sequence)
