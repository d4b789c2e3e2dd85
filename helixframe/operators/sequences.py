"""Sequence extraction, stable identifiers and metadata joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.session import materialize


def ordered_join(df: DataFrame, keys: list[str], order: list[str], value: str, out: str, sep: str = "") -> DataFrame:
    """The values of each key in order, joined to one string."""
    item = F.struct(*order, F.col(value).alias("_v"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["_v"]), sep)
    return df.groupBy(*keys).agg(text.alias(out))


def chain_sequences(chains: DataFrame, residues: DataFrame, keys: list[str], order: str, letter: str, comp: str, kind: str,
                    branched: DataFrame | None = None) -> DataFrame:
    """One string a chain: canonical letters of a polymer, ``(COMP)`` of a non-polymer's first residue.

    A branched chain's string is its canonical graph (``canonical_strings``),
    from ``branched`` with the keys and ``canonical``; without it, it is null.
    """
    joined = ordered_join(residues, keys, [order], letter, "_letters")
    first = residues.groupBy(*keys).agg(F.min_by(comp, order).alias("_first"))
    polymer = ~F.col(kind).isin("non-polymer", "branched", "water")
    out = chains.join(joined, keys, "left").join(first, keys, "left")
    if branched is None:
        out = out.withColumn("_graph", F.lit(None).cast("string"))
    else:
        out = out.join(branched.select(*keys, F.col("canonical").alias("_graph")), keys, "left")
    one = F.concat(F.lit("("), F.col("_first"), F.lit(")"))
    sequence = F.when(polymer, F.col("_letters")).when(F.col(kind) == "non-polymer", one).when(F.col(kind) == "branched", F.col("_graph"))
    return out.withColumn("sequence", sequence).drop("_letters", "_first", "_graph")


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key; all columns decide ties, so the result is fixed."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def fasta_records(df: DataFrame, header: Column, sequence: str, keys: list[str], order: list[str]) -> DataFrame:
    """``ord, record`` of FASTA records, the first of each key."""
    one = first_per_key(df, keys, order)
    return one.select(*order, F.concat(F.lit(">"), header, F.lit("\n"), F.coalesce(sequence, F.lit("")), F.lit("\n")).alias("record"))


def global_rank(df: DataFrame, order: list[str], out: str, partitions: int | None = None) -> DataFrame:
    """Dense row numbers from 0 over all rows without one global window.

    Rows are range-partitioned by ``order``; a partition's rows are numbered in
    it and shifted by the rows before it (one small aggregate a partition).
    """
    return running_count(df, order, F.lit(1), out, partitions).withColumn(out, F.col(out) - 1)


def running_count(df: DataFrame, order: list[str], step: Column, out: str, partitions: int | None = None) -> DataFrame:
    """The sum of ``step`` up to each row, in ``order`` over all rows, from range partitions as in ``global_rank``."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.withColumn("_step", step).repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranked")
    sums = ranged.groupBy("_part").agg(F.sum("_step").alias("_n"))
    # as many rows as partitions
    before = sums.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    local = F.sum("_step").over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        ranged.withColumn("_local", local).join(F.broadcast(before), "_part")
        .withColumn(out, F.col("_local") + F.col("_before")).drop("_part", "_step", "_local", "_before")
    )


def assign_seq_ids(records: DataFrame, old: DataFrame | None, kind: str, sequence: str, order: str, digits: int = 7) -> DataFrame:
    """``seq_id, kind, sequence``: stable ids of all sequences present now.

    A (kind, sequence) keeps its old id; new ones continue behind the largest
    old number in the order they are first seen. Without an old table numbers
    start at 0.
    """
    # keys are digests; a sequence itself goes along once
    digest = lambda c: F.md5(F.col(c).cast("binary")).alias("_d")
    seen = records.groupBy(kind, digest(sequence)).agg(F.min(order).alias("_first"), F.min(sequence).alias(sequence))
    if old is None:
        return global_rank(seen, ["_first", kind, sequence], "_n").select(_seq_id(kind, F.col("_n"), digits), kind, sequence)
    known = old.select(F.substring("seq_id", 1, 1).alias(kind), digest("sequence"), "seq_id")
    joined = materialize(seen.join(known, [kind, "_d"], "left"), "seen-sequences")
    top = old.agg(F.coalesce(F.max(F.substring("seq_id", 2, 20).cast("long")), F.lit(-1))).first()[0]
    new = global_rank(joined.where("seq_id is null").select(kind, sequence, "_first"), ["_first", kind, sequence], "_n")
    return joined.where("seq_id is not null").select("seq_id", kind, sequence).unionByName(
        new.select(_seq_id(kind, F.col("_n") + top + 1, digits), kind, sequence))


def _seq_id(kind: str, number: Column, digits: int) -> Column:
    return F.concat(F.col(kind), F.lpad(number.cast("string"), digits, "0")).alias("seq_id")


def strict_lookup(df: DataFrame, table: DataFrame, keys: list[str], values: list[str], strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows with their table values, and the rows that miss (the quarantine).

    ``strict`` raises once, with the number of misses, instead.
    """
    hit = df.join(table.select(*keys, *values), keys)
    miss = df.join(table.select(*keys), keys, "left_anti")
    if strict:
        n = miss.count()
        if n:
            raise KeyError(f"{n} rows have no entry")
    return hit, miss


def invert_map(pairs: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """``value -> key``; the last key in order wins."""
    return pairs.where(F.col(value).isNotNull()).groupBy(value).agg(F.max_by(key, F.struct(order, key)).alias(key))


def header_clusters(fasta: DataFrame, seqs: DataFrame, clusters: DataFrame) -> DataFrame:
    """``header, seq_id, cluster_id`` through (type, sequence) and seq_id."""
    by_seq = fasta.join(seqs.select("mol_type", "sequence", "seq_id"), ["mol_type", "sequence"])
    return by_seq.join(clusters.select("seq_id", "cluster_id"), "seq_id").select("header", "seq_id", "cluster_id")


def attach_metadata(chains: DataFrame, table: DataFrame, chain_key: str, table_key: str, values: list[str]) -> DataFrame:
    """Chains with their values; chains without an entry have nulls."""
    right = table.select(F.col(table_key).alias("_k"), *values)
    return chains.join(right, F.col(chain_key) == F.col("_k"), "left").drop("_k")


def entry_metadata(entries: DataFrame, members: DataFrame, key: str, member_key: str, flags: dict[str, Column], counts: dict[str, Column]) -> DataFrame:
    """Counts of members and Yes/No flags of every entry."""
    found = members.groupBy(F.col(member_key).alias("_k")).agg(
        *(c.alias(n) for n, c in counts.items()), *(F.max(c).alias(n) for n, c in flags.items()))
    out = entries.join(found, F.col(key) == F.col("_k"), "left").drop("_k")
    for n in counts:
        out = out.withColumn(n, F.coalesce(F.col(n), F.lit(0)))
    for n in flags:
        out = out.withColumn(n, F.when(F.coalesce(F.col(n), F.lit(False)), "Yes").otherwise("No"))
    return out


def earliest(df: DataFrame, key: str, date: str, out: str = "earliest") -> DataFrame:
    return df.groupBy(key).agg(F.min(date).alias(out))


def trimmed_sequence(df: DataFrame, sequence: str, last: str) -> Column:
    """A sequence behind its 0-based annotated end; whole without annotation."""
    return F.when(F.col(last).isNull(), F.col(sequence)).otherwise(F.substr(F.col(sequence), F.col(last) + F.lit(2)))


def template_metadata(dates: DataFrame, chains: DataFrame, seqs: DataFrame, signals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per (entry, chain): date and trimmed sequence; per seq_id: earliest date and trimmed sequence.

    ``dates(entry_id, date)``, ``chains(entry_id, chain_id, seq_id)``,
    ``seqs(seq_id, sequence)``, ``signals(seq_id, start0, end0)``.
    """
    cut = seqs.join(signals.select("seq_id", "end0"), "seq_id", "left")
    cut = cut.select("seq_id", trimmed_sequence(cut, "sequence", "end0").alias("sequence"))
    by_chain = chains.join(dates, "entry_id").join(cut, "seq_id")
    per_seq = by_chain.groupBy("seq_id").agg(F.min("date").alias("earliest"), F.min("sequence").alias("sequence"))
    return by_chain.select("entry_id", "chain_id", "seq_id", "date", "sequence"), per_seq
