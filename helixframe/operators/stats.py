"""Dataset statistics: distinct clusters and interfaces, node and edge maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def monomers_and_interfaces(chains: DataFrame, contacts: DataFrame, key: str, chain: str, cluster: str, src: str, dst: str) -> tuple[DataFrame, DataFrame]:
    """Distinct clusters, and distinct sorted cluster pairs in contact."""
    from helixframe.operators.graph import interacting_ids

    pairs = interacting_ids(contacts, chains, key, chain, cluster, src, dst)
    return chains.select(F.col(cluster).alias("cluster")).distinct(), pairs.select(F.col("id1").alias("a"), F.col("id2").alias("b"))


def type_statistics(monomers: DataFrame, interfaces: DataFrame, types: DataFrame) -> DataFrame:
    """One tidy table ``section, type, n``; ``types(cluster, type)`` gives every cluster's type."""
    single = monomers.join(types, "cluster").groupBy("type").agg(F.count(F.lit(1)).alias("n")).select(F.lit("monomer").alias("section"), "type", "n")
    ta = types.select(F.col("cluster").alias("a"), F.col("type").alias("ta"))
    tb = types.select(F.col("cluster").alias("b"), F.col("type").alias("tb"))
    both = interfaces.join(ta, "a").join(tb, "b").select(F.concat_ws("-", F.least("ta", "tb"), F.greatest("ta", "tb")).alias("type"))
    return single.unionByName(both.groupBy("type").agg(F.count(F.lit(1)).alias("n")).select(F.lit("interface").alias("section"), "type", "n"))


def node_map(chains: DataFrame, cluster: str, ref: str, observed: DataFrame | None = None, observed_ref: str | None = None) -> DataFrame:
    """``cluster, refs``: chain references of each cluster (of observed chains only)."""
    if observed is not None:
        chains = chains.join(observed.select(F.col(observed_ref or ref).alias("_o")).distinct(), F.col(ref) == F.col("_o"), "left_semi")
    return chains.groupBy(F.col(cluster).alias("cluster")).agg(F.array_join(F.sort_array(F.collect_set(ref)), ",").alias("refs"))


def interface_map(pairs: DataFrame, a: str, b: str, ref_a: str, ref_b: str) -> DataFrame:
    """``a, b, refs`` with ``src:dst`` references of each sorted cluster pair."""
    flip = F.col(a) > F.col(b)
    ref = F.when(flip, F.concat_ws(":", ref_b, ref_a)).otherwise(F.concat_ws(":", ref_a, ref_b))
    return pairs.groupBy(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).agg(F.array_join(F.sort_array(F.collect_set(ref)), ",").alias("refs"))


#: Characters of one piece of a list, about.
PIECE = 1 << 20


def list_pieces(rows: DataFrame, keys: list[str], ref: str, size: int = PIECE) -> DataFrame:
    """``keys..., piece, refs``: each key's distinct references in order, comma-joined, cut into numbered pieces.

    Characters are summed over range partitions of all rows, and a piece ends
    where the sum passes a multiple of ``size``: no row has more than ``size``
    characters and one reference, however many a key has. Pieces count from 0.
    """
    from helixframe.operators.sequences import running_count

    every = rows.select(*keys, F.col(ref).alias("_ref")).where("_ref IS NOT NULL").distinct()
    order = [*keys, "_ref"]
    summed = running_count(every, order, F.length("_ref") + 1, "_sum").withColumn("_p", F.floor((F.col("_sum") - 1) / size))
    first = summed.groupBy(*keys).agg(F.min("_p").alias("_p0"))
    numbered = summed.join(first, keys).withColumn("piece", F.col("_p") - F.col("_p0"))
    return numbered.groupBy(*keys, "piece").agg(F.array_join(F.sort_array(F.collect_list("_ref")), ",").alias("refs"))


def node_pieces(chains: DataFrame, cluster: str, ref: str, size: int = PIECE) -> DataFrame:
    """``cluster, piece, refs``: the node map in pieces."""
    return list_pieces(chains.withColumn("cluster", F.col(cluster)), ["cluster"], ref, size)


def interface_pieces(pairs: DataFrame, a: str, b: str, ref_a: str, ref_b: str, size: int = PIECE) -> DataFrame:
    """``a, b, piece, refs``: the interface map in pieces."""
    flip = F.col(a) > F.col(b)
    ref = F.when(flip, F.concat_ws(":", ref_b, ref_a)).otherwise(F.concat_ws(":", ref_a, ref_b))
    return list_pieces(pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), ref.alias("_r")), ["a", "b"], "_r", size)


def isolated_nodes(nodes: DataFrame, interfaces: DataFrame) -> DataFrame:
    """Nodes that occur in no interface."""
    linked = interfaces.select(F.explode(F.array("a", "b")).alias("cluster")).distinct()
    return nodes.join(linked, "cluster", "left_anti")
