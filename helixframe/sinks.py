"""Writers of the domain's text formats, each with the table it writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def write_lines(df: DataFrame, path: str, line: str = "line") -> None:
    df.select(line).write.text(path)


def write_tsv(df: DataFrame, path: str, header: bool = False, null: str = "NA") -> None:
    df.write.csv(path, sep="\t", header=header, nullValue=null, emptyValue="")


def seq_id_lines(seqs: DataFrame) -> DataFrame:
    return seqs.select("seq_id", "sequence").orderBy("seq_id")


def cluster_lines(members: DataFrame, cluster: str, member: str) -> DataFrame:
    """``cluster_id, members``: ``c`` and the representative, members sorted and comma-joined."""
    return members.groupBy(F.concat(F.lit("c"), cluster).alias("cluster_id")).agg(F.array_join(F.sort_array(F.collect_list(member)), ",").alias("members"))


def cluster_pieces(members: DataFrame, cluster: str, member: str, size: int = 1 << 20) -> DataFrame:
    """``cluster_id, piece, members``: as ``cluster_lines``, a long cluster in numbered pieces of about ``size`` characters."""
    from helixframe.operators.stats import list_pieces

    rows = members.select(F.concat(F.lit("c"), cluster).alias("cluster_id"), F.col(member).cast("string").alias("_m"))
    return list_pieces(rows, ["cluster_id"], "_m", size).withColumnRenamed("refs", "members")


def metadata_lines(df: DataFrame, columns: list[str], null: str = "NA") -> DataFrame:
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit(null)).alias(c) for c in columns))


def pair_lines(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.select(a, b).distinct().orderBy(a, b)


def check_lines(df: DataFrame, key: str, result: str) -> DataFrame:
    return df.select(key, F.coalesce(result, F.lit("passed")).alias("result"))


def statistics_lines(statistics: DataFrame) -> DataFrame:
    """``part, line``: the two sections of a statistics file from ``section, type, n``; write it in the order of ``part, line``."""
    names = {"monomer": "Monomer Cluster Statistics:", "interface": "Interface Cluster Statistics:"}
    heads = statistics.sparkSession.createDataFrame([(k, i, line) for k, (i, line) in enumerate([(0, names["monomer"]), (2, ""), (3, names["interface"])])], "_k int, part int, line string").drop("_k")
    rows = statistics.select(F.when(F.col("section") == "monomer", 1).otherwise(4).alias("part"), F.concat_ws(",", "type", F.col("n").cast("string")).alias("line"))
    return heads.unionByName(rows)


def atom_site_lines(atoms: DataFrame, key: str, order: str, columns: dict[str, Column]) -> DataFrame:
    """``key, serial, line``: a whole atom table of a structure file; serials below 1 are the block's and loop's heads.

    ``columns`` are item names and values in the file's order; ``atom_lines`` pads them.
    """
    body = atom_lines(atoms, [key], order, columns)
    heads = ["#", "loop_", "_atom_site.group_PDB", "_atom_site.id", *(f"_atom_site.{c}" for c in columns)]
    places = F.array(*(F.struct(F.lit(i - len(heads)).alias("serial"), F.lit(h).alias("line")) for i, h in enumerate(heads)))
    first = body.select(key).distinct()
    named = first.select(key, F.lit(-len(heads) - 1).alias("serial"), F.concat(F.lit("data_"), F.col(key).cast("string")).alias("line"))
    return named.unionByName(first.select(key, F.inline(places))).unionByName(body)


def lookup(store: DataFrame, keys: DataFrame, store_key: str, key: str) -> DataFrame:
    """The stored rows of the wanted keys, each once however often it is wanted."""
    return store.join(keys.select(F.col(key).alias("_k")), F.col(store_key) == F.col("_k"), "left_semi")


def write_store(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """A stored table in sorted buckets of ``key``, with a bloom filter of it in every row group."""
    out = df.write.bucketBy(buckets, key).sortBy(key).option("parquet.bloom.filter.enabled#" + key, "true")
    (out.option("path", path) if path else out).mode("overwrite").saveAsTable(table)


def store_lookup(spark: SparkSession, table: str, store_key: str, keys: DataFrame, key: str, listed: int = 1000) -> DataFrame:
    """The stored rows of the wanted keys; the store is never shuffled.

    Up to ``listed`` keys become a filter that row groups are skipped by (bounds
    and bloom filters); more are dealt out as the store's buckets are and joined
    bucket by bucket.
    """
    wanted = keys.select(F.col(key).alias("_k")).where("_k IS NOT NULL").distinct()
    few = [r[0] for r in wanted.limit(listed + 1).collect()]
    if len(few) <= listed:
        return spark.table(table).where(F.col(store_key).isin(few))
    return spark.table(table).join(wanted.hint("merge"), F.col(store_key) == F.col("_k"), "left_semi")


def write_blocks(blocks: DataFrame, path: str) -> None:
    """One row a block, in folders by its first letter."""
    blocks.select("prefix", "text").write.partitionBy("prefix").text(path)


def strip_common_entry(src: Column, dst: Column) -> Column:
    """``src:dst`` with the part of ``dst`` before its ``(`` dropped where it equals that of ``src``."""
    head = lambda c: F.substring_index(c, "(", 1)
    short = F.substr(dst, F.length(head(dst)) + F.lit(1))
    return F.concat(src, F.lit(":"), F.when(head(src) == head(dst), short).otherwise(dst))


def edge_node_lines(isolated: DataFrame, interfaces: DataFrame) -> DataFrame:
    """``c1, c2, chains``: isolated clusters with ``None``, then interfaces."""
    alone = isolated.select(F.col("cluster").alias("c1"), F.lit("None").alias("c2"), F.col("refs").alias("chains"))
    return alone.unionByName(interfaces.select(F.col("a").alias("c1"), F.col("b").alias("c2"), F.col("refs").alias("chains")))


def merge_shards(shards: list[DataFrame], keys: list[str]) -> DataFrame:
    """One row a key; a later shard wins."""
    whole = None
    for i, s in enumerate(shards):
        s = s.withColumn("_shard", F.lit(i))
        whole = s if whole is None else whole.unionByName(s)
    rest = [c for c in whole.columns if c not in keys and c != "_shard"]
    return whole.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_shard").alias("_v")).select(*keys, *(F.col(f"_v.{c}").alias(c) for c in rest))


def key_counts(df: DataFrame, key: str, depth: Column | None = None) -> DataFrame:
    """``n_rows, n_keys`` and, with a depth, ``n_found``."""
    extra = [] if depth is None else [F.count_if(depth > 0).alias("n_found")]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"), *extra)


def atom_lines(atoms: DataFrame, keys: list[str], order: str, columns: dict[str, Column], xyz: tuple[str, str, str] = ("x", "y", "z")) -> DataFrame:
    """``keys..., serial, line``: atoms with all coordinates, renumbered from 1, columns padded to the molecule's widest."""
    whole = atoms.where(" and ".join(f"`{c}` is not null" for c in xyz))
    serial = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    rows = whole.withColumn("serial", serial)
    every = {"_serial": F.col("serial").cast("string"), **columns}
    rows = rows.select(*keys, "serial", *(c.alias(f"_c{i}") for i, c in enumerate(every.values())))
    w = Window.partitionBy(*keys)
    cells = [F.rpad(f"_c{i}", F.max(F.length(f"_c{i}")).over(w), F.lit(" ")) for i in range(len(every))]
    return rows.select(*keys, "serial", F.concat_ws(" ", F.lit("ATOM"), *cells).alias("line"))
