"""FASTA, A3M, key-value, annotation, report and cluster-file scans.

Files are read with Spark's ``text`` source. A record's place is kept by the
file, the start of its split and a running id, so order holds over splits. The
``parse_*`` functions take a table of (file, ord, line) or whole texts and do
the work; the ``read_*`` functions put a scan in front.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.operators.sequences import running_count


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``path, stem``: files below a folder that match the pattern."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path")
    return files.withColumn("stem", F.regexp_extract("path", r"([^/]+?)(\.[^/.]*)*$", 1))


def list_pairs(spark: SparkSession, folder: str, pattern: str, output: str, suffix: str) -> DataFrame:
    """``path, output``: every input file and the file its result goes to."""
    return list_files(spark, folder, pattern).select("path", F.concat(F.lit(output.rstrip("/") + "/"), "stem", F.lit(suffix)).alias("output"))


def read_lines(spark: SparkSession, path: str, sep: str = "\n", dense: bool = True) -> DataFrame:
    """``file, ord, value`` in file order.

    A dense ``ord`` counts a file's lines from 0, in one window a file, for
    reports and annotations. Large files take ``dense=False``: ``ord`` is then
    the place of the split and of the line in it, which sorts alike and needs
    no shuffle.
    """
    rows = spark.read.option("lineSep", sep).option("recursiveFileLookup", "true").text(path)
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("ord"), "value")
    if not dense:
        return rows
    w = Window.partitionBy("file").orderBy("ord")
    return rows.withColumn("ord", F.row_number().over(w) - 1)


def read_wholes(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), "value")


def parse_fasta(records: DataFrame, record: str = "value") -> DataFrame:
    """Adds ``header`` and ``sequence`` to records split at ``\\n>``; text without a header is an error row (null header)."""
    body = F.regexp_replace(F.col(record), "^>", "")
    head = F.split_part(body, F.lit("\n"), F.lit(1))
    rest = F.substr(body, F.length(head) + F.lit(2))
    return records.withColumns({"header": F.trim(head), "sequence": F.regexp_replace(rest, r"\s", "")})


def fasta_header(df: DataFrame, header: str = "header") -> DataFrame:
    """``ENTRY_ASYM_ALT | type | Auth:x`` to ``cif_id, entity_type, auth_id``."""
    part = lambda i: F.trim(F.split_part(F.col(header), F.lit("|"), F.lit(i)))
    return df.withColumns({"cif_id": part(1), "entity_type": part(2), "auth_id": F.regexp_replace(part(3), "^Auth:", "")})


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    rows = parse_fasta(read_lines(spark, path, "\n>", dense=False).where(F.length(F.trim("value")) > 0))
    return fasta_header(rows.select("file", "ord", "header", "sequence"))


def only_type(fasta: DataFrame, entity_type: str = "polypeptide(L)") -> DataFrame:
    return fasta.where(F.col("entity_type") == entity_type)


def parse_a3m(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys..., row_ord, header, sequence``: sequences concatenated over lines.

    A text whose first line isn't a header raises when it is read.
    """
    body = F.when(F.startswith(F.col(text), F.lit(">")) | (F.trim(text) == ""), F.col(text)).otherwise(F.raise_error(F.lit("a sequence precedes the first header")))
    rows = texts.select(*keys, F.posexplode(F.split(F.regexp_replace(body, "^>", ""), "\n>")).alias("row_ord", "_r")).where(F.length("_r") > 0)
    return rows.select(*keys, "row_ord", F.split_part("_r", F.lit("\n"), F.lit(1)).alias("header"),
                       F.regexp_replace(F.substr(F.col("_r"), F.length(F.split_part("_r", F.lit("\n"), F.lit(1))) + F.lit(2)), r"\s", "").alias("sequence"))


def query_rows(a3m: DataFrame) -> DataFrame:
    return a3m.where("row_ord = 0")


def header_counts(a3m: DataFrame, keys: list[str]) -> DataFrame:
    return a3m.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_headers"))


def parse_kv(lines: DataFrame, value: str = "value", comma: bool = True) -> DataFrame:
    """``key, value`` pairs of ``key<TAB>v1,v2`` lines, one row a value; lines without a tab are skipped."""
    rows = lines.where(F.contains(F.col(value), F.lit("\t")))
    key, rest = F.split_part(value, F.lit("\t"), F.lit(1)), F.split_part(value, F.lit("\t"), F.lit(2))
    others = [c for c in lines.columns if c not in (value, "key")]
    return rows.select(*others, key.alias("key"), F.explode(F.split(rest, ",") if comma else F.array(rest)).alias("value"))


def merge_antibodies(clusters: DataFrame, cluster: str = "cluster_id", merged: str = "Ab_cluster") -> DataFrame:
    """All antibody clusters (``cA…``) as one."""
    return clusters.withColumn(cluster, F.when(F.substring(cluster, 2, 1) == "A", merged).otherwise(F.col(cluster)))


def parse_gff(lines: DataFrame, keys: list[str], ord_: str = "ord", value: str = "value") -> DataFrame:
    """``keys..., start0, end0`` from columns 4 and 5 of the second line; one-line files give nothing."""
    second = lines.where(F.col(ord_) == 1)
    column = lambda i: F.split_part(value, F.lit("\t"), F.lit(i)).cast("long") - 1
    return second.select(*keys, column(4).alias("start0"), column(5).alias("end0"))


def parse_dates(lines: DataFrame, key: str, date: str, order: str) -> DataFrame:
    """Entry id and date, the last row of an entry wins; ``NA`` is null."""
    rows = lines.select(F.lower(key).alias("entry_id"), F.to_date(F.nullif(F.col(date), F.lit("NA"))).alias("date"), F.col(order).alias("_o"))
    return rows.groupBy("entry_id").agg(F.max_by("date", "_o").alias("date"))


def parse_antibodies(rows: DataFrame, entry: str, heavy: str, light: str) -> DataFrame:
    clean = lambda c: F.upper(F.nullif(F.col(c), F.lit("NA")))
    return rows.select(F.upper(entry).alias("entry_id"), clean(heavy).alias("heavy"), clean(light).alias("light"))


HIT_ROW = r"^\s*([0-9.eE+-]+)\s+([0-9.eE+-]+)\s+([0-9.eE+-]+)\s+([0-9.eE+-]+)\s+([0-9.eE+-]+)\s+([0-9.eE+-]+)\s+([0-9.]+)\s+(\d+)\s+(\S+)"


def parse_hits(lines: DataFrame, keys: list[str], ord_: str = "ord", value: str = "value") -> DataFrame:
    """``keys..., target, hit_rank``: report rows in order, ids cut to entry_chain, the first of each."""
    rows = lines.where(F.rlike(F.col(value), F.lit(HIT_ROW))).withColumn("_id", F.regexp_extract(value, HIT_ROW, 9))
    target = F.concat_ws("_", F.split_part("_id", F.lit("_"), F.lit(1)), F.split_part("_id", F.lit("_"), F.lit(2)))
    first = rows.withColumn("target", target).groupBy(*keys, "target").agg(F.min(ord_).alias("_o"))
    w = Window.partitionBy(*keys).orderBy("_o")
    return first.withColumn("hit_rank", F.row_number().over(w)).select(*keys, "target", "hit_rank")


NODE_ROW = r"^\s*(\d+)((?:\s+(?:[0-9.]+|\*)){20})\s+(\d+|-)\s+(\S)\s+\S+\s+\S+\s+\S+\s*$"


def parse_hmm_nodes(lines: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """``keys..., hmm_idx, query_idx`` (0-based) from node lines with a map column."""
    rows = lines.where(F.rlike(F.col(value), F.lit(NODE_ROW)) & (F.regexp_extract(value, NODE_ROW, 3) != "-"))
    return rows.select(*keys, (F.regexp_extract(value, NODE_ROW, 1).cast("int") - 1).alias("hmm_idx"), (F.regexp_extract(value, NODE_ROW, 3).cast("int") - 1).alias("query_idx"))


def parse_clstr(lines: DataFrame, keys: list[str], ord_: str = "ord", value: str = "value") -> DataFrame:
    """``keys..., representative, member`` of a cluster file; names lose ``_H3``/``_L3`` and representatives start with A.

    Headings are counted over range partitions and a cluster's representative
    is an aggregate, so neither a file nor a cluster has to fit in one task.
    """
    heading = F.startswith(F.col(value), F.lit(">Cluster")).cast("int")
    numbered = running_count(lines, [*keys, ord_], F.coalesce(heading, F.lit(0)), "_c")
    rows = numbered.where(F.contains(F.col(value), F.lit(", >"))).select(
        *keys, "_c", F.regexp_replace(F.regexp_extract(value, r">(.+?)\.\.\.", 1), "_[HL]3$", "").alias("member"), F.endswith(F.rtrim(value), F.lit("*")).alias("_star"))
    # a file starts a cluster of its own, also for lines in front of its first heading
    found = rows.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_c").alias("_d")).agg(F.max(F.when(F.col("_star"), F.col("member"))).alias("_rep"))
    same = F.col("_c") == F.col("_d")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(found, same).select(*keys, F.regexp_replace("_rep", "^P", "A").alias("representative"), "member")


def parse_pairs(lines: DataFrame, value: str = "value", keep: list[str] = ()) -> DataFrame:
    """``a, b``: the first two columns of every line."""
    return lines.select(*keep, F.split_part(value, F.lit("\t"), F.lit(1)).alias("a"), F.split_part(value, F.lit("\t"), F.lit(2)).alias("b"))


def edge_table(pairs: DataFrame, a: str, b: str, ignored: list[str], polymer: Column) -> DataFrame:
    """Edges without ignored nodes, with a ``polymer`` flag."""
    return pairs.where(~F.col(a).isin(ignored) & ~F.col(b).isin(ignored)).withColumn("polymer", polymer)


def split_blocks(chunks: DataFrame, value: str = "value") -> DataFrame:
    """``block_id, prefix, text`` of chunks split before ``data_`` lines."""
    body = F.regexp_replace(F.col(value), "^data_", "")
    name = F.trim(F.split_part(body, F.lit("\n"), F.lit(1)))
    return chunks.select(name.alias("block_id"), F.substring(name, 1, 1).alias("prefix"), F.concat(F.lit("data_"), body).alias("text")).where("block_id <> ''")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return split_blocks(read_lines(spark, path, "\ndata_", dense=False))


def equal_length(rows: DataFrame, keys: list[str], length: Column) -> tuple[DataFrame, DataFrame]:
    """Keys whose rows agree in length, and those that don't."""
    spread = rows.groupBy(*keys).agg(F.min(length).alias("shortest"), F.max(length).alias("longest"))
    return spread.where("shortest = longest").select(*keys, F.col("shortest").alias("length")), spread.where("shortest <> longest")
