"""Text formats rendered from the business tables, parsed back by the readers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe import sinks
from helixframe.operators import normalize, sequences
from helixframe.plans.base import Tables, query
from helixframe.sinks import cluster_lines, key_counts, metadata_lines, seq_id_lines
from helixframe.session import shared_dir
from helixframe.sources import text


@query("""SELECT 'D' || doc_id || '_A_.' AS cif_id, source AS auth_id, regexp_replace(text, '[ \\t\\n\\r\\f\\v]', '', 'g') AS sequence FROM documents WHERE lang = 'en'""")
def fasta_roundtrip(t: Tables):
    record = F.concat(F.lit(">D"), "doc_id", F.lit("_A_. | "), F.when(F.col("lang") == "en", "polypeptide(L)").otherwise("other"), F.lit(" | Auth:"), "source", F.lit("\n"), "text", F.lit("\n"))
    parsed = text.fasta_header(text.parse_fasta(t.documents.select(record.alias("value"))))
    return text.only_type(parsed).select("cif_id", "auth_id", "sequence")


@query("""SELECT conv_id, CAST(row_ord AS INT) AS row_ord, role || turn AS header, regexp_replace(text, '[ \\t\\n\\r\\f\\v]', '', 'g') AS sequence, n AS n_headers, row_ord = 0 AS is_query FROM (
SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS row_ord, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)""")
def a3m_roundtrip(t: Tables):
    rec = F.concat(F.lit(">"), "role", "turn", F.lit("\n"), F.regexp_replace("text", ">", ")"), F.lit("\n"))
    whole = sequences.ordered_join(t.conversations.withColumn("rec", rec), ["conv_id"], ["turn", "role", "text"], "rec", "value")
    parsed = text.parse_a3m(whole, ["conv_id"], "value")
    first = text.query_rows(parsed).select("conv_id", "row_ord", F.lit(True).alias("is_query"))
    out = parsed.join(text.header_counts(parsed, ["conv_id"]), "conv_id").join(first, ["conv_id", "row_ord"], "left")
    return out.withColumn("is_query", F.coalesce("is_query", F.lit(False)))


@query("""SELECT substr(c_name, length(c_name), 1) AS prefix, count(*) AS n_blocks, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer GROUP BY 1""")
def block_files(t: Tables):
    """Customers as blocks, written to folders by their first letter and read back."""
    head = F.reverse("c_name")
    body = F.concat(F.lit("data_"), head, F.lit("\n_entry.id "), "c_custkey")
    path = f"{shared_dir(t.spark).rstrip('/')}/blocks-{uuid.uuid4().hex}"
    sinks.write_blocks(t.customer.select(F.substring(head, 1, 1).alias("prefix"), body.alias("text")), path)
    blocks = text.read_blocks(t.spark, path)
    keys = F.regexp_extract("text", r"_entry\.id (\d+)", 1).cast("long")
    return blocks.groupBy("prefix").agg(F.count(F.lit(1)).alias("n_blocks"), F.sum(keys).alias("keys"))


@query("""SELECT substr(s_name, length(s_name), 1) AS prefix, count(*) AS n_blocks, CAST(sum(s_suppkey) AS BIGINT) AS keys FROM supplier GROUP BY 1""")
def block_split(t: Tables):
    chunk = F.concat(F.when(F.col("s_suppkey") == 0, "data_").otherwise(""), F.reverse("s_name"), F.lit("\n_entry.id "), "s_suppkey", F.lit("\n"))
    blocks = text.split_blocks(t.supplier.select(chunk.alias("value")))
    keys = F.regexp_extract("text", r"_entry\.id (\d+)", 1).cast("long")
    return blocks.groupBy("prefix").agg(F.count(F.lit(1)).alias("n_blocks"), F.sum(keys).alias("keys"))


@query("""SELECT CASE WHEN p_brand = 'Brand#1' THEN 'Ab_cluster' ELSE 'c' || replace(p_brand, 'Brand#', 'P') END AS cluster_id, p_name, count(*) AS n FROM (SELECT DISTINCT p_brand, p_name FROM part) GROUP BY 1, 2""")
def kv_roundtrip(t: Tables):
    kind = F.when(F.col("p_brand") == "Brand#1", "A").otherwise(F.replace("p_brand", F.lit("Brand#"), F.lit("P")))
    lines = cluster_lines(t.part.select(kind.alias("rep"), "p_name").distinct(), "rep", "p_name")
    parsed = text.parse_kv(lines.select(F.concat_ws("\t", "cluster_id", "members").alias("value")))
    merged = text.merge_antibodies(parsed.withColumnRenamed("key", "cluster_id"))
    return merged.groupBy("cluster_id", F.col("value").alias("p_name")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS seq_id, p_name AS sequence, substr('P', 1, 1) || p_name AS lookup FROM part""")
def seq_map_roundtrip(t: Tables):
    seqs = seq_id_lines(t.part.select(F.concat(F.lit("P"), F.lpad(F.col("p_partkey").cast("string"), 7, "0")).alias("seq_id"), F.col("p_name").alias("sequence")))
    parsed = text.parse_kv(seqs.select(F.concat_ws("\t", "seq_id", "sequence").alias("value")), comma=False)
    return parsed.select(F.col("key").alias("seq_id"), F.col("value").alias("sequence"), F.concat(F.substring("key", 1, 1), "value").alias("lookup"))


@query("""SELECT user_id, event_id - 1 AS start0, event_id + user_id - 1 AS end0 FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r = 1""")
def gff_parse(t: Tables):
    w = Window.partitionBy("user_id").orderBy("event_id")
    lines = t.events.select("user_id", F.row_number().over(w).alias("ord"), F.concat_ws("\t", F.lit("seq"), F.lit("SignalP"), "event_type", "event_id", F.col("event_id") + F.col("user_id"), F.lit(".")).alias("value"))
    return text.parse_gff(lines, ["user_id"])


@query("""SELECT 'o' || o_orderkey AS entry_id, CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date FROM orders""")
def tsv_parse(t: Tables):
    date = F.when(F.col("o_orderkey") % 5 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    lines = metadata_lines(t.orders.select(F.concat(F.lit("O"), "o_orderkey").alias("entry"), date.alias("date"), F.col("o_orderkey").alias("ord")), ["entry", "date", "ord"])
    return text.parse_dates(lines.withColumn("ord", F.col("ord").cast("long")), "entry", "date", "ord").withColumn("date", F.col("date").cast("string"))


@query("""SELECT upper(o_orderpriority) AS entry_id, CASE WHEN o_orderstatus <> 'P' THEN 'H' || o_custkey END AS heavy, CASE WHEN o_orderkey % 2 = 0 THEN 'L' || o_custkey END AS light, count(*) AS n FROM orders GROUP BY 1, 2, 3""")
def antibody_parse(t: Tables):
    rows = t.orders.select(F.lower("o_orderpriority").alias("e"), F.when(F.col("o_orderstatus") == "P", "NA").otherwise(F.concat(F.lit("h"), "o_custkey")).alias("h"),
                           F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("l"), "o_custkey")).otherwise("NA").alias("l"))
    return text.parse_antibodies(rows, "e", "h", "l").groupBy("entry_id", "heavy", "light").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT user_id, target, row_number() OVER (PARTITION BY user_id ORDER BY f) AS hit_rank FROM (
SELECT user_id, 'e' || (event_id % 40) || '_A' AS target, min(event_id) AS f FROM events GROUP BY 1, 2)""")
def report_parse(t: Tables):
    row = F.concat_ws("  ", F.lit("  1.2e-10"), "value", F.lit("0.1"), F.lit("3e-9"), F.lit("33.0"), F.lit("0.1"), F.lit("1.5"), F.lit("2"),
                      F.concat(F.lit("e"), F.col("event_id") % 40, F.lit("_A_0")), F.lit("| protein"))
    lines = t.events.select("user_id", F.col("event_id").alias("ord"), row.alias("value")).unionByName(
        t.events.select("user_id", F.col("event_id").alias("ord"), F.lit("# comment").alias("value")))
    return text.parse_hits(lines, ["user_id"]).withColumn("hit_rank", F.col("hit_rank").cast("long"))


@query("""SELECT user_id, CAST(event_id AS INT) AS hmm_idx, CAST(event_id * 2 AS INT) AS query_idx FROM events WHERE event_id % 3 <> 0""")
def hmm_parse(t: Tables):
    scores = F.lit(" ".join(["1.5"] * 19 + ["*"]))
    row = F.concat_ws(" ", F.col("event_id") + 1, scores, F.when(F.col("event_id") % 3 == 0, "-").otherwise((F.col("event_id") * 2 + 1).cast("string")), F.lit("a - - -"))
    return text.parse_hmm_nodes(t.events.select("user_id", row.alias("value")), ["user_id"])


@query("""SELECT p_brand, 'A' || lpad(CAST(min(p_partkey) OVER (PARTITION BY p_brand, p_size) AS VARCHAR), 7, '0') AS representative,
'P' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS member FROM part""")
def clstr_parse(t: Tables):
    w = Window.partitionBy("p_brand", "p_size")
    star = F.when(F.min("p_partkey").over(w) == F.col("p_partkey"), "*").otherwise("at 95.00%")
    # a heading stands in front of its parts: its key is null
    place = lambda key: F.struct("p_size", key.cast("long").alias("key")).alias("ord")
    body = t.part.select("p_brand", place(F.col("p_partkey")),
                         F.concat(F.lit("0\t12aa, >P"), F.lpad(F.col("p_partkey").cast("string"), 7, "0"), F.lit("_H3... "), star).alias("value"))
    heads = t.part.select("p_brand", place(F.lit(None)), F.concat(F.lit(">Cluster "), "p_size").alias("value")).distinct()
    return text.parse_clstr(body.unionByName(heads), ["p_brand"])


@query("""SELECT l_partkey AS a, l_suppkey AS b, p_type IN ('STANDARD', 'LARGE') AS polymer, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_suppkey NOT IN (1, 2) AND l_partkey NOT IN (1, 2) GROUP BY 1, 2, 3""")
def edge_ignore(t: Tables):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_type", F.concat_ws("\t", "l_partkey", "l_suppkey", "l_quantity").alias("value"))
    pairs = text.parse_pairs(lines, keep=["p_type"])
    out = text.edge_table(pairs, "a", "b", ["1", "2"], F.col("p_type").isin("STANDARD", "LARGE"))
    return out.groupBy(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), "polymer").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT (SELECT count(*) FROM lineitem) AS n_rows, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS n_keys, (SELECT count(*) FROM lineitem WHERE l_quantity > 25) AS n_found""")
def store_counts(t: Tables):
    return key_counts(t.lineitem, "l_orderkey", F.col("l_quantity") - 25)


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 5000)""")
def store_lookup(t: Tables):
    keys = t.customer.where("c_mktsegment = 'MACHINERY' and c_acctbal > 5000").select("c_custkey")
    return sinks.lookup(t.orders, keys, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey", "o_totalprice")


@query("""SELECT DISTINCT o_custkey, o_orderpriority FROM orders""")
def pair_lines(t: Tables):
    return sinks.pair_lines(t.orders, "o_custkey", "o_orderpriority")


@query("""WITH s AS (SELECT substr(p_type, 1, 1) AS type, count(*) AS n FROM part GROUP BY 1),
i AS (SELECT least(substr(p_type, 1, 1), substr(p_brand, 7)) || '-' || greatest(substr(p_type, 1, 1), substr(p_brand, 7)) AS type, count(*) AS n FROM part GROUP BY 1)
SELECT 1 AS part, type || ',' || n AS line FROM s UNION ALL SELECT 4, type || ',' || n FROM i
UNION ALL VALUES (0, 'Monomer Cluster Statistics:'), (2, ''), (3, 'Interface Cluster Statistics:')""")
def statistics_file(t: Tables):
    kind, brand = F.substring("p_type", 1, 1), F.substring("p_brand", 7, 9)
    rows = t.part.select(F.lit("monomer").alias("section"), kind.alias("type")).unionByName(
        t.part.select(F.lit("interface").alias("section"), F.concat_ws("-", F.least(kind, brand), F.greatest(kind, brand)).alias("type")))
    return sinks.statistics_lines(rows.groupBy("section", "type").agg(F.count(F.lit(1)).alias("n")))


@query("""SELECT p_brand, p_size, min(length(p_name)) AS length FROM part GROUP BY 1, 2 HAVING min(length(p_name)) = max(length(p_name))""")
def equal_length(t: Tables):
    good, _ = text.equal_length(t.part, ["p_brand", "p_size"], F.length("p_name"))
    return good.withColumn("length", F.col("length").cast("long"))


@query("""SELECT l_orderkey, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1""")
def single_value(t: Tables):
    return normalize.single_value(t.lineitem, ["l_orderkey"], "l_returnflag")[0]
