"""Filters, identity, spatial and normalisation operators on the business tables.

Orders stand for entries, line items for chains or residues, parts' brands for
clusters and types for molecule types.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import filters, normalize, sequences, spatial
from helixframe.plans.base import Tables, query
from helixframe.session import materialize, wide

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("""SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
WHERE o_totalprice <= 200000 AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def entry_filter(t: Tables):
    return filters.by_resolution_and_date(t.orders, "o_totalprice", 200000, "o_orderdate", "1996-01-01", "1998-01-01").select("o_orderkey", "o_totalprice", "o_orderdate")


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (
SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag <> 'N')""")
def component_drop(t: Tables):
    left = filters.drop_components(t.lineitem, "l_returnflag", ["N"])
    return filters.non_empty(t.orders, left, "o_orderkey", "l_orderkey").select("o_orderkey", "o_custkey")


@query("""SELECT o_orderkey FROM orders WHERE
(SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) <= 4 AND
(SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag IN ('A', 'R')) <= 2""")
def count_caps(t: Tables):
    few = filters.cap_members(t.orders, t.lineitem, "o_orderkey", 4, "l_orderkey")
    return filters.cap_members(few, t.lineitem, "o_orderkey", 2, "l_orderkey", F.col("l_returnflag").isin("A", "R")).select("o_orderkey")


@query("""SELECT o_orderkey FROM orders WHERE NOT EXISTS (
SELECT 1 FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey = o_orderkey
AND p_brand NOT IN (SELECT p_brand FROM part WHERE p_size <= 50 AND p_brand <> 'Brand#7' AND p_brand <> 'Brand#13'))""")
def universal_filter(t: Tables):
    brands = t.part.where("p_size <= 50 and p_brand <> 'Brand#7' and p_brand <> 'Brand#13'")
    members = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand")
    return filters.all_members_in(t.orders, members, "o_orderkey", "p_brand", brands, "p_brand", "l_orderkey").select("o_orderkey")


@query("""SELECT conv_id, turn, role FROM conversations
WHERE conv_id % 3 = 0 OR turn > conv_id % 3""")
def prefix_trim(t: Tables):
    cuts = t.conversations.where("conv_id % 3 <> 0").select(F.col("conv_id").alias("k"), (F.col("conv_id") % 3).alias("last")).distinct()
    return filters.trim_prefix(t.conversations, "conv_id", "turn", cuts, "k", "last").select("conv_id", "turn", "role")


BRAND_PAIRS_SQL = """SELECT DISTINCT least(a.p_brand, b.p_brand) AS c1, greatest(a.p_brand, b.p_brand) AS c2
FROM (SELECT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey) a
JOIN (SELECT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey) b
ON a.l_orderkey = b.l_orderkey AND a.p_brand < b.p_brand"""


def brand_pairs(t: Tables):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand")
    other = rows.select("l_orderkey", F.col("p_brand").alias("other"))
    return rows.join(other, "l_orderkey").where("p_brand < other").select(F.col("p_brand").alias("c1"), F.col("other").alias("c2")).distinct()


@query(f"""SELECT c1, c2 FROM ({BRAND_PAIRS_SQL}) WHERE right(c1, 1) IN ('1', '3') OR right(c2, 1) IN ('1', '3')""")
def pair_type_filter(t: Tables):
    return filters.pairs_with_type(brand_pairs(t), "c1", "c2", ["1", "3"], -1)


CODED_SQL = "SELECT *, substr(p_type, 1, 1) AS code FROM lineitem JOIN part ON l_partkey = p_partkey"


def coded_lines(t: Tables):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn("code", F.substring("p_type", 1, 1))


CUTS_SQL = "SELECT s_suppkey AS k, 1 + s_nationkey % 4 AS last FROM supplier WHERE s_acctbal < 2000"


def signals(t: Tables):
    """Annotated prefixes: how many of the first lines from a supplier count as signal."""
    return t.supplier.where("s_acctbal < 2000").select(F.col("s_suppkey").alias("k"), (F.col("s_nationkey") % 4 + 1).alias("last"))


@query(f"""WITH c AS ({CODED_SQL}), cuts AS ({CUTS_SQL}), kept AS (
SELECT o_orderkey FROM orders WHERE o_totalprice <= 300000 AND o_orderdate < TIMESTAMP '1998-06-01'
AND (SELECT count(*) FROM c WHERE l_orderkey = o_orderkey AND code IN ('P', 'Q', 'D', 'R', 'N')) <= 1)
SELECT l_orderkey AS entry, count(*) AS n_chains FROM c JOIN kept ON l_orderkey = o_orderkey
LEFT JOIN cuts ON k = l_suppkey WHERE l_returnflag <> 'N' AND (last IS NULL OR l_linenumber > last) GROUP BY l_orderkey""")
def train_chain(t: Tables):
    entries = t.orders.select(F.col("o_orderkey").alias("entry"), "o_totalprice", "o_orderdate")
    chains = coded_lines(t).select(F.col("l_orderkey").alias("entry"), "l_returnflag", "code", "l_suppkey", "l_linenumber")
    _, kept = filters.train_filter(entries, chains, "entry", "o_totalprice", "o_orderdate", "l_returnflag", "code", 300000, "1998-06-01", 1, ["N"],
                                   signals=(signals(t), "l_suppkey", "k", "l_linenumber", "last"))
    return kept.groupBy("entry").agg(F.count(F.lit(1)).alias("n_chains"))


@query(f"""WITH c AS ({CODED_SQL}), cuts AS ({CUTS_SQL}), kept AS (
SELECT o_orderkey FROM orders WHERE o_totalprice <= 300000 AND o_orderdate >= TIMESTAMP '1998-06-01' AND o_orderdate < TIMESTAMP '2000-06-01'
AND (SELECT count(*) FROM c WHERE l_orderkey = o_orderkey AND code IN ('P', 'Q', 'D', 'R', 'N')) <= 1
AND (SELECT count(*) FROM c WHERE l_orderkey = o_orderkey) <= 5)
SELECT l_orderkey AS entry, count(*) AS n_chains FROM c JOIN kept ON l_orderkey = o_orderkey
LEFT JOIN cuts ON k = l_suppkey WHERE l_returnflag <> 'N' AND (last IS NULL OR l_linenumber > last) GROUP BY l_orderkey""")
def valid_chain(t: Tables):
    entries = t.orders.select(F.col("o_orderkey").alias("entry"), "o_totalprice", "o_orderdate")
    chains = coded_lines(t).select(F.col("l_orderkey").alias("entry"), "l_returnflag", "code", "l_suppkey", "l_linenumber")
    _, kept = filters.valid_filter(entries, chains, chains, "entry", "o_totalprice", "o_orderdate", "l_returnflag", "code", 300000,
                                   "1998-06-01", "2000-06-01", 1, 5, ["N"], signals=(signals(t), "l_suppkey", "k", "l_linenumber", "last"))
    return kept.groupBy("entry").agg(F.count(F.lit(1)).alias("n_chains"))


@query("""WITH d AS (SELECT upper(substr(lang, 1, 1)) AS mol_type, text AS sequence, min(doc_id) AS first FROM documents
WHERE lang IS NOT NULL AND text IS NOT NULL GROUP BY 1, 2),
o AS (SELECT mol_type, sequence, row_number() OVER (ORDER BY f, mol_type, sequence) - 1 AS n FROM (
SELECT upper(substr(lang, 1, 1)) AS mol_type, text AS sequence, min(doc_id) AS f FROM documents WHERE source = 'src1' AND lang IS NOT NULL AND text IS NOT NULL GROUP BY 1, 2)),
new AS (SELECT d.mol_type, d.sequence, row_number() OVER (ORDER BY first, d.mol_type, d.sequence) + (SELECT max(n) FROM o) AS n
FROM d LEFT JOIN o USING (mol_type, sequence) WHERE o.n IS NULL)
SELECT mol_type || lpad(CAST(n AS VARCHAR), 7, '0') AS seq_id, mol_type, length(sequence) AS n_letters FROM (
SELECT d.mol_type, d.sequence, o.n FROM d JOIN o USING (mol_type, sequence) UNION ALL SELECT * FROM new)""")
def seq_id_map(t: Tables):
    docs = t.documents.where("lang is not null and text is not null").select(
        F.upper(F.substring("lang", 1, 1)).alias("mol_type"), F.col("text").alias("sequence"), "doc_id", "source")
    old = sequences.assign_seq_ids(docs.where("source = 'src1'"), None, "mol_type", "sequence", "doc_id")
    ids = sequences.assign_seq_ids(docs, old, "mol_type", "sequence", "doc_id")
    return ids.select("seq_id", "mol_type", F.length("sequence").cast("long").alias("n_letters"))


@query("""SELECT doc_id, '>' || source || '_' || lang || chr(10) || text || chr(10) AS record FROM (
SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS r FROM documents) WHERE r = 1""")
def fasta_records(t: Tables):
    return sequences.fasta_records(t.documents, F.concat("source", F.lit("_"), "lang"), "text", ["source", "lang"], ["doc_id"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p_brand, s_name FROM lineitem
LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def attach_metadata(t: Tables):
    out = sequences.attach_metadata(t.lineitem, t.part, "l_partkey", "p_partkey", ["p_brand"])
    return sequences.attach_metadata(out, t.supplier, "l_suppkey", "s_suppkey", ["s_name"]).select(*LINE, "p_brand", "s_name")


@query("""SELECT o_orderkey, o_totalprice, coalesce(n_lines, 0) AS n_lines, coalesce(n_parts, 0) AS n_parts,
CASE WHEN coalesce(f, false) THEN 'Yes' ELSE 'No' END AS has_return FROM orders LEFT JOIN (
SELECT l_orderkey, count(*) AS n_lines, count(DISTINCT l_partkey) AS n_parts, bool_or(l_returnflag = 'R') AS f FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def entry_metadata(t: Tables):
    return sequences.entry_metadata(t.orders.select("o_orderkey", "o_totalprice"), t.lineitem, "o_orderkey", "l_orderkey",
                                    {"has_return": F.col("l_returnflag") == "R"},
                                    {"n_lines": F.count(F.lit(1)), "n_parts": F.count_distinct("l_partkey")})


@query("""SELECT w AS word, max(doc_id) AS doc_id FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY w""")
def invert_map(t: Tables):
    pairs = t.documents.select("doc_id", F.explode(F.split("text", " ")).alias("word"))
    return sequences.invert_map(pairs, "doc_id", "word", "doc_id")


@query("""SELECT o_custkey, min(o_orderdate) AS earliest FROM orders GROUP BY o_custkey""")
def earliest_by_key(t: Tables):
    return sequences.earliest(t.orders, "o_custkey", "o_orderdate")


@query("""SELECT p_partkey AS seq_id, min(o_orderdate) AS earliest, min(CASE WHEN p_size % 3 = 0 THEN substr(p_name, p_size % 4 + 2) ELSE p_name END) AS sequence
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def template_dates(t: Tables):
    """Parts as sequences, a third of them with an annotated end, in orders as entries with a date."""
    dates = t.orders.select(F.col("o_orderkey").alias("entry_id"), F.col("o_orderdate").alias("date"))
    chains = t.lineitem.select(F.col("l_orderkey").alias("entry_id"), F.col("l_linenumber").alias("chain_id"), F.col("l_partkey").alias("seq_id"))
    seqs = t.part.select(F.col("p_partkey").alias("seq_id"), F.col("p_name").alias("sequence"))
    signals = t.part.where("p_size % 3 = 0").select(F.col("p_partkey").alias("seq_id"), F.lit(0).alias("start0"), (F.col("p_size") % 4).alias("end0"))
    return sequences.template_metadata(dates, chains, seqs, signals)[1]


POINTS_SQL = """SELECT vec_id, vec_id % 5 AS mol, label, CAST(embedding[1] AS DOUBLE) * 10 AS x, CAST(embedding[2] AS DOUBLE) * 10 AS y,
CAST(embedding[3] AS DOUBLE) * 10 AS z FROM embeddings"""


def points(t: Tables):
    e = lambda i: F.element_at("embedding", i).cast("double") * 10
    return t.embeddings.select("vec_id", (F.col("vec_id") % 5).alias("mol"), "label", e(1).alias("x"), e(2).alias("y"), e(3).alias("z"))


NEAR_SQL = """(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) <= 0.6 * 0.6"""


@query(f"""WITH p AS ({POINTS_SQL}) SELECT i, j FROM (SELECT a.vec_id AS i, b.vec_id AS j, row_number() OVER (PARTITION BY a.vec_id ORDER BY b.vec_id) AS r
FROM p a JOIN p b ON a.vec_id <> b.vec_id AND {NEAR_SQL}) WHERE r <= 8""")
def grid_neighbours(t: Tables):
    # a point meets 27 cells
    with wide(t.spark, 27 * t.embeddings.count()):
        return materialize(spatial.neighbours(points(t).withColumn("one", F.lit(1)), 0.6, ["one"], "vec_id", most=8).select("i", "j"), "neighbours")


@query(f"""WITH p AS ({POINTS_SQL}) SELECT a.mol, least(a.label, b.label) AS src, greatest(a.label, b.label) AS dst, count(*) AS n
FROM p a JOIN p b ON a.mol = b.mol AND a.vec_id <> b.vec_id AND a.label <> b.label AND {NEAR_SQL} GROUP BY 1, 2, 3""")
def contact_graph(t: Tables):
    return spatial.contact_graph(points(t), 0.6, ["mol"], "vec_id", "label", most=None)


@query(f"""WITH p AS ({POINTS_SQL}), o AS (SELECT n_nationkey % 5 AS mol, n_name AS oper_id, n_nationkey AS k FROM nation)
SELECT vec_id, p.mol, label, oper_id, round(-y + k, 6) AS x, round(x + 2 * k, 6) AS y, round(z - k, 6) AS z FROM p JOIN o ON p.mol = o.mol""")
def affine_assembly(t: Tables):
    m = {"m11": 0, "m12": -1, "m13": 0, "m21": 1, "m22": 0, "m23": 0, "m31": 0, "m32": 0, "m33": 1}
    k = F.col("n_nationkey")
    raw = t.nation.select((k % 5).cast("long").alias("mol"), F.col("n_name").alias("oper_id"), *(F.lit(str(v)).alias(n) for n, v in m.items()),
                          k.cast("string").alias("v1"), (k * 2).cast("string").alias("v2"), (-k).cast("string").alias("v3"))
    opers = normalize.operator_table(raw, ["mol", "oper_id"])
    moved = spatial.apply_operators(points(t), opers, ["mol"])
    return moved.select("vec_id", "mol", "label", "oper_id", *(F.round(c, 6).alias(c) for c in "xyz"))


@query("""WITH e AS (SELECT o_orderkey, o_custkey % 4 + 1 AS lo, o_custkey % 4 + 1 + o_orderkey % 3 AS hi, o_orderkey % 5 AS one FROM orders WHERE o_orderkey % 11 <> 0)
SELECT o_orderkey, asym_id, oper_id FROM (
SELECT o_orderkey, CAST(unnest(range(lo, hi + 1)) AS VARCHAR) AS oper_id FROM e UNION ALL SELECT o_orderkey, 'P' || one FROM e)
CROSS JOIN (VALUES ('A'), ('B')) v(asym_id)""")
def oper_expression(t: Tables):
    lo, one = F.col("o_custkey") % 4 + 1, (F.col("o_orderkey") % 5).cast("string")
    span = F.concat(F.lit("("), lo.cast("string"), F.lit("-"), (lo + F.col("o_orderkey") % 3).cast("string"), F.lit(")"))
    expr = F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("(X0)"), span)).otherwise(F.concat(span, F.lit(",P"), one))
    gen = t.orders.select("o_orderkey", expr.alias("expr"), F.lit("A,,B").alias("asyms"))
    return normalize.assembly_rows(gen, ["o_orderkey"], "expr", "asyms")


@query("""WITH a AS (SELECT event_id, user_id AS atom, event_type AS model, CASE WHEN CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 3 = 0 THEN '.'
ELSE CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 3 AS VARCHAR) END AS alt FROM events),
s AS (SELECT a.*, t.target FROM a JOIN (SELECT DISTINCT model, alt AS target FROM a) t USING (model) WHERE alt = target OR alt = '.'),
w AS (SELECT *, max(CAST(alt = target AS INT)) OVER (PARTITION BY model, target, atom) AS has FROM s)
SELECT event_id, atom, model, alt, target FROM w WHERE has = 0 OR alt = target""")
def altloc_resolve(t: Tables):
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 3
    atoms = t.events.select("event_id", F.col("user_id").alias("atom"), F.col("event_type").alias("model"), F.when(k == 0, ".").otherwise(k.cast("string")).alias("alt"))
    return normalize.resolve_altlocs(atoms, ["model"], ["atom"], "alt")


@query("""SELECT p_partkey, p_name, coalesce(price, p_retailprice) AS p_retailprice FROM part LEFT JOIN (
SELECT l_partkey, max(l_extendedprice) AS price FROM lineitem WHERE l_quantity >= 40 GROUP BY 1) ON l_partkey = p_partkey""")
def local_over_default(t: Tables):
    local = t.lineitem.where("l_quantity >= 40").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_extendedprice").alias("p_retailprice"))
    return normalize.local_over_default(local, t.part, ["p_partkey"], ["p_retailprice"]).select("p_partkey", "p_name", "p_retailprice")


@query("""WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '?' ELSE CAST(o_custkey AS VARCHAR) || '.5' END AS a,
CASE WHEN o_orderkey % 4 = 0 THEN '1.0e1' ELSE CAST(o_orderkey AS VARCHAR) END AS b FROM orders)
SELECT o_orderkey, greatest(CASE WHEN regexp_matches(a, '^-?[0-9]+(\\.[0-9]+)?$') THEN CAST(a AS DOUBLE) END,
CASE WHEN regexp_matches(b, '^-?[0-9]+(\\.[0-9]+)?$') THEN CAST(b AS DOUBLE) END) AS resolution FROM s""")
def max_valid_float(t: Tables):
    a = F.when(F.col("o_orderstatus") == "P", "?").otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".5")))
    b = F.when(F.col("o_orderkey") % 4 == 0, "1.0e1").otherwise(F.col("o_orderkey").cast("string"))
    return t.orders.select("o_orderkey", normalize.largest_number(a, b).alias("resolution"))


@query("""SELECT l_orderkey, src, dst FROM (SELECT l_orderkey, l_partkey AS src, lead(l_partkey) OVER (
PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS dst FROM lineitem) WHERE dst IS NOT NULL""")
def sequence_bonds(t: Tables):
    return normalize.sequence_bonds(t.lineitem, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "l_partkey")


@query("""SELECT r.category, r.row_ord, r.k AS key, r.name FROM (
SELECT 'nation' AS category, n_nationkey AS row_ord, CAST(n_nationkey AS VARCHAR) AS k, n_name AS name FROM nation
UNION ALL SELECT 'customer', c_custkey, CAST(c_custkey AS VARCHAR), c_name FROM customer) r""")
def category_long(t: Tables):
    def rows(df, category, key, name):
        return df.select(F.lit(category).alias("category"), F.col(key).cast("long").alias("row_ord"),
                         F.inline(F.array(F.struct(F.lit("key").alias("item"), F.col(key).cast("string").alias("value")), F.struct(F.lit("name").alias("item"), F.col(name).alias("value")))))

    long = rows(t.nation, "nation", "n_nationkey", "n_name").unionByName(rows(t.customer, "customer", "c_custkey", "c_name"))
    parts = [normalize.pivot_category(long, c, ["key", "name"], ("category",)) for c in ("nation", "customer")]
    return parts[0].unionByName(parts[1])


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus, o_orderstatus <> 'P' AS o_orderstatus_valid FROM orders""")
def cast_missing(t: Tables):
    return normalize.cast_with_mask(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", "string", ["P"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round(l_discount + l_tax, 6) AS both, true AS whole FROM lineitem""")
def stack_columns(t: Tables):
    out = normalize.stack(t.lineitem, ["l_discount", "l_tax"], "pair")
    return out.select(*LINE, F.round(F.element_at("pair", 1) + F.element_at("pair", 2), 6).alias("both"), F.col("pair_valid").alias("whole"))


@query("""WITH n AS (SELECT n_name, row_number() OVER (ORDER BY n_name) - 1 AS idx FROM nation WHERE n_regionkey <> 2)
SELECT c_custkey, s_suppkey, a.idx AS src, b.idx AS dst FROM customer JOIN supplier ON c_custkey % 100 = s_suppkey
JOIN nation x ON c_nationkey = x.n_nationkey JOIN nation y ON s_nationkey = y.n_nationkey JOIN n a ON a.n_name = x.n_name JOIN n b ON b.n_name = y.n_name""")
def endpoint_lookup(t: Tables):
    atoms = normalize.dense_index(t.nation.where("n_regionkey <> 2").withColumn("mol", F.lit(0)), ["mol"], "n_name", "idx")
    x = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("a"))
    y = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("b"))
    bonds = t.customer.withColumn("s_suppkey", F.col("c_custkey") % 100).join(t.supplier, "s_suppkey").join(x, "c_nationkey").join(y, "s_nationkey").withColumn("mol", F.lit(0))
    good, _ = normalize.resolve_endpoints(bonds, atoms, ["mol"], "a", "b", "n_name", "idx")
    return good.select("c_custkey", "s_suppkey", F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"))


@query("""SELECT l_orderkey, l_linenumber, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS parts, bool_or(l_returnflag = 'R') AS hetero,
min(l_partkey) AS first FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem) GROUP BY 1, 2""")
def heterogeneity(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag").distinct()
    rows = rows.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_partkey").cast("string").alias("comp"), (F.col("l_returnflag") == "R").alias("het"))
    out = normalize.residue_scheme(rows, ["l_orderkey"], "l_linenumber", "comp", "het", "l_partkey")
    return out.select("l_orderkey", "l_linenumber", F.array_join("comp_ids", ",").alias("parts"), F.col("hetero"), F.col("res_ord").alias("first"))


@query("""SELECT p_partkey, k AS seq_num, substr(s, CAST(k AS BIGINT), 1) AS letter FROM (
SELECT p_partkey, replace(p_name, ' ', '') AS s, unnest(range(1, length(replace(p_name, ' ', '')) + 1)) AS k FROM part)""")
def letters(t: Tables):
    out = normalize.entity_letters(t.part.withColumn("code", F.replace("p_name", F.lit(" "), F.lit(""))), ["p_partkey"], "code")
    return out.withColumn("seq_num", F.col("seq_num").cast("long"))


@query("""SELECT l_orderkey, string_agg(l_returnflag, '' ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS sequence FROM lineitem GROUP BY 1""")
def ordered_flags(t: Tables):
    return sequences.ordered_join(t.lineitem, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "l_returnflag", "sequence")


@query("""SELECT o_orderkey AS l_orderkey, CASE o_orderstatus WHEN 'F' THEN s WHEN 'O' THEN '(' || f || ')' END AS sequence FROM orders LEFT JOIN (
SELECT l_orderkey, string_agg(l_returnflag, '' ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS s,
first(p_type ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS f FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1) ON l_orderkey = o_orderkey""")
def chain_strings(t: Tables):
    """Orders as chains: filled ones are polymers, open ones non-polymers, the others branched."""
    kind = F.when(F.col("o_orderstatus") == "F", "polymer").when(F.col("o_orderstatus") == "O", "non-polymer").otherwise("branched")
    chains = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), kind.alias("kind"))
    residues = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn("place", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    return sequences.chain_sequences(chains, residues, ["l_orderkey"], "place", "l_returnflag", "p_type", "kind").select("l_orderkey", "sequence")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p_type FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type <> 'PROMO' AND l_shipdate >= TIMESTAMP '1996-01-01'""")
def unknown_drop(t: Tables):
    rows = t.lineitem.where("l_shipdate >= timestamp '1996-01-01'").join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return normalize.drop_unknown(rows, "p_type", ["PROMO"]).select(*LINE, "p_type")


@query("""SELECT a.p_type AS ta, b.p_type AS tb, count(*) AS n FROM lineitem x JOIN lineitem y ON x.l_orderkey = y.l_orderkey AND x.l_linenumber < y.l_linenumber
JOIN part a ON a.p_partkey = x.l_partkey JOIN part b ON b.p_partkey = y.l_partkey WHERE a.p_type <> 'PROMO' AND b.p_type <> 'PROMO' GROUP BY 1, 2""")
def unknown_pairs(t: Tables):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    x = rows.select("l_orderkey", F.col("l_linenumber").alias("la"), F.col("p_type").alias("ta"))
    y = rows.select("l_orderkey", F.col("l_linenumber").alias("lb"), F.col("p_type").alias("tb"))
    return normalize.drop_unknown_pairs(x.join(y, "l_orderkey").where("la < lb"), "ta", "tb", ("PROMO",)).groupBy("ta", "tb").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS seq_id, p_name AS sequence FROM part WHERE p_partkey % 2 = 0""")
def protein_sequences(t: Tables):
    kind = F.when(F.col("p_partkey") % 2 == 0, "P").otherwise("L")
    seqs = t.part.select(F.concat(kind, F.lpad(F.col("p_partkey").cast("string"), 7, "0")).alias("seq_id"), F.col("p_name").alias("sequence"))
    return filters.filter_protein_sequences(seqs)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem WHERE NOT EXISTS (
SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_nationkey < 20)""")
def subset_check(t: Tables):
    rows = t.lineitem.select(*LINE).withColumn("all", F.lit(0))
    allowed = t.supplier.where("s_nationkey < 20").select(F.lit(0).alias("all"), F.col("s_suppkey").alias("l_suppkey"))
    return normalize.subset_violations(rows, allowed, ["all"], "l_suppkey").select(*LINE)


@query("""WITH o AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS q FROM lineitem GROUP BY 1, 2)
SELECT o_orderkey AS l_orderkey, k AS l_linenumber, q AS quantity FROM orders CROSS JOIN (SELECT unnest(range(1, 8)) AS k) p
LEFT JOIN o ON o.l_orderkey = o_orderkey AND o.l_linenumber = k""")
def full_length(t: Tables):
    seen = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("quantity")).withColumns({"comp_id": F.lit("R"), "atom_id": F.lit("X")})
    scheme = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.explode(F.sequence(F.lit(1), F.lit(7))).alias("l_linenumber"), F.array(F.lit("R")).alias("comp_ids"))
    atoms = t.orders.select(F.lit("R").alias("comp_id"), F.lit("X").alias("atom_id")).distinct()
    out = normalize.full_length(scheme, atoms, seen, ["l_orderkey"], "l_linenumber", values=("quantity",))
    return out.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "quantity")


@query("""SELECT l_orderkey, l_linenumber, p_type FROM (SELECT DISTINCT l_orderkey, l_linenumber, p_type FROM lineitem JOIN part ON p_partkey = l_partkey)
WHERE length(p_type) % 4 = l_orderkey % 4""")
def scheme_violations(t: Tables):
    """Lines whose part type has a length that their order doesn't allow."""
    kinds = t.part.select("p_type").distinct().join(t.lineitem.select((F.col("l_orderkey") % 4).alias("k")).distinct(), F.length("p_type") % 4 != F.col("k"))
    kinds = kinds.groupBy("k").agg(F.collect_set("p_type").alias("comp_ids"))
    scheme = t.lineitem.select("l_orderkey", "l_linenumber").distinct().withColumn("k", F.col("l_orderkey") % 4).join(kinds, "k", "left")
    seen = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "p_type")
    return normalize.outside_scheme(scheme, seen, ["l_orderkey"], "l_linenumber", "p_type")


@query("""SELECT coalesce(o_custkey, c_custkey) AS k, coalesce(n, 0) AS n, c_name FROM (SELECT o_custkey, count(*) AS n FROM orders WHERE o_totalprice > 300000 GROUP BY 1)
FULL JOIN (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 1000) ON o_custkey = c_custkey""")
def merged_categories(t: Tables):
    rich = t.orders.where("o_totalprice > 300000").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return normalize.merge_by_key(rich, t.customer.where("c_acctbal > 1000").select(F.col("c_custkey").alias("k"), "c_name"), ["k"]).withColumn("n", F.coalesce("n", F.lit(0)))


@query("""SELECT o_orderkey, c_name, 'hit' AS state FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal > 0
UNION ALL SELECT o_orderkey, NULL, 'miss' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def strict_lookup(t: Tables):
    table = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    hit, miss = sequences.strict_lookup(t.orders.select("o_orderkey", "o_custkey"), table, ["o_custkey"], ["c_name"])
    return hit.select("o_orderkey", "c_name", F.lit("hit").alias("state")).unionByName(
        miss.select("o_orderkey", F.lit(None).cast("string").alias("c_name"), F.lit("miss").alias("state")))


@query("""WITH s AS (SELECT p_type AS mol_type, p_name AS sequence, min(p_partkey) AS seq_id FROM part GROUP BY 1, 2)
SELECT p_partkey AS header, seq_id, seq_id % 7 AS cluster_id FROM part JOIN s ON p_type = mol_type AND p_name = sequence""")
def header_clusters(t: Tables):
    fasta = t.part.select(F.col("p_partkey").alias("header"), F.col("p_type").alias("mol_type"), F.col("p_name").alias("sequence"))
    seqs = fasta.groupBy("mol_type", "sequence").agg(F.min("header").alias("seq_id"))
    return sequences.header_clusters(fasta, seqs, seqs.select("seq_id", (F.col("seq_id") % 7).alias("cluster_id")))


@query("""WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, date_trunc('month', l_shipdate) AS m FROM lineitem)
SELECT x.l_orderkey AS mol_key, x.l_partkey AS src, y.l_partkey AS dst, 'c' AS conn_type, o_orderstatus AS value_order, count(*) AS n FROM orders
JOIN a x ON x.l_orderkey = o_orderkey AND x.l_linenumber = 1 JOIN a y ON y.l_orderkey = o_orderkey AND y.l_linenumber = 2 AND x.m = y.m
WHERE x.l_suppkey % 3 = 0 AND y.l_suppkey % 3 = 1 GROUP BY ALL""")
def connection_atoms(t: Tables):
    """Connections of the first and the second line of an order in one month; parts are residues, suppliers' remainders atom names."""
    atoms = t.lineitem.select(
        F.col("l_orderkey").alias("mol_key"), F.col("l_orderkey").alias("entry_id"), F.date_trunc("month", "l_shipdate").alias("oper_id"), F.col("l_linenumber").alias("asym_id"),
        F.lit("1").alias("auth_idx"), (F.col("l_suppkey") % 3).alias("atom_id"), F.col("l_partkey").alias("res_idx"), F.col("l_suppkey").alias("atom_idx"))
    conns = t.orders.select(F.col("o_orderkey").alias("entry_id"), F.lit(1).alias("asym_a"), F.lit("1").alias("auth_a"), F.lit(0).alias("atom_a"), F.lit(2).alias("asym_b"),
                            F.lit("1").alias("auth_b"), F.lit(1).alias("atom_b"), F.lit("c").alias("conn_type"), F.col("o_orderstatus").alias("value_order"))
    residues, linked = normalize.connection_edges(conns, atoms, ["mol_key"])
    both = linked.join(atoms.select("mol_key", F.col("atom_idx").alias("src"), F.col("res_idx").alias("_a"), F.col("asym_id").alias("_x")), ["mol_key", "src"]).join(
        atoms.select("mol_key", F.col("atom_idx").alias("dst"), F.col("res_idx").alias("_b"), F.col("asym_id").alias("_y")), ["mol_key", "dst"]).where("_x = 1 and _y = 2")
    rows = both.select("mol_key", F.col("_a").alias("src"), F.col("_b").alias("dst"), "conn_type", "value_order")
    return residues.join(rows, ["mol_key", "src", "dst", "conn_type", "value_order"]).groupBy("mol_key", "src", "dst", "conn_type", "value_order").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT a.l_orderkey AS entry, a.l_partkey AS src, b.l_partkey AS dst, date_trunc('month', a.l_shipdate) AS oper
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND date_trunc('month', a.l_shipdate) = date_trunc('month', b.l_shipdate)
WHERE a.l_linenumber = 1 AND b.l_linenumber = 2""")
def conn_mapping(t: Tables):
    chains = t.lineitem.select(F.col("l_orderkey").alias("entry"), F.col("l_linenumber").alias("asym"), F.date_trunc("month", "l_shipdate").alias("oper"), F.col("l_partkey").alias("idx"))
    conns = t.orders.select(F.col("o_orderkey").alias("entry"), F.lit(1).alias("a"), F.lit(2).alias("b"))
    x = chains.select("entry", F.col("asym").alias("a"), "oper", F.col("idx").alias("src"))
    mapped = normalize.map_connections(conns, chains, ["entry"], "a", "b", "asym", "oper", "idx")
    return mapped.join(x, ["entry", "a", "src"]).join(
        chains.select("entry", F.col("asym").alias("b"), F.col("idx").alias("dst"), F.col("oper").alias("o2")), ["entry", "b", "dst"]).where("oper = o2").select("entry", "src", "dst", "oper")


@query("""SELECT p_partkey, CASE substr(upper(p_name), 1, 1) WHEN 'A' THEN 0 WHEN 'R' THEN 1 WHEN 'N' THEN 2 WHEN 'D' THEN 3 WHEN 'C' THEN 4 WHEN 'Q' THEN 5
WHEN 'E' THEN 6 WHEN 'G' THEN 7 WHEN 'H' THEN 8 WHEN 'I' THEN 9 WHEN 'L' THEN 10 WHEN 'K' THEN 11 WHEN 'M' THEN 12 WHEN 'F' THEN 13 WHEN 'P' THEN 14 WHEN 'S' THEN 15
WHEN 'T' THEN 16 WHEN 'W' THEN 17 WHEN 'Y' THEN 18 WHEN 'V' THEN 19 WHEN 'X' THEN 20 WHEN 'B' THEN 3 WHEN 'J' THEN 20 WHEN 'O' THEN 20 WHEN 'U' THEN 4 WHEN 'Z' THEN 6
ELSE -1 END AS idx FROM part""")
def code_lookup(t: Tables):
    from helixframe.functions.codes import lookup, protein_index

    return t.part.select("p_partkey", lookup(protein_index(), F.substring(F.upper("p_name"), 1, 1), -1).alias("idx"))


@query("""SELECT l_orderkey, split_part(k, '_', 1) AS assembly_id, split_part(k, '_', 2) AS model_id, split_part(k, '_', 3) AS alt_id, o_custkey, o_totalprice FROM (
SELECT l_orderkey, l_returnflag || '_' || l_linestatus || '_' || l_linenumber AS k FROM lineitem) JOIN orders ON o_orderkey = l_orderkey""")
def molecule_expand(t: Tables):
    from helixframe.operators.stages import expand_molecules

    rows = t.lineitem.select("l_orderkey", F.concat_ws("_", "l_returnflag", "l_linestatus", "l_linenumber").alias("mol_key"))
    out = expand_molecules(rows, "mol_key", t.orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")
    return out.select("l_orderkey", "assembly_id", "model_id", "alt_id", "o_custkey", "o_totalprice")


@query("""WITH kept AS (SELECT * FROM orders WHERE o_totalprice <= 250000 AND o_orderdate < TIMESTAMP '1999-01-01'),
m AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1)
SELECT o_orderkey AS entry, o_orderstatus, n AS n_members FROM kept JOIN m ON l_orderkey = o_orderkey""")
def stage_rebuild(t: Tables):
    from helixframe.operators.stages import rebuild

    def chain(entries, members):
        entries = filters.by_resolution_and_date(entries, "o_totalprice", 250000, "o_orderdate", end="1999-01-01")
        return entries, filters.drop_components(members, "l_returnflag", ["N"])

    entries, members = rebuild(t.orders.withColumnRenamed("o_orderkey", "entry"), t.lineitem.withColumnRenamed("l_orderkey", "entry"), "entry", chain)
    counted = members.groupBy("entry").agg(F.count(F.lit(1)).alias("n_members"))
    with wide(t.spark, t.lineitem.count()):
        return materialize(entries.join(counted, "entry").select("entry", "o_orderstatus", "n_members"), "rebuilt")


@query("""SELECT l_linestatus || l_returnflag AS error, count(*) AS n, min(l_orderkey) AS sample FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1""")
def error_tally(t: Tables):
    from helixframe.operators.stages import error_tally as tally

    rows = t.lineitem.select(F.col("l_orderkey").alias("key"), F.when(F.col("l_returnflag") != "N", F.concat("l_linestatus", "l_returnflag")).alias("error"))
    return tally(rows)


@query("""SELECT o_orderkey, shard, o_totalprice FROM (
SELECT o_orderkey, 'b' AS shard, o_totalprice FROM orders WHERE o_orderkey >= 500
UNION ALL SELECT o_orderkey, 'a', o_totalprice FROM orders WHERE o_orderkey < 500)
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 7 = 0)""")
def incremental_keys(t: Tables):
    from helixframe.operators.stages import new_keys
    from helixframe.sinks import merge_shards

    a = t.orders.where("o_orderkey < 1000").select("o_orderkey", F.lit("a").alias("shard"), "o_totalprice")
    b = t.orders.where("o_orderkey >= 500").select("o_orderkey", F.lit("b").alias("shard"), "o_totalprice")
    return new_keys(merge_shards([a, b], ["o_orderkey"]), t.orders.where("o_orderkey % 7 = 0"), "o_orderkey")


@query("""SELECT c_custkey, 'P' || lpad(CAST(c_custkey % 50 AS VARCHAR), 7, '0') AS seq_id, true AS found FROM customer WHERE c_custkey % 50 < 40
UNION ALL SELECT c_custkey, NULL, false FROM customer WHERE c_custkey % 50 >= 40""")
def remap_join(t: Tables):
    from helixframe.operators.stages import remap_alignments

    text = lambda k: F.concat(F.lit("SEQUENCENUMBER"), F.lpad(k.cast("string"), 4, "0"))
    rows = t.customer.select("c_custkey", text(F.col("c_custkey") % 50).alias("sequence"))
    seqs = t.customer.where("c_custkey < 40").select(text(F.col("c_custkey")).alias("sequence"), F.concat(F.lit("P"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("seq_id"))
    hit, miss = remap_alignments(rows, seqs)
    return hit.select("c_custkey", "seq_id", F.lit(True).alias("found")).unionByName(miss.select("c_custkey", F.lit(None).cast("string").alias("seq_id"), F.lit(False).alias("found")))
