"""Graph operators and statistics on the business tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import filters, graph, sequences, spatial, stats
from helixframe.operators.components import connected_components
from helixframe.plans.base import Tables, query
from helixframe.plans.entries import BRAND_PAIRS_SQL, POINTS_SQL, brand_pairs, points
from helixframe.session import materialize, wide


@query("""SELECT DISTINCT least(x.n_name, y.n_name) AS c1, greatest(x.n_name, y.n_name) AS c2 FROM lineitem a JOIN lineitem b
ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey JOIN supplier s ON s.s_suppkey = a.l_suppkey JOIN supplier t ON t.s_suppkey = b.l_suppkey
JOIN nation x ON x.n_nationkey = s.s_nationkey JOIN nation y ON y.n_nationkey = t.s_nationkey""")
def interacting_pairs(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_suppkey").distinct()
    contacts = lines.select("l_orderkey", F.col("l_suppkey").alias("src")).join(lines.select("l_orderkey", F.col("l_suppkey").alias("dst")), "l_orderkey").where("src < dst")
    ids = graph.interacting_ids(contacts, lines, "l_orderkey", "l_suppkey", "l_suppkey", "src", "dst")
    members = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    return graph.lift_pairs(ids, members, "s_suppkey", "n_name")


CHARS = "substr('PADRNLBQX', 1 + CAST({} AS INT) % 9, 1)"


@query("""WITH o AS (SELECT unnest(string_split('P,A,D,R,N,L', ',')) AS c, unnest(range(6)) AS i),
keys AS (SELECT a.c || b.c AS category FROM o a JOIN o b ON a.i <= b.i),
e AS (SELECT substr('PADRNLBQX', 1 + CAST(l_partkey % 9 AS INT), 1) AS x, substr('PADRNLBQX', 1 + CAST(l_suppkey % 9 AS INT), 1) AS y FROM lineitem),
m AS (SELECT CASE x WHEN 'B' THEN 'L' WHEN 'Q' THEN 'P' ELSE x END AS x, CASE y WHEN 'B' THEN 'L' WHEN 'Q' THEN 'P' ELSE y END AS y FROM e),
n AS (SELECT CASE WHEN a.i <= b.i THEN x || y ELSE y || x END AS category, count(*) AS n FROM m JOIN o a ON a.c = x JOIN o b ON b.c = y GROUP BY 1)
SELECT category, coalesce(n, 0) AS n FROM keys LEFT JOIN n USING (category)""")
def category_counts(t: Tables):
    char = lambda c: F.substr(F.lit("PADRNLBQX"), (F.col(c) % 9 + 1).cast("int"), F.lit(1))
    return graph.category_counts(t.lineitem.select(char("l_partkey").alias("a"), char("l_suppkey").alias("b")), "a", "b")


EDGES_SQL = """SELECT DISTINCT 'c' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS a, 'o' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS b FROM orders"""


def named(c: str, letter: str):
    return F.concat(F.lit(letter), F.lpad(F.col(c).cast("string"), 9, "0"))


def edges(t: Tables):
    """Customers and their orders: as many components as customers with an order."""
    return t.orders.select(named("o_custkey", "c").alias("a"), named("o_orderkey", "o").alias("b")).distinct()


def part_edges(t: Tables):
    """Parts and their suppliers: few, large components."""
    return t.lineitem.select(named("l_partkey", "p").alias("a"), named("l_suppkey", "s").alias("b")).distinct()


def closure(edge_sql: str, node: str = "node") -> str:
    """SQL for (node, component) of an edge query with columns a, b."""
    return f"""WITH RECURSIVE e AS ({edge_sql}), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(n, m) AS (SELECT a, a FROM u UNION SELECT u.b, r.m FROM r JOIN u ON u.a = r.n),
c AS (SELECT n AS {node}, min(m) AS component FROM r GROUP BY n)"""


@query(closure(EDGES_SQL) + " SELECT node, component FROM c")
def components(t: Tables):
    return connected_components(edges(t), "a", "b")


@query(closure(EDGES_SQL) + """ SELECT component, n_nodes, n_edges FROM (SELECT component, count(*) AS n_nodes FROM c GROUP BY 1)
JOIN (SELECT component, count(*) AS n_edges FROM e JOIN c ON e.a = c.node GROUP BY 1) USING (component)""")
def component_sizes(t: Tables):
    return graph.split_by_components(edges(t), "a", "b")[1]


GRAPH_LABELS_SQL = """SELECT DISTINCT x.l_orderkey AS gid, least(a.p_brand, b.p_brand) AS ka, greatest(a.p_brand, b.p_brand) AS kb
FROM lineitem x JOIN lineitem y ON x.l_orderkey = y.l_orderkey AND x.l_partkey < y.l_partkey JOIN part a ON a.p_partkey = x.l_partkey JOIN part b ON b.p_partkey = y.l_partkey"""
PART_LABELS_SQL = """SELECT DISTINCT x.l_orderkey AS gid, x.l_partkey AS ka, y.l_partkey AS kb
FROM lineitem x JOIN lineitem y ON x.l_orderkey = y.l_orderkey AND x.l_partkey < y.l_partkey"""


def order_graphs(t: Tables, label: str = "p_brand"):
    """Orders as graphs: nodes are parts with a label, every two parts of an order are linked."""
    lines = t.lineitem.select("l_orderkey", "l_partkey").distinct().join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), F.col(label).alias("label")), "l_partkey")
    contacts = lines.select("l_orderkey", F.col("l_partkey").alias("src")).join(lines.select("l_orderkey", F.col("l_partkey").alias("dst")), "l_orderkey").where("src < dst")
    return graph.molecule_graphs(lines, contacts, "l_orderkey", "l_partkey", "label", "src", "dst")


@query(closure(f"SELECT g.gid AS a, l.low AS b FROM ({PART_LABELS_SQL}) g JOIN (SELECT ka, kb, min(gid) AS low FROM ({PART_LABELS_SQL}) GROUP BY 1, 2) l USING (ka, kb)", "gid")
       + " SELECT gid, component AS cluster FROM c")
def edge_cluster(t: Tables):
    """Orders that share a pair of parts."""
    with wide(t.spark, t.lineitem.count()):
        return graph.edge_clusters(materialize(graph.edge_labels(*order_graphs(t, "p_partkey")), "edge-labels"))


@query(f"""WITH l AS ({GRAPH_LABELS_SQL}) SELECT gid, count(*) AS n_labels, bool_or(ka IN ('Brand#1', 'Brand#2') OR kb IN ('Brand#1', 'Brand#2')) AS shares FROM l GROUP BY gid""")
def label_sets(t: Tables):
    with wide(t.spark, t.lineitem.count()):
        labels = materialize(graph.edge_labels(*order_graphs(t)), "edge-labels")
        wanted = t.part.where("p_brand in ('Brand#1', 'Brand#2')").select(F.col("p_brand").alias("label")).distinct()
        ends = labels.select("gid", F.explode(F.array("a", "b")).alias("label"))
        shared = graph.share_a_node(ends, wanted).withColumn("shares", F.lit(True))
        return materialize(labels.groupBy("gid").agg(F.count(F.lit(1)).alias("n_labels")).join(shared, "gid", "left").withColumn("shares", F.coalesce("shares", F.lit(False))), "label-sets")


@query("""WITH n AS (SELECT gid, node, label, row_number() OVER (PARTITION BY gid ORDER BY node, label) - 1 AS place FROM (
SELECT DISTINCT l_orderkey AS gid, l_partkey AS node, p_brand AS label FROM lineitem JOIN part ON p_partkey = l_partkey))
SELECT gid, 'node' AS kind, place AS src, place AS dst, CAST(node AS VARCHAR) AS node, label FROM n
UNION ALL SELECT x.gid, 'edge', x.place, y.place, NULL, NULL FROM n x JOIN n y ON x.gid = y.gid AND x.place < y.place""")
def graph_tables(t: Tables):
    """Orders' graphs, those of one part too: every node with its place, part and brand, every edge with its ends' places."""
    with wide(t.spark, t.lineitem.count()):
        lines = t.lineitem.select("l_orderkey", "l_partkey").distinct().join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
        placed = graph.node_places(lines.select(F.col("l_orderkey").alias("gid"), F.col("l_partkey").alias("node"), F.col("p_brand").alias("label")).distinct())
        contacts = placed.select("gid", F.col("place").alias("src")).join(placed.select("gid", F.col("place").alias("dst")), "gid").where("src < dst")
        _, links = graph.molecule_graphs(placed, contacts, "gid", "place", "label", "src", "dst")
        return materialize(graph.graph_rows(placed, links), "graph-tables")


@query("""WITH g AS (SELECT l_orderkey AS gid, string_agg(p_brand, '|' ORDER BY p_brand) AS labels FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
JOIN part ON p_partkey = l_partkey GROUP BY 1) SELECT gid, min(gid) OVER (PARTITION BY labels) AS class_id FROM g""")
def graph_dedup(t: Tables):
    """Every two parts of an order are linked, so two orders are isomorphic if their labels are equal; only the SQL uses that."""
    with wide(t.spark, t.lineitem.count()):
        return graph.graph_dedup(*order_graphs(t))


@query("""WITH g AS (SELECT l_orderkey AS gid, string_agg(p_brand, '|' ORDER BY p_brand) AS labels FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
JOIN part ON p_partkey = l_partkey GROUP BY 1)
SELECT a.o_orderkey AS gid1, a.o_orderkey + 1 AS gid2, coalesce(x.labels = y.labels, false) AS same FROM orders a LEFT JOIN g x ON x.gid = a.o_orderkey LEFT JOIN g y ON y.gid = a.o_orderkey + 1""")
def isomorphic_neighbours(t: Tables):
    """Whether an order's graph is that of the next one."""
    pairs = t.orders.select(F.col("o_orderkey").alias("gid1"), (F.col("o_orderkey") + 1).alias("gid2"))
    with wide(t.spark, t.lineitem.count()):
        return graph.isomorphic_pairs(pairs, *order_graphs(t)).withColumn("same", F.coalesce("same", F.lit(False)))


@query("""WITH c AS (SELECT DISTINCT l_orderkey AS gid, l_partkey AS p, l_suppkey AS s FROM lineitem),
n AS (SELECT gid, s, count(*) AS n, string_agg(p_type, ',' ORDER BY p_type) AS kinds FROM c JOIN part ON p_partkey = p GROUP BY 1, 2),
shared AS (SELECT gid FROM c GROUP BY gid, p HAVING count(*) > 1),
f AS (SELECT gid, string_agg(kinds, '|' ORDER BY kinds) AS form FROM n WHERE gid NOT IN (SELECT gid FROM shared) GROUP BY gid)
SELECT gid, min(gid) OVER (PARTITION BY form) AS class_id FROM f""")
def supplier_forests(t: Tables):
    """Orders whose parts have one supplier each, as forests of stars; a form is its stars, which only the SQL uses."""
    with wide(t.spark, t.lineitem.count()):
        lines = t.lineitem.select(F.col("l_orderkey").alias("gid"), "l_partkey", "l_suppkey").distinct()
        shared = lines.groupBy("gid", "l_partkey").count().where("count > 1").select("gid").distinct()
        lines = materialize(lines.join(shared, "gid", "left_anti"), "forest-lines")
        part, supplier = F.concat(F.lit("p"), "l_partkey"), F.concat(F.lit("s"), "l_suppkey")
        kinds = lines.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        nodes = kinds.select("gid", part.alias("node"), F.col("p_type").alias("label")).unionByName(kinds.select("gid", supplier.alias("node"), F.lit("SUPPLIER").alias("label"))).distinct()
        return graph.graph_dedup(nodes, lines.select("gid", part.alias("u"), supplier.alias("v")))


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS a, p_partkey + 1 AS b FROM part WHERE p_partkey % 97 <> 96 AND p_partkey + 1 IN (SELECT p_partkey FROM part)),
r(node, component) AS (SELECT a, a FROM e WHERE a NOT IN (SELECT b FROM e) UNION ALL SELECT b, component FROM r JOIN e ON e.a = r.node) SELECT node, component FROM r""")
def long_paths(t: Tables):
    """Components of paths of up to 97 parts: several rounds of both star steps."""
    edges = t.part.select(F.col("p_partkey").alias("src"), (F.col("p_partkey") + 1).alias("dst")).where("src % 97 <> 96")
    edges = edges.join(t.part.select(F.col("p_partkey").alias("dst")), "dst", "left_semi")
    return connected_components(edges)


@query()
def canonical_string(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey").distinct().join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    nodes = lines.select(F.col("l_orderkey").alias("gid"), F.concat(F.lit("p"), "l_partkey").alias("node"), F.col("p_type").alias("label")).unionByName(
        lines.select(F.col("l_orderkey").alias("gid"), F.concat(F.lit("s"), "l_suppkey").alias("node"), F.lit("SUPPLIER").alias("label"))).distinct()
    links = lines.select(F.col("l_orderkey").alias("gid"), F.concat(F.lit("p"), "l_partkey").alias("u"), F.concat(F.lit("s"), "l_suppkey").alias("v")).distinct()
    return graph.canonical_strings(nodes, links)


def _walk_sql(counts: str, kinds: list[str], ratio: float = 0.9, least: int = 100) -> str:
    """SQL of a split: the walk over free components, one a step; ``counts`` defines k with a component and its kinds."""
    each = lambda f, sep=", ": sep.join(map(f, kinds))
    return f"""WITH RECURSIVE {counts},
t AS (SELECT {each(lambda c: f"least(CAST(floor(sum({c}) * (1 - CAST({ratio} AS DOUBLE)) + 1e-9) AS BIGINT), {least}) AS keep_{c}")} FROM k),
m AS (SELECT k.*, {each(lambda c: f"{c} > keep_{c}", " OR ")} AS must FROM k, t),
free AS (SELECT *, row_number() OVER (ORDER BY {each(lambda c: c, " + ")}, component) AS i FROM m WHERE NOT must),
s AS (SELECT {each(lambda c: f"CAST(coalesce(sum({c}) FILTER (NOT must), 0) - any_value(keep_{c}) AS BIGINT) AS room_{c}")} FROM m, t),
w AS (SELECT CAST(0 AS BIGINT) AS i, '' AS component, false AS ok, {each(lambda c: f"room_{c}")} FROM s
UNION ALL SELECT free.i, free.component, {each(lambda c: f"{c} <= room_{c}", " AND ")},
{each(lambda c: "room_{0} - CASE WHEN {1} THEN {0} ELSE 0 END".format(c, each(lambda d: f"{d} <= room_{d}", " AND ")))} FROM w JOIN free ON free.i = w.i + 1)
SELECT component, 'train' AS split FROM m WHERE must UNION ALL SELECT component, CASE WHEN ok THEN 'train' ELSE 'valid' END FROM w WHERE i > 0"""


ORDERS_SQL = """k AS (SELECT 'c' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS component,
count_if(o_orderstatus = 'F') AS f, count_if(o_orderstatus = 'O') AS o, count_if(o_orderstatus = 'P') AS p FROM orders GROUP BY o_custkey)"""
PARTS_SQL = f"""l AS (SELECT DISTINCT l_partkey AS part, l_suppkey AS supp FROM lineitem),
e AS (SELECT DISTINCT x.supp AS a, y.supp AS b FROM l x JOIN l y ON x.part = y.part),
r(n, m) AS (SELECT a, a FROM e UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.n),
g AS (SELECT part, supp, 'p' || lpad(CAST(min(part) OVER (PARTITION BY low) AS VARCHAR), 9, '0') AS component FROM l JOIN (SELECT n, min(m) AS low FROM r GROUP BY n) ON n = supp),
k AS (SELECT component, {", ".join(f"count_if(n_regionkey = {i}) AS r{i}" for i in range(5))} FROM g JOIN supplier ON s_suppkey = supp JOIN nation ON n_nationkey = s_nationkey GROUP BY 1)"""


@query(_walk_sql(PARTS_SQL, [f"r{i}" for i in range(5)]))
def split_components(t: Tables):
    """Components of part and supplier with the supplier's region as category, split for training and validation."""
    labels, _ = graph.split_by_components(part_edges(t), "a", "b")
    kinds = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("s"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("b"), F.concat(F.lit("r"), "n_regionkey").alias("region"))
    rows = part_edges(t).join(labels.withColumnRenamed("node", "a"), "a").join(kinds, "b")
    counts = materialize(rows.groupBy("component").pivot("region", [f"r{i}" for i in range(5)]).count().na.fill(0), "kinds")
    return graph.split_train_valid(counts, [f"r{i}" for i in range(5)])


@query(_walk_sql(ORDERS_SQL, ["f", "o", "p"]))
def split_customers(t: Tables):
    """Components of customers and their orders with the order's status as category, split for training and validation."""
    labels, _ = graph.split_by_components(edges(t), "a", "b")
    kinds = t.orders.select(named("o_orderkey", "o").alias("node"), F.lower("o_orderstatus").alias("kind"))
    counts = materialize(labels.join(kinds, "node").groupBy("component").pivot("kind", ["f", "o", "p"]).count().na.fill(0), "kinds")
    return graph.split_train_valid(counts, ["f", "o", "p"])


BUYER_SQL = "'c' || substr(c_mktsegment, 1, 1) || c_custkey"
BOUGHT_SQL = f"""SELECT {BUYER_SQL} AS cluster_id, l_partkey, l_shipdate, l_orderkey, l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey"""
SPARSE_SQL = f"""SELECT DISTINCT x.cluster_id AS a, y.cluster_id AS b FROM ({BOUGHT_SQL}) x JOIN ({BOUGHT_SQL}) y
ON x.l_partkey = y.l_partkey AND x.l_shipdate = y.l_shipdate AND x.cluster_id < y.cluster_id AND substr(x.cluster_id, 2, 1) <> 'F' AND substr(y.cluster_id, 2, 1) <> 'F'"""
LEAK_SQL = closure(SPARSE_SQL) + f""", m AS (SELECT {BUYER_SQL} AS cluster_id, o_orderdate FROM orders JOIN customer ON c_custkey = o_custkey),
train AS (SELECT DISTINCT cluster_id FROM m WHERE o_orderdate < TIMESTAMP '1995-07-01' AND substr(cluster_id, 2, 1) <> 'F'),
valid AS (SELECT DISTINCT cluster_id FROM m WHERE o_orderdate >= TIMESTAMP '2001-01-01'),
free AS (SELECT cluster_id FROM valid WHERE cluster_id NOT IN (SELECT cluster_id FROM train) AND cluster_id NOT IN (
SELECT node FROM c WHERE component IN (SELECT component FROM c JOIN train ON node = cluster_id)))"""


def sparse_interactions(t: Tables):
    """Customers to whom the same part was shipped on the same day."""
    rows = bought(t)
    x = rows.select("l_partkey", "l_shipdate", F.col("cluster_id").alias("c1"))
    y = rows.select("l_partkey", "l_shipdate", F.col("cluster_id").alias("c2"))
    return x.join(y, ["l_partkey", "l_shipdate"]).where("c1 < c2").select("c1", "c2").distinct()


def buyers(t: Tables):
    """Orders with their customer as a cluster; the second letter is the market segment's."""
    people = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("c"), F.substring("c_mktsegment", 1, 1), F.col("c_custkey").cast("string")).alias("cluster_id"))
    return t.orders.join(people, "o_custkey").select("o_orderkey", "o_orderdate", "cluster_id")


def bought(t: Tables):
    return t.lineitem.join(buyers(t), F.col("l_orderkey") == F.col("o_orderkey"))


def free_clusters(t: Tables):
    rows = buyers(t)
    train, valid = rows.where("o_orderdate < timestamp '1995-07-01'"), rows.where("o_orderdate >= timestamp '2001-01-01'")
    return graph.leakage_free(train, valid, sparse_interactions(t), ["A", "B", "H", "M"])


@query(LEAK_SQL + " SELECT cluster_id FROM free")
def leakage_free(t: Tables):
    return free_clusters(t)


@query(LEAK_SQL + f""" SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND NOT EXISTS (
SELECT 1 FROM customer WHERE c_custkey = o_custkey AND {BUYER_SQL} NOT IN (SELECT cluster_id FROM free))""")
def valid2_chain(t: Tables):
    members = buyers(t).select(F.col("o_orderkey").alias("l_orderkey"), "cluster_id")
    late = filters.by_resolution_and_date(t.orders, "o_totalprice", float("inf"), "o_orderdate", "1999-01-01")
    return filters.all_members_in(late, members, "o_orderkey", "cluster_id", free_clusters(t), "cluster_id", "l_orderkey").select("o_orderkey")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem WHERE least(l_partkey, l_suppkey) || '-' || greatest(l_partkey, l_suppkey) IN (
SELECT least(o_custkey % 100, o_orderkey % 97) || '-' || greatest(o_custkey % 100, o_orderkey % 97) FROM orders)""")
def extract_edges(t: Tables):
    wanted = t.orders.select((F.col("o_custkey") % 100).alias("l_partkey"), (F.col("o_orderkey") % 97).alias("l_suppkey"))
    return graph.extract_edges(t.lineitem, wanted, "l_partkey", "l_suppkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


FLAG_SQL = """WITH ent AS (SELECT o_orderkey FROM orders WHERE o_totalprice <= 200000 AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'),
ch AS (SELECT l_orderkey, p_brand, p_type, l_shipdate FROM lineitem JOIN ent ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey WHERE l_returnflag <> 'N'),
inter AS (SELECT DISTINCT least(x.p_brand, y.p_brand) AS a, greatest(x.p_brand, y.p_brand) AS b FROM ch x JOIN ch y ON x.l_orderkey = y.l_orderkey
AND x.p_brand < y.p_brand AND abs(date_diff('day', x.l_shipdate, y.l_shipdate)) <= 30),
mono AS (SELECT DISTINCT p_brand AS cluster FROM ch),
types AS (SELECT p_brand AS cluster, min(p_type) AS type FROM part GROUP BY 1)"""


def flagship(t: Tables):
    """Entry filter, component drop, contacts by ship date, clusters: chains and their sorted cluster pairs."""
    ent = filters.by_resolution_and_date(t.orders, "o_totalprice", 200000, "o_orderdate", "1996-01-01", "1998-01-01")
    lines = filters.drop_components(t.lineitem, "l_returnflag", ["N"]).join(ent.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    chains = sequences.attach_metadata(lines.select("l_orderkey", "l_partkey", "l_shipdate"), t.part, "l_partkey", "p_partkey", ["p_brand"])
    x = chains.select("l_orderkey", F.col("p_brand").alias("ba"), F.col("l_shipdate").alias("da"))
    y = chains.select("l_orderkey", F.col("p_brand").alias("bb"), F.col("l_shipdate").alias("db"))
    touching = x.join(y, "l_orderkey").where("ba < bb and abs(datediff(db, da)) <= 30")
    return chains, touching.select(F.col("ba").alias("a"), F.col("bb").alias("b"), "l_orderkey").distinct()


@query(FLAG_SQL + """ SELECT 'monomer' AS section, type, count(*) AS n FROM mono JOIN types USING (cluster) GROUP BY 2
UNION ALL SELECT 'interface', least(x.type, y.type) || '-' || greatest(x.type, y.type), count(*) FROM inter JOIN types x ON x.cluster = a JOIN types y ON y.cluster = b GROUP BY 2""")
def interface_stats(t: Tables):
    chains, touching = flagship(t)
    types = t.part.groupBy(F.col("p_brand").alias("cluster")).agg(F.min("p_type").alias("type"))
    return stats.type_statistics(chains.select(F.col("p_brand").alias("cluster")).distinct(), touching.select("a", "b").distinct(), types)


@query(FLAG_SQL + """ SELECT a, b FROM inter""")
def interface_pairs(t: Tables):
    return flagship(t)[1].select("a", "b").distinct()


@query(f"""WITH r AS (SELECT DISTINCT l_partkey, l_shipdate, cluster_id AS cluster, 'o' || l_orderkey || '_1_1_.(' || l_linenumber || ')' AS ref FROM ({BOUGHT_SQL})),
p AS (SELECT CASE WHEN x.cluster < y.cluster THEN x.cluster ELSE y.cluster END AS a, CASE WHEN x.cluster < y.cluster THEN y.cluster ELSE x.cluster END AS b, x.ref AS ra, y.ref AS rb,
x.cluster > y.cluster AS flip FROM r x JOIN r y ON x.l_partkey = y.l_partkey AND x.l_shipdate = y.l_shipdate AND x.ref < y.ref AND x.cluster <> y.cluster),
i AS (SELECT a, b, string_agg(v, ',' ORDER BY v) AS refs FROM (SELECT DISTINCT a, b, CASE WHEN flip THEN rb || ':' || ra ELSE ra || ':' || rb END AS v FROM p) GROUP BY 1, 2),
n AS (SELECT cluster, string_agg(ref, ',' ORDER BY ref) AS refs FROM (SELECT DISTINCT cluster, ref FROM r) GROUP BY 1)
SELECT a AS c1, b AS c2, refs AS chains FROM i UNION ALL SELECT cluster, 'None', refs FROM n WHERE cluster NOT IN (SELECT a FROM i UNION SELECT b FROM i)""")
def edge_node(t: Tables):
    from helixframe.sinks import edge_node_lines

    rows = bought(t).select(
        "l_partkey", "l_shipdate", F.col("cluster_id").alias("cluster"),
        F.concat(F.lit("o"), "l_orderkey", F.lit("_1_1_.("), "l_linenumber", F.lit(")")).alias("ref"))
    x = rows.select("l_partkey", "l_shipdate", F.col("cluster").alias("a"), F.col("ref").alias("ra"))
    y = rows.select("l_partkey", "l_shipdate", F.col("cluster").alias("b"), F.col("ref").alias("rb"))
    faces = stats.interface_map(x.join(y, ["l_partkey", "l_shipdate"]).where("ra < rb and a <> b"), "a", "b", "ra", "rb")
    return edge_node_lines(stats.isolated_nodes(stats.node_map(rows, "cluster", "ref"), faces), faces)


@query(f"""WITH p AS ({POINTS_SQL}), k AS (SELECT vec_id, label, x, y, z, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS serial FROM p WHERE label IS NOT NULL AND vec_id % 7 <> 0)
SELECT label, serial, printf('%.3f %.3f %.3f', x, y, z) AS xyz FROM k""")
def atom_lines(t: Tables):
    from helixframe.sinks import atom_lines as lines

    rows = points(t).withColumn("x", F.when(F.col("vec_id") % 7 != 0, F.col("x")))
    out = lines(rows, ["label"], "vec_id", {c: F.format_string("%.3f", F.col(c)) for c in "xyz"})
    return out.select("label", F.col("serial").cast("long").alias("serial"), F.regexp_replace(F.rtrim("line"), r"^ATOM\s+\d+\s+(\S+)\s+(\S+)\s+(\S+)$", "$1 $2 $3").alias("xyz"))
