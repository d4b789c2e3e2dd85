"""Queries without SQL run over whole tables."""

from helixframe.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_every_order_has_a_class(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    parts = spark.read.parquet(f"{FOLDER}/part.parquet").selectExpr("p_partkey as l_partkey", "p_brand")
    brands = {}
    for r in lines.select("l_orderkey", "l_partkey").distinct().join(parts, "l_partkey").collect():
        brands.setdefault(r.l_orderkey, []).append(r.p_brand)
    # every two parts are linked, so graphs are equal if their labels are
    firsts = {}
    for gid in sorted(brands):
        firsts.setdefault(tuple(sorted(brands[gid])), gid)
    got = {r.gid: r.class_id for r in QUERIES["graph_dedup"](spark, FOLDER).collect()}
    assert got == {gid: firsts[tuple(sorted(b))] for gid, b in brands.items()}


def test_every_component_is_split(spark):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for r in spark.read.parquet(f"{FOLDER}/lineitem.parquet").select("l_partkey", "l_suppkey").distinct().collect():
        a, b = top(f"p{r.l_partkey:09d}"), top(f"s{r.l_suppkey:09d}")
        root[max(a, b)] = min(a, b)
    assert {r.component for r in QUERIES["split_components"](spark, FOLDER).collect()} == {top(x) for x in list(root)}
