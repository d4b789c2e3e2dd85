"""Operators whose plans must hold at many times the tests' size: what they shuffle, read and keep in one row."""

import itertools
import random
import time
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.operators import cluster, graph, msa, seqcluster, spatial, stats, structure
from helixframe.operators.components import connected_components
from helixframe.plans.registry import QUERIES
from helixframe.sinks import store_lookup, write_store
from helixframe.streaming.ingest import ingest_keyed


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("dense", [40, 10_000])
def test_a_crowded_cell_is_brute_force(spark, dense):
    rng = np.random.default_rng(3)
    near, far = rng.uniform(0, 5, (1500, 3)), rng.uniform(-20, 20, (300, 3))
    points = np.concatenate([near, far, np.array([[0.0, 0.0, 0.0], [5.0, 0.0, 0.0], [0.0, 5.0, 0.0], [-5.0, 0.0, 0.0]])])
    frame = spark.createDataFrame([("a", i, *map(float, p)) for i, p in enumerate(points)] + [("b", 0, 0.0, 0.0, None)], "g string, i int, x double, y double, z double")
    d = ((points[:, None] - points[None]) ** 2).sum(2)
    want = {(i, j) for i, j in zip(*np.nonzero(d <= 1.0)) if i != j}
    got = spatial.neighbours(frame, 1.0, ["g"], "i", dense=dense)
    assert {(r.i, r.j) for r in got.collect()} == want and got.count() == len(want)
    wide = {(i, j) for i, j in zip(*np.nonzero(d <= 25.0)) if i != j}
    assert spatial.neighbours(frame, 5.0, ["g"], "i", dense=dense).count() == len(wide)


def test_a_crowded_cell_spreads(spark):
    """All points in one cell: none of the join's keys has more than a few times the bound."""
    frame = spark.range(20_000).select(F.lit(1).alias("g"), F.col("id").alias("i"), *(F.rand(k).alias(c) for k, c in enumerate("xyz")))
    pairs = spatial.neighbours(frame, 1.0, ["g"], "i", dense=500)
    text = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "_p0" in text and "_p2" in text
    sub = F.struct(*(F.floor(F.col(c) * 4) for c in "xyz"))
    assert frame.groupBy(sub).count().agg(F.max("count")).first()[0] < 1000


def test_copies_of_a_capsid(spark):
    """Sixty copies of two chains: indices run through, and windows hold a chain or a row a copy."""
    full = spark.createDataFrame([("e", a, "1", ".", r, k, float(r), float(k), 0.0) for a, n in (("A", 30), ("B", 11)) for r in range(n) for k in range(3)],
                                 "entry_id string, asym_id string, model_id string, target string, res_ord int, atom_ord int, x double, y double, z double")
    rows = spark.createDataFrame([("e", "1", a, str(o)) for a in "AB" for o in range(60)], "entry_id string, assembly_id string, asym_id string, oper_id string")
    opers = spark.createDataFrame([("e", str(o), *[1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0], float(o), 0.0, 0.0) for o in range(60)],
                                  "entry_id string, oper_id string, " + ", ".join(f"m{r}{c} double" for r in (1, 2, 3) for c in (1, 2, 3)) + ", v1 double, v2 double, v3 double")
    have = spark.createDataFrame([("e", "1", "1", ".")], "entry_id string, assembly_id string, model_id string, target string")
    out = structure.indexed_copies(full, rows, have, opers)
    got = sorted((r.chain_id, r.res_ord, r.atom_ord, r.chain_idx, r.res_idx, r.atom_idx) for r in out.collect())
    assert [g[5] for g in got] == list(range(60 * 41 * 3))
    assert [g[4] for g in got] == [i // 3 for i in range(60 * 41 * 3)]
    assert [g[3] for g in got] == [c for c in range(120) for _ in range((30 if c < 60 else 11) * 3)]
    windows = [line for line in plan(out).split("\n") if " Window [" in line and "mol_key" in line]
    assert windows and all("atom_ord" not in line for line in windows)
    joins = [line for line in plan(out).split("\n") if "Join" in line]
    assert "asym_id" in joins[0] and any("oper_id" in line for line in joins[1:])  # atoms come last, when copies have their operators


def test_profiles_from_matrices(spark):
    rng = random.Random(5)
    rows = [(f"m{i % 3}", "".join(rng.choice("ARNDX-BZabü") for _ in range(rng.randint(0, 12)))) for i in range(300)] + [("m0", None), (None, "AR"), ("m9", "")]
    frame = spark.createDataFrame(rows, "msa string, row string").repartition(4)
    cells = msa.positions(frame, "msa", "row")
    want = {(r.msa, r.pos, r.idx): round(r.frequency, 9) for r in msa.profile_counts(cells).collect()}
    means = {(r.msa, r.pos): round(r.deletion_mean, 9) for r in msa.deletion_mean(cells).collect()}
    matrices = msa.profile_matrices(frame, "msa", "row")
    got = msa.profile_rows(matrices).collect()
    depth = Counter(r.msa for r in got if r.pos == 0)
    assert depth and {(r.msa, r.pos, r.idx): round(r.frequency, 9) for r in got if r.msa} == {k: v for k, v in want.items() if k[0]}
    assert {(r.msa, r.pos): round(r.deletion_mean, 9) for r in got if r.msa} == {k: v for k, v in means.items() if k[0]}
    assert {(r.pos, r.idx) for r in got if r.msa is None} == {(0, 0), (1, 1)}


def test_profile_shuffles_positions_not_letters(spark):
    frame = spark.range(20_000).select((F.col("id") % 2).alias("msa"), F.lit("ARNDARNDAR").alias("row")).repartition(4)
    text = plan(msa.profile_matrices(frame, "msa", "row"))
    assert "MapInArrow" in text and "Generate" not in text
    parts = frame.mapInArrow(lambda b: b, "msa long, row string").rdd.getNumPartitions()
    made = msa.profile_matrices(frame, "msa", "row")
    assert made.agg(F.sum("depth")).first()[0] == 200_000 and made.count() == 20 and parts == 4


def test_store_lookup_without_a_shuffle_of_the_store(spark, tmp_path):
    rows = spark.range(50_000).selectExpr("id * 7 % 50000 AS k", "id AS v")
    write_store(rows, "stored_test", "k", 4, str(tmp_path / "store"))
    try:
        few = store_lookup(spark, "stored_test", "k", spark.createDataFrame([(3,), (3,), (None,), (70_000,)], "w long"), "w")
        assert [r.k for r in few.collect()] == [3]
        assert "PushedFilters" in plan(few) and "Exchange" not in plan(few)
        many = store_lookup(spark, "stored_test", "k", spark.range(0, 50_000, 25).selectExpr("id AS w"), "w", listed=100)
        assert many.count() == 2000
        text = many._jdf.queryExecution().optimizedPlan().toString()
        physical = plan(many)
        store = physical[: physical.index("Scan parquet spark_catalog.default.stored_test")].rsplit("SortMergeJoin", 1)[1]
        assert "stored_test" in text and "Exchange" not in store and "Bucketed: true" in physical
    finally:
        spark.sql("DROP TABLE stored_test")


def test_keyed_ingest_survives_a_broken_batch(spark, tmp_path):
    folder, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    schema = "k string, v int"

    def add(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)

    def run(parse=lambda d: d):
        return ingest_keyed(spark, folder, schema, table, checkpoint, "k", parse)

    def stored():
        return sorted(r.k for r in spark.read.parquet(table).collect())

    add([("a", 1), ("b", 2), ("b", 3), (None, 4)])
    run()
    assert stored() == ["a", "b"]
    add([("b", 5), ("c", 6)])
    broken = lambda d: d.withColumn("v", F.when(F.col("k") == "c", F.raise_error(F.lit("stopped")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="stopped"):
        run(broken)
    assert stored() == ["a", "b"]
    run()
    assert stored() == ["a", "b", "c"]
    run()
    assert stored() == ["a", "b", "c"]


def test_pieces_of_long_lists(spark):
    rows = spark.range(20_000).selectExpr("'big' AS c", "concat('ref', id) AS r").unionByName(spark.createDataFrame([("one", "x"), ("one", "x"), ("none", None), (None, "y")], "c string, r string"))
    got = stats.node_pieces(rows, "c", "r", 1000).collect()
    assert max(len(r.refs) for r in got) <= 1010
    big = sorted((r.piece, r.refs) for r in got if r.cluster == "big")
    assert [p for p, _ in big] == list(range(len(big)))
    assert ",".join(r for _, r in big) == ",".join(sorted(f"ref{i}" for i in range(20_000)))
    assert [(r.piece, r.refs) for r in got if r.cluster == "one"] == [(0, "x")]
    pairs = spark.createDataFrame([("b", "a", "1", "2"), ("a", "b", "2", "1")], "a string, b string, ra string, rb string")
    assert [tuple(r) for r in stats.interface_pieces(pairs, "a", "b", "ra", "rb").collect()] == [("a", "b", 0, "2:1")]


def test_batched_alignment_is_the_single_one():
    rng = random.Random(9)
    pairs = [tuple("".join(rng.choice("AB-é") for _ in range(rng.randint(0, 9))) for _ in "xy") for _ in range(400)] + [("", ""), ("", "AB"), ("AB", ""), ("A" * 700, "A" * 650)]
    xs, ys = map(list, zip(*pairs))
    assert cluster.align_many(xs, ys) == [cluster.align(x, y) for x, y in pairs]
    assert cluster.align_many([], []) == []


def test_graph_classes_with_every_kind_of_tie(spark):
    """Paths, stars, cycles, two triangles against a hexagon, twins, loops, isolated nodes; each under several numberings."""
    rng = random.Random(4)
    ring = lambda n, at=0: [(at + i, at + (i + 1) % n) for i in range(n)]
    shapes = [(6, ring(6)), (6, ring(3) + ring(3, 3)), (5, [(0, i) for i in range(1, 5)]), (5, [(i, i + 1) for i in range(4)]), (4, []), (3, [(0, 0), (0, 1)]), (3, [(0, 1)]),
              (6, [(a, b) for a in range(3) for b in range(3, 6)]), (4, [(a, b) for a in range(4) for b in range(a)]), (8, ring(8) + [(0, 4), (2, 6)]), (8, ring(8) + [(0, 4), (1, 5)])]
    shapes += [(n, [(a, b) for a in range(n) for b in range(a) if rng.random() < 0.4]) for n in (5, 6, 7, 7)]
    nodes, links, want, kept = [], [], {}, {}
    for n, pairs in shapes:
        for labels in (["x"] * n, ["xy"[i % 2] for i in range(n)]):
            for _ in range(3):
                gid, order = len(want), rng.sample(range(100, 100 + n), n)
                nodes += [(gid, order[i], labels[i]) for i in range(n)]
                links += [(gid, *((order[a], order[b]) if rng.random() < 0.5 else (order[b], order[a]))) for a, b in pairs] + [(gid, order[0], 999)]
                mine = (dict(enumerate(labels)), set(pairs))
                want[gid] = next((c for c, g in kept.items() if graph.isomorphic(mine, g)), gid)
                kept.setdefault(want[gid], mine)
    got = graph.graph_dedup(spark.createDataFrame(nodes, "gid int, node int, label string"), spark.createDataFrame(links, "gid int, u int, v int"))
    assert {r.gid: r.class_id for r in got.collect()} == want


def test_redundancy_of_a_deep_alignment_in_few_rounds(spark, monkeypatch):
    """Fifty blocks: windows, not blocks, are walked one after another; chains and copies included."""
    rng = random.Random(8)
    base = ["".join(rng.choice("ARNDCQEG") for _ in range(30)) for _ in range(300)]

    def near(text, n):
        cells = list(text)
        for i in rng.sample(range(30), n):
            cells[i] = rng.choice("ARNDCQEG-")
        return "".join(cells)

    texts = [near(rng.choice(base), rng.randint(0, 5)) for _ in range(1200)]
    drift = [base[0]]
    for i in range(199):  # each like its neighbours alone
        cells = list(drift[-1])
        for j in (2 * i % 30, (2 * i + 1) % 30):
            cells[j] = rng.choice([c for c in "ARNDCQEG" if c != cells[j]])
        drift.append("".join(cells))
    texts += drift + [texts[0]] * 200
    kept = []
    for i, text in enumerate(texts):
        pairs = ([(x, y) for x, y in zip(text, texts[k]) if "-" not in (x, y)] for k in kept)
        if all(sum(x == y for x, y in p) <= 0.9 * max(len(p), 1) for p in pairs):
            kept.append(i)
    made = []
    real = msa.materialize
    monkeypatch.setattr(msa, "materialize", lambda df, *a, **k: made.append(a) or real(df, *a, **k))
    frame = spark.createDataFrame([("m", i, t) for i, t in enumerate(texts)], "msa string, ord int, row string")
    got = sorted(r.ord for r in msa.drop_redundant(frame, "msa", "row", "ord", 0.5, 0.9, 32).collect())
    assert got == kept
    assert len(texts) / 32 == 50 and len(made) < 40


def test_long_pairs_are_laid_out_in_parts():
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("ACDEFGHIKL") for _ in range(n))
    xs = [word(rng.randint(1, 40)) for _ in range(250)] + [word(60000)]  # 115 MB in one piece
    ys = [x[2:] + "A" for x in xs[:-1]] + [xs[-1]]
    diagonals = [rng.choice([0, 2, -3, 30, -30]) for _ in xs[:-1]] + [0]
    tracemalloc.start()
    n, columns = seqcluster.banded_counts(xs, ys, diagonals)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (n[-1], columns[-1]) == (60000, 60000)
    alone = [seqcluster.banded_counts([x], [y], [d]) for x, y, d in zip(xs, ys, diagonals)]
    assert [int(a[0][0]) for a in alone] == n.tolist() and [int(a[1][0]) for a in alone] == columns.tolist()
    assert peak < 100 << 20


def test_minimisers_of_many_short_texts():
    rng = random.Random(5)
    texts = ["".join(rng.choice("ABC") for _ in range(rng.choice([0, 3, 5, 6, 9, 40]))) for _ in range(300)]
    for k, window in ((6, 1), (3, 4), (5, 30)):
        want = set()
        for i, text in enumerate(texts):
            codes = seqcluster.kmer_codes(text, k).tolist()
            ranked = [(c % seqcluster.PRIME * seqcluster.FACTOR % seqcluster.PRIME, c, p) for p, c in enumerate(codes)]
            picked = {min(ranked[p : p + window]) for p in range(max(1, len(codes) - window + 1)) if codes}
            want |= {(i, c, min(p for _, d, p in picked if d == c)) for _, c, _ in picked}
        assert sorted(want) == list(zip(*(x.tolist() for x in seqcluster.minimisers_of(texts, k, window))))


def test_common_runs_leave_their_batch_once(spark):
    rng = random.Random(8)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(12)]
    data = [(f"k{rng.randrange(200):03d}", rng.choice([" ", "\n", "  \n"]).join(rng.sample(pool, rng.randint(1, 4))) + rng.choice(["", " ", " \u00e9\u4e2d"])) for _ in range(300)]
    data += [("k900", "a b"), ("k901", " \n "), ("k902", None), (None, pool[0]), ("k000", "a a a a a a")]
    runs: dict = {}
    for i, text in data:
        tokens = [w for w in (text or "").replace("\n", " ").split(" ") if w]
        for p in range(len(tokens) - 3 if i is not None else 0):
            runs.setdefault(tuple(tokens[p : p + 4]), set()).add(i)
    want = dict(Counter((i, min(ids)) for ids in runs.values() for i in ids if i > min(ids)))
    docs = spark.createDataFrame(data, "id string, text string").repartition(5)
    for common in (2, 5, 256):
        got = cluster.shingle_links(docs, "id", "text", 4, salts=3, common=common).collect()
        assert len(got) == len(want) and {(r.id, r.first): r.n for r in got} == want


def test_links_to_first_texts_span_all_pairs(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(40)]
    pool = [" ".join(rng.choice(words) for _ in range(4)) for _ in range(60)]
    data = [(i, " ".join(rng.sample(pool, rng.randint(1, 3)))) for i in range(250)] + [(250, None), (251, ""), (252, "w1 w2"), (None, pool[0] * 2), (3, pool[1])]
    docs = spark.createDataFrame(data, "id int, text string")
    links = cluster.shingle_links(docs, "id", "text", 4, salts=4)
    runs: dict = {}
    for i, text in data:
        tokens = (text or "").split()
        for p in range(len(tokens) - 3 if i is not None else 0):
            runs.setdefault(tuple(tokens[p : p + 4]), set()).add(i)
    want = Counter((i, min(ids)) for ids in runs.values() for i in ids if i > min(ids))
    assert {(r.id, r.first): r.n for r in links.collect()} == dict(want)
    single = docs.where("id < 250").dropDuplicates(["id"])
    whole = lambda frame, a, b: {(r.node, r.component) for r in connected_components(frame, a, b).collect()}
    assert whole(cluster.shingle_links(single, "id", "text", 4), "id", "first") == whole(cluster.shared_shingles(single, "id", "text", 4), "id1", "id2")
    common = spark.range(400).select("id", F.concat(F.lit("a b c d "), F.col("id").cast("string")).alias("text"))
    assert cluster.shingle_links(common, "id", "text", 4).count() == 399
    assert cluster.shingle_links(docs.limit(0), "id", "text").count() == 0


def test_large_part_keys_keep_their_clusters(spark, tmp_path):
    """A key beyond a million is still a line of its own size's cluster."""
    rows = [(1, "Brand#1", 2), (2, "Brand#1", 1), (1_000_001, "Brand#1", 1), (2_000_007, "Brand#1", 1), (1_500_000, "Brand#1", 2), (1_000_002, "Brand#2", 1), (3, "Brand#2", 2)]
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    got = {(r.p_brand, r.representative, r.member) for r in QUERIES["clstr_parse"](spark, str(tmp_path)).collect()}
    first = {g: min(k for k, *h in rows if tuple(h) == g) for g in {(b, s) for _, b, s in rows}}
    assert got == {(b, f"A{first[b, s]:07d}", f"P{k:07d}") for k, b, s in rows}


def test_rows_of_letters_are_not_broadcast(spark, tmp_path):
    """Exploded rows of a small file."""
    rows = [(i, "ab cd ef"[: 2 + i % 6], f"Brand#{i % 3}", "STANDARD", i % 4) for i in range(50)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    for name, most in [("msa_tables", 0), ("align_project", 2)]:  # the sizes' first names, in both uses of the pairs
        assert str(QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().sparkPlan()).count("BroadcastHashJoin") == most, name


def test_forests_and_twins_need_no_canonical_string(spark, monkeypatch):
    """Equal stars on different hubs, paths, matchings beside a hub, crowns of two labels: told apart in columns; rings are not."""
    rng = random.Random(6)
    ring = lambda n, at=0: [(at + i, at + (i + 1) % n) for i in range(n)]
    stars = lambda *sizes: [(h, len(sizes) + sum(sizes[:h]) + i) for h, n in enumerate(sizes) for i in range(n)]
    crown = [(2 * a, 2 * b + 1) for a in range(4) for b in range(4) if a != b]
    shapes = [(6, stars(2, 2)), (6, stars(1, 3)), (8, stars(1, 1, 1, 1)), (9, stars(1, 1, 1, 1) + [(8, i) for i in range(8)]), (7, ring(7)[:6]), (8, ring(4)[:3] + ring(4, 4)[:3]), (8, crown)]
    shapes += [(n, [(rng.randrange(i), i) for i in range(1, n) if rng.random() < 0.85]) for n in (5, 6, 7)]
    hard = [(6, ring(6)), (6, ring(3) + ring(3, 3))]
    nodes, links, want, kept, ringed = [], [], {}, {}, set()
    for n, pairs in shapes + hard:
        for labels in (["x"] * n, ["xy"[i % 2] for i in range(n)]):
            for _ in range(3):
                gid, order = len(want), rng.sample(range(100, 100 + n), n)
                nodes += [(gid, order[i], labels[i]) for i in range(n)]
                links += [(gid, order[a], order[b]) for a, b in pairs]
                mine = (dict(enumerate(labels)), set(pairs))
                want[gid] = next((c for c, g in kept.items() if graph.isomorphic(mine, g)), gid)
                kept.setdefault(want[gid], mine)
                if (n, pairs) in hard or pairs == crown and len(set(labels)) == 1:
                    ringed.add(gid)
    plain, asked = graph.canonical_strings, []
    monkeypatch.setattr(graph, "canonical_strings", lambda a, b: asked.extend(r.gid for r in a.select("gid").distinct().collect()) or plain(a, b))
    got = graph.graph_dedup(spark.createDataFrame(nodes, "gid int, node int, label string"), spark.createDataFrame(links, "gid int, u int, v int"))
    assert {r.gid: r.class_id for r in got.collect()} == want
    assert asked and set(asked) <= ringed


def test_graph_tables_have_nodes_labels_and_edges(spark):
    """Every order's graph as a table: its parts with their brands, one-part orders too, and every two of them linked."""
    folder = "/root/testdata/sf0.001"
    rows = [r.asDict() for r in QUERIES["graph_tables"](spark, folder).collect()]
    brand = {r.p_partkey: r.p_brand for r in spark.read.parquet(f"{folder}/part.parquet").collect()}
    want = {}
    for r in spark.read.parquet(f"{folder}/lineitem.parquet").collect():
        if r.l_partkey in brand:
            want.setdefault(r.l_orderkey, set()).add(r.l_partkey)
    got = {gid: {} for gid in want}
    for r in rows:
        if r["kind"] == "node":
            assert r["src"] == r["dst"] not in got[r["gid"]] and r["label"] == brand[int(r["node"])]
            got[r["gid"]][r["src"]] = int(r["node"])
    assert any(len(parts) == 1 for parts in want.values())
    assert got == {gid: dict(enumerate(sorted(parts))) for gid, parts in want.items()}
    edges = [(r["gid"], got[r["gid"]][r["src"]], got[r["gid"]][r["dst"]]) for r in rows if r["kind"] == "edge"]
    assert sorted(edges) == sorted((gid, *pair) for gid, parts in want.items() for pair in itertools.combinations(sorted(parts), 2))


@pytest.mark.parametrize("most, rows", [(2048, 1 << 18), (2048, 7), (5, 7), (0, 1 << 18)])
def test_classes_are_the_same_for_graphs_of_any_size(spark, monkeypatch, most, rows):
    """Graphs that one task settles beside others, in any batches, and those that are refined in columns."""
    monkeypatch.setattr(graph, "SMALL_GRAPH", most)
    monkeypatch.setattr(graph, "GRAPH_ROWS", rows)
    rng, nodes, links, want, kept = random.Random(8), [], [], {}, {}
    for gid in [f"g{i:02}" for i in range(40)]:
        n = rng.choice([1, 2, 3, 4, 5, 6, 7])
        labels, pairs = [rng.choice("xy") for _ in range(n)], {(a, b) for b in range(n) for a in range(b) if rng.random() < 0.5}
        order = rng.sample(range(20), n)
        nodes += [(gid, f"n{order[i]}", labels[i]) for i in range(n)]
        # both directions, twice, and one with an end that isn't a node
        links += [(gid, f"n{order[a]}", f"n{order[b]}") for a, b in pairs] + [(gid, f"n{order[b]}", f"n{order[a]}") for a, b in pairs] + [(gid, f"n{order[0]}", "none"), (gid, None, f"n{order[0]}")]
        mine = (dict(enumerate(labels)), pairs)
        want[gid] = next((c for c, g in kept.items() if graph.isomorphic(mine, g)), gid)
        kept.setdefault(want[gid], mine)
    nodes += [("none", None, None), (None, "n1", "x")]
    frame = spark.createDataFrame(nodes, "gid string, node string, label string")
    got = {r.gid: r.class_id for r in graph.graph_dedup(frame, spark.createDataFrame(links, "gid string, u string, v string")).collect()}
    assert len(set(want.values())) < len(want) and got.pop("none") == "none"
    assert got == want


def test_rounds_of_refinement_write_nothing(spark, monkeypatch):
    """Paths that take fifteen rounds: the links are shuffled once and what is written doesn't grow with the rounds."""
    plain, names = graph.materialize, []
    monkeypatch.setattr(graph, "materialize", lambda df, name="t", *a: names.append(name) or plain(df, name, *a))
    nodes = spark.range(4 * 31).selectExpr("id div 31 AS gid", "id AS node", "IF(id div 31 = 3 AND id % 31 = 3, 'y', 'x') AS label")
    links = nodes.where("node % 31 < 30").selectExpr("gid", "node AS u", "node + 1 AS v")
    got = {r.gid: r.class_id for r in graph.graph_dedup(nodes, links).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3}
    assert len(names) <= 3


def test_structure_files_are_there_a_share_at_a_time(spark, monkeypatch):
    """A share's files are read and gone before the next ones are written; the rows are those of all lines."""
    from pathlib import Path

    from helixframe.plans import structures
    from helixframe.session import shared_dir

    here = lambda: {p for p in Path(shared_dir(spark).removeprefix("file:")).glob("structure*") if p.is_dir() and not p.name.startswith("structure-atoms")}
    monkeypatch.setattr(structures, "SHARE", 400)
    plain, sizes, before = structures.mmcif.read_mmcif, [], here()
    monkeypatch.setattr(structures.mmcif, "read_mmcif", lambda spark, files, **k: sizes.append(sum(Path(f.removeprefix("file:")).stat().st_size for f in files)) or plain(spark, files, **k))
    rows = structures.structure_scan(structures.Tables(spark, "/root/testdata/sf0.001"))
    assert len(sizes) == 4 and max(sizes) < sum(sizes) / 3
    assert here() == before
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    of = lambda df, *c: sorted(map(tuple, df.select(*c).collect()))
    assert of(rows, "l_orderkey", F.col("number").cast("int"), "x", "y") == of(lines, "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")


@pytest.mark.parametrize("name", ["graph_tables", "label_sets", "edge_cluster", "stage_rebuild", "grid_neighbours"])
def test_tasks_grow_in_number_not_in_size(spark, monkeypatch, name):
    """With few rows a task, the query's tables are written with more shuffle tasks, and the session's settings come back."""
    from helixframe import session
    from helixframe.plans import entries, graphs
    from helixframe.plans.registry import QUERIES

    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before, seen = [spark.conf.get(n) for n in names], []
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    for module in (entries, graphs):
        monkeypatch.setattr(module, "materialize", lambda df, *a, **k: seen.append(int(spark.conf.get(names[0]))) or session.materialize(df, *a, **k))
    QUERIES[name](spark, "/root/testdata/sf0.001").count()
    assert min(seen) > int(before[0])
    assert [spark.conf.get(n) for n in names] == before


def test_a_shared_passage_makes_its_pairs_once(spark, monkeypatch):
    """Forty texts with a passage of 200 words: a row a text and set of runs meets, and the counts are those of all runs."""
    passage = " ".join(f"p{i}" for i in range(200))
    texts = [(i, f"{passage} own{i} " + (" ".join(f"q{k}" for k in range(20)) if i % 2 else f"x{i}")) for i in range(40)] + [(7, f"{passage} own7b"), (50, None)]
    plain, met = cluster._meet, []
    monkeypatch.setattr(cluster, "_meet", lambda rows, *a: met.append(rows.count()) or plain(rows, *a))
    got = {(r.id1, r.id2): r.n for r in cluster.shared_shingles(spark.createDataFrame(texts, "id int, t string"), "id", "t", 4, hot=10).collect()}
    runs = lambda t: {tuple(t.split()[i : i + 4]) for i in range(len(t.split()) - 3)}
    want = {}
    for (i, s), (j, t) in itertools.combinations([x for x in texts if x[1]], 2):
        n = len(runs(s) & runs(t))
        if n and i != j:
            want[min(i, j), max(i, j)] = want.get((min(i, j), max(i, j)), 0) + n
    assert got == want
    assert met[0] < 200


@pytest.mark.parametrize("kind", ["string", "int"])
def test_runs_are_made_once_and_meet_as_all_pairs(spark, monkeypatch, kind):
    """Digests of runs were made three times, and texts with them; odd texts and keys of any kind are those of brute force."""
    rng, plain, plans = random.Random(6), cluster.materialize, []
    monkeypatch.setattr(cluster, "materialize", lambda df, *a, **k: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df, *a, **k))
    key = (lambda i: f"k{i}") if kind == "string" else (lambda i: i)
    texts = [(key(i), rng.choice([" ", "\n", "  "]).join(rng.choice(["a", "b", "é", "c\td"]) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    texts += [(key(60), None), (None, "a b a b"), (key(61), ""), (key(62), " a  b\na ")]
    pairs = cluster.shared_shingles(spark.createDataFrame(texts, f"id {kind}, t string").repartition(3), "id", "t", 3, hot=4)
    got = {(r.id1, r.id2): r.n for r in pairs.collect()}
    runs = lambda t: {tuple(w[i : i + 3]) for w in [[x for x in t.replace("\n", " ").split(" ") if x]] for i in range(len(w) - 2)}
    sets = {k: runs(t) for k, t in texts if k is not None and t}
    want = {(min(a, b), max(a, b)): len(sets[a] & sets[b]) for a, b in itertools.combinations(sets, 2) if sets[a] & sets[b]}
    assert got == want and len(want) > 100
    whole = "".join(plans) + pairs._jdf.queryExecution().executedPlan().toString()
    assert whole.count("MapInArrow") == 1 and "md5" not in whole


def test_bands_of_greedy_clusters_broadcast_nothing(spark, monkeypatch):
    """A band's broadcasts went through the driver, band for band; the index alone has one, a row a partition."""
    plain, plans = seqcluster.materialize, {}

    def recorded(df, name="t", lasting=False):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, name, lasting)

    monkeypatch.setattr(seqcluster, "materialize", recorded)
    seqs = spark.createDataFrame([(i, "ACDEFGHIKLMNPQRSTVWY"[i % 7 :] + "KLMNPQ" * (i % 3)) for i in range(40)], "id long, s string")
    found = seqcluster.greedy_bands(cluster.first_copies(seqs, "id", "s").where("id = first"), "id", "s", k=4, first=2, most=8)
    assert found.count() == 21
    assert len(plans["greedy-links"]) > 3
    assert {n for n, ps in plans.items() if any("BroadcastExchange" in p for p in ps)} <= {"greedy-words"}


def test_equal_trees_are_not_told_apart_by_choices():
    """A forest of equal stars takes one choice a level; a numbering changes nothing."""
    stars = [(f"s{i}", f"p{i}{k}") for i in range(100) for k in range(3)] + [(f"p{i}0", f"q{i}") for i in range(100)]
    labels = {n: n[0] for e in stars for n in e}
    began = time.process_time()
    form = graph.canonical_form(labels, set(stars))
    assert time.process_time() - began < 4
    names = list(labels)
    random.Random(1).shuffle(names)
    assert graph.canonical_form({n: labels[n] for n in names}, {(b, a) for a, b in stars}) == form
    ring = {(f"a{i}", f"a{(i + 1) % 6}") for i in range(6)}
    two = {(f"a{i}", f"a{i // 3 * 3 + (i + 1) % 3}") for i in range(6)}
    assert graph.canonical_form({f"a{i}": "a" for i in range(6)}, ring) != graph.canonical_form({f"a{i}": "a" for i in range(6)}, two)
