"""Hand-computed fixtures and properties of the structural operators."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from helixframe.functions import codes
from helixframe.operators import cluster, filters, graph, msa, normalize, sequences, spatial, stages, stats, templates
from helixframe.operators.components import connected_components
from helixframe.sinks import atom_lines, check_lines, edge_node_lines, merge_shards, strip_common_entry
from helixframe.sources import mmcif, text


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_ids_without_an_old_map(spark):
    seqs = [("P", "MKTAYIAKQR"), ("P", "MKTAYIAKQR"), ("L", "(ATP)"), ("D", "ACGT"), ("X", "XX")]
    df = spark.createDataFrame([(i, k, s) for i, (k, s) in enumerate(seqs)], "ord long, kind string, sequence string")
    first = sequences.assign_seq_ids(df, None, "kind", "sequence", "ord")
    assert [r[0] for r in rows(first.select("seq_id"))] == ["D0000002", "L0000001", "P0000000", "X0000003"]
    again = sequences.assign_seq_ids(df, first, "kind", "sequence", "ord")
    assert rows(again) == rows(first)
    old = spark.createDataFrame([("P0000007", "MKTAYIAKQR")], "seq_id string, sequence string")
    new = sequences.assign_seq_ids(df, old, "kind", "sequence", "ord")
    assert [r[0] for r in rows(new.select("seq_id"))] == ["D0000009", "L0000008", "P0000007", "X0000010"]


def test_largest_number(spark):
    data = [("2.5", "?"), ("2.5", "3.1"), (".", "?"), ("1.0e1", None), (None, None)]
    df = spark.createDataFrame(data, "a string, b string")
    assert [r[0] for r in df.select(normalize.largest_number(F.col("a"), F.col("b"))).collect()] == [2.5, 3.1, None, None, None]


def test_resolution_and_date(spark):
    df = spark.createDataFrame([(9.0, "2020-01-01"), (None, "2020-01-01"), (9.1, "2020-01-01"), (1.0, "2021-09-30"), (1.0, "2019-12-31")], "r double, d string").withColumn("d", F.to_timestamp("d"))
    kept = filters.by_resolution_and_date(df, "r", 9.0, "d", "2020-01-01", "2021-09-30")
    assert [r.r for r in kept.collect()] == [9.0]
    with pytest.raises(ValueError):
        filters.by_resolution_and_date(df, "r", 9.0, "d")


def test_operator_expressions(spark):
    given = ["(1,2,6)", "(1-60)", "1-10,21-25", "P,Q", "(X0)(1-60)"]
    got = spark.createDataFrame([(g,) for g in given], "e string").select(normalize.expand_operators(F.col("e"))).collect()
    assert [None if r[0] is None else len(r[0]) for r in got] == [3, 60, 15, 2, None]
    assert got[3][0] == ["P", "Q"]


def test_altlocs_within_a_model(spark):
    atoms = [(1, "N", "10", "."), (1, "CA", "10", "A"), (1, "CA", "10", "B"), (2, "CA", "10", "."), (2, "CB", "10", "A")]
    df = spark.createDataFrame(atoms, "model int, atom string, auth string, alt string")
    got = rows(normalize.resolve_altlocs(df, ["model"], ["atom", "auth"], "alt").where("model = 1").select("target", "atom", "alt"))
    assert got == [(".", "N", "."), ("A", "CA", "A"), ("A", "N", "."), ("B", "CA", "B"), ("B", "N", ".")]


CHAINS = [(0, 0.0), (0, 1.0), (1, 5.0), (1, 6.5), (2, 20.0), (3, -6.0), (4, None)]


def test_contact_graph_counts_both_directions(spark):
    pts = [("m", i, c, x, None if x is None else 0.0, None if x is None else 0.0) for i, (c, x) in enumerate(CHAINS)]
    df = spark.createDataFrame(pts, "mol string, idx int, chain int, x double, y double, z double")
    assert rows(spatial.contact_graph(df, 6.0, ["mol"], "idx", "chain")) == [("m", 0, 1, 6), ("m", 0, 3, 2)]
    assert rows(spatial.contact_graph(df, 6.0, ["mol"], "idx", "chain", undirected=True)) == [("m", 0, 1, 3), ("m", 0, 3, 1)]


def test_grid_join_is_brute_force(spark):
    rng = random.Random(4)
    pts = [(i % 2, i, *(rng.uniform(-3, 3) for _ in range(3))) for i in range(120)]
    df = spark.createDataFrame(pts, "mol int, idx int, x double, y double, z double")
    near = {(a[1], b[1]) for a in pts for b in pts if a[0] == b[0] and a[1] != b[1] and sum((p - q) ** 2 for p, q in zip(a[2:], b[2:])) <= 1.0}
    assert {(r.i, r.j) for r in spatial.neighbours(df, 1.0, ["mol"], "idx").collect()} == near


def test_alignment_rows(spark):
    df = spark.createDataFrame([("m", 0, "ACDE"), ("m", 1, "AC-E"), ("m", 2, "AacCDdE")], "msa string, ord int, row string")
    assert [r[0] for r in df.orderBy("ord").select(msa.aligned(F.col("row"))).collect()] == ["ACDE", "AC-E", "ACDE"]
    assert [list(r[0]) for r in df.orderBy("ord").select(msa.deletions(F.col("row"))).collect()][2] == [0, 2, 0, 1]
    assert list(df.where("ord = 1").select(msa.encode(F.col("row"))).first()[0]) == [0, 4, 31, 6]
    cells = msa.positions(df, "msa", "row")
    means = {r.pos: r.deletion_mean for r in msa.deletion_mean(cells).collect()}
    assert means[1] == pytest.approx(0.124778, abs=1e-6) and means[3] == pytest.approx(0.068278, abs=1e-6)
    dense = {r.pos: list(r.profile) for r in msa.dense_profile(msa.profile_counts(cells)).collect()}
    assert dense[2][3] == pytest.approx(2 / 3) and dense[2][31] == pytest.approx(1 / 3)
    assert all(sum(p) == pytest.approx(1, abs=1e-6) for p in dense.values())
    with pytest.raises(ValueError):
        msa.encode(F.col("row"), "ligand")
    # an insertion behind the last match column is ignored
    assert list(spark.createDataFrame([("ACxx",)], "r string").select(msa.deletions(F.col("r"))).first()[0]) == [0, 0]


def test_alignment_headers(spark):
    h = [(0, "any"), (1, "UniRef100_W5NM83 thing n=1 Tax=Lepisosteus oculatus TaxID=7918 RepID=W5NM83_LEPOC"), (2, "SRR4029434_2280741")]
    got = msa.header_fields(spark.createDataFrame(h, "ord int, h string"), "h", "ord").orderBy("ord").select("database", "database_id", "species", "rep_id").collect()
    assert [tuple(r) for r in got] == [("query",) * 4, ("uniref100", "W5NM83", "Lepisosteus oculatus", "W5NM83_LEPOC"), ("bfd", "SRR4029434_2280741", "N/A", "SRR4029434_2280741")]


def test_depth_cap_and_redundancy(spark):
    df = spark.createDataFrame([("m", 0, "A--E"), ("m", 1, "ACDE"), ("m", 2, "ACDF"), ("m", 3, "ACDE")], "msa string, ord int, row string")
    assert {r.ord for r in msa.cap_depth(df, "msa", "row", "ord", 2).collect()} == {1, 2}
    kept = {r.ord for r in msa.drop_redundant(df.where("ord > 0"), "msa", "row", "ord", 0.5, 0.9).collect()}
    assert kept == {1, 2}


def test_redundancy_is_the_same_in_any_blocks(spark):
    rng = random.Random(11)
    data = [(rng.choice(["m", "n", None]), i, "".join(rng.choice("AC-") for _ in range(rng.choice([6, 6, 6, 3])))) for i in range(150)]
    data += [("m", 200, ""), ("m", 201, None), ("m", 4, "AAAAAA"), ("m", 4, "AAAAAA")]
    df = spark.createDataFrame(data, "msa string, rank int, a string")
    want = []
    for name in ("m", "n", None):
        kept = []
        for _, i, text in sorted((r for r in data if r[0] == name and r[2] is not None), key=lambda r: r[1:]):
            if sum(c != "-" for c in text) < len(text) / 2:
                continue
            pairs = [[(x, y) for x, y in zip(text, k) if "-" not in (x, y)] for k in kept]
            if all(sum(x == y for x, y in p) <= 0.7 * max(len(p), 1) for p in pairs):
                kept.append(text)
                want.append((name, i, text))
    for block in (7, 1000):
        got = msa.drop_redundant(df, "msa", "a", "rank", 0.5, 0.7, block)
        assert got.columns == df.columns
        assert sorted((r.msa or "", r.rank, r.a) for r in got.collect()) == sorted((n or "", i, t) for n, i, t in want)
    assert msa.drop_redundant(df.limit(0), "msa", "a", "rank", 0.5).count() == 0


def test_category_counts(spark):
    e = spark.createDataFrame([("cP1", "cA1"), ("cA1", "cP1"), ("cB1", "cP1"), ("cX1", "cP1")], "a string, b string")
    got = {r.category: r.n for r in graph.category_counts(e, "a", "b", 2).collect()}
    assert len(got) == 21 and got["PA"] == 2 and got["PL"] == 1 and sum(got.values()) == 3


def test_leakage_free(spark):
    one = lambda xs: spark.createDataFrame([(x,) for x in xs], "cluster_id string")
    pairs = spark.createDataFrame([("cP1", "cP2"), ("cP3", "cL8")], "c1 string, c2 string")
    got = graph.leakage_free(one(["cP1", "cL9"]), one(["cP2", "cP3", "cL8"]), pairs, codes.POLYMER_CODES)
    assert {r[0] for r in got.collect()} == {"cP3", "cL8"}


def test_statistics(spark):
    mono = ["cP1", "cP2", "cL1", "cB1", "cX1"]
    types = spark.createDataFrame([(m,) for m in mono], "cluster string").withColumn("type", codes.cluster_label(F.substring("cluster", 2, 1), True))
    faces = spark.createDataFrame([("cL1", "cP1"), ("cP1", "cP2")], "a string, b string")
    got = rows(stats.type_statistics(types.select("cluster"), faces, types))
    assert got == [("interface", "Ligand-Protein(L)", 1), ("interface", "Protein(L)-Protein(L)", 1), ("monomer", "Ligand", 3), ("monomer", "Protein(L)", 2)]


def test_template_dates(spark):
    hits = [("q", i, d, n) for i, (d, n) in enumerate([("2015-02-01", 50), ("2016-01-01", 50), ("2022-01-01", 50), ("2014-01-01", 50), ("2016-01-01", 9)])]
    df = spark.createDataFrame(hits, "q string, rank int, d string, n int").withColumns({"d": F.to_timestamp("d"), "first": F.to_timestamp(F.lit("2015-01-01"))})
    got = templates.candidate_hits(df, "q", "rank", "d", "first", "n")
    assert [r["rank"] for r in got.collect()] == [1]
    before = templates.candidate_hits(df, "q", "rank", "d", "first", "n", after=False)
    assert [r["rank"] for r in before.collect()] == [3]


def test_backbone_falls_back(spark):
    df = spark.createDataFrame([(1, "N", 1.0), (1, "CA", 2.0), (1, "C", 3.0), (2, "CB", None), (2, "CA", 5.0)], "res int, atom string, v double")
    assert rows(templates.backbone(df, ["res"], "atom", "v")) == [(1, 1.0, 2.0, 3.0, 2.0), (2, None, 5.0, None, None)]


def test_routing(spark):
    s = [("P", "ACDEFGHIK"), ("P", "HEAVYHEAVYHEAVY"), ("Q", "ACDEFGHIKLMN"), ("R", "ACGUACGUACGU"), ("B", "(NAG)"), ("P", "ACDEFGHIKLMNPQ")]
    df = spark.createDataFrame(s, "mol_type string, sequence string")
    h = spark.createDataFrame([("HEAVYHEAVYHEAVY",)], "sequence string")
    got = {r.sequence: r.route for r in cluster.route_sequences(df, h, h.limit(0)).collect()}
    assert [got[x] for _, x in s] == ["peptide", "antibody_H", "protein_D", "nucleotide", "ligand", "protein"]


def test_alignment_is_optimal():
    assert cluster.align("ACDE", "ACDE") == ("ACDE", "ACDE")
    a, b = cluster.align("ACDEFG", "ACFG")
    assert a == "ACDEFG" and b == "AC--FG"
    assert cluster.align("", "AC") == ("--", "AC") and cluster.align("", "") == ("", "")
    rng = random.Random(2)

    def best(x, y, match=2, mismatch=-1, open_=-5, extend=-1):
        low = -(10**6)
        m = [[[low] * 3 for _ in range(len(y) + 1)] for _ in range(len(x) + 1)]
        m[0][0][0] = 0
        for i in range(len(x) + 1):
            for j in range(len(y) + 1):
                if i:
                    m[i][j][1] = max(m[i - 1][j][k] + (extend if k == 1 else open_) for k in range(3))
                if j:
                    m[i][j][2] = max(m[i][j - 1][k] + (extend if k == 2 else open_) for k in range(3))
                if i and j:
                    m[i][j][0] = max(m[i - 1][j - 1]) + (match if x[i - 1] == y[j - 1] else mismatch)
        return max(m[-1][-1])

    def score(x, y, match=2, mismatch=-1, open_=-5, extend=-1):
        total, last = 0, None
        for p, q in zip(x, y):
            kind = "d" if q == "-" else "r" if p == "-" else "m"
            total += (match if p == q else mismatch) if kind == "m" else (extend if kind == last else open_)
            last = kind
        return total

    for _ in range(200):
        x, y = ("".join(rng.choices("ACG", k=rng.randint(0, 9))) for _ in range(2))
        p, q = cluster.align(x, y)
        assert p.replace("-", "") == x and q.replace("-", "") == y and score(p, q) == best(x, y)


def test_greedy_clusters(spark):
    seqs = spark.createDataFrame([(1, "A" * 10), (2, "A" * 9), (3, "A" * 8), (4, "C" * 8)], "id long, s string")
    links = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.95)], "id1 long, id2 long, identity double")
    assert rows(cluster.greedy_clusters(seqs, "id", "s", links)) == [(1, 1), (2, 1), (3, 3), (4, 4)]
    assert rows(cluster.cluster_components(seqs, "id", links)) == [(1, 1), (2, 1), (3, 1), (4, 4)]


def test_align_counts():
    rng = random.Random(12)
    word = lambda n: "".join(rng.choices("ACG", k=rng.randint(0, n)))
    for xs, ys in (([word(12) for _ in range(300)], [word(12) for _ in range(300)]), (["ACGT" * 30], [word(200)])):
        done = [cluster.align(x, y) for x, y in zip(xs, ys)]
        n, columns = cluster.align_counts(xs, ys)
        assert n.tolist() == [sum(p == q for p, q in zip(*r)) for r in done]
        assert columns.tolist() == [sum(p != "-" and q != "-" for p, q in zip(*r)) for r in done]
    assert [v.tolist() for v in cluster.align_counts(["A-CD"], ["A-CD"])] == [[4], [4]]


def test_similar_pairs_with_common_words(spark):
    rng = random.Random(13)
    made = {i: rng.choice(["ACDEFGHIK", "LMNPQRSTV"]) + "".join(rng.choices("ACDE", k=rng.randint(2, 6))) for i in range(60)}
    seqs = spark.createDataFrame(list(made.items()), "id long, s string")
    words = {i: {s[p : p + 6] for p in range(len(s) - 5)} for i, s in made.items()}
    counts = {(i, j): len(words[i] & words[j]) for i in made for j in made if i < j and words[i] & words[j]}
    want = []
    for (i, j), n in counts.items():
        x, y = cluster.align(made[i], made[j])
        same, columns = sum(p == q for p, q in zip(x, y)), sum(p != "-" and q != "-" for p, q in zip(x, y))
        if n >= 4 and columns >= 0.8 * max(len(made[i]), len(made[j])) and same >= 0.8 * columns:
            want.append((i, j))
    assert len(want) > 60
    for hot in (5, 1000, None):  # words of up to about 30 sequences
        assert sorted((r.id1, r.id2) for r in cluster.similar_pairs(seqs, "id", "s", 0.8, 0.8, 6, 4, hot).collect()) == sorted(want)
        assert {(r.id1, r.id2): r.n for r in cluster.shared_kmers(seqs, "id", "s", 6, hot).collect()} == counts


def test_copies_go_with_their_first(spark):
    seqs = spark.createDataFrame([(1, "AAC"), (2, "AAC"), (3, None), (4, None), (5, "C")], "id long, s string")
    copies = cluster.first_copies(seqs, "id", "s")
    assert {r.id: r.first for r in copies.collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    found = spark.createDataFrame([(1, 5), (3, 3), (4, 4), (5, 5)], "id long, representative long")
    assert rows(cluster.with_copies(found, copies, "id")) == [(1, 5), (2, 5), (3, 3), (4, 4), (5, 5)]


def test_precedence_of_clusterings(spark):
    df = lambda xs: spark.createDataFrame(xs, "id string, rep string")
    got = cluster.merge_clusterings([df([("a", "A1")]), df([("a", "P1"), ("b", "P1")])], "id", "rep")
    assert rows(got) == [("a", "A1"), ("b", "P1")]


def test_components_properties(spark):
    rng = random.Random(8)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7), (200, 200)]
    root = {n: n for e in edges for n in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    want = {n: top(n) for n in root}
    for order in (edges, edges[::-1]):
        df = spark.createDataFrame([*order, (None, 3)], "src long, dst long")
        assert {r.node: r.component for r in connected_components(df).collect()} == want
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_branched_chains_have_their_canonical_string(spark):
    chains = spark.createDataFrame([("a", "branched"), ("b", "polymer"), ("c", "non-polymer"), ("d", "water")], "k string, kind string")
    residues = spark.createDataFrame([("a", 1, "X", "NAG"), ("b", 2, "G", "GLY"), ("b", 1, "A", "ALA"), ("c", 1, "X", "ATP"), ("d", 1, "X", "HOH")], "k string, place int, letter string, comp string")
    graphs = spark.createDataFrame([("a", "(NAG)(FUC)|(0,1)")], "k string, canonical string")
    got = sequences.chain_sequences(chains, residues, ["k"], "place", "letter", "comp", "kind", graphs)
    assert {r.k: r.sequence for r in got.collect()} == {"a": "(NAG)(FUC)|(0,1)", "b": "AG", "c": "(ATP)", "d": None}
    assert got.columns == ["k", "kind", "sequence"]


def test_isomorphic_graphs(spark):
    n = [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "x"), ("b", 7, "x"), ("b", 8, "x"), ("b", 9, "y"), ("c", 1, "x"), ("c", 2, "y"), ("c", 3, "x")]
    e = [("a", 1, 2), ("a", 2, 3), ("b", 7, 9), ("b", 8, 9), ("c", 1, 2), ("c", 1, 3)]
    nodes, edges = spark.createDataFrame(n, "gid string, node int, label string"), spark.createDataFrame(e, "gid string, u int, v int")
    assert {r.gid: r.class_id for r in graph.graph_dedup(nodes, edges).collect()} == {"a": "a", "b": "a", "c": "c"}
    form = {r.gid: r.canonical for r in graph.canonical_strings(nodes, edges).collect()}
    assert form["a"] == form["b"] != form["c"]
    marks = {r.gid: r.hash for r in graph.graph_hashes(nodes, edges).collect()}
    assert marks["a"] == marks["b"] != marks["c"]
    odd = spark.createDataFrame([("x", 1, "a)(b"), ("y", 1, "a"), ("y", 2, "b"), ("z", 1, None), ("t", 5, "")], "gid string, node int, label string")
    loose = spark.createDataFrame([("x", 1, 9)], "gid string, u int, v int")
    assert {r.gid: r.class_id for r in graph.graph_dedup(odd, loose).collect()} == {"x": "x", "y": "y", "z": "t", "t": "t"}


def test_classes_agree_with_the_pairwise_test(spark):
    rng = random.Random(8)
    nodes, edges = [], []
    for g in range(60):
        n = rng.randint(1, 5)
        names = rng.sample(range(90), n)
        nodes += [(g, k, rng.choice("AB")) for k in names]
        edges += [(g, *sorted(p)) for p in itertools.combinations(names, 2) if rng.random() < 0.5]
    graphs = {g: ({k: x for h, k, x in nodes if h == g}, {(u, v) for h, u, v in edges if h == g}) for g in range(60)}
    want = {g: next(h for h in range(60) if graph.isomorphic(graphs[h], graphs[g])) for g in range(60)}
    got = graph.graph_dedup(spark.createDataFrame(nodes, "gid int, node int, label string"), spark.createDataFrame(edges, "gid int, u int, v int"))
    assert {r.gid: r.class_id for r in got.collect()} == want


def test_canonical_form_ignores_numbering():
    rng = random.Random(3)
    for _ in range(40):
        n = rng.randint(1, 6)
        labels = {i: rng.choice("AB") for i in range(n)}
        edges = {(i, j) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.4}
        p = list(range(n))
        rng.shuffle(p)
        assert graph.canonical_form(labels, edges) == graph.canonical_form({p[i]: labels[i] for i in labels}, {(p[i], p[j]) for i, j in edges})


def test_canonical_form_with_many_ties():
    rng = random.Random(5)
    ring = lambda at, n: {(at + i, at + (i + 1) % n) for i in range(n)}
    star = {(0, i) for i in range(1, 9)}
    arms = {(0, i) for i in range(1, 9)} | {(i, i + 8) for i in range(1, 9)}
    grid = {(i, 5 + j) for i in range(5) for j in range(5)} - {(i, 5 + i) for i in range(5)}
    cube = {(i, i ^ b) for i in range(16) for b in (1, 2, 4, 8) if i < i ^ b}
    graphs = [(9, star), (17, arms), (10, {(i, 5 + j) for i in range(5) for j in range(5)}), (10, grid), (12, ring(0, 12)), (12, ring(0, 6) | ring(6, 6)),
              (12, ring(0, 3) | ring(3, 9)), (16, cube), (14, set()), (20, {(0, 1)} | {(i % 2, i) for i in range(2, 20)}), (300, {(0, i) for i in range(1, 300)})]
    forms = []
    for n, edges in graphs:
        labels = {i: "S" if i == 0 and n in (9, 17, 300) else "A" for i in range(n)}
        forms.append(graph.canonical_form(labels, edges))
        for _ in range(4):
            p = rng.sample(range(n), n)
            order = rng.sample(range(n), n)
            assert graph.canonical_form({f"x{p[i]}": labels[i] for i in order}, {(f"x{p[i]}", f"x{p[j]}") for i, j in edges}) == forms[-1]
    assert len(set(forms)) == len(forms)
    assert graph.canonical_form({}, set()) == "|"


def test_split_has_no_leak(spark):
    df = spark.createDataFrame([(i, i % 7, i % 3) for i in range(60)], "component int, P long, L long")
    got = {r.component: r.split for r in graph.split_train_valid(df, ["P", "L"], 0.9, 100).collect()}
    assert len(got) == 60 and set(got.values()) == {"train", "valid"}
    for c in (1, 2):
        total = sum((i % 7, i % 3)[c - 1] for i in range(60))
        assert sum((i % 7, i % 3)[c - 1] for i in got if got[i] == "valid") >= min(int(total * 0.1), 100)


@pytest.mark.parametrize("ratio, least", [(0.9, 100), (0.5, 6), (0.2, 10_000), (1.0, 100), (0.0, 3)])
def test_split_is_the_walk_in_order(spark, ratio, least):
    """Component by component, smallest first."""
    rng = random.Random(int(ratio * 10) + least)
    data = [(f"c{i:04d}", rng.choice([0, 1, 1, 2, 9]), rng.choice([0, 0, 3, 5, 40]), rng.choice([None, 0, 1])) for i in range(400)]
    df = spark.createDataFrame(data, "component string, P long, L long, Q long")
    sizes = {k: [n or 0 for n in v] for k, *v in data}
    total = [sum(v[i] for v in sizes.values()) for i in range(3)]
    keep = [min(int(t * (1 - ratio) + 1e-9), least) for t in total]
    want = {k: "train" for k, v in sizes.items() if any(n > m for n, m in zip(v, keep))}
    left = [t - sum(sizes[k][i] for k in want) for i, t in enumerate(total)]
    for k, v in sorted(sizes.items(), key=lambda x: (sum(x[1]), x[0])):
        if k not in want:
            ok = all(n - x >= m for n, x, m in zip(left, v, keep))
            left = [n - x for n, x in zip(left, v)] if ok else left
            want[k] = "train" if ok else "valid"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as many partitions as a large table has
    try:
        assert {r.component: r.split for r in graph.split_train_valid(df, ["P", "L", "Q"], ratio, least).collect()} == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert graph.split_train_valid(df.limit(0), ["P", "L", "Q"]).count() == 0


def test_last_pair_wins_option(spark):
    pairs = spark.createDataFrame([("a", "b", 1), ("a", "c", 2)], "id1 string, id2 string, ord int")
    members = spark.createDataFrame([(x, "c" + x) for x in "abc"], "id string, cl string")
    assert rows(graph.lift_pairs(pairs, members, "id", "cl")) == [("ca", "cb"), ("ca", "cc")]
    assert rows(graph.lift_pairs(pairs, members, "id", "cl", True, "ord")) == [("ca", "cc")]


def test_normalisation(spark):
    atoms = spark.createDataFrame([("ALA", 0, "N", "N"), ("ALA", 1, "H", "H"), ("ALA", 2, "CA", "C"), ("UNL", 0, "C", "C")], "comp_id string, atom_ord int, atom_id string, element string")
    bonds = spark.createDataFrame([("ALA", "N", "CA"), ("ALA", "N", "H")], "comp_id string, atom_id_1 string, atom_id_2 string")
    comps = spark.createDataFrame([("ALA", "x"), ("UNL", "x"), ("EMP", "x")], "comp_id string, name string")
    c, a, b = normalize.component_tables(comps, atoms, bonds)
    assert rows(c) == [("ALA", "x")] and a.count() == 2 and [(r.src, r.dst) for r in b.collect()] == [(0, 1)]
    code = spark.createDataFrame([("A(MSE)C G",)], "c string").select(normalize.one_letter_tokens(F.col("c"))).first()[0]
    assert list(code) == ["A", "(MSE)", "C", "G"]
    with pytest.raises(ValueError):
        normalize.merge_by_key(comps, comps, ["comp_id"])
    trimmed = filters.trim_prefix(spark.createDataFrame([("s", i) for i in range(10)], "k string, p int"), "k", "p", spark.createDataFrame([("s", 2)], "k string, e int"), "k", "e")
    assert [r.p for r in trimmed.collect()] == list(range(3, 10))


def test_stage_helpers(spark):
    d = lambda xs: spark.createDataFrame(xs, "k string, v int")
    assert rows(stages.new_keys(d([("a", 1), ("UNL", 2), ("b", 3)]), d([("b", 9)]), "k")) == [("a", 1)]
    assert rows(merge_shards([d([("a", 1), ("b", 2)]), d([("b", 3)])], ["k"])) == [("a", 1), ("b", 3)]
    assert rows(check_lines(spark.createDataFrame([("a", None), ("b", "bad")], "k string, r string"), "k", "r")) == [("a", "passed"), ("b", "bad")]


def test_strip_common_entry(spark):
    df = spark.createDataFrame([("1abc_1_1_._(A_1)", "1abc_1_1_._(B_1)"), ("x(A)", "y(B)")], "s string, d string")
    assert [r[0] for r in df.select(strip_common_entry(F.col("s"), F.col("d"))).collect()] == ["1abc_1_1_._(A_1):(B_1)", "x(A):y(B)"]
    nodes = spark.createDataFrame([("c1", "r1")], "cluster string, refs string")
    assert rows(edge_node_lines(nodes, spark.createDataFrame([], "a string, b string, refs string"))) == [("c1", "None", "r1")]


def test_atom_lines(spark):
    df = spark.createDataFrame([("m", 1, 1.0, 2.0, 3.0), ("m", 2, None, 1.0, 1.0), ("m", 3, 10.0, 2.0, 3.0)], "m string, i int, x double, y double, z double")
    got = atom_lines(df, ["m"], "i", {"x": F.format_string("%.3f", "x")}).orderBy("serial").collect()
    assert [r.line for r in got] == ["ATOM 1 1.000 ", "ATOM 2 10.000"]


CIF = """data_1ABC
_entry.id 1ABC
loop_
_atom_site.id
_atom_site.name
1 'N A'
2 "C'"
#
_struct.title
;long
title
;
"""


def test_structure_files(spark, tmp_path):
    got = list(mmcif.parse(CIF))
    assert got == [("1ABC", "_entry", 0, "id", "1ABC"), ("1ABC", "_atom_site", 0, "id", "1"), ("1ABC", "_atom_site", 0, "name", "N A"),
                   ("1ABC", "_atom_site", 1, "id", "2"), ("1ABC", "_atom_site", 1, "name", "C'"), ("1ABC", "_struct", 0, "title", "long\ntitle")]
    (tmp_path / "a.cif").write_text(CIF)
    (tmp_path / "b.cif").write_text("data_X\nloop_\n_a.b\n_a.c\n1\n")
    long, bad = mmcif.read_mmcif_folder(spark, str(tmp_path), ["_atom_site"])
    assert long.count() == 4 and bad.count() == 1
    assert mmcif.read_mmcif(spark, [str(tmp_path / "a.cif")]).count() == 6
    assert rows(normalize.pivot_category(mmcif.normal_ids(long), "_atom_site", ["id", "name"])) == [("1abc", 0, "1", "N A"), ("1abc", 1, "2", "C'")]


def test_text_files(spark, tmp_path):
    (tmp_path / "x.fasta").write_text(">1ABC_A_. | polypeptide(L) | Auth:A\nMKT\nAYI\n>1ABC_B_. | other | Auth:B\nGG\n")
    got = text.read_fasta(spark, str(tmp_path / "x.fasta")).orderBy("ord").select("cif_id", "entity_type", "auth_id", "sequence").collect()
    assert [tuple(r) for r in got] == [("1ABC_A_.", "polypeptide(L)", "A", "MKTAYI"), ("1ABC_B_.", "other", "B", "GG")]
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "P1.gff3").write_text("##gff\nP1\tS\tsignal\t1\t3\t.\n")
    (tmp_path / "g" / "P2.gff3").write_text("##gff\n")
    assert [(r.start0, r.end0) for r in text.parse_gff(text.read_lines(spark, str(tmp_path / "g")), ["file"]).collect()] == [(0, 2)]
    assert {r.stem for r in text.list_files(spark, str(tmp_path), "*.gff3").collect()} == {"P1", "P2"}
    assert [r.output for r in text.list_pairs(spark, str(tmp_path), "*.fasta", "/out", ".a3m").collect()] == ["/out/x.a3m"]
    blocks = tmp_path / "c.cif"
    blocks.write_text("data_ALA\n_a.b 1\ndata_GLY\n_a.b 2\n")
    assert {(r.block_id, r.prefix) for r in text.read_blocks(spark, str(blocks)).collect()} == {("ALA", "A"), ("GLY", "G")}


def test_incremental_ingest(spark, tmp_path):
    from helixframe.streaming.ingest import ingest_new

    src, table, mark = (str(tmp_path / n) for n in ("in", "table", "mark"))
    write = lambda xs: spark.createDataFrame(xs, "k string, v int").coalesce(1).write.mode("append").parquet(src)
    write([("a", 1), ("b", 2)])
    ingest_new(spark, src, "k string, v int", table, mark, "k", lambda d: d)
    write([("b", 5), ("c", 3)])
    ingest_new(spark, src, "k string, v int", table, mark, "k", lambda d: d)
    assert rows(spark.read.parquet(table)) == [("a", 1), ("b", 2), ("c", 3)]
