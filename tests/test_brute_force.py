"""Queries without SQL against plain Python over the whole smallest tables."""

import math
import random
from collections import Counter
from itertools import permutations

import pytest

from helixframe.operators import seqcluster
from helixframe.operators.cluster import align, candidate_pairs, greedy_clusters
from helixframe.plans.registry import QUERIES
from helixframe.sources.text import parse_clstr

FOLDER = "/root/testdata/sf0.001"


def _names(spark):
    """First customer of every name, and each customer's first."""
    firsts, of = {}, {}
    for r in spark.read.parquet(f"{FOLDER}/customer.parquet").orderBy("c_custkey").selectExpr(
            "c_custkey AS id", "concat(c_mktsegment, c_nationkey, round(c_acctbal, 0)) AS name").collect():
        of[r.id] = firsts.setdefault(r.name, r.id)
    return {i: n for n, i in firsts.items()}, of


def _similar(names, identity, cover=0.8, k=6, least=4):
    """All pairs by alignment: ``{(i, j): identity}``."""
    grams = {i: {n[p : p + k] for p in range(len(n) - k + 1)} for i, n in names.items()}
    found, ids = {}, sorted(names)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = (names[x].replace("-", "~") for x in (i, j))  # a name's "-" is no gap
            if len(grams[i] & grams[j]) < least or min(len(a), len(b)) < cover * max(len(a), len(b)):
                continue
            columns = [(p, q) for p, q in zip(*align(a, b)) if p != "-" and q != "-"]
            same = sum(p == q for p, q in columns)
            if len(columns) >= cover * max(len(a), len(b)) and same >= identity * len(columns):
                found[i, j] = same / max(len(columns), 1)
    return found


def _semiglobal(x, y, diagonal, band):
    """Matches and columns of the best banded alignment with free ends, cell by cell."""
    best, before = (0, 0, 0), {}
    for i in range(len(x) + 1):
        row = {}
        for b in range(2 * band + 1):
            j = i + b - band - diagonal
            if not 0 <= j <= len(y):
                continue
            found = [(0, 0, 0)] if i == 0 or j == 0 else []
            if i and j and b in before:
                same = x[i - 1] == y[j - 1]
                found.append((before[b][0] + (2 if same else -1), before[b][1] + same, before[b][2] + 1))
            if i and j and b + 1 in before:
                found.append((before[b + 1][0] - 3, *before[b + 1][1:]))
            if i and b - 1 in row:
                found.append((row[b - 1][0] - 3, *row[b - 1][1:]))
            row[b] = max(found, default=(-(10**6), 0, 0))
            if i and (j == len(y) or i == len(x)):
                best = max(best, row[b])
        before = row
    return best[1:]


def _kmer_rank(word):
    code = 0
    for c in word:
        code = code * 64 + (ord(c) & 63)
    return code % seqcluster.PRIME * seqcluster.FACTOR % seqcluster.PRIME, code


def _centre_links(seqs, identity, cover, k, window, band, votes=1):
    """The links from members to centres, by the method's words."""
    picked, groups, found = {}, {}, {}
    for i, s in seqs.items():
        ranks = [(*_kmer_rank(s[p : p + k]), p) for p in range(len(s) - k + 1)]
        for w in range(max(1, len(ranks) - window + 1) if ranks else 0):
            _, code, p = min(ranks[w : w + window])
            picked.setdefault(i, {}).setdefault(code, []).append(p)
    for i, words in picked.items():
        for code, places in words.items():
            groups.setdefault(code, []).append((-len(seqs[i]), i, min(places)))
    diagonals = {}
    for members in groups.values():
        _, centre, there = min(members)
        for n, i, at in members:
            if i != centre and -n >= cover * len(seqs[centre]):
                diagonals.setdefault((i, centre), Counter())[at - there] += 1
    for (i, centre), count in diagonals.items():
        if sum(count.values()) >= votes:
            diagonal = max(count, key=lambda d: (count[d], -abs(d), d))
            n, columns = _semiglobal(seqs[i], seqs[centre], diagonal, band)
            if columns and columns >= cover * max(len(seqs[i]), len(seqs[centre])) and n >= identity * columns:
                found[i, centre] = n / columns
    return found


def _joined(ids, pairs):
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in pairs:
        a, b = top(i), top(j)
        root[max(a, b)] = min(a, b)
    return top


def test_similar_clusters(spark):
    names, of = _names(spark)
    top = _joined(names, _centre_links(names, 0.8, 0.8, 6, 1, 4))
    got = {r.id: r.representative for r in QUERIES["similar_clusters"](spark, FOLDER).collect()}
    assert got == {i: top(first) for i, first in of.items()}
    assert len(set(got.values())) < len(names)


def _families(seed, count=30, size=8, change=0.05):
    """Mutated copies of random sequences, with insertions and deletions, one of 3,000 letters among them."""
    rng, out = random.Random(seed), {}
    for f in range(count):
        base = [rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(3000 if f == 0 else rng.randint(80, 300))]
        for m in range(size):
            s = []
            for c in base:
                r = rng.random()
                if r > change / 5:
                    s.append(rng.choice("ACDEFGHIKLMNPQRSTVWY") if r < change else c)
                if r > 1 - change / 5:
                    s.append(rng.choice("ACDEFGHIKLMNPQRSTVWY"))
            out[f * size + m] = "".join(s)
    return out


@pytest.mark.parametrize("change, least", [(0.02, 1.0), (0.1, 0.95)])
def test_recall_of_centres(spark, change, least):
    """All pairs of a family are similar; the share that ends in one cluster is the recall. No two families meet."""
    seqs = _families(5, change=change)
    links = seqcluster.linked_centres(spark.createDataFrame(list(seqs.items()), "id int, s string"), "id", "s", 0.6, 0.8, 6, 5)
    got = {(r.id1, r.id2): round(r.identity, 9) for r in links.collect()}
    assert got == {pair: round(x, 9) for pair, x in _centre_links(seqs, 0.6, 0.8, 6, 5, 16).items()}
    top = _joined(seqs, got)
    pairs = [(i, j) for i in seqs for j in seqs if i < j and i // 8 == j // 8]
    assert sum(top(i) == top(j) for i, j in pairs) >= least * len(pairs)
    assert all(i // 8 == j // 8 for i, j in got)


def test_rows_of_a_long_sequence(spark):
    """Rows of minimisers are in proportion to the letters, and carry none of them."""
    rng = random.Random(8)
    base = "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(30_000))
    frame = spark.createDataFrame([(i, base[i:]) for i in range(8)] + [(9, None), (10, ""), (11, "ACD")], "id int, s string")
    words = seqcluster.minimisers(frame, "id", "s", 8, 10)
    assert words.columns == ["id", "word", "at", "length"] and words.where("id = 0").count() < 30_000 * 2 / 11 * 1.1
    pairs = seqcluster.centre_pairs(words, 0.8)
    assert {(r.id, r.centre, r.diagonal) for r in pairs.collect()} == {(i, 0, -i) for i in range(1, 8)}
    met = candidate_pairs(spark.createDataFrame([(i, base[i : i + 3000]) for i in range(8)], "id int, s string"), "id", "s", 0.8, 6, 4, 1000)
    assert met.count() == 28


def _greedy(seqs, identity, cover, k):
    """The sequential walk: ``{id: representative}``."""
    words = {i: Counter(s[p : p + k] for p in range(len(s) - k + 1)) for i, s in seqs.items()}
    heads, rep = [], {}
    for i in sorted(seqs, key=lambda i: (-len(seqs[i]), i)):
        n, best = len(seqs[i]), None
        bound = max(1, n - (k - 1) - k * math.floor(round(n * (1 - identity), 6)))
        for h in heads:
            if n < cover * len(seqs[h]) or sum((words[i] & words[h]).values()) < bound:
                continue
            columns = [(p, q) for p, q in zip(*align(seqs[h].replace("-", "~"), seqs[i].replace("-", "~"))) if p != "-" and q != "-"]
            same = sum(p == q for p, q in columns)
            if len(columns) >= cover * len(seqs[h]) and same >= identity * len(columns) and (best is None or same / len(columns) > best[0]):
                best = (same / len(columns), h)
        rep[i] = best[1] if best else i
        if not best:
            heads.append(i)
    return rep


def test_greedy_representatives(spark):
    names, of = _names(spark)
    want = _greedy(names, 0.9, 0.8, 4)
    got = {r.id: r.representative for r in QUERIES["greedy_representatives"](spark, FOLDER).collect()}
    assert got == {i: want[first] for i, first in of.items()}
    assert len(set(got.values())) < len(names)


@pytest.mark.parametrize("first, most", [(3, 5), (16, 64), (1000, 1000)])
def test_greedy_bands_are_the_walk(spark, first, most):
    rng, seqs = random.Random(first), {}
    for i in range(90):
        s = list(rng.choice(["ACDEFGHIKLMN", "ACDEFGHIKLWW", "QQQQQQQQQQQQQ", "WYWYWYACDEFGHIK"]))
        for _ in range(rng.randint(0, 2)):
            s[rng.randrange(len(s))] = rng.choice("ACDY")
        seqs[i] = "".join(s[: rng.randint(9, 15)])
    seqs = {i: s for s, i in {s: i for i, s in reversed(seqs.items())}.items()} | {200: "A", 201: ""}
    got = seqcluster.greedy_bands(spark.createDataFrame(list(seqs.items()), "id int, s string"), "id", "s", 0.85, 0.8, 3, first, most)
    assert {r.id: r.representative for r in got.collect()} == _greedy(seqs, 0.85, 0.8, 3)


def test_greedy_bands_of_odd_tables(spark):
    rows = [(1, "ACDEFGHIK"), (1, "ACDEFGHI"), (2, None), (3, "ACDEFGHIL"), (3, "ACDEFGHIL")]
    got = seqcluster.greedy_bands(spark.createDataFrame(rows, "id int, s string"), "id", "s", 0.8, k=3)
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 2), (3, 1)]
    assert seqcluster.greedy_bands(spark.createDataFrame([], "id int, s string"), "id", "s").count() == 0


def test_families_of_documents(spark):
    texts = {}
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect():
        s = "".join(c.upper() for c in r.text or "" if c.isascii() and c.isalpha())
        if s:
            texts.setdefault(s, r.doc_id)
    seqs = {i: s for s, i in texts.items()}
    small = {i: s for i, s in seqs.items()}
    top = _joined(seqs, _centre_links(small, 0.8, 0.8, 10, 30, 16, 3))
    assert {r.doc_id: r.representative for r in QUERIES["sequence_families"](spark, FOLDER).collect()} == {i: top(i) for i in seqs}


def test_align_project(spark):
    parts = spark.read.parquet(f"{FOLDER}/part.parquet").orderBy("p_partkey").select("p_partkey", "p_size", "p_name").collect()
    heads, want = {}, {}
    for r in parts:
        head = heads.setdefault(r.p_size, r.p_name)
        a, b = align(head, r.p_name)
        want[r.p_partkey] = "".join("." if q == "-" else q for p, q in zip(a, b) if p != "-")
    assert {r.p_partkey: r.projected for r in QUERIES["align_project"](spark, FOLDER).collect()} == want


def test_canonical_string(spark):
    """Two orders have one string if some numbering of their suppliers makes them equal."""
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_suppkey").distinct()
    kinds = spark.read.parquet(f"{FOLDER}/part.parquet").selectExpr("p_partkey AS l_partkey", "p_type")
    orders = {}
    for r in lines.join(kinds, "l_partkey").collect():
        orders.setdefault(r.l_orderkey, {}).setdefault((r.l_partkey, r.p_type), set()).add(r.l_suppkey)
    forms = {}
    for gid, parts in orders.items():
        makers = sorted(set().union(*parts.values()))
        # suppliers that differ in what they deliver need no common order
        kind = {m: sorted((t, len(s)) for (_, t), s in parts.items() if m in s) for m in makers}
        groups = [[m for m in makers if kind[m] == k] for k in sorted(kind.values())]
        groups = [g for x, g in enumerate(groups) if g not in groups[:x]]

        def numberings(left):
            if not left:
                yield ()
                return
            for head in permutations(left[0]):
                for tail in numberings(left[1:]):
                    yield head + tail

        best = None
        for order in numberings(groups):
            place = {m: i for i, m in enumerate(order)}
            form = sorted((t, tuple(sorted(place[m] for m in s))) for (_, t), s in parts.items())
            best = form if best is None or form < best else best
        forms[gid] = (len(makers), tuple(best))
    got = {r.gid: r.canonical for r in QUERIES["canonical_string"](spark, FOLDER).collect()}
    assert got.keys() == forms.keys()
    assert len({(got[g], forms[g]) for g in got}) == len(set(got.values())) == len(set(forms.values()))


def test_greedy_clusters_with_repeated_keys(spark):
    seqs = spark.createDataFrame([(1, "AAAA"), (1, "AAAAA"), (2, "AAA"), (2, "AAA"), (3, None)], "id int, s string")
    links = spark.createDataFrame([(1, 2, 0.9), (2, 9, 0.9)], "id1 int, id2 int, identity double")
    assert sorted(greedy_clusters(seqs, "id", "s", links).collect()) == [(1, 1), (2, 1), (3, 3)]


def test_cluster_files_without_keys(spark):
    rows, want = [], []
    for c in range(40):
        rows.append((len(rows), f">Cluster {c}"))
        for m in range(c % 4 + 1):
            rows.append((len(rows), f"{m}\t9aa, >P{c}x{m}_H3... " + ("*" if m == c % 3 else "at 95.00%")))
            want.append((f"A{c}x{c % 3}" if c % 3 <= c % 4 else None, f"P{c}x{m}"))
    got = parse_clstr(spark.createDataFrame(rows, "ord int, value string").repartition(5), []).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    two = [("a", 0, "0\t9aa, >P1... *"), ("a", 1, ">Cluster 0"), ("a", 2, "0\t9aa, >P2... *"), ("b", 0, "0\t9aa, >P3... at 95%"), (None, 1, "0\t9aa, >P4... *")]
    got = parse_clstr(spark.createDataFrame(two, "file string, ord int, value string"), ["file"]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [("a", "A1", "P1"), ("a", "A2", "P2"), ("b", None, "P3"), (None, "A4", "P4")]))
