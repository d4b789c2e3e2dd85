"""Secret scans, spelling variants and conversation tries against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helixframe.llm import conversation_trie, language_id, licenses, quality, queries, secrets, spelling, url_filter
from helixframe.session import read_table
from tests.llm.test_text_operators import MIDDLE, SMALL, clashing, table

# secret scans


def brute_spans(text, rules=secrets.RULES):
    out = []
    for k, r in enumerate(rules):
        for m in re.finditer(r.pattern, text or ""):
            if r.keep is None or re.fullmatch(r.keep, m.group()):
                out.append((m.start(), m.end(), k, r.kind))
    return [(kind, s, e) for s, e, _, kind in sorted(out)]


def spans(spark, rows, **more):
    return {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.scan(table(spark, rows), **more).collect()}


def test_secrets_of_all_documents(spark):
    docs = read_table(spark, MIDDLE, "documents").select("doc_id", "text")
    want = {r.doc_id: brute_spans(r.text) for r in docs.collect()}
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.scan(docs).collect()} == want
    assert sum(map(len, want.values())) > 5


PIECES = [*"aé0=:_-. \"'@/xF1日", "passWORD", "Token", "api_key", "apikey", "ghp_", "AKIA", "xoxb-", "sk_live_", "AIza", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "0123456789abcdef", "ABCDEFGHIJKLMNOP1"]


@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=40).map("".join), max_size=8))
@settings(max_examples=300, deadline=None)
def test_one_pass_finds_what_each_regex_finds(texts):
    scanner = secrets.Scanner()
    raws = [t.encode() for t in texts]
    got = [[(scanner.kinds[k], s, e) for s, e, k in secrets.code_points(r, f)] for r, f in zip(raws, scanner.spans(raws))]
    assert got == [brute_spans(t) for t in texts]


def test_own_rules_and_redaction(spark):
    rules = (secrets.Rule("far", "a[^z]*z|b"), secrets.Rule("mail", r"[a-z]+@[a-z]+(\.[a-z]+)+"), secrets.Rule("twice", "(ab){2,3}"))
    text = "b a b z b x@y.zz.q @ ababababab"
    got = secrets.scan(table(spark, [(1, text), (2, None)]), rules, redacted=True).orderBy("doc_id").collect()
    assert [tuple(s) for s in got[0].spans] == brute_spans(text, rules)
    assert got[0].redacted == "[far] [far] [far] [mail] @ [twice][twice]"
    assert got[1].redacted is None and got[1].spans == []
    for wrong in ("a*", "(", "[a", "*", "é", "a{2"):
        with pytest.raises(ValueError):
            secrets.Scanner((secrets.Rule("x", wrong),))


def test_redaction_covers_overlapping_spans():
    assert secrets.redact("0123456789", [(1, 4, "a"), (3, 6, "b"), (6, 7, "c")]) == "0[a][c]789"
    assert secrets.redact("", []) == ""


def test_secrets_of_odd_texts(spark):
    long = "é " * 700_000 + "password: " + "x" * 2_000_000 + " " + "0123456789abcdef" * 200_000
    rows = [(1, None), (2, ""), (3, "token=abc"), (4, "token=secret: abcdefgh"), (5, long), (6, "AKIA" + "Q" * 16), (6, "AKIA" + "Q" * 15), (None, "secret='abcdef'")]
    got = secrets.scan(table(spark, rows)).collect()
    assert sorted((str(r.doc_id), [tuple(s) for s in r.spans]) for r in got) == sorted((str(d), brute_spans(t)) for d, t in rows)
    assert secrets.scan(table(spark, [])).count() == 0
    crowd = secrets.scan(clashing(spark, [(1, "token=abcdef")]).withColumnRenamed("lang", "spans"), keep=("spans", "source", "doc"))
    assert crowd.columns == ["doc_id", "source", "doc", "spans"] and crowd.first().spans[0].kind == "assign"


# spelling variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, factor=2):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


words = st.lists(st.text("abé", min_size=1, max_size=6), unique=True, max_size=40)


@given(words)
@settings(max_examples=300, deadline=None)
def test_sorted_list_walk(found):
    for n in range(1, 7):
        some = sorted(w for w in found if len(w) in (n, n + 1))
        if some:
            want = [(i, j) for i in range(len(some)) for j in range(i + 1, len(some)) if one_edit(some[i], some[j])]
            assert sorted(spelling.near_in_list(some)) == want


@pytest.mark.parametrize("largest", [1, 3, 64])
def test_variant_groups(spark, largest):
    rng = random.Random(largest)
    counts = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))): rng.choice([1, 2, 3, 5, 8, 20, 50]) for _ in range(400)}
    counts |= {"x" * n: 2**n for n in range(1, 12)} | {"日本語語": 9, "日本語": 2, "a\0b": 1}
    got = spelling.variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long"), largest=largest)
    assert {tuple(r) for r in got.collect()} == brute_variants(counts)


def test_vocabulary(spark):
    rows = [(1, None), (2, ""), (3, "Straße straße STRAße x" + " Äpfel×÷ÿ" * 3), (4, "hello Hello,HELLO1hello" * 2000), (None, "hello")]
    got = {tuple(r) for r in spelling.vocabulary(table(spark, rows)).collect()}
    assert got == {("straße", 3), ("Äpfel×÷ÿ", 3), ("hello", 4003), ("hellohello", 1999)}
    assert spelling.variant_groups(spelling.vocabulary(table(spark, []))).count() == 0
    crowd = spelling.vocabulary(clashing(spark, [(1, "hello hello hello")]).withColumnRenamed("lang", "word").withColumnRenamed("doc", "n"))
    assert crowd.collect() == [("hello", 3)]


def test_slipped_vocabulary(spark):
    docs = read_table(spark, SMALL, "documents").select("doc_id", "text")
    want = Counter()
    for d, t in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    want = {(w, n) for w, n in want.items() if len(w) >= 5 and n >= 3}
    assert {tuple(r) for r in spelling.vocabulary(docs, slip_rate=97).collect()} == want
    with pytest.raises(ValueError):
        spelling.variant_groups(spelling.vocabulary(docs), factor=1)


# conversation tries


def brute_trie(paths):
    members = defaultdict(set)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].add(c)
    kids = Counter(p[:-1] for p in members if p)
    out = set()
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(c for c in m if paths[c] == p))
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], sum(not kids[q] for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rebuilt(rows):
    turns = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            turns[c].append((r or "", x or ""))
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = tuple(turns.get(c - c % 20, [])[:h] + turns[c][h:])
    return out


CONVERSATIONS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("shard, most", [(1, 1 << 17), (3, 1 << 17), (4096, 2), (4096, 1 << 17)])
def test_tries(spark, shard, most):
    rng = random.Random(shard + most)
    paths = {c: tuple((rng.choice("ua"), rng.choice(["", "x", "x y"])) for _ in range(rng.randint(0, 5))) for c in range(60)}
    paths |= {c: paths[7] for c in range(60, 90)} | {c: (("u", "deep words"),) * (c - 80) for c in range(90, 100)}
    rows = [(c, t, r, x) for c, p in paths.items() for t, (r, x) in enumerate(p)]
    turns = conversation_trie.turn_rows(table(spark, rows, CONVERSATIONS))
    marks = table(spark, [(c, -1, None, 0) for c in paths], "conv long, at long, digest binary, tokens long")
    got = conversation_trie.prefix_trie(turns.unionAll(marks), shard, most)
    assert {tuple(r) for r in got.collect()} == brute_trie(paths)


def test_rebuilt_conversations(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", None, "bot"]), rng.choice([None, "", "hi", "a\tb c", "\x0b"])) for c in range(95) if c % 20 or c < 60 for t in rng.sample(range(50), rng.randint(1, 6))]
    rows += [(4, None, "system", "first"), (None, 1, "user", "nobody"), (500, 3, None, None)]
    frame = table(spark, [(*r, 1, 2) for r in rows], CONVERSATIONS + ", conv int, path int")
    got = conversation_trie.prefix_trie(conversation_trie.with_shared_heads(conversation_trie.turn_rows(frame)), shard=7)
    assert {tuple(r) for r in got.collect()} == brute_trie(rebuilt(rows))
    empty = conversation_trie.with_shared_heads(conversation_trie.turn_rows(table(spark, [], CONVERSATIONS)))
    assert conversation_trie.prefix_trie(empty).count() == 0


def test_one_long_conversation_and_many_copies(spark):
    turns = conversation_trie.turn_rows(spark.range(3000).selectExpr("0L AS conv_id", "id AS turn", "'u' AS role", "concat('t ', id) AS text"))
    copies = spark.range(1, 6000).selectExpr("id AS conv", "0L AS at", "unhex(md5('x')) AS digest", "1L AS tokens")
    marks = spark.range(6000).selectExpr("id AS conv", "-1L AS at", "CAST(NULL AS BINARY) AS digest", "0L AS tokens")
    got = {(r.depth, r.conv_id): r for r in conversation_trie.prefix_trie(turns.unionAll(copies).unionAll(marks), shard=512).collect()}
    assert len(got) == 3002
    assert (got[0, 0].n_convs, got[0, 0].n_leaves, got[0, 0].n_children, got[0, 0].saved_tokens) == (6000, 2, 2, 5998)
    assert got[1, 1].ends_sha256 == hashlib.sha256(",".join(map(str, range(1, 6000))).encode()).hexdigest()
    assert got[3000, 0].n_leaves == 1 and got[3000, 0].parent_conv_id == 0


@pytest.mark.parametrize("name", ["op11_secret_scan", "op12_spelling_variants", "op13_conversation_trie"])
def test_registered(name):
    assert name in queries.QUERIES and name in queries.ORACLES


# columns of the caller, long labelled texts, many languages


def test_urls_with_helper_names(spark):
    names = ["_u", "_rules", "_h", "_s", "_best", "rule_verdict", "_node0", "_node", "node", "row", "own", "passed", "component", "rule_host"]
    rows = [(i, f"http://a{i % 2}.net/p{i}", f'<link rel="canonical" href="http://b.com/{i % 3}">', *[f"{n}{i}" for n in names]) for i in range(6)]
    pages = spark.createDataFrame(rows, ["page_id", "url", "html", *names])
    rules = url_filter.rules_table(spark, [("a0.net", "/p", "block"), ("net", "/p3", "allow"), ("b.com", "/1", "block")])
    got = {r.page_id: r for r in url_filter.judge_urls(pages, rules).collect()}
    assert all([got[i][n] for n in names] == [f"{n}{i}" for n in names] for i in range(6))
    assert {i: (r.rule, r.verdict) for i, r in got.items()} == {
        0: ("a0.net/p", "block"), 1: (None, "block"), 2: ("a0.net/p", "block"), 3: ("net/p3", "allow"), 4: ("a0.net/p", "block"), 5: (None, "block")}
    matched = url_filter.match_rules(pages.withColumnRenamed("_h", "host").withColumnRenamed("_s", "path"), rules)
    assert matched.count() == 6 and {"_u", "_rules", "_best", "row", "own"} <= set(matched.columns)


def test_a_host_with_many_rules(spark):
    rules = url_filter.rules_table(spark, [("x.org", f"/{i}/", "block" if i % 2 else "allow") for i in range(300)])
    pages = spark.createDataFrame([(i, f"https://www.x.org/{i}/page") for i in range(320)], "page_id int, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules, html=None).collect()}
    assert got == {i: (f"x.org/{i}/" if i < 300 else None, "block" if i < 300 and i % 2 else "allow") for i in range(320)}


def test_training_on_a_long_first_text(spark):
    """One text of 30 MB among labelled ones neither stops the training nor drops the others."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["xq", "zz"] if i % 2 else ["the", "of", "and"]) for _ in range(60))) for i in range(60)]
    docs = table(spark, [*rows, (99, "zz " * 10_000_000)]).selectExpr("*", "9 AS label", "1 AS _o", "2 AS k", "'t' AS h")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(60)] + [(99, 0), (3, None), (None, 1)], "doc_id long, label int").selectExpr("*", "'x' AS text", "1 AS k")
    net = quality.train(docs.drop("k"), labels)
    scores = {r.doc_id: r.score for r in quality.score(docs.where("doc_id < 60"), net).collect()}
    assert all((scores[i] > 0.5) == (i % 2 == 0) for i in range(60))


def test_training_does_not_depend_on_what_is_kept(spark):
    docs = read_table(spark, SMALL, "documents")
    labels = read_table(spark, SMALL, "labels").selectExpr("doc_id", "quality AS label")
    one, two = quality.train(docs, labels), quality.train(docs, labels, held_bytes=0)
    assert all(np.array_equal(getattr(one, f), getattr(two, f)) for f in ("embed", "filters", "bias", "out"))


def test_more_than_256_languages(spark):
    rng = random.Random(6)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 900)]
    rows = [(i, " ".join("".join(rng.sample(letters[3 * (i % 300) : 3 * (i % 300) + 3], 3)) for _ in range(30)), f"l{i % 300:03}") for i in range(600)]
    docs = table(spark, rows, "doc_id long, text string, lang string")
    model = language_id.train(docs)
    assert len(model.languages) == 300
    got = language_id.identify(docs, model, keep=("lang",), spans=True).collect()
    assert sum(r.lang == r.lang_pred for r in got) > 590 and {r.lang_spans[0].lang for r in got} > {"l299"}
    long = language_id.identify(table(spark, [(1, "abc " * 2_000_000 + rows[299][1])]), model, spans=True).first()
    assert long.lang_spans[-1].end == 2_000_030


def test_license_sql_says_the_same_rule(spark):
    """Wrapped, neighbouring, repeated and broken notices: operator and SQL agree, and not only on nothing."""
    import duckdb

    from tests.llm.test_text_operators import APACHE, BSD, GPL, ISC, LGPL, MIT, MPL, NAMES

    mpl = "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    base = [APACHE, BSD, BSD + NAMES, GPL.format(3), ISC, LGPL, MIT, MPL, mpl, "This software is distributed without\nany warranty", "Released under\n\nthe MIT license.", "Released under\nthe MIT license",
            "Released under. The MIT license", "Licensed under the gplv3; Licensed under the ISC License.\r\nThis work is licensed under a\r\n Creative Commons Attribution 4.0 International License!", "", None,
            "MIT License\n\n" + MIT, MPL + MPL, "permission is hereby granted", "// SPDX-License-Identifier: MIT\n# spdx-license-identifier: isc", "The MIT license;\n" * 40]
    rng = random.Random(1)
    texts = base + ["\n".join(rng.sample([b for b in base if b], 3)) for _ in range(30)] + [" ".join(rng.choice(base) or "" for _ in range(2)) for _ in range(20)]
    got = {r.doc_id: (",".join(r.sentence_ids), ",".join(r.licenses)) for r in licenses.scan_licenses(table(spark, list(enumerate(texts)))).collect()}
    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    c.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    found = c.execute(queries.ORACLES["op4_license_scan"])
    names = [d[0] for d in found.description]
    want = {r["doc_id"]: (r["sentence_ids"], r["licenses"]) for r in (dict(zip(names, row)) for row in found.fetchall())}
    assert got == want
    assert got[8][0] == "mpl2_copy" and got[9][0] == "cc0_warranty" and got[10][0] == "mit_title" and got[11][0] == "mit_line"
    assert got[13][1] == "ISC-reference,GPL-3.0-reference,CC-BY-4.0-reference" and len({v for v in got.values()}) > 25


def test_thousands_of_sentences_and_a_long_text(spark):
    own = [(f"s{i}", f"clause number {i} of the contract") for i in range(5000)]
    rules = [(f"L{i}", [f"s{i}", f"s{i + 1}"]) for i in range(4000)]
    text = "filler words here\n" * 300_000 + "Clause number 17\nof the contract; clause number 18 of\nthe contract. Clause number 4999 of the contract"
    got = licenses.scan_licenses(table(spark, [(1, text), (2, "clause number 18 of the contract")]), sentences=own, rules=rules).orderBy("doc_id").collect()
    assert [(list(r.sentence_ids), list(r.licenses)) for r in got] == [(["s17", "s18", "s4999"], ["L17"]), (["s18"], [])]


def test_gradients_of_the_classifier():
    """Analytic gradients against differences of the plain loss, for short, long and empty texts together."""
    rng = np.random.default_rng(3)
    net = quality.Network(*(rng.normal(0, 0.5, s) for s in ((256, quality.DIM), (quality.STEP * quality.DIM, 2 * quality.FILTERS), (quality.FILTERS,), (quality.FILTERS + 1,))))
    texts = [b"", b"abc", bytes(rng.integers(0, 256, 700, np.uint8)), bytes(rng.integers(90, 100, 1500, np.uint8))]
    labels, shift = np.array([1, 0, 1, 0], np.float32), -3

    def loss():
        total = 0.0
        for text, y in zip(texts, labels):
            tops = []
            halves = max(1, -(-len(text) // quality.HALF) - 1)
            for c in range(halves):
                chunk = text[c * quality.HALF : (c + 2) * quality.HALF].ljust(2 * quality.HALF, b"\0")
                data = np.roll(np.frombuffer(chunk, np.uint8), shift)
                x = net.embed[data].reshape(-1, quality.STEP * quality.DIM)
                z = x[:-1] @ net.filters[:, : quality.FILTERS] + x[1:] @ net.filters[:, quality.FILTERS :]
                tops.append(np.maximum(z.max(0) + net.bias, 0))
            p = 1 / (1 + np.exp(-(np.mean(tops, 0) @ net.out[:-1] + net.out[-1])))
            total -= np.log(p if y else 1 - p)
        return total / len(texts)

    for part, grad in zip((net.embed, net.filters, net.bias, net.out), quality._gradients(net, texts, labels, shift, len(texts))):
        flat, want = part.reshape(-1), np.asarray(grad).reshape(-1)
        for k in {*rng.integers(0, len(flat), 12).tolist(), int(np.abs(want).argmax())}:
            keep, step = flat[k], 1e-5
            flat[k] = keep + step
            high = loss()
            flat[k] = keep - step
            low = loss()
            flat[k] = keep
            assert abs((high - low) / (2 * step) - want[k]) < 1e-4


def test_word_scores_from_plain_counts(spark):
    """Log probabilities of n-gram slots from counts made word by word, and a word's score as their sum."""
    rows = [(1, "the cat the", "en"), (2, "die Katze", "de"), (3, "über 12 cats!", "de"), (4, None, "en"), (5, "lost", None)]
    docs = table(spark, rows, "doc_id long, text string, lang string")
    model = language_id.train(docs)

    def slots(word):
        raw, out = b"\x02" + word + b"\x03", []
        for n in language_id.GRAMS:
            for p in range(len(raw) - n + 1):
                h = 0
                for k in range(1, n + 1):
                    h = (h * 0x100000001B3 ^ (raw[p + k - 1] + (k << 9))) % (1 << 64)
                out.append((h * 0x9E3779B97F4A7C15 % (1 << 64)) >> 48)
        return out

    counts = {lang: Counter(s for _, text, name in rows if name == lang for w in language_id.words(text) for s in slots(w)) for lang in ("de", "en")}
    logs = {lang: {s: np.log((c[s] + 0.5) / (sum(c.values()) + 0.5 * language_id.SLOTS)) for s in set(counts["de"]) | set(counts["en"])} for lang, c in counts.items()}
    assert model.languages == ["de", "en"]
    for k, lang in enumerate(model.languages):
        assert all(abs(model.table[s, k] - v) < 1e-5 for s, v in logs[lang].items())
    scorer = language_id.Scorer(model)
    import pyarrow as pa

    row = scorer.rows(pa.array(["the katze"]))[0]
    for place, word in zip(row, (b"the", b"katze")):
        sums = np.array([sum(model.table[s, k] for s in slots(word)) for k in range(2)])
        assert np.allclose(scorer.scores[place], np.maximum(sums - sums.max(), -language_id.WORST), atol=1e-3)


def test_redirect_sql_says_the_same(spark):
    """Chains, refreshes, relative targets and aliases: operator and SQL agree on pages that do redirect."""
    import duckdb

    link = lambda u: f'<head><LINK href="{u}" rel=canonical></head>'
    fresh = lambda u: f"<meta content='3; URL={u}' http-equiv=\"Refresh\">"
    pages = [(1, "https://a.bad.net/x", ""), (2, "http://alias.com/1", link("https://a.bad.net/x")), (3, "http://far.com/", fresh("http://alias.com/1#top")), (4, "http://good.com/", link("http://other.com/")),
             (5, "http://example.net/en/1", link("http://alias2.com/")), (6, "http://alias2.com/", fresh("http://blocked.net/")), (7, None, link("x")), (8, "no url", link("http://a.bad.net/")), (9, "HTTP://A.B.ORG/fr/x?q#f", None),
             (9, "HTTP://A.B.ORG/fr/x?q#f", None), (10, "http://x.net", ""), (11, "http://rel.com/a/b/c", link("../y/./w?q=1#f")), (12, "http://rel.com/a/y/w?q=1", fresh("//bad.net/z")), (13, "http://rel.com/a/b/c?p=2", link("?p=3")),
             (14, "http://rel.com/a/b/c?p=3", link("mailto:x@y.net")), (15, "http://up.com/a/", link("../../../..")), (16, "http://up.com/", link("http://d.example.com/de/1")), (17, "http://one.com/p", link("q") + fresh("/r") + "<link rel='next' href='http://s.net/'>"),
             (18, "http://one.com/r", link("https://deep.net/")), (19, "http://one.com/q", "<p>"), (20, "http://example.com/de/x", link("http://b.org/fr/ok"))]
    df = table(spark, pages, "page_id long, url string, html string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df, url_filter.rules_table(spark, queries.RULES)).collect()}
    c = duckdb.connect()
    c.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    c.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    assert got == set(c.execute(queries.ORACLES["op7_url_filter"]).fetchall())
    verdicts = {g[0]: g[4] for g in got}
    assert [verdicts[k] for k in (2, 3, 4, 5, 6, 11, 12, 13, 15, 16, 17, 19, 20)] == ["block", "block", "allow", "allow", "allow", "block", "block", "allow", "block", "block", "block", "block", "block"]
