"""The text operators against brute force, round trips and held-out labels."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helixframe.llm import decontamination, language_id, licenses, media, near_dedup, packing, quality, queries, sharding, suffix_dedup, url_filter
from helixframe.llm.textbytes import LOWER
from helixframe.session import read_table

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
CLASH = "doc_id long, text string, lang string, source string, score double, n_words long, shard int, bucket int, doc long, id long"


def table(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def clashing(spark, rows):
    """The rows with columns whose names the operators use themselves."""
    return table(spark, [(i, t, "xx", "s", 9.0, 9, 9, 9, 9, 9) for i, t in rows], CLASH)


# suffix-array dedup


def brute_repeats(docs, length=100):
    seen, out = set(), {}
    for d, t in sorted(docs):
        raw = (t or "").encode()
        hit = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            if w in seen:
                hit[p : p + length] = True
            seen.add(w)
        kept = bytes(np.frombuffer(raw, np.uint8)[~hit])
        runs = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        out[d] = (len(raw), int(hit.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("bucket", [1 << 13, 8 << 20])
def test_repeats_are_exact(spark, bucket):
    docs = read_table(spark, SMALL, "documents")
    got = {r[0]: tuple(r[1:5]) for r in suffix_dedup.dedup(docs, bucket_bytes=bucket).collect()}
    assert got == brute_repeats([tuple(r) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("marked", [False, True])
def test_repeats_in_small_batches(spark, monkeypatch, marked):
    """Many levels in the family, and segments shorter than the documents."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 6))) for _ in range(30)]
    passages = [" ".join(rng.choices(words, k=60)) for _ in range(6)]
    docs = [(i, " ".join(rng.choice([rng.choice(passages), " ".join(rng.choices(words, k=20))]) for _ in range(rng.randint(0, 6)))) for i in range(40)]
    want = brute_repeats(docs)
    spans = []
    # some common strings: the anchors differ, the result doesn't
    hot = suffix_dedup._hashes(np.frombuffer(passages[0].encode(), np.uint8)) if marked else np.zeros(0, np.uint64)
    monkeypatch.setattr(suffix_dedup, "BATCH", 40)
    import pyarrow as pa

    batches = pa.table({"doc": pa.array([d for d, _ in docs], pa.int64()), "text": [t for _, t in docs]}).to_batches(max_chunksize=7)
    monkeypatch.setattr(suffix_dedup, "TASK_BYTES", 4000)
    monkeypatch.setattr(suffix_dedup, "segments", lambda b, o: __import__("helixframe.llm.textbytes", fromlist=["segments"]).segments(b, o, 700))
    mapped = pa.Table.from_batches(list(suffix_dedup._map(100, 3, hot)(batches))).sort_by("bucket")
    for out in suffix_dedup._reduce(100, 3)(mapped.to_batches(max_chunksize=5)):
        spans += zip(out["doc"].to_pylist(), out["begin"].to_pylist(), out["end"].to_pylist())
    by = defaultdict(list)
    for d, a, b in spans:
        by[d].append((a, b))
    for d, t in docs:
        raw = t.encode()
        hit = np.zeros(len(raw), bool)
        for a, b in by[d]:
            hit[a:b] = True
        assert int(hit.sum()) == want[d][1]


def test_repeats_edge_cases(spark):
    rows = [(1, "a" * 350), (2, "a" * 120), (3, None), (5, "xy" * 300), (6, "\0" * 150 + "q" * 99), (7, "\0" * 150 + "q" * 98 + "z"), (8, "é" * 80), (9, "é" * 80), (10, ""), (11, "b" * 99)]
    got = {r[0]: tuple(r[1:5]) for r in suffix_dedup.dedup(clashing(spark, [*rows, (None, "a" * 300)])).collect()}
    assert got.pop(None)[1] == 0
    assert got == brute_repeats(rows)
    assert suffix_dedup.dedup(table(spark, [])).count() == 0
    twice = suffix_dedup.dedup(table(spark, [(4, "c" * 150 + "d"), (4, "c" * 150 + "d")])).collect()
    assert len(twice) == 2 and twice[0] == twice[1]


def test_repeats_of_periodic_texts():
    """Runs of short periods, whole, broken and over segment borders; then very long ones, whose entries stay few."""
    import pyarrow as pa

    from helixframe.llm import textbytes

    def removed(docs, size):
        part = lambda b, o: textbytes.segments(b, o, size)
        suffix_dedup.segments, kept = part, suffix_dedup.segments
        try:
            batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs], pa.int64()), pa.array([t for _, t in docs])], ["doc", "text"])
            mapped = pa.Table.from_batches(list(suffix_dedup._map(100, 3, np.zeros(0, np.uint64))([batch]))).sort_by("bucket")
            by = defaultdict(list)
            for out in suffix_dedup._reduce(100, 3)(mapped.to_batches()):
                for d, a, b in zip(out["doc"].to_pylist(), out["begin"].to_pylist(), out["end"].to_pylist()):
                    by[d].append((a, b))
        finally:
            suffix_dedup.segments = kept
        out = {}
        for d, t in docs:
            hit = np.zeros(len(t.encode()), bool)
            for a, b in by[d]:
                hit[a:b] = True
            out[d] = hit
        return out, mapped

    rng = random.Random(8)
    line = "".join(rng.choices("abcdefgh ", k=90))
    for trial in range(60):
        docs = []
        for d in range(6):
            unit = rng.choice(["a", "ab", "xyz", line, line[:33], "é", "-" * 40 + "+"])
            text = unit * rng.randint(1, 30)
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(text))
                text = text[:at] + rng.choice("aq") * rng.randint(0, 3) + text[at:]
            docs.append((d, text + rng.choice(["", line * 3, "b" * 150])))
        got, _ = removed(docs, rng.choice([150, 700, 1 << 21]))
        seen = set()
        for d, t in docs:
            raw, want = t.encode(), np.zeros(len(t.encode()), bool)
            for p in range(len(raw) - 99):
                want[p : p + 100] |= raw[p : p + 100] in seen
                seen.add(raw[p : p + 100])
            assert (got[d] == want).all()
    for unit in ("a", "ab", line):
        text = unit * (3_000_000 // len(unit))
        got, mapped = removed([(1, text)], 1 << 21)
        # the bytes that only strings of the first period cover
        assert int((~got[1]).sum()) == len(unit) and not got[1][: len(unit)].any()
        assert mapped.num_rows < 50


# near duplicates


def brute_groups(docs, percent):
    sets = {}
    for d, t in docs:
        w = (t or "").encode().translate(LOWER).split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    index, root = defaultdict(list), {d: d for d in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for d, s in sets.items():
        for e, n in Counter(e for x in s for e in index[x]).items():
            if 100 * n >= percent * (len(s) + len(sets[e]) - n):
                a, b = top(d), top(e)
                root[max(a, b)] = min(a, b)
        for x in s:
            index[x].append(d)
    return {d: (len(sets[d]), top(d), top(d) == d) for d in sets}


@pytest.mark.parametrize("options", [{}, {"small": 3, "depth": 1}])
def test_near_duplicates_are_exact(spark, options):
    docs = read_table(spark, SMALL, "documents")
    got = {r[0]: tuple(r[1:4]) for r in near_dedup.near_duplicates(docs, 85, **options).collect()}
    assert got == brute_groups([tuple(r) for r in docs.select("doc_id", "text").collect()], 85)


def test_near_duplicates_chains_and_edges(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(400)]
    docs, base = [], rng.choices(words, k=120)
    for i in range(60):  # a drifting chain: neighbours are linked, the ends are not
        base = list(base)
        base[rng.randrange(120)] = rng.choice(words)
        docs.append((i, " ".join(base)))
    hub = rng.choices(words, k=200)
    for i in range(60, 100):
        copy = list(hub)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(200)] = "x" + rng.choice(words)
        docs.append((i, " ".join(copy)))
    docs += [(100, None), (101, ""), (102, " \t\n"), (103, "One two"), (104, "one  TWO"), (105, "one"), (106, docs[70][1].upper())]
    want = brute_groups(docs, 85)
    got = {r[0]: tuple(r[1:4]) for r in near_dedup.near_duplicates(clashing(spark, docs), 85, small=8, depth=2).collect()}
    assert got == want
    assert near_dedup.near_duplicates(table(spark, [])).count() == 0
    odd = near_dedup.near_duplicates(table(spark, [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f")])).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in odd) == [("1", "1", True), ("1", "1", True), ("None", "None", True)]


# decontamination


def brute_hits(docs, items, window=10):
    windows = defaultdict(set)
    for k, t in items:
        x = decontamination.words(t)
        for i in range(max(len(x) - window + 1, 1 if x else 0)):
            windows[tuple(x[i : i + window])].add(k)
    sizes, out = {len(w) for w in windows}, {}
    for d, t in docs:
        x = decontamination.words(t)
        mark, found = np.zeros(len(x), bool), set()
        for n in sizes:
            for i in range(len(x) - n + 1):
                if tuple(x[i : i + n]) in windows:
                    mark[i : i + n] = True
                    found |= windows[tuple(x[i : i + n])]
        out[d] = (len(x), int(mark.sum()), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(mark.any()))
    return out


def test_automaton_is_brute_force():
    rng = random.Random(1)
    for trial in range(300):
        letters, window = ("abc" if trial % 2 else "abcdef"), rng.choice([3, 5, 10])
        items = sorted((str(i), " ".join(rng.choices(letters, k=rng.randint(0, 14)))) for i in range(6))
        text = " ".join(rng.choices(letters, k=60))
        automaton = decontamination.Automaton([(k, decontamination.words(t)) for k, t in items], window)
        mark, found = automaton.hits(decontamination.words(text))
        names = sorted(automaton.names[k] for k in found)
        want = brute_hits([(0, text)], items, window)[0]
        assert (int(mark.sum()), hashlib.sha256(",".join(names).encode()).hexdigest()) == (want[1], want[3])


def test_decontamination_is_exact(spark):
    docs, bench = read_table(spark, MIDDLE, "documents"), read_table(spark, MIDDLE, "benchmark")
    got = {r[0]: tuple(r[1:6]) for r in decontamination.scan(docs, bench).collect()}
    assert got == brute_hits([tuple(r) for r in docs.select("doc_id", "text").collect()], [(str(r[0]), r[1]) for r in bench.select("item_id", "text").collect()])


def test_a_large_benchmark_takes_several_passes(spark, monkeypatch):
    docs, bench = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "benchmark")
    long = [(9001, " ".join(r.text or "" for r in docs.orderBy("doc_id").limit(12).collect()))]
    bench = bench.select(F.col("item_id").cast("long"), "text").unionByName(spark.createDataFrame(long, "item_id long, text string"))
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 30)
    whole = decontamination.scan(docs, bench, clean=True, keep=("lang",)).collect()
    assert {r[0]: tuple(r[2:7]) for r in whole} == brute_hits([tuple(r) for r in docs.select("doc_id", "text").collect()], [(str(r[0]), r[1]) for r in bench.collect()])
    monkeypatch.setattr(decontamination, "MAX_ITEM_WORDS", sum(len(decontamination.words(r.text)) for r in bench.collect()) // 3)
    parts = decontamination.scan(docs, bench, clean=True, keep=("lang",)).collect()
    assert sorted(map(str, parts)) == sorted(map(str, whole))


def test_decontamination_edges(spark):
    items = table(spark, [(1, "One two, three four five six seven eight nine ten eleven"), (2, "short item"), (3, None), (4, ""), (None, "null item words")], "item_id long, text string")
    rows = [(1, "x ONE two three four five six seven eight nine ten y"), (2, "a Short, item!"), (3, None), (4, ""), (5, "null item words"), (1, "x")]
    got = decontamination.scan(clashing(spark, rows), items, clean=True, keep=("lang", "n_words")).collect()
    assert [(r.n_hit, r.n_items, r.contaminated) for r in got] == [(10, 1, True), (2, 1, True), (0, 0, False), (0, 0, False), (3, 0, True), (0, 0, False)]
    assert got[0].clean_text == "x  y" and got[1].clean_text == "a !" and got[2].clean_text is None
    assert decontamination.scan(table(spark, rows), items.limit(0)).where("contaminated").count() == 0
    assert decontamination.scan(table(spark, []), items).count() == 0


# packing


TRICKY = [
    "", " \n\n ", "it's!!. a..b don't, x'. 'S <|endoftext|>a <|startoftext|>\tz\x1cq", "ÉÉ İΣ ΑΣ. 12.5, 3. a1.", "naïve.\ncafé, ’s", "é. Å,",
    "see <|EndOfText|> here <|ENDOFTEXT|>", "<|StartOfText|>x", "a\u0338 =\u0338 <\u0338", "'retore 'llama,'s1", "K ; \u037e", "x" * 5000,
]


def test_token_ids_are_the_tokenizers(spark, monkeypatch):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    rng = random.Random(3)
    signs = [*"abcABCzZ09 '.,;-<>|\n\t\0\x1c\x7f", *"éÉßİıΣσς\u0338\u0301\xa0\u2003K\u037e中文١½ⅷ’…«😀\u200d", "'s", "'re", "'LL", "<|endoftext|>", "<|EndOfText|>"]
    texts = [r.text for r in read_table(spark, SMALL, "documents").collect()] + TRICKY
    texts += ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(20_000)]
    want = [[*e.ids, 1] for e in tok.encode_batch(texts, add_special_tokens=False)]
    words = packing.WordIds(queries.tokenizer_path())
    assert not words.exact
    for chunk in (packing.CHUNK, 300):  # short chunks cut texts
        monkeypatch.setattr(packing, "CHUNK", chunk)
        assert [x.tolist() for x in words.encode([t.encode() for t in texts])] == want
    monkeypatch.setattr(packing, "CACHE_WORDS", 500)  # everything is forgotten now and then
    assert [x.tolist() for x in words.encode([t.encode() for t in texts])] == want


def test_other_tokenizers_encode_whole_texts(tmp_path):
    import json

    from tokenizers import Tokenizer

    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        told = json.load(f)
    told["normalizer"] = None
    path = str(tmp_path / "cased.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(told, f)
    words, tok = packing.WordIds(path), Tokenizer.from_file(path)
    assert words.exact
    assert [x.tolist() for x in words.encode([t.encode() for t in TRICKY])] == [[*e.ids, 1] for e in tok.encode_batch(TRICKY, add_special_tokens=False)]


def check_packing(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_query(spark):
    docs = read_table(spark, SMALL, "documents")
    rows = queries.QUERIES["op1_packing"](spark, SMALL).collect()
    total = sum(r.length for r in rows)
    assert check_packing(rows, 4096) <= -(-total // 4096) + 1
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    want = {}
    for d in docs.collect():
        ids = [*tok.encode(d.text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k : k + 4096], "<u4")
            want[d.doc_id, k // 4096] = (k, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want


def test_fullest_combination_is_optimal():
    rng = random.Random(5)
    for _ in range(200):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(0, 9))]
        room = rng.randint(0, 60)
        counts = Counter(sizes)
        got = packing.fullest(sorted(counts, reverse=True), counts, room)
        sums = {0}
        for s in sizes:
            sums |= {x + s for x in sums}
        assert sum(got) == max(x for x in sums if x <= room) and not Counter(got) - counts
    plan = packing.plan_bins({3: 1000, 5: 700, 10: 5}, 10)
    assert sum(n * b.count(3) for b, n, _ in plan) == 1000 and all(sum(b) <= 10 for b, _, _ in plan)


def test_packing_edges(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 3)
    rows = [(i, "one two three") for i in range(20)] + [(20, None), (21, ""), (None, "x"), (5, "one two three"), (22, "w " * 40)]
    pieces = packing.pack_documents(clashing(spark, rows), queries.tokenizer_path(), capacity=16)
    got = pieces.collect()
    assert check_packing(got, 16) >= 1 and sum(r.length for r in got) == 21 * 4 + 1 + 1 + 2 + 41
    assert packing.pack_documents(table(spark, []), queries.tokenizer_path()).count() == 0


# sharding


def test_shards_hold_the_row_law(spark):
    rows = queries.QUERIES["op8_sharding"](spark, MIDDLE).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert len(rows) == 1000 and set(by) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    docs = {r.doc_id: r.text for r in read_table(spark, MIDDLE, "documents").collect()}
    assert all(r.size == len(docs[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) for r in rows)


def test_one_more_shard_moves_little(spark):
    keys = spark.range(4000).withColumnRenamed("id", "k")
    at = lambda n, load: {r.k: r.shard for r in sharding.shard(keys, "k", n, load=load).collect()}
    for load, most in ((1.0, 0.35), (1.25, 0.2)):
        a, b = at(16, load), at(17, load)
        assert sum(a[k] != b[k] for k in a) < most * len(a)
        assert max(Counter(a.values()).values()) <= -(-load * len(a) // 16)
    none = sharding.shard(table(spark, [(None, "a"), (None, "a"), (1, "b"), (1, "b")]), "doc_id", 3, order=("text",)).collect()
    assert Counter(r.shard for r in none).most_common()[0][1] == 2
    assert sharding.shard(table(spark, []), "doc_id", 3).count() == 0


def test_shards_are_a_walk_round_the_ring(spark):
    """Key by key: each goes to the next virtual node clockwise whose shard has room."""
    keys = spark.range(700).select((F.col("id") * 7919).alias("_rank"), F.lit("u").alias("_cell"), F.lit(3).alias("_h"), F.lit(9).alias("row"))
    hashes = sorted((r.h & (1 << 64) - 1, r[0]) for r in keys.select("_rank", F.xxhash64("_rank").alias("h")).collect())
    for n, load in ((5, 1.0), (6, 1.0), (5, 1.3)):
        got = sharding.shard(keys, "_rank", n, vnodes=4, load=load)
        assert got.columns == ["_rank", "_cell", "_h", "row", "shard", "slot"]
        got = {r[0]: (r.shard, r.slot) for r in got.collect()}
        room = [700 // n + (s < 700 % n) for s in range(n)] if load == 1.0 else [-int(-load * 700 // n)] * n
        places, used, want = sharding.ring(n, 4), [0] * n, {}
        for h, key in hashes:
            cell = h >> 64 - sharding.CELL_BITS
            start = next((i for i, (c, _) in enumerate(places) if c >= cell), 0)
            s = next(s for _, s in places[start:] + places[:start] if used[s] < room[s])
            want[key] = (s, used[s])
            used[s] += 1
        assert got == want


def test_a_hot_key_goes_clockwise_in_order(spark):
    """A third of the rows under one key, and null keys: ties go by ``order``, slots have no gap."""
    docs = table(spark, [(7, f"t{i:03d}") for i in range(100)] + [(None, f"n{i:03d}") for i in range(40)] + [(100 + i, "x") for i in range(160)])
    got = sharding.shard(docs, "doc_id", 7, order=("text",)).collect()
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert len(got) == 300 and sorted(map(len, by.values())) == [42] + [43] * 6
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    for key in (7, None):
        hot = sorted((r.text, r.shard, r.slot) for r in got if r.doc_id == key)
        # a shard takes the rows that come next in order, then the next shard on the ring goes on
        runs = [list(g) for _, g in itertools.groupby(hot, key=lambda r: r[1])]
        assert len({g[0][1] for g in runs}) == len(runs) > 1 - (key is None)
        assert all([r[2] for r in g] == list(range(g[0][2], g[0][2] + len(g))) for g in runs)


# transport streams


def test_a_stream_written_by_hand():
    """Tables as common encoders write them, one unit over two packets, the second one stuffed."""
    pat = bytes.fromhex("474000100000b00d0001c100000001f0002ab104b2").ljust(188, b"\xff")
    pmt = bytes.fromhex("475000100002b0120001c10000e100f0001be100f00015bd4d56").ljust(188, b"\xff")
    one = bytes.fromhex("47410030075000007b0c7e00" + "000001e000b4808005210007d861") + b"A" * 162
    two = bytes.fromhex("47010031ad00").ljust(178, b"\xff") + b"B" * 10
    back = media.demux(pat + pmt + one + two)
    assert back.payload == b"A" * 162 + b"B" * 10 and back.programs == {1: {0x100: 0x1B}}
    assert back.pts.tolist() == [126000] and back.random_access.tolist() == [0] and back.continuity_errors == 0


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=9000))
def test_stream_round_trip(payload):
    back = media.demux(media.mux(payload))
    assert back.payload == payload and back.continuity_errors == 0 and back.random_access[0] == 0


def test_stream_lengths_and_faults():
    for n in [161, 162, 163, 345, 346, 347, 4209, 4210, 4211, 8420, 50000]:
        stream = media.mux(bytes(range(256)) * (n // 256) + bytes(n % 256))
        back = media.demux(stream)
        assert len(back.payload) == n and back.programs == {1: {media.ES_PID: media.STREAM_TYPE}}
        assert back.pts.tolist() == [3003 * i for i in range(len(back.pts))]
    cut = stream[: 5 * 188] + stream[6 * 188 :]
    with pytest.raises(ValueError):
        media.demux(cut)
    with pytest.raises(ValueError):
        media.demux(b"\x00" + stream[1:])
    with pytest.raises(ValueError):
        media.demux(stream[:12] + b"\x55" + stream[13:])
    skipped = bytearray(stream)
    skipped[4 * 188 + 3] ^= 5
    assert media.demux(bytes(skipped)).continuity_errors == 2


def test_stream_columns(spark):
    rows = [(1, None), (2, ""), (3, "abc"), (3, "abc"), (4, "x" * 64), (None, "é" * 5000)]
    got = media.transport_columns(clashing(spark, rows), keep_media=True).collect()
    assert [r.n_bytes for r in got] == [0, 0, 3, 3, 64, 10000] and [r.payload_bytes for r in got] == [64, 64, 64, 64, 64, 10048]
    assert got[0][1:] == got[1][1:] and got[2] == got[3]
    for r, (_, t) in zip(got, rows):
        payload = (t or "").encode().ljust(r.payload_bytes, b"\0")
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
        assert media.demux(r.media).payload == payload and r.media_sha256 == hashlib.sha256(r.media).hexdigest()


# language


def test_language_is_found(spark):
    found = queries.QUERIES["op6_language_id"](spark, MIDDLE).toPandas().merge(read_table(spark, MIDDLE, "documents").select("doc_id", "lang").toPandas())
    held = found[found.held_out & found.lang.notna()]
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.98


def test_language_spans_and_edges(spark):
    docs = read_table(spark, MIDDLE, "documents")
    model = language_id.train(docs)
    texts = {lang: docs.where(f"lang = '{lang}' and n_chars between 400 and 3000").first().text for lang in ("en", "de")}
    rows = [(1, texts["en"] + "\n" + texts["de"]), (2, None), (3, ""), (4, "123 !? —"), (5, "Привет мир"), (6, "x")]
    got = language_id.identify(clashing(spark, rows), model, keep=("lang", "score"), spans=True).collect()
    assert [s.lang for s in got[0].lang_spans] == ["en", "de"]
    assert [(r.lang_pred, r.score) for r in got[1:4]] == [("und", 0.0)] * 3
    assert all(0 <= r.score <= 1 for r in got) and got[5].lang_pred in model.languages
    empty = language_id.train(table(spark, [(1, None, None)], "doc_id long, text string, lang string"))
    assert language_id.identify(table(spark, rows), empty).where("lang_pred <> 'und'").count() == 0
    assert language_id.identify(table(spark, []), model).count() == 0


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    scores = rng.normal(0, 2, (50, 3)).astype(np.float32)
    rows = [rng.integers(0, 50, n) for n in (5, 0, 1, 6, 4)]
    for row, path in zip(rows, language_id.viterbi(scores, rows, 1.5)):
        value = lambda p: sum(scores[r, s] for r, s in zip(row, p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: E731, B023
        best = max((value(p) for p in np.ndindex(*[3] * len(row))), default=0)
        assert value(path.tolist()) == pytest.approx(best, abs=1e-4)


# quality


def test_quality_is_learned(spark):
    got = queries.QUERIES["op9_quality"](spark, "/root/testdata/sf0.1").toPandas().merge(read_table(spark, "/root/testdata/sf0.1", "labels").toPandas())
    held = got[got.held_out]
    assert len(held) > 500 and (held.predicted == held.quality).mean() > 0.96
    assert held[held.quality == 1].predicted.mean() > 0.97


def test_quality_reads_every_byte(spark):
    rng = np.random.default_rng(1)
    net = quality.Network(*(rng.normal(0, 1, s).astype(np.float32) for s in ((256, 4), (16, 32), (16,), (17,))))

    def plain(raw):
        n = max(1, -(-len(raw) // 256))
        data = np.frombuffer(raw.ljust(n * 256, b"\0"), np.uint8)
        x = net.embed[data].reshape(-1, 16) @ net.filters
        z = x[:, :16].copy()
        z[:-1] += x[1:, 16:]
        top = np.maximum(z.reshape(n, 64, 16).max(1) + net.bias, 0)
        chunks = [np.maximum(top[i], top[i + 1]) for i in range(n - 1)] or [top[0]]
        return 1 / (1 + np.exp(-(np.mean(chunks, 0) @ net.out[:-1] + net.out[-1])))

    texts = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (0, 1, 255, 256, 257, 512, 5000, 2_300_000, 3)]
    assert np.allclose(quality.probabilities(texts, net), [plain(t) for t in texts], atol=1e-4)
    rows = [(1, None), (2, ""), (3, "abc"), (3, "abc")]
    got = quality.score(clashing(spark, rows), net, keep=("lang", "score")).collect()
    assert got[0].score == got[1].score and got[2] == got[3] and all(0 <= r.score <= 1 for r in got)
    none = quality.train(table(spark, rows), table(spark, [], "doc_id long, label int"))
    assert quality.score(table(spark, rows), none).first().score == pytest.approx(0.5)


# licences


def test_licenses(spark):
    full = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"
    notice = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    rows = [(1, "Licensed under the Apache License, Version 2.0."), (2, "Text.\nReleased under the MIT License.\nMore. Released under the MIT License."), (3, None), (4, ""),
            (5, f"The MIT License\n{full}\n{notice}\n"), (6, f"{full}\n{notice}\n"), (7, "We like the license."), (8, "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0.")]
    got = {r.doc_id: list(r.licenses) for r in licenses.scan_licenses(clashing(spark, rows)).collect()}
    assert got == {1: ["Apache-2.0-reference"], 2: ["MIT-reference"], 3: [], 4: [], 5: ["MIT"], 6: ["MIT-text"], 7: [], 8: ["CC-BY-NC-4.0", "CC-BY-4.0"]}
    assert licenses.scan_licenses(table(spark, [])).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version {} of the License, or
(at your option) any later version.

You should have received a copy of the GNU General Public License
along with this program; if not, write to the Free Software Foundation.
"""


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAMES = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.

You should have received a copy of the GNU Lesser General Public
License along with this library; if not, write to the Free Software
"""


def test_more_licenses(spark):
    unlicense = "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or\ndistribute this software, either in source code form or as a compiled\nbinary, for any purpose, commercial or non-commercial, and by any\nmeans.\n"
    rows = [(1, BSD), (2, BSD + NAMES), (3, MPL), (4, ISC), (5, LGPL), (6, unlicense), (7, "// SPDX-License-Identifier: MPL-2.0\n" + MPL + MPL), (8, "# SPDX-License-Identifier: BSD-3-Clause\n")]
    got = {r.doc_id: list(r.licenses) for r in licenses.scan_licenses(table(spark, rows)).collect()}
    assert got == {1: ["BSD-2-Clause"], 2: ["BSD-3-Clause"], 3: ["MPL-2.0"], 4: ["ISC"], 5: ["LGPL-2.1-or-later"], 6: ["Unlicense"], 7: ["MPL-2.0", "MPL-2.0-tag"], 8: ["BSD-3-Clause-tag"]}


def test_wrapped_licenses(spark):
    texts = {"MIT-text": MIT, "MIT": "The MIT License\n\n" + MIT, "BSD-2-Clause": BSD, "Apache-2.0": APACHE,
             "GPL-2.0-or-later": GPL.format(2), "GPL-3.0-or-later": GPL.format(3).replace("software;", "software:")}
    looks = [lambda t: t, lambda t: t.replace("\n", "\r\n"), lambda t: "/*\n" + "".join(f" * {x}\n" for x in t.splitlines()) + " */", lambda t: "".join(f"# {x}\n" for x in t.splitlines()),
             lambda t: "Some words.\n" + t + "\nOther words"]
    want = {(k, name): name for name in texts for k in range(len(looks))}
    rows = [(i, looks[k](texts[name])) for i, (k, name) in enumerate(want)]
    got = {r.doc_id: list(r.licenses) for r in licenses.scan_licenses(table(spark, rows)).collect()}
    assert got == {i: [name] for i, name in enumerate(want.values())}
    apart = [(1, "Released under\n\nthe MIT license."), (2, "Released under. The MIT license"), (3, "Not released under\nthe MIT license"), (4, "Released under\nthe MIT license")]
    got = {r.doc_id: list(r.sentence_ids) for r in licenses.scan_licenses(table(spark, apart)).collect()}
    assert got == {1: ["mit_title"], 2: ["mit_title"], 3: ["mit_title"], 4: ["mit_line"]}
    own = licenses.scan_licenses(table(spark, [(1, "All rights\nreserved, forever!")]), sentences=[("own", "All rights reserved, forever")], rules=[("Own", ["own"])])
    assert [list(r.licenses) for r in own.collect()] == [["Own"]]


# URLs


def test_redirects_carry_blocks(spark):
    link = lambda u: f'<head><link rel="canonical" href="{u}"></head>'
    pages = [(1, "https://a.bad.net/x", ""), (2, "http://alias.com/1", link("https://a.bad.net/x")), (3, "http://far.com/", "<META http-equiv='Refresh' content='0; URL=http://alias.com/1#top'>"),
             (4, "http://good.com/", link("http://other.com/")), (5, "http://example.net/en/1", link("http://alias2.com/")), (6, "http://alias2.com/", ""),
             (7, None, None), (8, "no url", "x"), (9, "HTTP://A.B.ORG/fr/x?q#f", ""), (9, "HTTP://A.B.ORG/fr/x?q#f", ""), (10, "http://x.net", ""), (11, "http://rel.com/a", link("/b")), (12, "http://rel.com/b", "")]
    df = table(spark, [(*p, "r") for p in pages], "page_id long, url string, html string, rule string")
    rules = url_filter.rules_table(spark, queries.RULES)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df, rules).collect()}
    assert got[1][2:] == ("net/", "block") and got[2] == ("alias.com", "/1", None, "block") and got[3][3] == "block"
    assert got[4][3] == "allow" and got[5][2:] == ("example.net/en/", "allow") and got[6][3] == "allow"
    assert got[7] == ("", "", None, "allow") and got[8] == ("", "", None, "allow")
    assert got[9] == ("a.b.org", "/fr/x", "org/fr/", "allow") and got[10] == ("x.net", "", None, "allow")
    more = table(spark, [("http://other.com/", "https://spam.net/z")], "src string, dst string")
    again = {r.page_id: r.verdict for r in url_filter.judge_urls(df, rules, more).collect()}
    assert again[4] == "block" and again[11] == "allow"
    for target, want in (("//bad.net/z", "block"), ("../y/./w?q=1#f", "block"), ("?p=2", "block"), ("mailto:x@y", "allow"), ("z", "allow")):
        two = [(1, "http://s.com/a/b/c", link("http://nowhere.com/") + link(target)), (2, "http://s.com/a/y/w?q=1", ""), (3, "http://s.com/a/b/c?p=2", "")]
        bad = table(spark, [("http://s.com/a/y/w?q=1", "http://bad.net/"), ("http://s.com/a/b/c?p=2", "http://bad.net/")], "src string, dst string")
        assert {r.page_id: r.verdict for r in url_filter.judge_urls(table(spark, two, "page_id long, url string, html string"), rules, bad).collect()}[1] == want
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_text_oracles(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        c.execute(f"create view {t} as select * from read_parquet('{MIDDLE}/{t}.parquet')")
    found = c.execute(queries.ORACLES[name])
    columns = [d[0] for d in found.description]
    want = found.fetchall()
    got = queries.QUERIES[name](spark, MIDDLE)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, got.select(columns).collect()))) == sorted(map(str, want))


def test_a_map_task_of_the_suffix_arrays_holds_its_bytes_a_few_times():
    """Places of bytes, eight times as large as these, are made for some entries at a time."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 123, 20_000, np.uint8)).decode() for _ in range(400)]
    batch = pa.table({"doc": pa.array(range(400), pa.int64()), "text": texts}).to_batches()
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in suffix_dedup._map(100, 1, np.zeros(0, np.uint64))(batch)) == 1
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 200 << 20
    begin, size = np.arange(9000) * 3, np.arange(9000) % 7
    source = rng.integers(0, 256, 28_000, np.uint8)
    assert suffix_dedup._runs(source, begin, size).tobytes() == b"".join(source[b : b + s].tobytes() for b, s in zip(begin, size))
