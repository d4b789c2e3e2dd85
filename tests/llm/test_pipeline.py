"""The pipeline's stages against brute force on their own inputs."""

import sys
import zlib

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from helixframe.llm import decontamination, queries
from helixframe.session import read_table
from tests.llm.test_text_operators import brute_groups, check_packing

SMALL = "/root/testdata/sf0.001"


def brute_cut(docs, length=100):
    seen, out = set(), {}
    for d, t in sorted(docs):
        raw = t.encode()
        hit = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            if w in seen:
                hit[p : p + length] = True
            seen.add(w)
        text = bytes(np.frombuffer(raw, np.uint8)[~hit]).decode(errors="ignore")
        if text or not hit.any():
            out[d] = text
    return out


def test_stages(spark, tmp_path):
    docs = read_table(spark, SMALL, "documents")
    extra = spark.createDataFrame([(900, "12 34", "en", "s", 5), (901, None, None, None, None), (902, "", "en", "s", 0)], docs.schema)
    now = docs.unionByName(extra)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in now.collect()} if k else None
        stage(spark, now, SMALL).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert now.columns == corpus_pipeline.COLUMNS
        rows = {r.doc_id: r for r in now.collect()} if k < 4 else now.collect()
        if name == "language_id":
            assert len(rows) == docs.count() and not set(rows) & {900, 901, 902}
        elif name == "near_dedup":
            want = brute_groups([(d, r.text) for d, r in before.items()], 80)
            assert set(rows) == {d for d, w in want.items() if w[2]}
        elif name == "suffix_dedup":
            assert {d: r.text for d, r in rows.items()} == brute_cut([(d, r.text) for d, r in before.items()])
        elif name == "decontamination":
            bench = [(str(r.item_id), decontamination.words(r.text)) for r in read_table(spark, SMALL, "benchmark").collect()]
            automaton = decontamination.Automaton(sorted(bench), 10)
            for d, r in before.items():
                n = int(automaton.hits(decontamination.words(r.text))[0].sum())
                assert (d in rows) == (n <= 0.5 * len(decontamination.words(r.text)))
                if not n:
                    assert rows[d] == r
        else:
            assert {r.doc_id for r in rows} == set(before) and check_packing(rows, 4096)


def test_language_stage_sets_lang(spark):
    docs = read_table(spark, SMALL, "documents")
    named = {r.doc_id: r.lang for r in docs.collect()}
    wrong = docs.where("lang = 'fr'").orderBy("doc_id").limit(3).select((F.col("doc_id") + 100000).alias("doc_id"), "text", F.lit("de").alias("lang"), "source", "n_chars")
    got = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, docs.unionByName(wrong), SMALL).collect()}
    assert [got[d] for d in sorted(got) if d >= 100000] == ["fr"] * 3
    assert sum(got[d] == v for d, v in named.items()) > 0.9 * len(named)


def test_language_stage_without_languages(spark):
    docs = read_table(spark, SMALL, "documents").withColumn("lang", F.lit(None).cast("string"))
    extra = spark.createDataFrame([(900, "12 34", None, "s", 5), (901, None, None, None, None), (902, "", None, "s", 0)], docs.schema)
    got = corpus_pipeline.identify_language(spark, docs.unionByName(extra), SMALL).collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in docs.collect()} and {r.lang for r in got} == {None}


def brute_hits(text, items, window=10):
    """Which words of a text an item's window covers, by comparing every place with every window."""
    tokens = decontamination.words(text)
    hit = np.zeros(len(tokens), bool)
    for item in items:
        n = min(len(item), window)
        known = {tuple(item[p : p + n]) for p in range(len(item) - n + 1)} if n else set()
        for p in range(len(tokens) - n + 1 if known else 0):
            if tuple(tokens[p : p + n]) in known:
                hit[p : p + n] = True
    return hit


def test_run_is_the_stages_by_brute_force(spark):
    """The whole pipeline: which documents are left, and the tokens of those that no benchmark passage touched."""
    from tokenizers import Tokenizer

    docs = {r.doc_id: r.text for r in read_table(spark, SMALL, "documents").collect() if any(c.isalpha() for c in r.text or "")}
    docs = {d: docs[d] for d, w in brute_groups(list(docs.items()), 80).items() if w[2]}
    docs = brute_cut(list(docs.items()))
    items = [decontamination.words(r.text) for r in read_table(spark, SMALL, "benchmark").collect()]
    hits = {d: brute_hits(t, items) for d, t in docs.items()}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == {d for d, h in hits.items() if h.sum() <= 0.5 * len(h)}
    encode = Tokenizer.from_file(queries.tokenizer_path()).encode
    for d, pieces in got.items():
        if not hits[d].any():
            ids = np.array([*encode(docs[d], add_special_tokens=False).ids, 1], "<u4")
            assert sum(r.length for r in pieces) == len(ids)
            assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in pieces)
    assert check_packing(rows, 4096) and sum(h.any() for h in hits.values())


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 100
    assert set(queries.ORACLES) <= set(queries.QUERIES)
