"""A corpus pipeline of five stages over ``documents``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next one's ``docs``. All but the last
return the columns of ``documents``; doc_id is unique, as in ``documents``.
Rows with a null doc_id take no part in dedup and are kept by every filter.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import decontamination, language_id, near_dedup, packing, suffix_dedup
from helixframe.llm.queries import tokenizer_path
from helixframe.llm.textbytes import expanded, small_batches, squeezed
from helixframe.session import read_table, release, scratch, shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A repeated passage of this many bytes loses its later copies.
REPEAT_BYTES = 100
#: Benchmark windows of this many words are cut out; above this share the document goes.
WINDOW, COVERAGE = 10, 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without any letter; ``lang`` is the language found.

    Where no row has both a text and a ``lang``, no language is learned: the
    documents with a letter stay and ``lang`` is as given.
    """
    small_batches(spark)
    model = language_id.train(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}")).select(COLUMNS)
    found = language_id.identify(docs, model, keep=("text", "source", "n_chars"))
    return found.where("lang_pred <> 'und'").withColumn("lang", F.col("lang_pred")).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group."""
    small_batches(spark)
    gone = near_dedup.near_duplicates(docs).where("not kept").select("doc_id")
    kept = squeezed(docs.select(COLUMNS), "text").join(gone, "doc_id", "left_anti")
    return expanded(kept, "text").select(COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts later copies of long passages; a document of which nothing is left goes."""
    small_batches(spark)
    cut = suffix_dedup.dedup(docs, REPEAT_BYTES, keep=("lang", "source", "n_chars"), keep_text=True)
    whole = F.col("n_removed") == 0
    return cut.where("n_removed = 0 or kept_text <> ''").select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source",
        F.when(whole, F.col("n_chars")).otherwise(F.length("kept_text").cast("long")).alias("n_chars"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of ``benchmark``; a document that is mostly such passages goes."""
    small_batches(spark)
    clean = decontamination.scan(docs, read_table(spark, sf_dir, "benchmark"), WINDOW, clean=True, keep=("lang", "source", "n_chars"))
    return clean.where(F.col("coverage") <= COVERAGE).select(
        "doc_id", F.col("clean_text").alias("text"), "lang", "source",
        F.when(F.col("contaminated"), F.length("clean_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences."""
    small_batches(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", decontaminate),
    ("packing", pack),
]
#: SQL can say none of the stages' methods as a whole; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread; only the last stage's table stays."""
    docs, before = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        path = f"{shared_dir(spark).rstrip('/')}/pipeline-{name}-{uuid.uuid4().hex}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        release(spark, before)
        before = [path]
    return docs
