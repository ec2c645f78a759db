"""Corpus preparation: five stages over ``documents``, each one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet below ``spark.checkpoint.dir`` and reads it back as the
next stage's docs.  All but the last return the columns of ``documents``; an
input column named like one the last stage adds is replaced.

Decisions: language ID drops documents without a letter or with a top
probability below ``MIN_SCORE``, and only those without a letter when no row has
a language label; near-dedup keeps the smallest doc_id of each
group, and different texts under one doc_id unless they are near duplicates; suffix dedup removes every repeated 200-byte string and then documents
left without a word; decontamination drops documents holding a benchmark item;
BPE adds ids, their count and the decoded text.  Null or empty texts go in the
first stage, so later stages see texts only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import bpe, decontaminate, lang_id, near_dedup, suffix_levels
from starload.llm._work import Workspace
from starload.llm.queries import importable, table, vocabulary

MIN_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = lang_id.fit(docs)
    if model is None:        # no labelled row: nothing to tell languages apart by
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    marked = lang_id.predict(docs, model, *docs.columns, names=("__lang", "__score"))
    return marked.filter((F.col("__lang") != lang_id.UND) & (F.col("__score") >= MIN_SCORE)).select(docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicate(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    stripped = suffix_levels.strip(docs)
    left = stripped.filter(~F.col("__removed") | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        count = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        left = left.withColumn("n_chars", F.when(F.col("__removed"), count).otherwise(F.col("n_chars")))
    return left.select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("__leaks") == 0).select(docs.columns)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = [c for c in docs.columns if c not in ("ids", "decoded", "n_tokens")]
    coded = bpe.encode_documents(docs, vocabulary("word_bpe_49k.json"), *kept)
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language_id", language_id),
    ("minhash_near_dedup", minhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encode", bpe_encode),
]

#: Trained models, sketches and tokenizers: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = table(spark, sf_dir, "documents")
    with Workspace(spark, "pipeline") as ws:
        for name, stage in STAGES:
            docs = ws.stage(stage(spark, docs, sf_dir), name)
        return ws.finish(docs)
