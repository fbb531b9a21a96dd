"""A corpus pipeline: documents in a known language, civil, once each, free of benchmark items, tokenised.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a frame.
All but the last return the columns of ``docs``.  ``run`` writes each result as Parquet in the
folder that the cluster shares and reads it again as the next stage's documents.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabulae.llm import bpe, decontaminate, language, near_dup, toxicity
from tabulae.llm.common import written
from tabulae.llm.queries import WORD_VOCABULARY, table, vocabulary_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the model; texts without letters and those in none of them go."""
    return language.keep_known(docs, language.fit(docs))


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier doesn't call toxic."""
    return toxicity.keep_civil(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates (five words, 0.8)."""
    return near_dup.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number and a digest of what they decode to."""
    return bpe.tokenised(docs, vocabulary_path(WORD_VOCABULARY))


STAGES = [
    ("language_id", language_id),
    ("toxicity", civil),
    ("minhash_dedup", near_dedup),
    ("decontamination", benchmark_free),
    ("bpe", tokens),
]

#: The stages fit models and follow links, which SQL can't express; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs)
    return docs
