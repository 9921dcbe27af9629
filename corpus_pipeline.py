"""Cleaning pipeline over documents: language ID, exact dedup, n-gram Jaccard join, substring dedup, best-fit packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from attestor.llm import pipeline as steps

STAGES = [
    ("language_id", steps.known_language),
    ("exact_dedup", steps.distinct_texts),
    ("ngram_jaccard_join", steps.one_of_each_group),
    ("substring_dedup", steps.without_repeats),
    ("best_fit_packing", steps.packed),
]

#: Language ID, shingle joins and tokenizers aren't SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = steps.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = steps.kept(stage(spark, docs, sf_dir), name)
    return docs
