"""Stages of corpus_pipeline.py: each takes (spark, docs, sf_dir) and returns what it keeps, with documents' columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh, table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def kept(df: DataFrame, name: str) -> DataFrame:
    """A stage's result, written as Parquet and read again."""
    return cut(df, f"stage-{name}")


def known_language(spark, docs, sf_dir):
    """Documents whose language is known with calibrated confidence."""
    from .language_id import predict, train

    (found,) = fresh(docs, "found")
    return predict(docs, train(docs), found).where(~F.col(found)["rejected"]).select(*docs.columns)


def distinct_texts(spark, docs, sf_dir):
    """Of texts equal but for white space, the longest, then the smallest doc_id."""
    from .exact_dedup import distinct_documents

    return distinct_documents(docs)


def one_of_each_group(spark, docs, sf_dir):
    """Of linked documents, the one with the smallest doc_id, null last; rows are told apart by doc_id and text."""
    from .ngram_join import ngram_components

    key, gone = fresh(docs, "key", "gone")
    keyed = docs.withColumn(key, F.shiftrightunsigned(F.xxhash64("doc_id", F.col("doc_id").isNull(), "text"), 1))
    groups = ngram_components(keyed.select(F.col(key).alias("doc_id"), "text")).select(F.col("doc_id").alias(gone), F.col("component_id").alias("component"))
    shared = groups.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
    linked = cut(groups.join(shared, "component"), "linked")
    ranked = linked.join(keyed.select(F.col(key).alias(gone), F.col("doc_id").alias("id")), gone).withColumn("rank", F.struct(F.col("id").isNull().alias("none"), "id", F.col(gone).alias("key")))
    first = ranked.groupBy("component").agg(F.min("rank").getField("key").alias("stays"))
    lost = linked.join(first, "component").where(F.col(gone) != F.col("stays")).select(gone).distinct()
    return keyed.join(lost, F.col(key) == F.col(gone), "left_anti").drop(key)


def without_repeats(spark, docs, sf_dir):
    """Documents without passages that an earlier document has; what is left empty by that goes."""
    from .substring_dedup import remove_repeats

    (removal,) = fresh(docs, "removal")
    changed = F.col(removal)["n_removed"] > 0
    out = remove_repeats(docs, removal).where(~changed | (F.length(F.trim("text")) > 0))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def packed(spark, docs, sf_dir):
    """Places of all documents in sequences of 1024 tokens."""
    from .packing import packed_pieces

    return packed_pieces(docs)
