"""Evidence: readings and checks of a fact, judged to a value with a confidence and a basis.

A fact table has a key, and per row: ord (the order of evidence), kind ('reading' or 'check'), source, value, agreed and
soft (for checks).  Confidence: no reading is `missing`; readings that differ, or a hard check that failed, `conflict`;
readings and agreeing checks of at least two in all `confirmed`; else `reference`.  The value is the first reading's own
spelling; comparison uses the canonical form.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestor.functions.canon import canonical


def readings(df: DataFrame, keys: Sequence[str], ord: int, source: str, value: Column) -> DataFrame:
    """Evidence rows of one source; a blank value is no reading."""
    out = df.select(*keys, F.lit(ord).alias("ord"), F.lit("reading").alias("kind"), F.lit(source).alias("source"), value.cast("string").alias("value"))
    out = out.withColumn("agreed", F.lit(None).cast("boolean")).withColumn("soft", F.lit(False))
    return out.where(F.coalesce(F.trim("value"), F.lit("")) != "")


def checks(df: DataFrame, keys: Sequence[str], ord: int, rule: str, agreed: Column, soft: bool = False) -> DataFrame:
    """Evidence rows of a rule that each fact passes or fails; a NULL outcome is no evidence."""
    out = df.select(*keys, F.lit(ord).alias("ord"), F.lit("check").alias("kind"), F.lit(rule).alias("source"), F.lit(None).cast("string").alias("value"), agreed.alias("agreed"))
    return out.withColumn("soft", F.lit(soft)).where("agreed is not null")


def dedup_evidence(df: DataFrame, keys: Sequence[str], canon: Callable = canonical) -> DataFrame:
    """The first reading of each source and canonical value; checks stay."""
    w = Window.partitionBy(*keys, "kind", "source", canon("value")).orderBy("ord")
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1 or kind = 'check'").drop("_n")


def judge(df: DataFrame, keys: Sequence[str], canon: Callable = canonical) -> DataFrame:
    """keys, value, confidence, basis: one row a fact, by one grouped aggregation without Python.

    Value and confidence come from sums that are folded before the shuffle; only the basis, which names all evidence,
    is gathered a fact.
    """
    reading, check = F.col("kind") == "reading", F.col("kind") == "check"
    said = F.when(reading | F.col("agreed"), F.col("source")).when(F.col("soft"), F.concat(F.lit("?"), "source")).otherwise(F.concat(F.lit("!"), "source"))
    spelt = F.coalesce(canon("value"), F.lit("\0"))
    g = df.groupBy(*keys).agg(
        F.count_if(reading).alias("_r"),
        F.count_if(check & F.col("agreed")).alias("_agreed"),
        (F.min(F.when(reading, spelt)) != F.max(F.when(reading, spelt))).alias("_differ"),
        F.coalesce(F.bool_or(check & ~F.col("agreed") & ~F.col("soft")), F.lit(False)).alias("_broken"),
        F.min(F.when(reading, F.struct("ord", "source", "value"))).alias("_first"),
        F.array_sort(F.collect_list(F.struct("ord", "source", "kind", "agreed", "soft", said.alias("said")))).alias("_e"),
    )
    confidence = F.when(F.col("_r") == 0, "missing").when(F.col("_differ") | F.col("_broken"), "conflict").when(F.col("_r") + F.col("_agreed") >= 2, "confirmed").otherwise("reference")
    return g.select(*keys, F.col("_first.value").alias("value"), confidence.alias("confidence"), F.array_join(F.col("_e.said"), "+").alias("basis"))


def tally(df: DataFrame, column: str = "confidence") -> DataFrame:
    """Histogram of a column."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def rollup(df: DataFrame, group: Sequence[str], value: str, confidence: str) -> DataFrame:
    """Members' values to one: the single value, or none where they vary or none is stated.

    Confidence: confirmed only if every member that states it is, else partial; varies; missing.
    """
    stated = F.when(F.coalesce(F.trim(F.col(value).cast("string")), F.lit("")) != "", F.col(value).cast("string"))
    g = df.groupBy(*group).agg(
        F.countDistinct(stated).alias("_d"), F.min(stated).alias("_v"), F.bool_and(F.when(stated.isNotNull(), F.coalesce(F.col(confidence) == "confirmed", F.lit(False)))).alias("_all"), F.count(stated).alias("members_stated"), F.count("*").alias("members")
    )
    return g.select(
        *group,
        F.when(F.col("_d") == 1, F.col("_v")).alias("value"),
        F.when(F.col("_d") == 0, "missing").when(F.col("_d") > 1, "varies").when(F.col("_all"), "confirmed").otherwise("partial").alias("confidence"),
        "members_stated",
        "members",
    )


def pooled(members: DataFrame, evidence: DataFrame, member: str, group: Sequence[str], canon: Callable = canonical) -> DataFrame:
    """Judges each group once on all of its members' evidence together; a source that says the same thing again counts once."""
    rows = members.select(member, *group).distinct().join(evidence, member)
    return judge(dedup_evidence(rows, group, canon), group, canon)
