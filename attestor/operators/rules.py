"""Integrity rules over tables: each gives (rule, key, detail) rows; no rule collects anything."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row(df: DataFrame, rule: str, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def foreign_key(rule: str, child: DataFrame, column: str, parent: DataFrame, parent_column: str, separator: str | None = None) -> DataFrame:
    """Values of the child without a parent; empty cells don't count, lists are taken apart."""
    value = F.explode(F.split(F.nullif(F.col(column), F.lit("")), separator)) if separator else F.col(column)
    rows = child.select(value.alias("_v")).where("_v is not null").distinct()
    return _row(rows.join(parent.select(F.col(parent_column).alias("_v")).distinct(), "_v", "left_anti"), rule, F.col("_v"), F.lit("no such parent"))


def composite_key(rule: str, child: DataFrame, parent: DataFrame, columns: Sequence[str]) -> DataFrame:
    rows = child.select(*columns).na.drop().distinct().join(parent.select(*columns).distinct(), list(columns), "left_anti")
    return _row(rows, rule, F.concat_ws("|", *columns), F.lit("no such parent"))


def unique(rule: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    g = df.groupBy(*columns).agg(F.count("*").alias("_n")).where("_n > 1")
    return _row(g, rule, F.concat_ws("|", *columns), F.col("_n"))


def shape(rule: str, df: DataFrame, key: str, column: str, pattern: str) -> DataFrame:
    return _row(df.where(F.col(column).isNotNull() & ~F.col(column).cast("string").rlike(pattern)), rule, F.col(key), F.col(column))


def holds(rule: str, df: DataFrame, key: str, condition: Column, detail: Column) -> DataFrame:
    """Rows where a condition isn't true; unknown is no violation."""
    return _row(df.where(~condition), rule, F.col(key), detail)


def implies(rule: str, df: DataFrame, key: str, premise: Column, conclusion: Column, detail: Column) -> DataFrame:
    return _row(df.where(premise & ~conclusion), rule, F.col(key), detail)


def both_or_neither(rule: str, df: DataFrame, key: str, a: str, b: str) -> DataFrame:
    return _row(df.where(F.col(a).isNull() != F.col(b).isNull()), rule, F.col(key), F.lit(f"{a} without {b}"))


def mutually_exclusive(rule: str, df: DataFrame, key: str, a: str, b: str) -> DataFrame:
    return _row(df.where(F.col(a).isNotNull() & F.col(b).isNotNull()), rule, F.col(key), F.lit(f"{a} and {b}"))


def intervals_overlap(rule: str, df: DataFrame, block: Sequence[str], start: str, end: str, key: str) -> DataFrame:
    """Half-open ranges that begin before an earlier one of their block has ended, by a running maximum."""
    from pyspark.sql import Window

    w = Window.partitionBy(*block).orderBy(start, end, key).rowsBetween(Window.unboundedPreceding, -1)
    return _row(df.withColumn("_e", F.max(end).over(w)).where(F.col(start) < F.col("_e")), rule, F.col(key), F.col("_e"))


def bits_overlap(rule: str, df: DataFrame, block: Sequence[str], bits: str) -> DataFrame:
    """Bits of a block that more than one row claims."""
    g = df.select(*block, F.explode(bits).alias("_bit")).groupBy(*block, "_bit").count().where("count > 1")
    return _row(g, rule, F.concat_ws("|", *block, "_bit"), F.col("count"))


def equal_across(rule: str, a: DataFrame, b: DataFrame, keys: Sequence[str], left: str, right: str) -> DataFrame:
    both = a.select(*keys, F.col(left).alias("_l")).join(b.select(*keys, F.col(right).alias("_r")), list(keys))
    return _row(both.where("_l <> _r"), rule, F.concat_ws("|", *keys), F.concat_ws(" <> ", F.col("_l").cast("string"), F.col("_r").cast("string")))


@dataclass
class Rule:
    name: str
    violations: DataFrame


def violations(frames: Sequence[DataFrame]) -> DataFrame:
    """Distinct violations of all rules."""
    return reduce(DataFrame.unionByName, frames).distinct()


def counts(names: Sequence[str], frames: Sequence[DataFrame]) -> DataFrame:
    """Violations per rule, 0 included."""
    spark = frames[0].sparkSession
    named = spark.createDataFrame([(n,) for n in names], "rule string")
    return named.join(violations(frames).groupBy("rule").agg(F.count("*").alias("_n")), "rule", "left").select("rule", F.coalesce("_n", F.lit(0)).alias("violations"))
