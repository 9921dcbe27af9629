"""Order-dependent operators as window functions: carry-forward, islands, sessions, offsets, density."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestor.operators.resolve import written


def _w(group: Sequence[str], order: Sequence) -> Window:
    return Window.partitionBy(*group).orderBy(*order)


def locf(df: DataFrame, group: Sequence[str], order: Sequence, column: str, out: str) -> DataFrame:
    """The last value that isn't NULL, up to the row."""
    w = _w(group, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(column, ignorenulls=True).over(w))


def locf_within(df: DataFrame, group: Sequence[str], order: Sequence, level: Column, column: str, out: str) -> DataFrame:
    """Carry-forward that a row where `level` holds resets."""
    w = _w(group, order).rowsBetween(Window.unboundedPreceding, 0)
    marked = df.withColumn("_level", F.sum(level.cast("int")).over(w))
    return locf(marked, [*group, "_level"], order, column, out).drop("_level")


def running_offset(df: DataFrame, group: Sequence[str], order: Sequence, size: str, out: str) -> DataFrame:
    """Exclusive running sum, for groups that one task can run through."""
    w = _w(group, order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(size).over(w), F.lit(0)))


def spread_offset(df: DataFrame, group: Sequence[str], order: Sequence[str], size: Column, out: str) -> DataFrame:
    """Exclusive running sum over groups of any size: rows are dealt by ranges of group and order, summed up within each.

    A range adds what the group has in the ranges before it, of which there is one row for each range and group.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(df.withColumn("_size", size).repartitionByRange(n, *group, *order).withColumn("_range", F.spark_partition_id()))
    sums = dealt.groupBy(*group, "_range").agg(F.sum("_size").alias("_s"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_s").over(_w(group, ["_range"]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_s")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*group, "_range"]]
    joined = dealt.alias("d").join(before.alias("b"), same).select("d.*", "b._before")
    inner = F.sum("_size").over(_w([*group, "_range"], order).rowsBetween(Window.unboundedPreceding, -1))
    return joined.withColumn(out, F.col("_before") + F.coalesce(inner, F.lit(0))).drop("_size", "_range", "_before")


def islands(df: DataFrame, group: Sequence[str], order: Sequence, column: str, out: str = "island") -> DataFrame:
    """Numbers the runs of equal values from 1."""
    w = _w(group, order)
    change = F.when(F.lag(column).over(w).eqNullSafe(F.col(column)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("_c", change).withColumn(out, F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_c")


def gap_sessions(df: DataFrame, group: Sequence[str], order: Sequence, start: Column, end: Column, gap: int, out: str = "session") -> DataFrame:
    """Numbers the clusters of intervals: a new one begins where more than `gap` lies behind all earlier ends."""
    w = _w(group, order)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (start - before > gap), 1).otherwise(0)
    return df.withColumn("_c", new).withColumn(out, F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_c")


def next_different(df: DataFrame, group: Sequence[str], order: Sequence, column: str, out: str) -> DataFrame:
    """The value of the next run, by windows of one sort."""
    w = _w(group, order)
    after = F.lead(F.struct(F.col(column).alias("v"))).over(w)
    marked = df.withColumn("_after", F.when(after.isNotNull() & ~after["v"].eqNullSafe(F.col(column)), after))
    return marked.withColumn(out, F.first("_after", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))["v"]).drop("_after")


def dense(df: DataFrame, group: Sequence[str], step: str) -> DataFrame:
    """Whether each group's steps are consecutive without repeats."""
    g = df.groupBy(*group).agg(F.count(step).alias("steps"), F.countDistinct(step).alias("_d"), F.min(step).alias("first"), F.max(step).alias("last"))
    return g.select(*group, "steps", "first", "last", ((F.col("last") - F.col("first") + 1 == F.col("steps")) & (F.col("_d") == F.col("steps"))).alias("dense"))


def ordinal(df: DataFrame, group: Sequence[str], order: Sequence, out: str) -> DataFrame:
    """Numbers from 0."""
    return df.withColumn(out, F.row_number().over(_w(group, order)) - 1)


def suffix_repeats(df: DataFrame, group: Sequence[str], name: str, order: Sequence, out: str) -> DataFrame:
    """Names made unique within the group: name, name_, name__ ..."""
    n = F.row_number().over(_w([*group, name], order))
    return df.withColumn(out, F.concat(F.col(name), F.repeat(F.lit("_"), n - 1)))


def share(df: DataFrame, group: Sequence[str], n: str, out: str) -> DataFrame:
    """n over the group's total."""
    return df.withColumn(out, F.col(n) / F.sum(n).over(Window.partitionBy(*group)))


def locf_array(x: Column | str) -> Column:
    """Carry-forward along an array: each NULL takes the last element before it."""
    a = F.col(x) if isinstance(x, str) else x
    empty = F.slice(a, 1, 0)
    return F.aggregate(a, empty, lambda acc, v: F.concat(acc, F.array(F.coalesce(v, F.when(F.size(acc) > 0, F.element_at(acc, -1))))))


def continued(df: DataFrame, group: Sequence[str], page: str, width: str, header: Column | None = None) -> DataFrame:
    """Numbers tables that go on: the next page of the same width continues the one before, unless it begins with a header."""
    w = _w(group, [page])
    goes_on = (F.col(page) - F.lag(page).over(w) == 1) & (F.lag(width).over(w) == F.col(width))
    if header is not None:
        goes_on = goes_on & ~header
    marked = df.withColumn("_new", F.when(goes_on, 0).otherwise(1))
    return marked.withColumn("table", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
