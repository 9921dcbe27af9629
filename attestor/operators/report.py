"""Report views: pivots, envelopes, collapsed values, signatures, ordered lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestor.functions.canon import capped
from attestor.operators.carry import spread_offset


def pivot_first(df: DataFrame, rows: str, columns: str, values: Sequence, value: Column, missing: str = "-") -> DataFrame:
    """One column for each listed value; blanks get a mark.  Values are listed, so that no extra job looks for them."""
    g = df.groupBy(rows).pivot(columns, list(values)).agg(value)
    return g.select(rows, *[F.coalesce(F.col(f"`{v}`").cast("string"), F.lit(missing)).alias(str(v)) for v in values])


def joined_set(x: Column | str, separator: str = ";") -> Column:
    """Aggregate: sorted distinct values in one text."""
    return F.array_join(F.array_sort(F.collect_set(x)), separator)


def joined_in_order(x: str, order: Sequence[str], separator: str = "/") -> Column:
    """Aggregate: values in order of appearance in one text."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(x).alias("_x")))), lambda s: s["_x"]), separator)


def most_common(df: DataFrame, group: Sequence[str], value: str, order: str) -> DataFrame:
    """The commonest value of each group; of equally common ones the one seen first."""
    g = df.groupBy(*group, value).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    best = F.max_by(F.struct(value, "n"), F.struct("n", -F.col("_first"))).alias("b")
    return g.groupBy(*group).agg(best).select(*group, f"b.{value}", "b.n")


def collapse(values: Column) -> Column:
    """Of an array of texts: 'yes' for the only mark, lo-hi for whole numbers, else sorted with '/'."""
    n = F.transform(values, lambda v: v.try_cast("long"))
    whole = F.forall(n, lambda v: v.isNotNull()) & (F.size(values) > 0)
    lo, hi = F.array_min(n), F.array_max(n)
    return F.when((F.size(values) == 1) & F.array_contains(values, "√"), "yes").when(whole & (lo == hi), lo.cast("string")).when(whole, F.concat_ws("-", lo.cast("string"), hi.cast("string"))).otherwise(F.array_join(F.array_sort(F.array_distinct(values)), "/"))


def envelope(df: DataFrame, group: Sequence[str], lo: str, hi: str) -> DataFrame:
    """The texts of the least and the largest number of each group."""
    return df.groupBy(*group).agg(F.min_by(F.col(lo).cast("string"), F.col(lo).try_cast("double")).alias("lo"), F.max_by(F.col(hi).cast("string"), F.col(hi).try_cast("double")).alias("hi"))


def priority_pick(df: DataFrame, group: Sequence[str], column: str, prefixes: Sequence[str]) -> DataFrame:
    """Of each group the values of the first prefix that has any, sorted."""
    rank = F.when(F.startswith(column, F.lit(prefixes[0])), 0)
    for n, p in enumerate(prefixes[1:], 1):
        rank = rank.when(F.startswith(column, F.lit(p)), n)
    ranked = df.withColumn("_r", rank).where("_r is not null")
    g = ranked.groupBy(*group, "_r").agg(joined_set(column).alias("picked"))
    return g.groupBy(*group).agg(F.min_by("picked", "_r").alias("picked"))


def content_groups(df: DataFrame, member: str, *columns: str) -> DataFrame:
    """Members grouped by their full content: a digest of the sorted rows, how many share it, and the first of them."""
    own = df.groupBy(member).agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", *columns))), ",").alias("content"))
    return own.groupBy("content").agg(F.count("*").alias("members"), F.min(member).alias("first_member"))


def partition_sum(df: DataFrame, group: Sequence[str], part: str, value: str) -> DataFrame:
    """A sum only where a group has two members or more, of one part, whose values are all numbers."""
    number = F.col(value).cast("string").try_cast("double")
    g = df.groupBy(*group).agg(F.count("*").alias("members"), F.countDistinct(part).alias("parts"), F.bool_and(number.isNotNull()).alias("_all"), F.sum(F.col(value).try_cast("long")).alias("_s"))
    return g.select(*group, "members", "parts", F.when((F.col("members") >= 2) & (F.col("parts") == 1) & F.col("_all"), F.col("_s")).alias("total"))


def top(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def first_items(df: DataFrame, group: Sequence[str], value: str, most: int) -> DataFrame:
    """The first distinct values in one text, with a mark if there are more."""
    g = df.groupBy(*group).agg(F.array_sort(F.collect_set(value)).alias("_a"))
    return g.select(*group, capped("_a", most).alias("items"), F.size("_a").alias("n_items"))


def lines(sections: Sequence[tuple[str, DataFrame, Column]]) -> DataFrame:
    """Sections as ordered lines: (section, ord, line), numbered across tasks, as a section may be of any size."""
    out = None
    for n, (name, df, line) in enumerate(sections):
        part = df.select(line.alias("line"))
        part = part.select(F.lit(n).alias("section_no"), F.lit(name).alias("section"), "line")
        out = part if out is None else out.unionByName(part)
    numbered = spread_offset(out, ["section_no"], ["line"], F.lit(1), "ord")
    return numbered.withColumn("ord", (F.col("ord") + 1).cast("int"))


def unique_or_none(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """A group's sorted values only if all are above 0 and none repeats."""
    g = df.groupBy(*group).agg(F.count(value).alias("_n"), F.countDistinct(value).alias("_d"), F.min(value).alias("_lo"), F.array_sort(F.collect_set(value)).alias("_a"))
    return g.select(*group, F.when((F.col("_n") == F.col("_d")) & (F.col("_lo") > 0), F.array_join(F.transform("_a", lambda v: v.cast("string")), ";")).alias("values"), F.col("_n").alias("observed"))


def differing_bits(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Bits in which a group's values differ: what some have and not all."""
    g = df.groupBy(*group).agg(F.bit_or(value).alias("_o"), F.bit_and(value).alias("_a"))
    return g.select(*group, F.col("_o").bitwiseXOR(F.col("_a")).alias("differ"))


def matrix(df: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """Row and column pairs with the sorted set of values: a pivot of sets in long form, whatever the columns are."""
    return df.groupBy(row, column).agg(joined_set(F.col(value).cast("string")).alias("values"))


def ranked(df: DataFrame, column: str, ranks: Sequence[str]) -> DataFrame:
    """Adds the place of the column's value in a fixed order; others come last."""
    place = F.array_position(F.array(*[F.lit(r) for r in ranks]), F.col(column))
    return df.withColumn("rank", F.when(place > 0, place.cast("int")).otherwise(len(ranks) + 1))


def distinct_in_order(df: DataFrame, group: Sequence[str], value: str, order: Sequence[str], out: str, separator: str = ";") -> DataFrame:
    """Each group's distinct values in order of their first appearance: repeats are folded before the shuffle."""
    first = df.groupBy(*group, value).agg(F.min(F.struct(*order)).alias("_o"))
    return first.groupBy(*group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", F.col(value).alias("_v")))), lambda s: s["_v"]), separator).alias(out))


def vote(df: DataFrame, group: Sequence[str], distance: Column, above: str, below: str, out: str) -> DataFrame:
    """Which side the distances of a group add up to more on; `below` if they are even."""
    d = df.withColumn("_d", distance).groupBy(*group).agg(F.sum(F.greatest("_d", F.lit(0))).alias("_a"), F.sum(F.greatest(-F.col("_d"), F.lit(0))).alias("_b"))
    return d.select(*group, F.when(F.col("_a") > F.col("_b"), above).otherwise(below).alias(out))


def as_text(*columns: str) -> list[Column]:
    """Sort columns in the order of their texts, numbers too: '10' before '9'."""
    return [F.col(c).cast("string").asc_nulls_first() for c in columns]


def by_frequency(df: DataFrame, column: str) -> DataFrame:
    """Values by how often they occur, ties by value."""
    g = df.groupBy(column).agg(F.count("*").alias("n"))
    return g.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), column)))


def first_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of each group; Spark keeps n a group before the shuffle, too."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def index_of(df: DataFrame, group: str, member: str, owner: str, most: int) -> DataFrame:
    """An index by group: where it is kept, how many members it has, and the first few of them."""
    g = df.groupBy(group).agg(F.count("*").alias("parts"), F.min(owner).alias("maker"), F.array_sort(F.collect_set(member)).alias("_m"))
    return g.select(group, "parts", "maker", capped(F.col("_m").cast("array<string>"), most).alias("shown"))


def searched(df: DataFrame, sets: dict[str, Sequence], shown: Sequence[str], text: str) -> DataFrame:
    """Rows that have one of the values of every set, and whose shown columns contain the text, whatever its case."""
    for column, values in sets.items():
        df = df.where(F.col(column).isin(*values)) if values else df
    return df.where(F.contains(F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in shown])), F.lit(text.lower())))


def context_windows(df: DataFrame, group: Sequence[str], start: str, end: str, window: int) -> DataFrame:
    """(group, start, end) of the hits that open a context: those that begin no earlier than `window` behind the last one's end.

    Hits inside a context are left out and don't lengthen it, so each group's hits are folded in order.
    """
    hits = df.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(F.col(start).alias("s"), F.col(end).alias("e")))).alias("_h"))
    kept = F.aggregate("_h", F.slice("_h", 1, 1), lambda acc, h: F.when(h["s"] >= F.element_at(acc, -1)["e"] + window, F.concat(acc, F.array(h))).otherwise(acc))
    return hits.select(*group, F.explode(kept).alias("_k")).select(*group, F.col("_k.s").alias(start), F.col("_k.e").alias(end))
