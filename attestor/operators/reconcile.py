"""Putting two accounts of the same things together: merges of editions, pairing of leftovers, alignment, greedy matches."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Sequence
from difflib import SequenceMatcher
from itertools import product

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestor.functions.canon import canonical


def edition_merge(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Full outer merge on keys: equal in both is confirmed, different a conflict (a's value stays), one-sided reference.

    Written as a union and one grouping, so that neither side is shuffled twice.
    """
    both = a.select(*keys, F.col(value).alias("_a"), F.lit(None).cast(a.schema[value].dataType).alias("_b"), F.lit(1).alias("_in"))
    both = both.unionByName(b.select(*keys, F.lit(None).cast(b.schema[value].dataType).alias("_a"), F.col(value).alias("_b"), F.lit(2).alias("_in")))
    g = both.groupBy(*keys).agg(F.max("_a").alias("value_a"), F.max("_b").alias("value_b"), F.bit_or("_in").alias("_in"))
    confidence = F.when(F.col("_in") != 3, "reference").when(F.col("value_a").eqNullSafe(F.col("value_b")), "confirmed").otherwise("conflict")
    return g.select(*keys, F.when(F.col("_in") == 2, F.col("value_b")).otherwise(F.col("value_a")).alias("value"), confidence.alias("confidence"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("a+b")), F.col("_in")).alias("basis"))


def pad_merge(a: DataFrame, b: DataFrame, keys: Sequence[str], pin: str, pad: str) -> DataFrame:
    """Merge of two editions of (keys, pin, pad): in both `confirmed`; one-sided `reference`.

    Where both have the pin with no pad in common, a's rows are a `conflict` that tells b's pads, and b's rows go.
    """
    k = [*keys, pin]
    merged = set_merge(a, b, [*k, pad])
    mine = a.groupBy(*k).agg(F.collect_set(pad).alias("_a"))
    theirs = b.groupBy(*k).agg(F.array_sort(F.collect_set(pad)).alias("_b"))
    apart = mine.join(theirs, k).where(~F.arrays_overlap("_a", "_b")).select(*k, F.array_join("_b", ",").alias("other"))
    rows = merged.join(apart, k, "left").where("other is null or in_a")
    return rows.select(*k, pad, F.when(F.col("other").isNotNull(), "conflict").otherwise(F.col("confidence")).alias("confidence"), F.when(F.col("other").isNotNull(), F.concat(F.lit("a+!b("), F.col("other"), F.lit(")"))).when(F.col("in_a") & F.col("in_b"), "a+b").when(F.col("in_a"), "a").otherwise("b").alias("basis"))


def set_merge(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Union of two sets of rows with the sides that have each."""
    both = a.select(*columns).distinct().withColumn("_in", F.lit(1)).unionByName(b.select(*columns).distinct().withColumn("_in", F.lit(2)))
    g = both.groupBy(*columns).agg(F.bit_or("_in").alias("_in"))
    return g.select(*columns, (F.col("_in").bitwiseAND(1) > 0).alias("in_a"), (F.col("_in").bitwiseAND(2) > 0).alias("in_b"), F.when(F.col("_in") == 3, "confirmed").otherwise("reference").alias("confidence"))


def residual_pairs(a: DataFrame, b: DataFrame, group: Sequence[str], item: str) -> DataFrame:
    """What only one side has, paired where a group has exactly one such item on either side."""
    left = a.select(*group, item).distinct().join(b.select(*group, item).distinct(), [*group, item], "left_anti")
    right = b.select(*group, item).distinct().join(a.select(*group, item).distinct(), [*group, item], "left_anti")
    x = left.groupBy(*group).agg(F.count("*").alias("na"), F.min(item).alias("item_a"))
    y = right.groupBy(*group).agg(F.count("*").alias("nb"), F.min(item).alias("item_b"))
    return x.join(y, list(group)).where("na = 1 and nb = 1").select(*group, "item_a", "item_b")


def align(df: DataFrame, group: Sequence[str], side: str, pos: str | Sequence[str], value: str, canon: Callable = canonical) -> DataFrame:
    """Order-preserving alignment of the two sides of each group, on canonical values, by contiguous matching blocks.

    Values that are alike are `confirmed`, each in its own spelling; a gap of one value on either side is a `conflict`;
    what else stands between blocks is one-sided `reference`.  Blanks aren't aligned.  Sequences are one group's, so a
    task holds one group; groups must fit in memory.
    """
    order = [pos] if isinstance(pos, str) else list(pos)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        key = pdf.iloc[0][list(group)].tolist()
        spelt, alike = zip(*(((s := pdf[pdf[side] == n].sort_values(order))[value].tolist(), s["_canon"].tolist()) for n in (0, 1)), strict=True)
        rows = []
        for kind, a, b, c, d in SequenceMatcher(None, *alike, autojunk=False).get_opcodes():
            if kind == "equal" or (kind == "replace" and b - a == d - c == 1):
                rows += [(x, y, "confirmed" if kind == "equal" else "conflict") for x, y in zip(spelt[0][a:b], spelt[1][c:d], strict=True)]
            else:
                rows += [(x, None, "reference") for x in spelt[0][a:b]] + [(None, y, "reference") for y in spelt[1][c:d]]
        return pd.DataFrame([(*key, n, *r) for n, r in enumerate(rows)], columns=[*group, "n", "left", "right", "confidence"])

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in group)
    kind = df.schema[value].dataType.simpleString()
    stated = df.withColumn("_canon", canon(value)).where("_canon is not null")
    return stated.groupBy(*group).applyInPandas(run, f"{schema}, n int, left {kind}, right {kind}, confidence string")


def rank_match(left: DataFrame, right: DataFrame, keys: Sequence[str], order_left: Sequence[str], order_right: Sequence[str], id_left: str, id_right: str) -> DataFrame:
    """One-to-one matches of rows with equal keys in order: the n-th of one side takes the n-th of the other, in one shuffle."""
    rank = lambda df, order: df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    both = rank(left, order_left).select(*keys, "_n", F.col(id_left).alias("left_id"), F.lit(None).cast(right.schema[id_right].dataType).alias("right_id"))
    both = both.unionByName(rank(right, order_right).select(*keys, "_n", F.lit(None).cast(left.schema[id_left].dataType).alias("left_id"), F.col(id_right).alias("right_id")))
    return both.groupBy(*keys, "_n").agg(F.max("left_id").alias("left_id"), F.max("right_id").alias("right_id")).drop("_n")


def greedy_match(left: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[str], equal: Sequence[str], if_both: Sequence[str]) -> DataFrame:
    """One-to-one matches of a key's rows in order, each left row taking the first right row that is still free and agrees.

    Rows agree if all `equal` columns are the same and those of `if_both` wherever both sides state them: `confirmed`, and
    the left row's blanks are filled from the right.  A left row without such a partner takes the first free row: a
    `conflict`, with the columns that differ.  Else it is `reference`; right rows left over are not returned.

    What a row takes depends on what earlier ones took, so a task runs through one key; both sides meet in one shuffle.
    Rows are streamed in Arrow batches: what a task holds is one key's right rows, and a row costs the same however many.
    """
    shown = [*equal, *if_both]
    names = [*keys, *order, *shown]
    both = left.select(*names).withColumn("_side", F.lit(0)).unionByName(right.select(*names).withColumn("_side", F.lit(1)))
    first = [*[F.col(c) for c in keys], F.desc("_side"), *[F.asc_nulls_last(c) for c in order]]
    at = {c: i for i, c in enumerate(names)}

    def run(batches):
        key, free = None, None
        for batch in batches:
            own = list(zip(*(_values(batch.column(at[c]), _NAN) for c in keys), strict=True))
            same, both_ = (list(zip(*(_values(batch.column(at[c])) for c in some), strict=True)) or [()] * batch.num_rows for some in (equal, if_both))
            side = batch.column(len(names)).to_pylist()
            filled, taken, confidence, differ = [], [], [], []
            for k, s, e, b in zip(own, side, same, both_, strict=True):
                if free is None or k != key:
                    key, free = k, _Free()
                if s:
                    free.add(e, b)
                    continue
                n = free.agreeing(e, b)
                if n is not None:
                    filled.append(tuple(y if x is None else x for x, y in zip(b, free.rows[n][1], strict=True)))
                    confidence.append("confirmed")
                    differ.append("")
                else:
                    n = free.first()
                    filled.append(b)
                    confidence.append("reference" if n is None else "conflict")
                    differ.append("" if n is None else ",".join(f"{c}={'' if y is None else y}" for c, x, y in zip(shown, e + b, sum(free.rows[n], ()), strict=True) if x != y))
                if n is not None:
                    free.taken[n] = 1
                taken.append(n)
            out = batch.filter(pa.array([not s for s in side], pa.bool_()))
            columns = [out.column(at[c]) for c in names[: len(names) - len(if_both)]]
            columns += [pa.array([f[i] for f in filled], out.column(at[c]).type) for i, c in enumerate(if_both)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(taken, pa.int32()), pa.array(confidence, pa.string()), pa.array(differ, pa.string())], [*names, "taken", "confidence", "differ"])

    schema = ", ".join(f"`{c}` {left.schema[c].dataType.simpleString()}" for c in names) + ", taken int, confidence string, differ string"
    return both.repartition(*keys).sortWithinPartitions(*first).mapInArrow(run, schema)


_NAN = float("nan")


def _values(column: pa.Array, nan: float | None = None) -> list:
    """A column's values, with a blank or one and the same object for every NaN."""
    values = column.to_pylist()
    return [nan if v != v else v for v in values] if pa.types.is_floating(column.type) else values


class _Free:
    """The right rows of one key in order, those taken, and the free ones by their values."""

    def __init__(self):
        self.rows, self.taken, self.by, self.least, self._kept = [], bytearray(), {}, 0, {}

    def add(self, equal: tuple, if_both: tuple) -> None:
        row = (equal, if_both)
        self.rows.append(self._kept.setdefault(row, row))  # rows alike are one object
        self.taken.append(0)

    def first(self) -> int | None:
        at = self.taken.find(0, self.least)
        self.least = len(self.taken) if at < 0 else at
        return None if at < 0 else at

    def agreeing(self, equal: tuple, if_both: tuple) -> int | None:
        """The first free row with the same `equal` and no other value of if_both where both state one."""
        stated = tuple(i for i, v in enumerate(if_both) if v is not None)
        if stated not in self.by:  # rows by `equal` and by their own values, or blanks, in the columns that are stated
            index = self.by[stated] = {}
            for n, (e, b) in enumerate(self.rows):
                if not self.taken[n]:
                    index.setdefault((e, *[b[i] for i in stated]), deque()).append(n)
        best, index = None, self.by[stated]
        for values in product(*[(if_both[i], None) for i in stated]):
            queue = index.get((equal, *values))
            while queue and self.taken[queue[0]]:
                queue.popleft()
            if queue and (best is None or queue[0] < best):
                best = queue[0]
        return best


def consensus(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """A value only where all occurrences agree."""
    g = df.groupBy(*group).agg(F.countDistinct(value).alias("spellings"), F.min(value).alias("_v"))
    return g.select(*group, F.when(F.col("spellings") == 1, F.col("_v")).alias("value"), "spellings")


def union_merge(df: DataFrame, keys: Sequence[str], rest: Sequence[str], items: str) -> DataFrame:
    """Lists united where all else is equal; a key with several variants of the rest is marked as disagreeing."""
    g = df.groupBy(*keys, *rest).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(items)))).alias(items))
    n = df.select(*keys, *rest).distinct().groupBy(*keys).agg((F.count("*") > 1).alias("disagrees"))
    return g.join(n, list(keys))
