"""Which selector field routes a signal: resolution by steps of evidence, what values the field takes, who owns a route.

Fields are (series, key), with keys as signals.field spells them.  A function is a signal on a pad at a value.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.functions import signals


def owners(fields: DataFrame) -> DataFrame:
    """(series, owner): the names that some field of the series belongs to."""
    return fields.select("series", F.explode(F.array("key", F.substring_index("key", "_", 1))).alias("owner")).distinct()


def contradicted(key: Column, name: Column, has_own: Column) -> Column:
    """Whether names alone rule out that a field routes a peripheral: that has a field of its own, or another number."""
    return ~signals.owns(key, name) & (has_own | signals.other_instance(key, name))


def resolve(functions: DataFrame, fields: DataFrame, stated: DataFrame, pads: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(id, key, method) of functions (id, series, signal, value, pad) whose field can be told; others are left out.

    Steps: the field that `stated` (series, signal, value, pad, key) names, unless the names contradict it; the field of
    the signal's peripheral; the only field that a pad source (name, (series, pad, value, key)) has and the name allows;
    the only field that begins with the name, or whose name with digits is the signal.  Where the name can't be read,
    pads come last and are unchecked.  The first step that answers wins.
    """
    parsed = functions.withColumn("_p", signals.parse("signal"))
    f = parsed.select("id", "series", signals.comparable("signal").alias("signal"), "value", "pad", F.col("_p.peripheral").alias("named"), F.coalesce("_p.peripheral", F.substring_index("signal", "_", 1)).alias("head"))
    f = f.join(owners(fields).withColumnRenamed("owner", "head").withColumn("has_own", F.lit(True)), ["series", "head"], "left").withColumn("has_own", F.coalesce("has_own", F.lit(False)))
    keys, named = fields.select("series", "key").distinct(), F.col("named").isNotNull()
    steps: list[tuple[int, int, str, DataFrame]] = []  # rank with a readable name, rank without, method, (id, series, key, named)

    said = f.join(stated.select("series", signals.comparable("signal").alias("signal"), "value", "pad", "key").distinct(), ["series", "signal", "value", "pad"]).join(keys, ["series", "key"], "left_semi")
    steps.append((0, 0, "signal", said.where(~(named & contradicted(F.col("key"), F.col("head"), F.col("has_own"))))))
    steps.append((1, 1, "peripheral", f.where(named).withColumn("key", F.col("named")).join(keys, ["series", "key"], "left_semi")))
    for n, (name, source) in enumerate(pads):
        met = f.join(source.select("series", "pad", "value", "key").distinct(), ["series", "pad", "value"]).join(keys, ["series", "key"], "left_semi").where(~named | signals.owns("key", "head"))
        steps.append((2 + n, 3 + n, name, _only(met)))
    begun = f.join(keys.withColumn("head", F.substring_index("key", "_", 1)), ["series", "head"])
    numbered = F.startswith("signal", "key") & F.expr("substring(signal, length(key) + 1)").rlike("^[0-9]*$")
    last = 2 + len(pads)
    steps.append((last, 2, "prefix", _only(begun).unionByName(_only(begun.where(numbered)))))
    found = reduce(DataFrame.unionByName, [df.select("id", "key", F.when(named, a).otherwise(b).alias("step"), F.lit(method).alias("method")) for a, b, method, df in steps])
    best = F.min_by(F.struct("key", "method"), F.struct("step", "key")).alias("b")
    return found.groupBy("id").agg(best).select("id", "b.key", "b.method")


def _only(df: DataFrame) -> DataFrame:
    """Functions with exactly one candidate."""
    g = df.groupBy("id").agg(F.min("key").alias("key"), F.min("named").alias("named"), F.countDistinct("key").alias("_n"))
    return g.where("_n = 1").drop("_n")


def misplaced(routes: DataFrame, fields: DataFrame) -> DataFrame:
    """Routes (series, selector, signal, peripheral) that stand under the field (series, selector, key) of another owner.

    Only what names refute is reported: the peripheral has a field of its own, or differs in the instance number only.
    """
    known = fields.select("series", F.substring_index("key", "_", 1).alias("peripheral")).distinct().withColumn("has_own", F.lit(True))
    rows = routes.where("peripheral is not null and peripheral <> ''").join(fields.select("series", "selector", "key"), ["series", "selector"]).join(known, ["series", "peripheral"], "left")
    return rows.where(contradicted(F.col("key"), F.col("peripheral"), F.coalesce("has_own", F.lit(False)))).drop("has_own")


def value_union(fields: DataFrame, sources: Sequence[tuple[str, str]], default: str = "default only") -> DataFrame:
    """fields (key, width and an array a source) with the values that any source states, 0 included.

    sources are (column, name); a NULL or empty array states nothing.  Values that the width can't hold are left out and
    listed in `over`; `source` names the sources that state any; `only_last` has what the last source alone states and
    `beyond_first` what the others but the first do, if the first states any.
    """
    none = F.array().cast("array<int>")
    lists = [F.coalesce(F.col(c).cast("array<int>"), none) for c, _ in sources]
    every = F.array_distinct(F.concat(*lists))
    limit = F.expr("shiftleft(1, cast(width as int))")
    fits, over = F.filter(every, lambda v: v < limit), F.filter(every, lambda v: v >= limit)
    names = F.filter(F.array(*[F.when(F.size(x) > 0, n) for x, (_, n) in zip(lists, sources, strict=True)]), lambda n: n.isNotNull())
    others = F.array_distinct(F.concat(*lists[:-1]))
    second = F.when((F.size(lists[0]) > 0), F.array_except(lists[1], lists[0])).otherwise(none)
    return fields.select(
        "*",
        F.array_sort(F.array_union(fits, F.array(F.lit(0)))).alias("values"),
        F.when(F.size(names) > 0, F.array_join(names, "+")).otherwise(default).alias("source"),
        F.array_sort(over).alias("over"),
        F.array_sort(F.array_except(lists[-1], others)).alias("only_last"),
        F.array_sort(second).alias("beyond_first"),
    )


def last_edition(df: DataFrame, key: Sequence[str], order: str, value: str) -> DataFrame:
    """The value that the last edition states, and a note of those that said otherwise: 'v1 -> v2' at every change."""
    stated = df.where(F.col(value).isNotNull()).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(order, value))).alias("_e"))
    told = F.col(f"_e.{value}")
    changes = F.filter(F.transform(F.sequence(F.lit(1), F.size(told) - 1), lambda i: F.when((i < F.size(told)) & (F.get(told, i) != F.get(told, i - 1)), F.concat(F.get(told, i - 1).cast("string"), F.lit(" -> "), F.get(told, i).cast("string")))), lambda x: x.isNotNull())
    return stated.select(*key, F.element_at(told, -1).alias(value), F.when(F.size(told) > 1, F.nullif(F.array_join(changes, "; "), F.lit(""))).alias("note"))


def complete_bits(fields: DataFrame, more: DataFrame, most: int) -> DataFrame:
    """Bits of fields (key, register, bits) completed from another source's (key, register, bits) of other registers.

    A register that the field has already isn't taken; `note` then says whether the bits differ.  The same bits under
    another name are one register spelled twice, and a field of over `most` bits in all is none.
    """
    own = fields.select("key", F.col("register").alias("own"), F.array_sort("bits").alias("own_bits"))
    both = own.join(more.select("key", "register", F.array_sort("bits").alias("bits")), "key", "left")
    note = (
        F.when(F.col("register").isNull(), "alone")
        .when(F.col("register") == F.col("own"), F.when(F.col("bits") == F.col("own_bits"), "same").otherwise("differs"))
        .when(F.size("own_bits") + F.size("bits") > most, "too wide")
        .when(F.col("bits") == F.col("own_bits"), "other name")
        .otherwise("completed")
    )
    noted = both.withColumn("note", note)
    added = F.array_sort(F.collect_list(F.when(F.col("note") == "completed", F.struct("register", "bits")))).alias("_more")
    g = noted.groupBy("key", "own", "own_bits").agg(added, F.array_sort(F.collect_set("note")).alias("notes"))
    labels = lambda register, bits: F.transform(bits, lambda b: F.concat_ws(":", register, b.cast("string")))
    return g.select("key", F.concat(labels(F.col("own"), F.col("own_bits")), F.flatten(F.transform("_more", lambda m: labels(m["register"], m["bits"])))).alias("bits"), "notes")


def scope_allows(name: Column | str, titles: Column | str, group: Column | str, prefix: str) -> Column:
    """Whether captions cover a name: true, false, or NULL where they state no scope it can be judged by.

    A title excludes what follows 'except' up to a bracket, and covers what it names.  A token that begins with `prefix`
    covers the names that it starts, with x for any one character and further three-digit endings after '/'; tokens in
    brackets cover the names of that group.  The first title that settles it does; a title that only names others is false.
    """
    n, g = (F.col(x) if isinstance(x, str) else x for x in (name, group))
    t = F.col(titles) if isinstance(titles, str) else titles
    token = rf"({prefix}[A-Z])([A-Z0-9x]+)((?:/[0-9]{{3}})*)"

    def judged(title):
        bare = F.regexp_replace(title, " ", "")
        excluded = F.regexp_replace(F.regexp_extract(title, r"(?i)except([^)）]*)", 1), " ", "")
        heads = F.regexp_extract_all(title, F.lit(token), 1)
        tokens = F.flatten(F.zip_with(F.arrays_zip(heads, F.regexp_extract_all(title, F.lit(token), 2)), F.regexp_extract_all(title, F.lit(token), 3), lambda h, more: F.concat(F.array(F.concat(h["0"], h["1"])), F.transform(F.filter(F.split(more, "/"), lambda d: d != ""), lambda d: F.concat(h["0"], d)))))
        counted = F.filter(tokens, lambda k: (excluded == "") | ~F.contains(excluded, k))
        covers = F.exists(counted, lambda k: F.when(F.contains(k, F.lit("x")), F.rlike(n, F.concat(F.lit("^"), F.replace(k, F.lit("x"), F.lit("[A-Z0-9]")), F.lit("[A-Z0-9]*$")))).otherwise(F.startswith(n, k)))
        groups = F.regexp_extract_all(title, F.lit(r"\(([A-Z][A-Z0-9])\)"), 1)
        settled = F.when((excluded != "") & F.contains(excluded, n), False).when(F.contains(bare, n) | covers | F.array_contains(groups, g), True)
        return F.struct(settled.alias("v"), ((F.size(counted) == 0) & (F.size(groups) == 0)).alias("silent"))

    each = F.transform(F.filter(t, lambda x: x.isNotNull() & (x != "")), judged)
    first = F.get(F.filter(each, lambda e: e["v"].isNotNull()), F.lit(0))["v"]
    return F.when(first.isNotNull(), first).when(F.exists(each, lambda e: ~e["silent"]), False)


def arbitrated(items: DataFrame, candidates: DataFrame, key: str, candidate: str, allowed: str) -> DataFrame:
    """Each item's candidate: the only one; else the only allowed; else the only one that nothing is said of; else NULL."""
    verdict = F.col(allowed)
    g = candidates.groupBy(key).agg(
        F.count("*").alias("_n"), F.min(candidate).alias("_one"),
        F.count_if(verdict).alias("_yes"), F.min(F.when(verdict, F.col(candidate))).alias("_allowed"),
        F.count_if(verdict.isNull()).alias("_open"), F.min(F.when(verdict.isNull(), F.col(candidate))).alias("_undecided"),
    )
    by = F.when(F.col("_n") == 1, "only").when(F.col("_yes") == 1, "allowed").when((F.col("_yes") != 1) & (F.col("_open") == 1), "undecided")
    picked = F.when(F.col("_n") == 1, F.col("_one")).when(F.col("_yes") == 1, F.col("_allowed")).when(F.col("_open") == 1, F.col("_undecided"))
    return items.select(key).distinct().join(g.select(key, picked.alias(candidate), by.alias("method")), key, "left")


def fan_out(assigned: DataFrame, column: Sequence[str], rows: DataFrame, functions: DataFrame, table: str, pad: str) -> DataFrame:
    """The rows of each member's column, with the functions of its table's pads: two inner joins."""
    return assigned.join(rows, list(column)).join(functions, [table, pad])
