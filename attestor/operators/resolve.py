"""Entity resolution: tiers of candidates, unique matches, prefixes, parents, chains."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def tiered(tiers: Sequence[tuple[str, DataFrame, bool]], key: str, candidate: str) -> DataFrame:
    """For each key the candidate of the first tier that has one; tiers are (name, pairs, must be unique).

    A tier that must be unique counts only where it has one candidate; else the smallest candidate is taken.
    """
    parts = []
    for n, (name, pairs, unique) in enumerate(tiers):
        g = pairs.groupBy(key).agg(F.min(candidate).alias(candidate), F.countDistinct(candidate).alias("_n"))
        parts.append((g.where("_n = 1") if unique else g).select(key, candidate, F.lit(n).alias("tier"), F.lit(name).alias("method")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    best = F.min_by(F.struct("tier", candidate, "method"), "tier").alias("b")
    return out.groupBy(key).agg(best).select(key, f"b.{candidate}", "b.tier", "b.method")


def unique_prefix(names: DataFrame, name: str, prefixes: DataFrame, prefix: str, length: int) -> DataFrame:
    """Each prefix with the name that starts with it, if exactly one does; joined on the first `length` characters."""
    a = names.select(F.col(name).alias("_name"), F.substring(name, 1, length).alias("_k")).distinct()
    b = prefixes.select(F.col(prefix).alias("prefix"), F.substring(prefix, 1, length).alias("_k")).distinct()
    hits = b.join(a, "_k").where(F.startswith("_name", "prefix")).groupBy("prefix").agg(F.count("*").alias("hits"), F.min("_name").alias("_one"))
    return b.select("prefix").join(hits, "prefix", "left").select("prefix", F.coalesce("hits", F.lit(0)).alias("hits"), F.when(F.col("hits") == 1, F.col("_one")).alias("name"))


def longest_prefix_parent(df: DataFrame, path: str, separator: str) -> DataFrame:
    """Each path with its longest proper prefix, at a separator, that is a path too.

    Every path gives its prefixes, as many as it has parts, and these meet the paths in an equi join.
    """
    paths = df.select(F.col(path).alias("path")).distinct()
    parts = F.split("path", separator)
    up = paths.where(F.size(parts) > 1).select(
        "path", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), separator))).alias("parent")
    )
    found = up.join(paths.select(F.col("path").alias("parent")), "parent").groupBy("path").agg(F.max_by("parent", F.length("parent")).alias("parent"))
    return paths.join(found, "path", "left")


def refuted(pairs: DataFrame, against: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pairs that no row of `against` contradicts."""
    return pairs.join(against.select(*keys).distinct(), list(keys), "left_anti")


def admit(df: DataFrame, *conditions: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """Rows that every condition table has a match for."""
    for other, keys in conditions:
        df = df.join(other.select(*keys).distinct(), list(keys), "left_semi")
    return df


def shared_path(spark, name: str) -> str:
    """A new path in the folder that driver and executors share; a temporary one only in local mode, where it is unset."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="attestor-")
    return f"{top}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back."""
    path = shared_path(df.sparkSession, "level")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ancestors(edges: DataFrame, child: str, parent: str, rounds: int | None = None) -> DataFrame:
    """(node, ancestor, depth) over a forest, level by level, each written, until a level is empty, or of `rounds` levels.

    A cycle has no last level: a node that is its own ancestor raises ValueError.
    """
    links = edges.select(F.col(child).alias("ancestor"), F.col(parent).alias("_up"))
    out = step = written(edges.select(F.col(child).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).alias("depth")))
    depth = 1
    while depth != rounds:
        cyclic, more = step.agg(F.coalesce(F.bool_or(F.col("node") == F.col("ancestor")), F.lit(False)), F.count("*")).first()
        if cyclic:
            raise ValueError(f"cycle of {depth} levels in {child}, {parent}")
        if not more:
            break
        depth += 1
        step = written(step.join(links, "ancestor").select("node", F.col("_up").alias("ancestor"), F.lit(depth).alias("depth")))
        out = out.unionByName(step)
    return out


def first_match(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def lookup_with_fallback(df: DataFrame, key: str, fallback: str, table: DataFrame, table_key: str, value: str, out: str) -> DataFrame:
    """The table's value for the key, else for the fallback key; the method says by which."""
    own = table.select(F.col(table_key).alias("_k"), F.col(value).alias("_v"))
    found = df.join(own.select(F.col("_k").alias("_k1"), F.col("_v").alias("_v1")), F.col(key) == F.col("_k1"), "left")
    found = found.join(own.select(F.col("_k").alias("_k2"), F.col("_v").alias("_v2")), F.col(fallback) == F.col("_k2"), "left")
    method = F.when(F.col("_v1").isNotNull(), "key").when(F.col("_v2").isNotNull(), "fallback")
    return found.withColumn(out, F.coalesce("_v1", "_v2")).withColumn("method", method).drop("_k1", "_v1", "_k2", "_v2")


def complete(df: DataFrame, more: DataFrame, keys: Sequence[str], items: str, most: int) -> DataFrame:
    """A list united with another source's items, unless it would get longer than `most`; the note says what happened."""
    other = more.select(*keys, F.col(items).alias("_m"))
    both = df.join(other, list(keys), "left").withColumn("_u", F.array_sort(F.array_union(items, F.coalesce("_m", F.slice(items, 1, 0)))))
    note = F.when(F.col("_m").isNull(), "alone").when(F.size("_u") > most, "too many").when(F.size("_u") == F.size(items), "same").otherwise("completed")
    return both.withColumn("note", note).withColumn(items, F.when(F.size("_u") > most, F.array_sort(items)).otherwise(F.col("_u"))).drop("_m", "_u")


def abbreviations(names: DataFrame, name: str, patterns: DataFrame, pattern: str, longer: int, stem: int) -> DataFrame:
    """(pattern, name) of every name that a short form stands for: begun by it and at most `longer` characters more.

    An x in a pattern is any one capital or digit.  Joined on the first `stem` characters, which hold no x; a name that
    is a pattern itself needs no expansion.
    """
    a = names.select(F.col(name).alias("name")).distinct().withColumn("_k", F.substring("name", 1, stem))
    b = patterns.select(F.col(pattern).alias("pattern")).distinct().withColumn("_k", F.substring("pattern", 1, stem))
    begun = F.rlike("name", F.concat(F.lit("^"), F.replace(F.col("pattern"), F.lit("x"), F.lit("[A-Z0-9]")), F.lit("[A-Z0-9]*$")))
    near = F.length("name") <= F.length("pattern") + longer
    return b.join(a, "_k").where(begun & near & (F.col("name") != F.col("pattern"))).select("pattern", "name")


def exists_folded(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Rows whose value the other table has, whatever its case."""
    known = other.select(F.lower(other_column).alias("_k")).distinct()
    return df.withColumn("_k", F.lower(column)).join(known, "_k", "left_semi").drop("_k")


def included(df: DataFrame, key: str, content: str, includes: str, files: DataFrame, file_key: str, file_content: str) -> DataFrame:
    """(key, included, content): each document's own content and that of the files that it includes, one level deep.

    What isn't there is skipped.
    """
    more = df.select(key, F.explode(includes).alias("included")).join(files.select(F.col(file_key).alias("included"), F.col(file_content).alias("content")), "included")
    return df.select(key, F.col(key).alias("included"), F.col(content).alias("content")).unionByName(more.select(key, "included", "content"))


def nearest(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, id_left: str, id_right: str, most: float, digits: int) -> DataFrame:
    """Each left row's nearest right row of the same keys, not further off than `most`; ties go to the smaller id.

    Places are cut into strips as wide as `most`, and a row meets only its own strip and the next on either side.
    """
    strip = F.floor(F.col(at) / most)
    a = left.select(*keys, F.col(id_left), F.col(at).alias("_a"), F.explode(F.array(strip - 1, strip, strip + 1)).alias("_s"))
    b = right.select(*keys, F.col(id_right), F.col(at).alias("_b"), strip.alias("_s"))
    met = a.join(b, [*keys, "_s"]).withColumn("_d", F.abs(F.col("_a") - F.col("_b"))).where(F.col("_d") <= most).withColumn("distance", F.round("_d", digits))
    best = F.min(F.struct("distance", F.col(id_right).alias("_id"))).alias("_m")
    return met.groupBy(id_left).agg(best).select(id_left, F.col("_m._id").alias(id_right), "_m.distance")


def required(df: DataFrame, key: str, table: DataFrame, table_key: str, value: str) -> DataFrame:
    """df with the first value that the table has for the key; a key that it lacks is an error when the row is read."""
    one = table.groupBy(F.col(table_key).alias("_k")).agg(F.min(value).alias("_v"))
    out = df.join(one, F.col(key) == F.col("_k"), "left")
    missing = F.raise_error(F.concat(F.lit(f"{value} of "), F.col(key).cast("string"), F.lit(" is missing"))).cast("string")
    return out.withColumn(value, F.when(F.col("_k").isNull(), missing).otherwise(F.col("_v"))).drop("_k", "_v")


def addresses(pointers: DataFrame, bases: DataFrame, members: DataFrame) -> DataFrame:
    """(block, member, address): pointers (block, type, base) to bases (base, at) with the members (type, member, offset) of their types.

    What a table lacks is left out.
    """
    return pointers.join(bases, "base").join(members, "type").select("block", "member", (F.col("at") + F.col("offset")).alias("address"))
