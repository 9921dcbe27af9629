"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

Everything is DataFrame and SQL functions.  A document is the set of its 5-word shingles (folded to lower case; a shorter
text is one shingle).  Each shingle is hashed once; the upper 8 bits choose one of 256 bins and each bin keeps its
smallest hash.  A bin that stays empty takes the value of the first filled bin in its own fixed permutation of the bins,
the same for all documents.  Of every bin the low 8 bits are stored, eight bins packed to a long, and written as hex.
The likeness of two fingerprints is the share of equal bins, corrected for the 1/256 that agree by chance.

How bins are found without a scan a bin: the array to sort also gets every bin's largest possible value, so after the
sort the first element of each run of equal upper bits is that bin's minimum, in order, and the added value marks an
empty bin.  Empty bins try a few probes and then take the least probe over the filled bins, the same bin either way.

Next documents: ids are range-partitioned and numbered within the ranges; only ids, sizes and packed bins move for that.
Texts are shuffled by key once for both sides, and of the next document only the part that is used moves again.

Defined cases: a null text is empty.  A text without words has the fingerprint '' and is like another such by 1, any
other by 0.  Ids may repeat or be null (ordered last): rows follow each other by descending doc_id, then by a hash of
the text, and of repeated rows each is followed by the next of them.  A single row is its own next.  Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

WIDTH = 5
BINS = 256
LOW = (1 << 56) - 1
#: Probes tried before the least one is searched for; a matter of speed only.
PROBES = 4

_SPACE = "' \\t\\n\\u000B\\f\\r'"


def _literal(values) -> str:
    """An array that is folded to one constant, unlike the result of a higher-order function."""
    return f"array({', '.join(values)})"


_MARKS = _literal(f"{(b << 56) | LOW}L" for b in range(-128, 128))
#: Each bin's permutation of the bins: r -> (start + step * r) mod 256 with an odd step; back is the step's inverse.
_STEPS = [(i * 2654435761 >> 7) % BINS | 1 for i in range(BINS)]
_START = _literal(str(i * 0x9E3779B1 >> 11 & 255) for i in range(BINS))
_STEP, _BACK = _literal(map(str, _STEPS)), _literal(str(pow(s, -1, BINS)) for s in _STEPS)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds `out`, an array of 32 longs with 8 bins each; empty for a text without words."""
    keep = df.columns
    df = df.withColumn("_t", F.expr(f"trim(BOTH {_SPACE} FROM lower({text}))"))
    df = df.withColumn("_w", F.expr(r"CASE WHEN _t = '' THEN cast(array() AS array<string>) ELSE split(_t, '[\\x20\\x09-\\x0D]+') END"))
    df = df.select(*keep, "_w")
    shingles = f"CASE WHEN size(_w) < {WIDTH} THEN array(xxhash64(_w)) ELSE transform(sequence(1, size(_w) - {WIDTH - 1}), i -> xxhash64(slice(_w, i, {WIDTH}))) END"
    df = df.withColumn("_s", F.expr(f"CASE WHEN size(_w) = 0 THEN cast(array() AS array<bigint>) ELSE sort_array(concat({shingles}, {_MARKS})) END")).drop("_w")
    df = df.withColumn("_m", F.expr("filter(_s, (x, i) -> i = 0 OR shiftright(x, 56) <> shiftright(_s[i - 1], 56))")).drop("_s")
    df = df.withColumn("_f", F.expr(f"filter(_m, x -> (x & {LOW}L) <> {LOW}L)"))
    probe = [f"_m[({_START}[i] + {_STEP}[i] * {r}) & 255]" for r in range(1, PROBES + 1)]
    tried = ", ".join(f"CASE WHEN ({p} & {LOW}L) <> {LOW}L THEN {p} & 255 END" for p in probe)
    least = f"array_min(transform(_f, y -> shiftleft(((shiftright(y, 56) + 128 - {_START}[i]) * {_BACK}[i] - 1) & 255, 8) | (y & 255))) & 255"
    df = df.withColumn("_c", F.expr(f"transform(_m, (x, i) -> CASE WHEN (x & {LOW}L) <> {LOW}L THEN x & 255 ELSE coalesce({tried}, {least}) END)")).drop("_m", "_f")
    eight = " | ".join(f"shiftleft(_c[8 * g + {k}], {56 - 8 * k})" for k in range(8))
    return df.withColumn(out, F.expr(f"CASE WHEN size(_c) = 0 THEN cast(array() AS array<bigint>) ELSE transform(sequence(0, {BINS // 8 - 1}), g -> {eight}) END")).drop("_c")


def written(packed: str) -> F.Column:
    return F.expr(f"array_join(transform({packed}, x -> lpad(hex(x), 16, '0')), '')")


def likeness(a: str, b: str) -> F.Column:
    """Estimated Jaccard similarity of the sets of two fingerprints."""
    differ = f"zip_with({a}, {b}, (p, q) -> p ^ q)"
    for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
        differ = f"transform({differ}, x -> x | (shiftrightunsigned(x, {shift}) & {mask}L))"
    differ = f"aggregate({differ}, 0L, (s, x) -> s + bit_count(x & {0x0101010101010101}L))"
    chance = 1 / 256
    return F.expr(f"CASE WHEN size({a}) = 0 OR size({b}) = 0 THEN cast(size({a}) = size({b}) AS int) * 1D ELSE least(1D, greatest(0D, (1D - {differ} / {BINS}D - {chance}D) / (1D - {chance}D))) END")


def next_rows(keys: DataFrame) -> DataFrame:
    """Of distinct (doc_id, h, n): the key of the row that follows by descending doc_id, the first after the last."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").desc()]
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(keys.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), "print-order")
    w = Window.partitionBy("range").orderBy(*order)
    here = dealt.select("*", F.lead(F.struct("doc_id", "h")).over(w).alias("_next"), F.row_number().over(w).alias("_place"))
    firsts = here.where("_place = 1").select("range", F.struct("doc_id", "h").alias("_first"))
    one = Window.orderBy("range")
    after = firsts.select(F.col("range"), F.lead("_first").over(one).alias("_after"), F.first("_first").over(one).alias("_top"))
    after = after.select("range", F.coalesce("_after", "_top").alias("_after"))
    linked = here.join(after, "range").withColumn("_next", F.coalesce("_next", "_after"))
    return linked.select("doc_id", "h", "n", "copies", F.col("_next.doc_id").alias("next_id"), F.col("_next.h").alias("next_h"))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of docs (doc_id, text) and of its edited text, with the likeness to it and to the next."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("h", F.xxhash64("text"))
    own = cut(with_fingerprint(docs.withColumn("n", F.length("text")), "text", "packed").drop("text"), "prints")
    keys = own.groupBy("doc_id", "h").agg(F.first("n").alias("n"), F.count("*").alias("copies"))
    chain = next_rows(keys)
    again = own.groupBy("doc_id", "h").count().where("count > 1").limit(1).count() > 0
    if again:
        docs, own = docs.dropDuplicates(["doc_id", "h"]), own.dropDuplicates(["doc_id", "h"])
        # all copies but the last are followed by a copy
        inner = chain.where("copies > 1").withColumn("next_id", F.col("doc_id")).withColumn("next_h", F.col("h")).withColumn("times", F.col("copies") - 1)
        chain = chain.withColumn("times", F.lit(1).cast("long")).unionByName(inner)
    else:
        chain = chain.withColumn("times", F.lit(1).cast("long"))
    chain = chain.drop("copies")

    def on(a, b):
        return F.col(a[0]).eqNullSafe(F.col(b[0])) & (F.col(a[1]) == F.col(b[1]))

    c = chain.select(F.col("doc_id").alias("c_id"), F.col("h").alias("c_h"), "n", "next_id", "next_h", "times")
    tails = docs.join(c, on(("next_id", "next_h"), ("doc_id", "h"))).select("c_id", "c_h", "next_id", "next_h", "times", "n", F.expr("substring(text, 1, n div 3)").alias("tail"))
    tails = tails.join(own.select(F.col("doc_id").alias("o_id"), F.col("h").alias("o_h"), F.col("packed").alias("next_packed")), on(("next_id", "next_h"), ("o_id", "o_h")))
    whole = docs.join(tails.select("c_id", "c_h", "times", "n", "tail", "next_packed"), on(("doc_id", "h"), ("c_id", "c_h")))
    edited = whole.select("doc_id", "h", "n", "times", "next_packed", F.expr("concat(substring(text, 1, n - n div 3), tail)").alias("edited"))
    edited = with_fingerprint(edited, "edited", "edited_packed").withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")
    out = edited.join(own.select(F.col("doc_id").alias("o_id"), F.col("h").alias("o_h"), "packed"), on(("doc_id", "h"), ("o_id", "o_h")))
    if again:
        out = out.withColumn("_", F.expr("explode(sequence(1, cast(times as int)))"))
    return out.select(
        "doc_id",
        F.col("n").cast("long").alias("n_chars"),
        "edited_sha256",
        written("packed").alias("fingerprint"),
        written("edited_packed").alias("edited_fingerprint"),
        likeness("packed", "edited_packed").alias("near_edited"),
        likeness("packed", "next_packed").alias("near_next"),
    )
