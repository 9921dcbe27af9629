"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Texts are equal when identical after deleting white space.  Every input partition sorts the fingerprints of its texts,
GATHERED at a time, codes the gaps with a Rice code and sends one short list to each owner of a range of fingerprints.
An owner tells every source, by a bitmap over the list that it sent, which fingerprints other sources sent too.  Only
rows so marked, and those repeated within their source, are suspects: their texts are shuffled and compared byte for byte
by grouping on the text itself, with copies folded up before the shuffle.  Groups with much of the table are joined back
by broadcast, so that no text's copies meet in one task.  Of equal texts the one with the most code points in the
original text stays, then the smallest doc_id (a null one last), then the row that came first.

Defined cases: a null text counts as empty.  Rows that repeat, ids and all, are copies like others: one of them stays.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, cut, fresh, lean, possible, slices, small_batches, spread_join, text_rows

OWNERS = 64
#: Fingerprints that a task holds before it sends them; what follows in its partition counts as another source.
GATHERED = 1 << 20
_KINDS = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
_FOUND = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("row", pa.int64()), ("h", pa.int64()), ("text_sha256", pa.string()), ("n_chars", pa.int64()), ("src", pa.int64()), ("print", pa.int64()), ("owner", pa.int32()), ("payload", pa.binary()), ("again", pa.binary())])


def golomb(values: np.ndarray) -> bytes:
    """Sorted distinct uint64 values as a Rice code of their gaps, behind a head: how many, the parameter, the first."""
    if not len(values):
        return np.array([0, 0, 0], "<u8").tobytes()
    gaps = np.diff(values, prepend=values[:1])
    mean = int(values[-1] - values[0]) // len(values)
    k = max(0, min(58, mean.bit_length() - 1))
    high, low = (gaps >> np.uint64(k)).astype(np.int64), gaps & np.uint64((1 << k) - 1)
    size = high + 1 + k
    start = np.cumsum(size) - size
    bits = np.zeros(int(size.sum()), np.uint8)
    bits[start + high] = 1  # the unary part: as many zeros as high, then a one
    for j in range(k):
        bits[start + high + 1 + j] = (low >> np.uint64(k - 1 - j)).astype(np.uint8) & 1
    return np.array([len(values), k, values[0]], "<u8").tobytes() + np.packbits(bits).tobytes()


def ungolomb(payload: bytes) -> np.ndarray:
    n, k, first = (int(x) for x in np.frombuffer(payload, "<u8", 3))
    if not n:
        return np.zeros(0, np.uint64)
    bits = np.unpackbits(np.frombuffer(payload, np.uint8, offset=24))
    ones = np.flatnonzero(bits)
    after = np.searchsorted(ones, ones + 1 + k).tolist()  # the unary one that follows, if this is one
    which, i = [], 0
    for _ in range(n):
        which.append(i)
        i = after[i]
    ends = ones[which]
    high = np.diff(ends, prepend=-1 - k).astype(np.uint64) - np.uint64(1 + k)
    low = np.zeros(n, np.uint64)
    for j in range(k):
        low = low << np.uint64(1) | bits[ends + 1 + j].astype(np.uint64)
    return np.cumsum(high << np.uint64(k) | low, dtype=np.uint64) + np.uint64(first)


def _send(owners: int):
    """Rows (kind 0) with their fingerprint as they come, and behind every GATHERED of them the lists (kind 1).

    A list's source is the partition and how many it has sent before; again marks what the source has more than once.
    """

    def run(batches):
        src, seen, held = TaskContext.get().partitionId() << 24, 0, []
        first = np.int64(src) << np.int64(12)

        def lists():
            distinct, counts = np.unique(np.concatenate(held), return_counts=True)
            owner = ((distinct >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int32)
            at = np.searchsorted(owner, np.arange(owners + 1))
            for k in np.flatnonzero(at[1:] > at[:-1]).tolist():
                own = slice(at[k], at[k + 1])
                yield _batch(1, src=[src], owner=[k], payload=[golomb(distinct[own])], again=[np.packbits(counts[own] > 1).tobytes()])

        for batch in batches:
            buf, offs = text_rows(batch.column(1))
            shas, prints, sizes = [], [], []
            for *_, b, o in slices(buf, offs):
                raw = b.tobytes()
                lead = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80, dtype=np.int32)])
                sizes.append(lead[o[1:]] - lead[o[:-1]])
                for x, y in zip(o[:-1].tolist(), o[1:].tolist(), strict=True):
                    digest = hashlib.sha256(raw[x:y].translate(None, SPACES)).digest()
                    shas.append(digest.hex())
                    prints.append(digest[:8])
            if not shas:
                continue
            n = len(shas)
            held.append(np.frombuffer(b"".join(prints), ">u8").astype(np.uint64))
            row = first + seen + np.arange(n)
            seen += n
            yield _batch(0, n, doc_id=batch.column(0), row=row, h=batch.column(2), text_sha256=shas, n_chars=np.concatenate(sizes), src=np.full(n, src), print=held[-1].view(np.int64))
            if sum(map(len, held)) >= GATHERED:
                yield from lists()
                src, held = src + 1, []
        if held:
            yield from lists()

    return run


def _batch(kind: int, n: int = 1, **columns) -> pa.RecordBatch:
    """Rows of _FOUND, null where nothing is given."""
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind), pa.int32()) if f.name == "kind" else _column(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _FOUND], schema=_FOUND)


def _column(values, kind) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def _own(batches):
    """For each list of an owner, the slots whose fingerprint another source sent too, as a bitmap."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    lists: dict[int, list] = {}
    for b in batches:
        for src, owner, payload in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            lists.setdefault(owner, []).append((src, payload))
    for owner, sent in lists.items():
        values = [ungolomb(p) for _, p in sent]
        distinct, counts = np.unique(np.concatenate(values), return_counts=True)
        shared = distinct[counts > 1]
        maps = [np.packbits(np.isin(v, shared)).tobytes() for v in values]
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in sent], pa.int64()), pa.array([owner] * len(sent), pa.int32()), pa.array(maps, pa.binary())], ["src", "owner", "bitmap"])


def _marked(batches):
    """(src, payload, again, bitmap) -> the fingerprints of a source that are met twice, in it or elsewhere."""
    for b in batches:
        for src, payload, again, bitmap in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            values = ungolomb(payload)
            both = np.frombuffer(again, np.uint8) | np.frombuffer(bitmap, np.uint8)
            values = values[np.unpackbits(both, count=len(values)) > 0].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), src)), pa.array(values)], ["src", "print"])


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of docs (doc_id, text); row and h tell rows apart."""
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    owners = max(OWNERS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = cut(docs.mapInArrow(lean(_send(owners)), ", ".join(f"{f.name} {_KINDS[f.type]}" for f in _FOUND)), "exact-prints")
    rows = found.where("kind = 0").select("doc_id", "row", "h", "text_sha256", "n_chars", "src", "print")
    lists = found.where("kind = 1").select("src", "owner", "payload", "again")
    bitmaps = lists.select("src", "owner", "payload").repartition(owners, "owner").mapInArrow(lean(_own), "src long, owner int, bitmap binary")
    marked = lists.join(bitmaps, ["src", "owner"]).select("src", "payload", "again", "bitmap").mapInArrow(lean(_marked), "src long, print long")
    suspects = rows.select("src", "print", "doc_id", "h", "row", "n_chars").join(marked, ["src", "print"], "left_semi")
    suspects = cut(suspects.groupBy("doc_id", "h").agg(F.min("row").alias("row"), F.min("n_chars").alias("n_chars")), "exact-suspects")
    texts = possible(docs, "h", suspects.select("h"))[0].alias("d").join(suspects.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.h") == F.col("s.h")))
    bare = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "")
    best = F.max(F.struct("n_chars", F.bitwise_not("id").alias("minus_id"), F.bitwise_not("row").alias("minus_row")))
    groups = texts.select(bare.alias("bare"), "n_chars", F.col("d.doc_id").alias("id"), "row").groupBy("bare").agg(F.count("*").alias("n"), best.alias("best")).where("n > 1")
    groups = cut(groups.select(F.sha2("bare", 256).alias("text_sha256"), "n", F.col("n").alias("group_size"), F.bitwise_not("best.minus_id").alias("best_id"), F.bitwise_not("best.minus_row").alias("best_row")), "exact-groups")
    out = spread_join(rows, groups, ["text_sha256"], rows.count(), "left")
    alone = F.col("best_row").isNull()
    return out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("row") == F.col("best_row"))).alias("kept"), "text_sha256", "row", "h")


def exact_duplicates_report(docs: DataFrame) -> DataFrame:
    return exact_duplicates(docs).drop("row", "h")


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all columns."""
    key, i, h, kept, n = fresh(docs, "key", "id", "hash", "kept", "copies")
    stays = exact_duplicates(docs).groupBy(F.col("doc_id").alias(i), F.col("h").alias(h)).agg(F.max("kept").alias(kept), F.count("*").alias(n))
    gone = cut(stays.where(~F.col(kept) | (F.col(n) > 1)), "exact-gone")
    marked = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(key) == F.col(h))
    some, others = possible(marked, key, gone.select(h))
    again = some.join(gone.where(kept), same, "left_semi").dropDuplicates(["doc_id", key])
    return others.unionByName(some.join(gone, same, "left_anti")).unionByName(again).drop(key)


SQL = """
with n as (
  select doc_id, coalesce(text, '') as text, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) as text_sha256
  from documents),
r as (
  select *, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size,
         row_number() over w as place
  from n window w as (partition by text_sha256 order by length(text) desc, doc_id nulls last rows between unbounded preceding and unbounded following))
select doc_id, keep_id, cast(group_size as bigint) as group_size, place = 1 as kept, text_sha256 from r
"""
