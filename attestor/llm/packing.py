"""Best-fit packing of tokenised documents into sequences, hierarchically by residuals.

Documents are encoded in the engine of byte_bpe (the same vocabulary as the tokenizer file; a test holds it against the
library) and end in an end-of-text id.  Only documents longer than a sequence are cut, into full sequences behind a
first piece with the remainder; full pieces are sequences of their own, with negative numbers.  The other pieces are items.  A round deals the
items to groups of at most GROUP, packs each group best-fit with decreasing sizes and emits the bins that are nearly
full; of the underfull ones, those with room for the least of them are items of the next round, of fewer groups, until
one group holds all that is left or a round merges nothing.  Items carry only ids and sizes; places follow from the rounds' tables at the end.

Defined cases: a null or empty text is the end id alone.  Ids may be null or repeat: every row is packed once.  Other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import Encoder, Ranks, default_path, read_ranks
from .common import cut, lean, slices, small_batches, text_rows

LENGTH, END = 1024, 2
#: The tokenizer file takes this string inside a text for its special token.
SPECIAL, SPECIAL_ID = b"<|endoftext|>", 50256
GROUP = 100_000
#: A bin with so few places left is emitted before the last round.
SLACK = 4


def _ids(encoder: Encoder, buf: np.ndarray, offs: np.ndarray):
    """Ids of rows, and offsets; rows with the special string are cut around it."""
    raw = buf.tobytes()
    if SPECIAL not in raw:
        return encoder.encode(buf, offs)
    pieces, counts = [], []
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        own = raw[a:b].split(SPECIAL)
        pieces += own
        counts.append(len(own))
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    ids, at = encoder.encode(flat, np.concatenate([[0], np.cumsum([len(p) for p in pieces])]))
    out, to, k = [], [0], 0
    for n in counts:
        own = []
        for i in range(n):
            own += [ids[at[k] : at[k + 1]], [SPECIAL_ID] if i < n - 1 else []]
            k += 1
        own = np.concatenate(own).astype(np.int32)
        out.append(own)
        to.append(to[-1] + len(own))
    return np.concatenate(out), np.array(to)


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """item, doc_id, piece, start, length, ids_crc32 of every piece."""
    ranks = small_batches(docs).sparkSession.sparkContext.broadcast(Ranks(read_ranks(path or default_path())))

    def run(batches):
        encoder, item = Encoder(ranks.value), TaskContext.get().partitionId() << 38
        for batch in batches:
            buf, offs = text_rows(batch.column(1))
            which, piece, start, size, crc = [], [], [], [], []
            row = 0
            for *_, b, o in slices(buf, offs):
                ids, at = _ids(encoder, b, o)
                for i, k in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    own = np.append(ids[i:k], end).astype("<u4")
                    cuts = [0, *range(len(own) % length or length, len(own) + 1, length)]
                    for p, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        which.append(row)
                        piece.append(p)
                        start.append(x)
                        size.append(y - x)
                        crc.append(zlib.crc32(own[x:y].tobytes()))
                    row += 1
            n = len(which)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(item, item + n)), batch.column(0).take(pa.array(which, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())], ["item", "doc_id", "piece", "start", "length", "ids_crc32"])
            item += n

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(run), "item long, doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset of every item, and the bins' sizes: best fit, sizes decreasing, equal ones in their order."""
    order = np.argsort(-sizes, kind="stable")
    bins, offset, total = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    open_by_room: list[list[int]] = [[] for _ in range(length + 1)]
    rooms: list[int] = []  # the rooms that some bin has, ascending
    for i in order.tolist():
        size = int(sizes[i])
        k = bisect.bisect_left(rooms, size)
        if k < len(rooms):
            room = rooms[k]
            b = open_by_room[room].pop()
            if not open_by_room[room]:
                del rooms[k]
        else:
            b, room = len(total), length
            total.append(0)
        bins[i], offset[i] = b, total[b]
        total[b] += size
        left = room - size
        if left:
            if not open_by_room[left]:
                bisect.insort(rooms, left)
            open_by_room[left].append(b)
    return bins, offset, np.array(total, np.int64)


def _round(number: int, length: int, least: int):
    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        group, item, size = (np.concatenate([b.column(i).to_numpy() for b in batches]) for i in range(3))
        order = np.lexsort((item, group))
        group, item, size = group[order], item[order], size[order]
        edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])).tolist()
        for a, b in zip(edge, [*edge[1:], len(item)], strict=True):
            bins, offset, total = best_fit(size[a:b], length)
            name = (np.int64(number) << np.int64(57)) + (np.int64(group[a]) << np.int64(24)) + np.arange(len(total))
            for i in range(0, b - a, 50_000):
                k = slice(i, i + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(item[a:b][k]), pa.array(name[bins[k]]), pa.array(offset[k]), pa.array(total[bins[k]]), pa.array(total[bins[k]] >= least)], ["item", "bin", "place", "total", "full"])

    return run


def pack(items: DataFrame, length: int = LENGTH, group: int = GROUP, slack: int = SLACK) -> DataFrame:
    """item, sequence_id, offset of items (item, size < length)."""
    left, rounds = items.select("item", "size"), []
    n = left.count()
    while True:
        groups = max(1, -(-n // group))
        least = length - slack if groups > 1 else 0
        dealt = left.withColumn("group", F.pmod(F.xxhash64("item", F.lit(len(rounds))), F.lit(groups)).cast("int"))
        done = cut(dealt.select("group", "item", "size").repartition(min(groups, 16384), "group").mapInArrow(lean(_round(len(rounds) + 1, length, least)), "item long, bin long, place long, total long, full boolean"), "pack")
        rounds.append(done)
        if groups == 1:
            break
        bins = done.where("not full").select(F.col("bin").alias("item"), F.col("total").alias("size")).distinct()
        before, n, least = n, *bins.agg(F.count("*"), F.min("size")).first()
        if len(rounds) > 1 and n + done.where("full").select("bin").distinct().count() == before:
            break
        left = cut(bins.where(F.col("size") <= length - (least or 0)), "pack-left")  # the others have room for none
        n = left.count()
        if n < 2:
            break
    out = rounds[0].select("item", "bin", "place")
    for k, done in enumerate(rounds[1:]):
        up = done.select(F.col("item").alias("bin"), F.col("bin").alias("_bin"), F.col("place").alias("_place"))
        out = out.join(up, "bin", "left").select("item", F.coalesce("_bin", "bin").alias("bin"), (F.col("place") + F.coalesce("_place", F.lit(0))).alias("place"))
    return out.select("item", F.col("bin").alias("sequence_id"), F.col("place").alias("offset"))


def packed_pieces(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of docs (doc_id, text)."""
    every = cut(pieces(docs, path), "pieces")
    full = every.where(F.col("length") == LENGTH).withColumn("sequence_id", F.bitwise_not("item")).withColumn("offset", F.lit(0).cast("long"))
    rest = every.where(F.col("length") < LENGTH)
    placed = rest.join(pack(rest.select("item", F.col("length").alias("size"))), "item")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return full.select(*columns).unionByName(placed.select(*columns))
