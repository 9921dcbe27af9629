"""Removal of passages that repeat, by hashing lines.

A unit is a line, cut further where a sentence ends within it ('.', '!' or '?' and a space), so that a passage is found
whatever shares its line.  Units are normalised (ASCII letters folded, runs of white space one) and hashed; equal digests
are grouped globally, and the earliest by (doc_id, place) stays.  Of the others, consecutive ones in a document make a
run, and runs of at least MIN_WORDS words are removed; shorter ones are everyday phrases and stay.  Each removed span
keeps its place in the original text, in code points, and the document that has the earliest occurrence of its start.

Digests are 96 bits, of two independent hashes of the words.  A document sends each of its distinct units once.  Grouping
sums up within each input partition first; the join that marks rows has one row of every digest on one side, and the
commonest digests, which would fill one task each, are broadcast.

Defined cases: null text stays null, an empty one empty.  A null doc_id ranks last.  Repeated rows of one id and text are
one document and all get its result; texts that share an id share its rank.  Units without words are never counted, and
go with a run that surrounds them.  Columns of docs pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, lean, runs_hash, slices, small_batches, spans_hash, spread_join, text_rows, words

MIN_WORDS, LINE_WORDS = 25, 8
_LAST = (1 << 63) - 1


def units(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all units, and the n+1 offsets of rows into them; a unit ends where the next begins."""
    n = len(buf)
    begins = np.zeros(n + 1, bool)
    begins[1:] = buf == 10
    ends = np.isin(buf, [33, 46, 63])
    begins[2:] |= (buf[1:] == 32) & ends[:-1]
    begins[offs[:-1][np.diff(offs) > 0]] = True
    begins[n] = False
    starts = np.flatnonzero(begins)
    return starts, np.searchsorted(starts, offs)


def digests(buf: np.ndarray, offs: np.ndarray):
    """Of the units with words: row, index within the row, two digests; and all units' starts, offsets, words."""
    starts, at = units(buf, offs)
    ws, we, _ = words(buf, offs)
    first = np.searchsorted(ws, starts)
    size = np.append(first[1:], len(ws)) - first
    row = np.repeat(np.arange(len(offs) - 1), np.diff(at))
    place = np.arange(len(starts)) - at[:-1][row]
    has = size > 0
    one, two = (runs_hash(spans_hash(buf, ws, we, True, seed), first[has], size[has], seed) for seed in (1, 2))
    return row[has], place[has], one, (two >> np.uint64(32)).astype(np.uint32), starts, at, size


def repeated(row: np.ndarray, place: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which units repeat an earlier one of their row, and the place of the first such one."""
    order = np.lexsort((place, d2, d1, row))
    same = np.zeros(len(order), bool)
    r, x, y = row[order], d1[order], d2[order]
    same[1:] = (r[1:] == r[:-1]) & (x[1:] == x[:-1]) & (y[1:] == y[:-1])
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    again, first = np.empty(len(order), bool), np.empty(len(order), np.int64)
    again[order], first[order] = same, place[order][head]
    return again, first


def _units(batches):
    """A row for each distinct unit of a document: what it repeats itself is known without the others."""
    names = ["rank", "h", "place", "d1", "d2"]
    for batch in batches:
        buf, offs = text_rows(batch.column(2))
        for a, b, part, o in slices(buf, offs):
            row, place, d1, d2, *_ = digests(part, o)
            once = ~repeated(row, place, d1, d2)[0]
            row, place, d1, d2 = row[once], place[once], d1[once], d2[once]
            rank, h = batch.column(0).slice(a, b - a).to_numpy()[row], batch.column(1).slice(a, b - a).to_numpy()[row]
            columns = [rank, h, place.astype(np.int32), d1.view(np.int64), d2.view(np.int32)]
            for i in range(0, len(row), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 100_000]) for c in columns], names)


def _runs(first: dict[int, int], size: np.ndarray, opens: np.ndarray, least: int):
    """First and last unit of every run of marked units that has enough words, and of the whole lines in shorter runs."""
    k = 0
    while k < len(size):
        if k not in first:
            k += 1
            continue
        to, n, last = k, 0, k
        while to < len(size) and (to in first or size[to] == 0):
            n += int(size[to])
            if to in first:
                last = to
            to += 1
        if n >= least:
            yield k, last
        elif n >= LINE_WORDS:
            edges = [*(k + np.flatnonzero(opens[k:to])).tolist(), *([to] if to == len(size) or opens[to] else [])]
            for x, y in zip(edges, edges[1:], strict=False):
                if size[x:y].sum() >= LINE_WORDS and x in first:
                    yield x, max(i for i in range(x, y) if i in first)
        k = to


def _cut(text: pa.Array, ranks: pa.Array, places: pa.Array, firsts: pa.Array, least: int):
    """Text without runs of the marked units, how many spans and code points went, and the spans."""
    buf, offs = text_rows(text)
    texts, spans, chars, said = [], [], [], []
    for a, b, part, o in slices(buf, offs):
        raw = part.tobytes()
        row, place, d1, d2, starts, at, size = digests(part, o)
        again, head = repeated(row, place, d1, d2)
        own: dict[int, list] = {}
        for i, p, q in zip(row[again].tolist(), place[again].tolist(), head[again].tolist(), strict=True):
            own.setdefault(i, []).append((p, q))
        marks, sources = places.slice(a, b - a).to_pylist(), firsts.slice(a, b - a).to_pylist()
        for i in range(b - a):
            gone, out, kept_from, to = [], [], int(o[i]), int(o[i + 1])
            if marks[i] or i in own:
                first = dict(zip(marks[i] or [], sources[i] or [], strict=True))
                first |= {p: first.get(q, ranks[a + i].as_py()) for p, q in own.get(i, [])}
                edge = [*starts[at[i] : at[i + 1]].tolist(), to]
                begin = starts[at[i] : at[i + 1]]
                opens = (begin == o[i]) | (part[begin - 1] == 10)
                for k, last in _runs(first, size[at[i] : at[i + 1]], opens, least):
                    x, y = edge[k], edge[last + 1]
                    out.append(raw[kept_from:x])
                    gone.append((len(raw[o[i] : x].decode()), len(raw[x:y].decode()), first[k]))
                    kept_from = y
            texts.append((b"".join(out) + raw[kept_from:to]).decode() if gone else text[a + i].as_py())
            spans.append(len(gone))
            chars.append(sum(g[1] for g in gone))
            said.append(";".join(f"{x}+{n}<{'' if d == _LAST else d}" for x, n, d in gone))
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(spans, pa.int64()), pa.array(chars, pa.int64()), pa.array(said, pa.string())], ["text", "n_removed", "removed_chars", "removed"])


def remove_repeats(docs: DataFrame, out: str, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with text cut, and a struct of n_removed, removed_chars, removed ('start+length<first document', by ';')."""
    rank, h, r, g, places, firsts = fresh(docs.withColumn(out, F.lit(0)), "rank", "hash", "r", "g", "places", "firsts")
    keyed = small_batches(docs).withColumn(rank, F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))).withColumn(h, F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = cut(keyed.select(rank, h, "text").mapInArrow(lean(_units), "rank long, h long, place int, d1 long, d2 int"), "units")
    groups = cut(rows.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min("rank").alias("first")).where("n > 1"), "unit-groups")
    marks = spread_join(rows, groups, ["d1", "d2"], rows.count()).where("rank <> first").select("rank", "h", "place", "first")
    lists = marks.groupBy("rank", "h").agg(F.array_sort(F.collect_set(F.struct("place", "first"))).alias("marks"))
    lists = lists.select(F.col("rank").alias(r), F.col("h").alias(g), F.col("marks.place").alias(places), F.col("marks.first").alias(firsts))
    both = keyed.join(lists, (F.col(rank) == F.col(r)) & (F.col(h) == F.col(g)), "left")

    @F.arrow_udf("struct<text: string, n_removed: long, removed_chars: long, removed: string>")
    def cut_runs(text: pa.Array, ranks: pa.Array, places: pa.Array, firsts: pa.Array) -> pa.Array:
        return _cut(text, ranks, places, firsts, min_words)

    done = both.withColumn(out, cut_runs("text", rank, places, firsts))
    return done.select(*[F.col(out)["text"].alias("text") if c == "text" else F.col(c) for c in docs.columns], out)


def substring_dedup_report(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_removed, removed_chars and removed of every row of docs (doc_id, text)."""
    done = remove_repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "out")
    return done.select("doc_id", "text", "out.n_removed", "out.removed_chars", "out.removed")
