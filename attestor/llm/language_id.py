"""Language identification by averaged hashed subword embeddings.

A text's subwords are the byte n-grams of 2 to 4 bytes within its words (letters folded, all else white space), hashed
to buckets of their length.  A document is the mean of its subwords' embeddings, and a linear softmax over it gives the
language; both are trained together by stochastic gradient descent in numpy on a bounded sample of labelled rows (about
SAMPLE distinct texts in equal shares of the MOST_LANGS commonest languages, drawn by a hash of the text).  Of a sampled
text only its buckets' counts reach the driver, so its length doesn't matter there.  For prediction the two linear maps
are multiplied out, so that a text costs one small table lookup a subword.

Rejection is calibrated on another bounded sample, CALIBRATION distinct texts that aren't trained on: a temperature by
their likelihood, then as threshold the score under which a share REJECTED of them lies, by the conformal rank of n + 1.
Where there are too few rows for that share, it lies by MARGIN below their least score.

Defined cases: a null text, or one without a letter, is `und` with score 0 and rejected.  Rows without a language, or
with a null doc_id, are not learned from; without any labelled row everything is `und`, and texts with letters are not
rejected, as nothing is known against them.  Repeated texts of a language are learned from once.  Other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import LETTER, byte_classes
from .common import SLICE_BYTES, lean, slices, small_batches, text_rows

#: Labelled texts that the classifier is fitted on, that it is calibrated on, and languages that it tells apart, at most.
SAMPLE, CALIBRATION, MOST_LANGS = 2400, 6000, 500
WIDTHS = (2, 3, 4)
BUCKETS = 1 << 14
DIM = 16
#: Steps of gradient descent at least, however few the rows are.
STEPS = 800
#: Share of texts in a known language that may be rejected, and the margin below the least score where that share is no text.
REJECTED, MARGIN = 0.001, 0.8
#: Share of wrong labels that calibration allows for, so that separable data don't make every score 1.
SMOOTH = 0.01
#: Numbers of the table that are looked up at once.
LOGITS = 1 << 22
UND = "und"


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # float32, (buckets of all widths, languages)
    bias: np.ndarray
    temperature: float
    least: float


def _letters(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes with a space for all that isn't a letter, and which bytes are letters'."""
    letter = byte_classes(buf) == LETTER
    out = np.where(letter, buf, 32).astype(np.uint8)
    out[(out >= 65) & (out <= 90)] += 32
    after = np.zeros(len(buf), bool)
    after[1:] = buf[:-1] == 0xC3
    out[after & (out >= 0x80) & (out <= 0x9E) & (out != 0x97)] += 0x20  # the capitals of Latin-1
    return out, letter


def subwords(buf: np.ndarray, offs: np.ndarray):
    """For each width: the bucket of every subword, the n+1 offsets of rows into them.  Then the letters of each row."""
    out, letter = _letters(buf)
    n = len(buf)
    v = out.astype(np.uint32)
    ink = letter.astype(np.int8)
    last = np.zeros(n + 1, np.int64)
    last[1:] = np.cumsum(letter)
    room = np.repeat(offs[1:], np.diff(offs)) - np.arange(n)
    found = []
    for k, width in enumerate(WIDTHS):
        m = n - width + 1
        if m <= 0:
            found.append((np.zeros(0, np.int64), np.zeros(len(offs), np.int64)))
            continue
        h, inner = v[:m].copy(), np.ones(m, np.int8)
        for j in range(1, width):
            h |= v[j : m + j] << np.uint32(8 * j)
            if j < width - 1:
                inner &= ink[j : m + j]
        if width == 2:
            inner = ink[:m] | ink[1:]
        at = np.flatnonzero((inner > 0) & (room[:m] >= width))
        h = h[at] * np.uint32(2654435761)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA77)
        found.append(((h >> np.uint32(18)).astype(np.int64) + k * BUCKETS, np.searchsorted(at, offs)))
    return found, last[offs[1:]] - last[offs[:-1]]


def bags(buf: np.ndarray, offs: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct buckets of each row and their counts."""
    found, _ = subwords(buf, offs)
    return [np.unique(np.concatenate([h[at[i] : at[i + 1]] for h, at in found]), return_counts=True) for i in range(len(offs) - 1)]


def bags_in_slices(buf: np.ndarray, offs: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """bags(), a slice of rows at a time: a batch's subwords are some seventy times its bytes."""
    return [bag for *_, b, o in slices(buf, offs, SLICE_BYTES) for bag in bags(b, o)]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(packed: list[tuple[np.ndarray, np.ndarray]], labels: list[str], seed: int = 7, epochs: int = 12, batch: int = 24, rate: float = 2.0) -> Model | None:
    """Embeddings and softmax by SGD over bags of buckets; None if none of them has any."""
    langs = sorted(set(labels))
    y = np.array([langs.index(x) for x in labels], np.int64)
    rng = np.random.default_rng(seed)
    train = np.array([i for i in rng.permutation(len(packed)) if len(packed[i][0])], np.int64)
    if not len(train):
        return None
    e = rng.normal(0, 0.1, (BUCKETS * len(WIDTHS), DIM)).astype(np.float32)
    w, b = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    epochs = max(epochs, -(-STEPS * batch // len(train)))
    steps = epochs * -(-len(train) // batch)
    step = 0
    for _ in range(epochs):
        train = rng.permutation(train)
        for i in range(0, len(train), batch):
            rows = train[i : i + batch]
            size = [len(packed[r][0]) for r in rows]
            index = np.concatenate([packed[r][0] for r in rows])
            share = np.concatenate([packed[r][1] / packed[r][1].sum() for r in rows]).astype(np.float32)
            at = np.concatenate([[0], np.cumsum(size)[:-1]])
            mean = np.add.reduceat(e[index] * share[:, None], at)
            d = _softmax(mean @ w + b)
            d[np.arange(len(rows)), y[rows]] -= 1
            d = (d / len(rows)).astype(np.float32)
            lr = np.float32(rate * (1 - step / steps))
            back = d @ w.T
            w -= lr * mean.T @ d
            b -= lr * 0.1 * d.sum(0)
            np.add.at(e, index, -lr * 20 * share[:, None] * np.repeat(back, size, axis=0))
            step += 1
    return Model(langs, (e @ w).astype(np.float32), b, 1.0, 0.0)


def calibrate(model: Model, z: np.ndarray, labels: list[str], rejected: float = REJECTED) -> None:
    """Set the temperature and the threshold by the logits of rows that weren't trained on."""
    if not len(z):
        return
    place = {x: i for i, x in enumerate(model.langs)}
    known = np.array([place.get(x, -1) for x in labels])
    target = np.full((int((known >= 0).sum()), len(model.langs)), SMOOTH / len(model.langs))
    target[np.arange(len(target)), known[known >= 0]] += 1 - SMOOTH
    losses = {t: -(target * np.log(np.maximum(_softmax(z[known >= 0] / t), 1e-12))).sum() for t in np.geomspace(0.1, 10, 41)}
    model.temperature = float(min(losses, key=losses.get))
    score = np.sort(_softmax(z / model.temperature).max(1))
    k = int(rejected * (len(score) + 1))
    model.least = float(score[k - 1] if k else MARGIN * score[0])


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A calibrated model of the labelled rows that aren't held out; None if there are none with subwords."""
    spark = small_batches(docs).sparkSession
    text = F.col("text")
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", text, F.xxhash64(text, F.lit("sample")).alias("h")).where("lang is not null and text is not null and crc32(cast(doc_id as string)) % 4 <> 2").drop("doc_id")
    counts = known.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGS).collect()
    if not counts:
        return None
    size = 1 << 30
    share = lambda most, n: min(1.0, most / len(counts) / max(1, n))
    shares = [(r["lang"], int(share(sample, r["n"]) * size * 0.8), int((share(sample, r["n"]) * 0.8 + share(CALIBRATION, r["n"])) * size)) for r in counts]
    drawn = F.broadcast(spark.createDataFrame(shares, "lang string, fitted int, upto long"))
    rows = known.withColumn("draw", F.pmod("h", F.lit(size))).join(drawn, "lang").where("draw < upto").withColumn("fits", F.expr("draw < fitted")).dropDuplicates(["lang", "h"])

    def packed(batches):
        for batch in batches:
            found = bags_in_slices(*text_rows(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([b for b, _ in found], pa.list_(pa.int32())), pa.array([n for _, n in found], pa.list_(pa.int32()))], ["lang", "h", "bucket", "n"])

    rows = rows.select("lang", "h", "text", "fits")
    fitted = rows.where("fits").drop("fits").mapInArrow(lean(packed), "lang string, h long, bucket array<int>, n array<int>").orderBy("h").limit(2 * sample).toArrow()
    model = fit(list(zip(rows_of(fitted["bucket"]), rows_of(fitted["n"]), strict=True)), fitted["lang"].to_pylist())
    if model is None:
        return None
    shared = spark.sparkContext.broadcast(model)

    def scored(batches):
        for batch in batches:
            z, letters = logits_in_slices(shared.value, *text_rows(batch.column(2)))
            keep = pa.array(letters > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(list(z[letters > 0]), pa.list_(pa.float64()))], ["lang", "h", "z"])

    most = max(1, min(2 * CALIBRATION, 4_000_000 // len(model.langs)))
    left = rows.where("not fits").drop("fits").mapInArrow(lean(scored), "lang string, h long, z array<double>").orderBy("h").limit(most).toArrow()
    z = rows_of(left["z"])
    calibrate(model, np.stack(z) if z else np.zeros((0, len(model.langs))), left["lang"].to_pylist())
    return model


def rows_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The rows of a column of lists, as arrays."""
    out = []
    for chunk in column.chunks:
        at = chunk.offsets.to_numpy()
        out += np.split(chunk.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]], at[1:-1] - at[0]) if len(chunk) else []
    return out


def logits(model: Model, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The languages' logits before the temperature, and the letters of each row."""
    found, letters = subwords(buf, offs)
    total, n = np.zeros((len(offs) - 1, len(model.langs))), np.zeros(len(offs) - 1)
    most = max(1, LOGITS // len(model.langs))
    for bucket, at in found:
        for a in range(0, len(bucket), most):
            part = np.clip(at - a, 0, min(most, len(bucket) - a))
            rows = np.flatnonzero(part[1:] > part[:-1])
            total[rows] += np.add.reduceat(model.table[bucket[a : a + most]], part[rows])
        n += np.diff(at)
    return total / np.maximum(n, 1)[:, None] + model.bias, letters


def logits_in_slices(model: Model, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """logits(), a slice of rows at a time."""
    z, letters = zip((np.zeros((0, len(model.langs))), np.zeros(0, np.int64)), *(logits(model, b, o) for *_, b, o in slices(buf, offs, SLICE_BYTES)), strict=True)
    return np.concatenate(z), np.concatenate(letters)


def scores(model: Model, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the language, score, and letters of each row."""
    z, letters = logits(model, buf, offs)
    p = _softmax(z / model.temperature)
    return p.argmax(1), p.max(1), letters


def predict(docs: DataFrame, model: Model | None, out: str) -> DataFrame:
    """docs with a struct of lang, score and rejected."""
    if model is None:
        return docs.withColumn(out, F.struct(F.lit(UND).alias("lang"), F.lit(0.0).alias("score"), (~F.rlike(F.coalesce("text", F.lit("")), F.lit(r"\p{L}"))).alias("rejected")))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double, rejected: boolean>")
    def language(text: pa.Array) -> pa.Array:
        m = shared.value
        buf, offs = text_rows(text)
        langs, score = [], []
        for *_, b, o in slices(buf, offs, SLICE_BYTES):
            best, p, letters = scores(m, b, o)
            langs += [m.langs[i] if n else UND for i, n in zip(best.tolist(), letters.tolist(), strict=True)]
            score.append(np.where(letters > 0, p, 0.0))
        score = np.concatenate(score) if score else np.zeros(0)
        rejected = (score < m.least) | (score == 0)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(score), pa.array(rejected)], ["lang", "score", "rejected"])

    return docs.withColumn(out, language("text"))


def language_predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every row of docs (doc_id, text, lang)."""
    out = predict(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), train(docs), "found")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"), F.col("found.rejected").alias("rejected"))
