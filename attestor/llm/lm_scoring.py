"""Language-model scores by masked pseudo-likelihood.

Every word is predicted from both sides: a network over the tokens of the two words before and the two after it, with
embeddings and one hidden layer, gives log P(token | context) over TOKENS tokens by a softmax of two levels: over CLASSES
classes of tokens, then over the MEMBERS tokens of the class.  A document's score is the sum over all its words of the
conditional log probabilities, or its mean per word.

The OWN commonest words are tokens of their own.  The others share the remaining tokens by hash, and such a token's
probability is dealt out by the words' counts, n(word) / n(token).  The count of a word is its own, by 64 bits of hash, in
a table that grows with the vocabulary.  The commonest words' counts, HEAD at most, are broadcast, which keeps them out of
the join by which all others get theirs.

Training starts from the unigram model, the counts' logarithms as biases, so that the network only adds what contexts
tell.  It runs in numpy within every input partition; the weights are averaged over partitions by their number of words
(blocks of them are summed up by tasks of their own, so nothing that grows reaches the driver), for ROUNDS rounds that
start from the last average.  A round masks every ROUNDS-th position of every text, the next round the positions after
these, with all words as context, so that every word of every text is a target once.  Scores depend on how the files are
cut into partitions, as the averages do, but not on the order or place of tasks.

Defined cases: a text without words, or null, has 0 words, sum 0 and a null mean.  Rows may repeat and all get their own
result; ids may be null; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HashTable, cut, slices, small_batches, spans_hash, text_rows, words

HEAD = 1 << 18
CLASSES = MEMBERS = 64
TOKENS = CLASSES * MEMBERS
SHARED = TOKENS // 4
OWN = TOKENS - SHARED
EDGE = TOKENS  # stands for what lies beyond a text's ends
DIM, HIDDEN, SIDE = 8, 16, 2
ROUNDS, BATCH, RATE = 2, 8192, 2.0
#: Rows that a class counts as more than it has in a batch, and how much faster embeddings move than the other weights.
FEW, SPREAD = 16, 64
#: The last row of u and v is a bias: the hidden layer ends in a constant 1.
_SHAPES = [("e", (TOKENS + 1, DIM)), ("w", (2 * SIDE * DIM, HIDDEN)), ("b", (HIDDEN,)), ("u", (HIDDEN + 1, CLASSES)), ("v", (CLASSES, HIDDEN + 1, MEMBERS))]
WEIGHTS = sum(int(np.prod(s)) for _, s in _SHAPES)
#: What a token without a word counts.
UNSEEN = 0.01
#: Weights that one row carries to their average.
BLOCK = 1 << 13
GATHERED = 1 << 20
_LAST = (1 << 63) - 1


def split(weights: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in _SHAPES:
        n = int(np.prod(shape))
        out[name] = weights[at : at + n].reshape(shape)
        at += n
    return out


def start(counts: np.ndarray, seed: int = 11) -> np.ndarray:
    """Weights that give every token its share of the counts, whatever the context."""
    rng = np.random.default_rng(seed)
    out = np.zeros(WEIGHTS, np.float32)
    m = split(out)
    m["e"][:] = rng.normal(0, 0.5, m["e"].shape)
    m["w"][:] = rng.normal(0, 1 / np.sqrt(len(m["w"])), m["w"].shape)
    n = np.maximum(counts, UNSEEN).reshape(CLASSES, MEMBERS)
    m["v"][:, -1] = np.log(n / n.sum(1, keepdims=True))
    m["u"][-1] = np.log(n.sum(1) / n.sum())
    return out


def word_hashes(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 bits of hash of every word, and the n+1 offsets of rows into them."""
    starts, ends, at = words(buf, offs)
    return spans_hash(buf, starts, ends, lower=True), at


class Tokens:
    """The token of every word, by its hash."""

    def __init__(self, own: np.ndarray):
        self.table = HashTable(1 << (8 * max(1, len(own))).bit_length())
        self.table.put(own | np.uint64(1), np.arange(len(own), dtype=np.int32))

    def of(self, h: np.ndarray) -> np.ndarray:
        out = self.table.get(h | np.uint64(1))
        rare = out < 0
        out[rare] = OWN + (h[rare] & np.uint64(SHARED - 1)).astype(np.int32)
        return out


def _count(batches):
    """Counts of the words of about GATHERED at a time, summed up afterwards."""
    held, n = [], 0

    def counted():
        h, k = np.unique(np.concatenate(held), return_counts=True)
        for i in range(0, len(h), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(h[i : i + 50_000].view(np.int64)), pa.array(k[i : i + 50_000].astype(np.int64))], ["h", "n"])

    for batch in batches:
        buf, offs = text_rows(batch.column(0))
        for *_, b, o in slices(buf, offs, 1 << 20):
            held.append(word_hashes(b, o)[0])
            n += len(held[-1])
            if n >= GATHERED:
                yield from counted()
                held, n = [], 0
    if n:
        yield from counted()


def word_counts(docs: DataFrame) -> DataFrame:
    """h and n of every word of docs (text), written."""
    return cut(docs.select("text").mapInArrow(_count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "lm-counts")


def commonest(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted hashes of the words that are met most, HEAD at most, their counts, and the least of these."""
    step = F.floor(F.log2("n") * 16)
    total, least = 0, None
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect(), key=lambda r: -r["step"]):
        total += r["words"]
        if total > HEAD:
            break
        least = r["least"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), _LAST
    found = counts.where(F.col("n") >= least).toPandas()
    h, n = found["h"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)
    order = np.argsort(h)
    return h[order], n[order], least


def contexts(cls: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Tokens around every word, (words, 2 * SIDE); EDGE beyond a text's ends."""
    n = np.diff(at)
    gap = SIDE
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(cls)) + gap * (row + 1)
    wide = np.full(len(cls) + gap * (len(n) + 1), EDGE, np.int32)
    wide[place] = cls
    return np.stack([wide[place + d] for d in (*range(-SIDE, 0), *range(1, SIDE + 1))], 1)


def hidden(m: dict[str, np.ndarray], around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings of contexts, and the hidden layer with the constant."""
    x = m["e"].take(around, 0).reshape(len(around), -1)
    h = np.ones((len(around), HIDDEN + 1), np.float32)
    np.tanh(x @ m["w"] + m["b"], out=h[:, :-1])
    return x, h


def exponentials(h: np.ndarray, u: np.ndarray) -> np.ndarray:
    """exp of the logits, shifted by row where they could overflow: no logit is above the sum of its absolute weights."""
    z = h @ u
    if np.abs(u).sum(0).max() > 60:
        z -= z.max(1, keepdims=True)
    return np.exp(z, out=z)


def errors(h: np.ndarray, u: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The loss's gradient by the softmax's weights, summed over rows, and by the hidden layer without its constant."""
    z = exponentials(h, u)
    total = z.sum(1)
    z[np.arange(len(z)), target] -= total
    share = (1 / total)[:, None]
    return (h * share).T @ z, (z @ u[:-1].T) * share


def by_class(cls: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of rows by class, and (class, from, to) of each class that occurs."""
    order = np.argsort(cls.astype(np.uint16), kind="stable")  # a radix sort
    edge = np.flatnonzero(np.diff(cls[order], prepend=-1)).tolist()
    return order, [(int(cls[order[a]]), a, b) for a, b in zip(edge, [*edge[1:], len(order)], strict=True)]


def learn(weights: np.ndarray, around: np.ndarray, target: np.ndarray, rate: float) -> None:
    """One pass of stochastic gradient descent, in place."""
    m = split(weights)
    for i in range(0, len(target), BATCH):
        order, groups = by_class(target[i : i + BATCH] // MEMBERS)
        ctx, y = around[i : i + BATCH][order], target[i : i + BATCH][order]
        n, member = len(y), y % MEMBERS
        x, h = hidden(m, ctx)
        dh, du = np.empty((n, HIDDEN), np.float32), 0
        for a in range(0, n, 1024):  # what stays in a core's cache
            k = slice(a, a + 1024)
            step, dh[k] = errors(h[k], m["u"], y[k] // MEMBERS)
            du = du + step
        for c, a, b in groups:
            step, more = errors(h[a:b], m["v"][c], member[a:b])
            dh[a:b] += more
            m["v"][c] -= (rate / (b - a + FEW)) * step
        m["u"] -= (rate / n) * du
        dh *= 1 - h[:, :-1] ** 2
        dx = (dh @ m["w"].T).reshape(-1, DIM)
        m["w"] -= (rate / n) * (x.T @ dh)
        m["b"] -= (rate / n) * dh.sum(0)
        flat = ctx.ravel()
        for k in range(DIM):
            m["e"][:, k] -= (rate * SPREAD / n) * np.bincount(flat, dx[:, k], TOKENS + 1)


def _train(shared, number: int):
    def run(batches):
        (weights, own), seen = shared.value, 0
        weights, tokens = weights.copy(), Tokens(own)
        for batch in batches:
            buf, offs = text_rows(batch.column(0))
            for *_, b, o in slices(buf, offs):
                h, at = word_hashes(b, o)
                if len(h):
                    token = tokens.of(h)
                    place = np.arange(len(token)) - np.repeat(at[:-1], np.diff(at))
                    pick = np.flatnonzero(place % ROUNDS == number)
                    learn(weights, contexts(token, at)[pick], token[pick], np.float32(RATE / (1 + number)))
                    seen += len(token)
        if seen:
            for k in range(0, WEIGHTS, BLOCK):
                part = weights[k : k + BLOCK].astype(np.float64) * seen
                yield pa.RecordBatch.from_arrays([pa.array([k // BLOCK], pa.int32()), pa.array([seen], pa.int64()), pa.array([part.astype("<f4").tobytes()], pa.binary())], ["block", "n", "part"])

    return run


def _average(batches):
    """(block, n, part) of all partitions -> each block's mean; a task holds the sums of its blocks only."""
    n, total = {}, {}
    for batch in batches:
        for block, k, part in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            n[block] = n.get(block, 0) + k
            total[block] = total.get(block, 0) + np.frombuffer(part, "<f4").astype(np.float64)
    for block in sorted(n):
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([(total[block] / n[block]).astype("<f4").tobytes()], pa.binary())], ["block", "part"])


def train(docs: DataFrame, own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The network's weights after all texts, given the words with tokens of their own and all tokens' counts."""
    sc = docs.sparkSession.sparkContext
    weights = start(counts)
    if counts.any():
        for number in range(ROUNDS):
            parts = docs.select("text").mapInArrow(_train(sc.broadcast((weights, own)), number), "block int, n long, part binary")
            mean = parts.repartition(-(-WEIGHTS // BLOCK), "block").mapInArrow(_average, "block int, part binary").toArrow().sort_by("block")
            weights = np.frombuffer(b"".join(mean.column("part").to_pylist()), "<f4").copy()
    return weights


def token_sums(weights: np.ndarray, token: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sum of each row's log P(token | context)."""
    m = split(weights)
    out = np.zeros(len(token) + 1)
    if len(token):
        order, groups = by_class(token // MEMBERS)
        around, member = contexts(token, at)[order], token[order] % MEMBERS
        own, cls = np.empty(len(token), np.float64), token[order] // MEMBERS
        h = np.empty((len(token), HIDDEN + 1), np.float32)
        for i in range(0, len(token), 1024):
            h[i : i + 1024] = hidden(m, around[i : i + 1024])[1]
            own[i : i + 1024] = log_softmax(h[i : i + 1024], m["u"], cls[i : i + 1024])
        for c, a, b in groups:
            for i in range(a, b, 1024):
                k = slice(i, min(b, i + 1024))
                own[k] += log_softmax(h[k], m["v"][c], member[k])
        placed = np.empty_like(own)
        placed[order] = own
        np.cumsum(placed, out=out[1:])
    return out[at[1:]] - out[at[:-1]]


def log_softmax(h: np.ndarray, u: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The targets' log probabilities."""
    z = exponentials(h, u)
    return np.log(z[np.arange(len(z)), target] / z.sum(1))


def _scored(shared):
    """A row's words, the sum of log P(token | context) and log P(word | token) but for the counts of words outside the head, and these words."""

    def run(batches):
        weights, own, counts, head, n_head = shared.value
        tokens, log_token, log_head = Tokens(own), np.log(np.maximum(counts, UNSEEN)), np.log(n_head)
        met = HashTable(1 << (4 * max(1, len(head))).bit_length())
        met.put(head | np.uint64(1), np.arange(len(head), dtype=np.int32))
        pid, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            buf, offs = text_rows(batch.column(1))
            for a, z, b, o in slices(buf, offs):
                h, at = word_hashes(b, o)
                token = tokens.of(h)
                total = token_sums(weights, token, at)
                k = met.get(h | np.uint64(1))
                common = k >= 0
                logs, rare = np.zeros(len(h) + 1), np.zeros(len(h) + 1, np.int32)
                np.cumsum(np.where(common, log_head[k] if len(head) else 0, 0) - log_token[token], out=logs[1:])
                np.cumsum(~common, out=rare[1:])
                total = total + logs[at[1:]] - logs[at[:-1]]
                lists = pa.ListArray.from_arrays(pa.array(rare[at]), pa.array(h[~common].view(np.int64)))
                row = pa.array((pid << 33) + seen + np.arange(z - a))
                seen += z - a
                yield pa.RecordBatch.from_arrays([row, batch.column(0).slice(a, z - a), pa.array(np.diff(at)), pa.array(total), lists], ["row", "doc_id", "n_words", "total", "rare"])

    return run


def tokens_of(table: DataFrame, head: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of words with tokens of their own, commonest first, and the counts of all tokens."""
    own = head[np.lexsort((head, -n))[:OWN]]
    counts = np.zeros(TOKENS, np.float64)
    for r in table.groupBy(F.col("h").bitwiseAND(SHARED - 1).alias("slot")).agg(F.sum("n").alias("n")).collect():
        counts[OWN + r["slot"]] = r["n"]
    n_own = n[np.lexsort((head, -n))[:OWN]]
    np.subtract.at(counts, OWN + (own & np.uint64(SHARED - 1)).astype(np.int64), n_own)
    counts[: len(own)] = n_own
    return own, counts


def lm_scores(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, log_likelihood and mean_log_likelihood of every row of docs (doc_id, text)."""
    table = word_counts(small_batches(docs))
    *head, least = commonest(table)
    own, counts = tokens_of(table, *head)
    shared = docs.sparkSession.sparkContext.broadcast((train(docs, own, counts), own, counts, *head))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scored(shared), "row long, doc_id long, n_words long, total double, rare array<long>")
    rows = cut(rows, "lm-rows")
    met = rows.select("row", F.explode("rare").alias("h"))
    logs = met.join(table.where(F.col("n") < least).select("h", F.log("n").alias("log_n")), "h").groupBy("row").agg(F.sum("log_n").alias("more"))
    out = rows.drop("rare").join(logs, "row", "left")
    total = F.col("total") + F.coalesce("more", F.lit(0.0))
    return out.select("doc_id", "n_words", total.alias("log_likelihood"), F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_likelihood"))
