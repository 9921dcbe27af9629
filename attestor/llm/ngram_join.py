"""Similarity self-join of documents on sets of word shingles, by prefix tokens and signature trees.

Every document is the set of its distinct 5-word shingles (ASCII letters folded; a shorter text is one shingle).
Documents link when 100 * |A & B| >= 80 * |A | B|; the result names each document's component of links.

How it scales:

1. Equal sets are one node; each input partition sends a node once, so copies cost nothing further on.
2. Shingles have one global order, the commonest last.  Linked sets share a token among the first
   ``n - ceil(0.8 n) + 1`` of each, so nodes meet by these prefix tokens only, and only if their sizes and what is left of
   them from that token on allow enough in common.  The order decides speed, never results:
   counts of common shingles come from all rows, and the bounded list of the commonest ones is what is broadcast.
3. Within a token's nodes sorted by size, neighbours are compared first and give many of the links.  Nodes of the same
   component need no comparison, so families of near copies, however large, fold up.
4. What is left, nodes of one token in different components, goes through signature trees: nodes hold OR-combined
   bitmaps and size ranges, and a dual traversal drops pairs of nodes by the largest overlap they could have.  Of tokens
   with the same nodes the first is searched, and large groups are dealt out as pairs of blocks.  A first search takes only
   each component's closest pair, which folds families up further; the second takes every pair that is left.
5. Candidates are sieved by their own bitmaps, of fixed size first and then of four bits a token, and verified on
   whole texts; components come from alternating large-star and small-star rounds.

Defined cases: null or empty text or white space only: an empty set, linked with nothing, component is the row's own
doc_id.  Rows with a null doc_id join in by text, and a component's id is the smallest non-null one (null if none).
Repeated rows, and repeated ids with different texts, are allowed.  Other columns are ignored.  A node is named by a
64-bit digest of its set.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, lean, possible, shingles, slices, small_batches, text_rows

#: The commonest shingles that are broadcast to order the rest, at most.
COMMON = 1 << 16
#: Rows of one token that a task compares with one another at most; more are dealt out as pairs of blocks.
BLOCK = 2048
#: Links that one task joins up to components; it takes some 200 bytes for each.
ONE_TASK = 1_000_000
BITS = 1024
PERCENT = 80
_TOP = np.uint64(1) << np.uint64(62)


def _sets(buf: np.ndarray, offs: np.ndarray, width: int, common: np.ndarray | None = None):
    """Sorted distinct tokens of every row (62 bits); with `common` (hashes sorted, rank), common ones sort last."""
    h, at = shingles(buf, offs, width)
    h >>= np.uint64(2)
    if common is not None and len(common):
        keys, ranks = common["h"], common["rank"]
        i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        h = np.where(keys[i] == h, _TOP | ranks[i], h)
    for a, b in zip(at[:-1], at[1:], strict=True):
        own = np.sort(h[a:b])
        yield own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) > 1 else own


def node_of(tokens: np.ndarray, clashes: frozenset = frozenset()) -> tuple[int, int]:
    """A set's node and check number, 64 bits of digest each; where sets clash in the node, it is told apart by the check."""
    node, check = np.frombuffer(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest(), "<i8").tolist()
    return (node ^ check if node in clashes else node), check


def _repeated(width: int):
    """Tokens that many documents share: whatever repeats within a few thousand documents, with its count."""

    def run(batches):
        held, n = [], 0

        def flush():
            tokens = np.concatenate(held)
            held.clear()
            tokens.sort()  # in place, and only repeated ones are indexed: numpy.unique takes several times the tokens' memory
            edge = np.diff(np.concatenate([[False], tokens[1:] == tokens[:-1], [False]]).view(np.int8))
            first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            return pa.RecordBatch.from_arrays([pa.array(tokens[first].astype(np.int64)), pa.array(last - first + 1)], ["token", "n"])

        for batch in batches:
            buf, offs = text_rows(batch.column(0))
            for *_, b, o in slices(buf, offs):
                for own in _sets(b, o, width):
                    held.append(own)
                    n += len(own)
                    if n > 2_000_000:
                        yield flush()
                        n = 0
        if held:
            yield flush()

    return run


def common_tokens(docs: DataFrame, width: int) -> np.ndarray:
    """The commonest tokens, COMMON at most, with their rank by count."""
    counts = cut(docs.select("text").mapInArrow(lean(_repeated(width)), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where("n >= 8"), "ngram-common")
    steps = sorted((r for r in counts.groupBy(F.floor(F.log2("n") * 4).alias("step")).count().collect()), key=lambda r: -r["step"])
    least, total = None, 0
    for r in steps:
        total += r["count"]
        if total > COMMON:
            break
        least = r["step"]
    if least is None:
        return np.zeros(0, [("h", np.uint64), ("rank", np.uint64), ("n", np.int64)])
    rows = counts.where(F.floor(F.log2("n") * 4) >= least).toPandas().sort_values(["n", "token"])
    out = np.zeros(len(rows), [("h", np.uint64), ("rank", np.uint64), ("n", np.int64)])
    out["h"], out["rank"], out["n"] = rows["token"].to_numpy().astype(np.uint64), np.arange(len(rows)), rows["n"]
    return np.sort(out, order="h")


def documents_as_nodes(docs: DataFrame, width: int = 5) -> DataFrame:
    """(doc_id, n, node, check, bitmap, excess, wide) of each document's set; node is null for an empty one.

    Only the first row of a node in a partition has its bitmaps: one of BITS for the trees, where excess is how many
    tokens share a bit with others, and for larger sets a wide one of four bits a token or more.
    """

    def run(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            buf, offs = text_rows(batch.column(1))
            n, node, check, maps, excess, wide = [], [], [], [], [], []
            for *_, b, o in slices(buf, offs):
                for own in _sets(b, o, width):
                    n.append(len(own))
                    both = node_of(own) if len(own) else (None, None)
                    node.append(both[0])
                    check.append(both[1])
                    if len(own) and both not in seen:
                        seen.add(both)
                        m = _bitmap(own)
                        maps.append(m.tobytes())
                        excess.append(len(own) - int(np.bitwise_count(m).sum()))
                        bits = 1 << (4 * len(own) - 1).bit_length()
                        wide.append(_bitmap(own, bits).tobytes() if bits > BITS else None)
                    else:
                        maps.append(None)
                        excess.append(None)
                        wide.append(None)
            columns = [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(check, pa.int64()), pa.array(maps, pa.binary()), pa.array(excess, pa.int32()), pa.array(wide, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "node", "check", "bitmap", "excess", "wide"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(run), "doc_id long, n long, node long, check long, bitmap binary, excess int, wide binary")


def _prefixes(width: int, common, clashes: frozenset):
    def run(batches):
        seen: set[int] = set()
        table = common.value
        parts = np.ones(len(table), np.int32)
        parts[table["rank"].astype(np.int64)] = 1 + table["n"] // 50_000
        for batch in batches:
            buf, offs = text_rows(batch.column(0))
            for *_, b, o in slices(buf, offs, 1 << 20):
                tokens, nodes, sizes, rests = [], [], [], []
                for own in _sets(b, o, width, table):
                    n = len(own)
                    if not n:
                        continue
                    # the digest is of the tokens themselves, so common ones get their own names back
                    plain = own
                    if own[-1] >= _TOP:
                        plain = own.copy()
                        high = own >= _TOP
                        plain[high] = by_rank(table)[(own[high] ^ _TOP).astype(np.int64)]
                        plain.sort()
                    node, _ = node_of(plain, clashes)
                    if node in seen:
                        continue
                    seen.add(node)
                    p = n - (PERCENT * n + 99) // 100 + 1
                    tokens.append(own[:p])
                    nodes.append(np.full(p, node, np.int64))
                    sizes.append(np.full(p, n, np.int32))
                    rests.append(np.arange(n, n - p, -1, np.int32))
                if tokens:
                    token, node = np.concatenate(tokens), np.concatenate(nodes)
                    part = np.zeros(len(token), np.int32)
                    high = token >= _TOP
                    if high.any():
                        part[high] = np.mod(node[high], parts[(token[high] ^ _TOP).astype(np.int64)])
                    yield pa.RecordBatch.from_arrays([pa.array(token.astype(np.int64)), pa.array(part), pa.array(node), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(rests))], ["token", "part", "node", "n", "rest"])

    def by_rank(table):
        if "h" not in cache:
            cache["h"] = np.empty(len(table), np.uint64)
            cache["h"][table["rank"].astype(np.int64)] = table["h"]
        return cache["h"]

    cache: dict = {}
    return run


def needed(na, nb):
    """The least number of common tokens that sets of these sizes link by."""
    return -(-PERCENT * (na + nb) // (100 + PERCENT))


def _meet(batches):
    """Of the (token, part, node, n, rest) of a partition: rows whose token may link them, and pairs of neighbours by size.

    Sets link at the first token of the order that they share only if no more than their rests can be common, so a row is
    kept if another of its token is of a size that its own rest suffices for; a token dealt to parts keeps all.
    """
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    token, part, node, n, rest = (np.concatenate([b.column(i).to_numpy() for b in batches]) for i in range(5))
    del batches
    order = np.lexsort((node, n, part, token))
    token, part, node, n, rest = (x[order] for x in (token, part, node, n, rest))
    same = (token[1:] == token[:-1]) & (part[1:] == part[:-1])
    new = np.concatenate([[True], ~(same & (node[1:] == node[:-1]))])
    token, part, node, n, rest = (x[new] for x in (token, part, node, n, rest))
    n, rest = n.astype(np.int64), rest.astype(np.int64)
    same = (token[1:] == token[:-1]) & (part[1:] == part[:-1])
    group = np.concatenate([[0], np.cumsum(~same)]) << 32
    most = np.minimum(100 * n // PERCENT, (100 + PERCENT) * rest // PERCENT - n)
    met = np.searchsorted(group + n, group + most, "right") - np.searchsorted(group + n, group + -(-PERCENT * n // 100))
    kept = (met > (most >= n)) | (token >= int(_TOP))
    near = np.flatnonzero(same & kept[:-1] & kept[1:] & (100 * n[:-1] >= PERCENT * n[1:]) & (np.minimum(rest[:-1], rest[1:]) >= needed(n[:-1], n[1:])))
    pairs = np.unique(np.stack([np.minimum(node[near], node[near + 1]), np.maximum(node[near], node[near + 1])], 1), axis=0)
    names = ["kind", "token", "node", "rest", "other"]
    at = np.flatnonzero(kept)
    for i in range(0, len(at), 200_000):
        k = at[i : i + 200_000]
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(k), np.int32)), pa.array(token[k]), pa.array(node[k]), pa.array(rest[k].astype(np.int32)), pa.array(np.zeros(len(k), np.int64))], names)
    for i in range(0, len(pairs), 200_000):
        p = pairs[i : i + 200_000]
        zero = np.zeros(len(p), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(zero.astype(np.int32) + 1), pa.array(zero), pa.array(p[:, 0].copy()), pa.array(zero.astype(np.int32)), pa.array(p[:, 1].copy())], names)


def _bitmap(tokens: np.ndarray, size: int = BITS) -> np.ndarray:
    """Bits of the tokens' values modulo size; OR of its halves is the bitmap of half the size."""
    bits = np.zeros(size, bool)
    bits[tokens.astype(np.int64) & (size - 1)] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


class SignatureTree:
    """Levels of (OR of bitmaps, least and largest size, largest excess, component if only one, largest rest) over sorted rows."""

    FAN = 8

    def __init__(self, maps, n, excess, comp, rest=None):
        self.levels = [(maps, n, n, excess, comp, comp, n if rest is None else rest)]
        while len(self.levels[-1][1]) > 1:
            m, lo, hi, ex, c0, c1, rest = self.levels[-1]
            at = np.arange(0, len(lo), self.FAN)
            self.levels.append((np.bitwise_or.reduceat(m, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.maximum.reduceat(ex, at), np.minimum.reduceat(c0, at), np.maximum.reduceat(c1, at), np.maximum.reduceat(rest, at)))

    def pairs_with(self, other: SignatureTree) -> np.ndarray:
        """Leaf pairs that may link and lie in different components, by descending both trees at once."""
        top = max(len(self.levels), len(other.levels)) - 1
        pairs = np.zeros((1, 2), np.int64)
        for depth in range(top, -1, -1):
            a, b = self.levels[min(depth, len(self.levels) - 1)], other.levels[min(depth, len(other.levels) - 1)]
            if depth < top:
                pairs = self._children(pairs, depth, other)
            kept = []
            for i in range(0, len(pairs), 1 << 16):
                x, y = pairs[i : i + (1 << 16)].T
                apart = ~((a[4][x] == a[5][x]) & (b[4][y] == b[5][y]) & (a[4][x] == b[4][y]))
                apart &= (100 * a[2][x] >= PERCENT * b[1][y]) & (100 * b[2][y] >= PERCENT * a[1][x])
                x, y = x[apart], y[apart]
                wanted, shared = needed(a[1][x], b[1][y]), np.minimum(a[6][x], b[6][y])
                x, y, wanted, shared = x[shared >= wanted], y[shared >= wanted], wanted[shared >= wanted], shared[shared >= wanted]
                both = np.bitwise_count(a[0][x] & b[0][y]).sum(1, dtype=np.int64)
                most = np.minimum(np.minimum(a[3][x], b[3][y]) + both, np.minimum(np.minimum(a[2][x], b[2][y]), shared))
                kept.append(np.stack([x[most >= wanted], y[most >= wanted]], 1))
            pairs = np.concatenate(kept) if kept else pairs[:0]
            if self is other:
                pairs = pairs[pairs[:, 0] <= pairs[:, 1]]
        return pairs if self is not other else pairs[pairs[:, 0] < pairs[:, 1]]

    def _children(self, pairs, depth, other):
        def below(tree):
            return depth < len(tree.levels) - 1

        fa, fb = (self.FAN if below(self) else 1), (self.FAN if below(other) else 1)
        x = (pairs[:, 0] * fa)[:, None, None] + np.arange(fa)[None, :, None]
        y = (pairs[:, 1] * fb)[:, None, None] + np.arange(fb)[None, None, :]
        x, y = np.broadcast_arrays(x, y)
        x, y = x.ravel(), y.ravel()
        ok = (x < len(self.levels[min(depth, len(self.levels) - 1)][1])) & (y < len(other.levels[min(depth, len(other.levels) - 1)][1]))
        return np.stack([x[ok], y[ok]], 1)


def _plausible(batches):
    """(a, b, size, excess and bitmap of each) -> the pairs that may link by their bitmaps."""
    for batch in batches:
        na, nb, ea, eb = (batch.column(i).to_numpy().astype(np.int64) for i in range(2, 6))
        x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(-1, BITS // 64) for i in (6, 7))
        both = np.bitwise_count(x & y).sum(1, dtype=np.int64)
        most = np.minimum(np.minimum(ea, eb) + both, np.minimum(na, nb))
        yield batch.select(["a", "b"]).filter(pa.array(most >= needed(na, nb)))


def _plausible_wide(batches):
    """(a, b, size and wide bitmap of each) -> the pairs that may link by these; the larger is folded to the smaller."""
    for batch in batches:
        keep = []
        for na, nb, x, y in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            while len(x) > len(y):
                x = x[: len(x) // 2] | x[len(x) // 2 :]
            while len(y) > len(x):
                y = y[: len(y) // 2] | y[len(y) // 2 :]
            both = int(np.bitwise_count(x & y).sum())
            most = min(na - int(np.bitwise_count(x).sum()), nb - int(np.bitwise_count(y).sum())) + both
            keep.append(min(most, na, nb) >= needed(na, nb))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _closest(x, y, like, comp):
    """Of pairs of rows, for each component the one most alike with another."""
    order = np.argsort(-like, kind="stable")
    x, y = x[order], y[order]
    _, i = np.unique(comp[x], return_index=True)
    _, k = np.unique(comp[y], return_index=True)
    keep = np.union1d(i, k)
    return x[keep], y[keep]


def _search(every: bool):
    return lambda batches: _searched(batches, every)


def _searched(batches, every):
    """Of (token, bi, bj, block, node, comp, rest, n, bitmap, excess): pairs of nodes that may link, by the trees.

    Not every: only each component's closest pair within a group.
    """
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    t = pa.Table.from_batches(batches).combine_chunks()
    token, bi, bj, block, node, comp, rest, n, excess = (t.column(c).to_numpy() for c in ("token", "bi", "bj", "block", "node", "comp", "rest", "n", "excess"))
    maps = np.frombuffer(b"".join(t.column("bitmap").to_pylist()), np.uint64).reshape(-1, BITS // 64)
    order = np.lexsort((n, comp, block, bj, bi, token))
    edge = np.flatnonzero(np.concatenate([[True], (token[order][1:] != token[order][:-1]) | (bi[order][1:] != bi[order][:-1]) | (bj[order][1:] != bj[order][:-1])]))
    out, held = [], 0

    def flush():
        p = np.unique(np.concatenate(out), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(p[:, 0].copy()), pa.array(p[:, 1].copy())], ["a", "b"])

    def tree(rows):
        return SignatureTree(maps[rows], n[rows].astype(np.int64), excess[rows].astype(np.int64), comp[rows], rest[rows].astype(np.int64))

    for a, b in zip(edge, [*edge[1:], len(order)], strict=True):
        rows = order[a:b]
        if bi[rows[0]] == bj[rows[0]]:
            one = tree(rows)
            found = one.pairs_with(one)
            x, y = rows[found[:, 0]], rows[found[:, 1]]
        else:
            left, right = rows[block[rows] == bi[rows[0]]], rows[block[rows] == bj[rows[0]]]
            if not len(left) or not len(right):
                continue
            found = tree(left).pairs_with(tree(right))
            x, y = left[found[:, 0]], right[found[:, 1]]
        if len(x) and not every:
            both = np.concatenate([np.bitwise_count(maps[x[i : i + 65536]] & maps[y[i : i + 65536]]).sum(1, dtype=np.int64) for i in range(0, len(x), 65536)])
            x, y = _closest(x, y, both / (n[x].astype(np.int64) + n[y]), comp)
        if len(x):
            x, y = node[x], node[y]
            out.append(np.stack([np.minimum(x, y), np.maximum(x, y)], 1))
            held += len(x)
        if held > 500_000:
            yield flush()
            out, held = [], 0
    if out:
        yield flush()


def _linked(width: int):
    """(a, b, text of a, text of b) -> the pairs that link."""

    def run(batches):
        for batch in batches:
            sides = []
            for column in (2, 3):
                buf, offs = text_rows(batch.column(column))
                sides.append(own for *_, b, o in slices(buf, offs) for own in _sets(b, o, width))
            keep = []
            for x, y in zip(*sides, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _forest(batches):
    """(node, root) of the links (a, b) of one partition, by union-find; the root is the smallest node."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    a, b = (np.concatenate([x.column(i).to_numpy() for x in batches]) for i in (0, 1))
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    up = list(range(len(nodes)))

    def root(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for x, y in zip(index[: len(a)].tolist(), index[len(a) :].tolist(), strict=True):
        x, y = root(x), root(y)
        up[max(x, y)] = min(x, y)
    roots = np.array([root(x) for x in range(len(nodes))])
    own = np.flatnonzero(roots != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[roots[own]])], ["node", "root"])


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, root) of every node of the links (a, b) but the roots, which are the smallest of their components.

    Up to `one_task` links are one task's union-find.  More go through alternating large-star and small-star rounds
    until nothing changes.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    if edges.count() <= one_task:
        return cut(edges.coalesce(1).mapInArrow(lean(_forest), "node long, root long"), "forest")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("a", "b", "m")
        edges = cut(small.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def ngram_components(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of docs (doc_id, text)."""
    spark = small_batches(docs).sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    nodes = cut(documents_as_nodes(docs, width), "ngram-nodes")
    # sets whose nodes clash are a few of 10 ** 10; they are renamed everywhere
    clashes = frozenset(r["node"] for r in nodes.groupBy("node").agg((F.min("check") != F.max("check")).alias("two")).where("two").select("node").collect())
    if clashes:
        nodes = nodes.withColumn("node", F.when(F.col("node").isin(*clashes), F.col("node").bitwiseXOR(F.col("check"))).otherwise(F.col("node")))
    classes = nodes.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"))
    common = spark.sparkContext.broadcast(common_tokens(docs, width))
    rows = docs.select("text").mapInArrow(lean(_prefixes(width, common, clashes)), "token long, part int, node long, n int, rest int")
    met = cut(rows.repartition("token", "part").mapInArrow(lean(_meet), "kind int, token long, node long, rest int, other long"), "ngram-met")
    shared, first = met.where("kind = 0").select("token", "node", "rest"), met.where("kind = 1").select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()

    maps = nodes.where("bitmap is not null").select("node", F.col("n").cast("int").alias("n"), "bitmap", "excess")
    drawn = cut(shared.select("node").distinct(), "ngram-shared")
    maps = cut(possible(maps, "node", drawn)[0].join(drawn, "node", "left_semi").dropDuplicates(["node"]), "ngram-bitmaps")

    def linked(pairs: DataFrame) -> DataFrame:
        def side(x):
            return maps.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("excess").alias(f"e{x}"), F.col("bitmap").alias(f"m{x}"))

        may = cut(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ea", "eb", "ma", "mb").mapInArrow(lean(_plausible), "a long, b long"), "ngram-pairs")
        taking_part = may.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        taking_part = cut(taking_part, "ngram-part")
        wide = nodes.where("bitmap is not null").select("node", "n", F.coalesce("wide", "bitmap").alias("wide"))
        wide = cut(possible(wide, "node", taking_part)[0].join(taking_part, "node", "left_semi").dropDuplicates(["node"]), "ngram-wide")

        def broad(x):
            return wide.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("wide").alias(f"w{x}"))

        may = cut(may.join(broad("a"), "a").join(broad("b"), "b").select("a", "b", "na", "nb", "wa", "wb").mapInArrow(lean(_plausible_wide), "a long, b long"), "ngram-pairs")
        read = cut(may.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(classes, "node"), "ngram-read")
        own = possible(docs, "doc_id", read.select("rep"))[0].alias("d").join(read.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.rep"))).select("node", "text")
        texts = cut(own.mapInArrow(lean(_only_own(width, clashes)), "node long, text string"), "ngram-texts")
        sides = may.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
        return cut(sides.select("a", "b", "ta", "tb").mapInArrow(lean(_linked(width)), "a long, b long"), "ngram-links")

    def met_in_trees(roots: DataFrame, every: bool) -> DataFrame:
        """Candidates between components; of tokens with the same nodes, one stands for all."""
        marked = shared.join(roots, "node", "left").select("token", "node", "rest", F.coalesce("root", "node").alias("comp"))
        print_ = [F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("g"), F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.hash("node").cast("long")).alias("s")]
        mixed = marked.groupBy("token").agg(*print_).where("c0 <> c1").groupBy("g", "x", "s").agg(F.min("token").alias("token")).select("token", F.ceil(F.col("g") / BLOCK).cast("int").alias("nb"))
        dealt = marked.join(mixed, "token").withColumn("block", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        dealt = dealt.join(maps, "node").select("token", F.least("block", "j").alias("bi"), F.greatest("block", "j").alias("bj"), "block", "node", "comp", "rest", "n", "bitmap", "excess")
        return dealt.repartition("token", "bi", "bj").mapInArrow(lean(_search(every)), "a long, b long").distinct()

    links = linked(first)
    roots = components(links)
    for every in (False, True):
        links = links.unionByName(linked(met_in_trees(roots, every)))
        roots = components(links)
    named = classes.join(roots, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    names = named.join(named.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select("node", "component_id")
    out = nodes.join(names, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _only_own(width: int, clashes: frozenset):
    """Rows whose text is the one that the node was named by, once each: ids may repeat, with other texts or the same."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            buf, offs = text_rows(batch.column(1))
            node = [node_of(own, clashes)[0] if len(own) else None for *_, b, o in slices(buf, offs) for own in _sets(b, o, width)]
            mine = []
            for x, y in zip(node, batch.column(0).to_pylist(), strict=True):
                mine.append(x == y and x not in seen)
                seen.add(x) if mine[-1] else None
            yield batch.filter(pa.array(mine, pa.bool_()))

    return run


SQL = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
n as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) end as g from d),
e as (select doc_id, len(g) as n, unnest(g) as t from n),
p as (
  select a.doc_id as a, b.doc_id as b, count(*) as c, any_value(a.n) as na, any_value(b.n) as nb
  from e a join e b on a.t = b.t and a.doc_id < b.doc_id and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) group by 1, 2),
l as (select a, b from p where 100 * c >= 80 * (na + nb - c)),
sides as (select a, b from l union all select b, a from l),
r as (select doc_id as x, doc_id as y from n union select r.x, sides.b from r join sides on sides.a = r.y),
m as (select x, min(y) as component_id from r group by x)
select doc_id, cast(len(g) as bigint) as n_shingles, component_id from n join m on x = doc_id
"""
