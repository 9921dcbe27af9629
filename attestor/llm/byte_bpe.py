"""Byte-level BPE encoding and decoding on padded numpy matrices.

A slice of texts is cut into pre-tokens by run boundaries of character classes (the pattern of the rank files, without
a regular-expression engine).  Pre-tokens are looked up by hash, and compared by their bytes, among those that the worker has met; new ones
are encoded together: bucketed by length into padded matrices in which every row merges its leftmost pair of minimum
rank each round, pairs being looked up in an open-addressing hash table, and finished rows leave the matrix.  Pre-tokens
of over LONG bytes, of which a matrix would need as many rounds, are merged with a heap.

Defined cases: a null text is an empty one and has no tokens; its digests are those of no bytes.  Rows may repeat; ids
may be null or repeat; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HashTable, Met, mix, slices, small_batches, spans_hash, text_rows

LONG = 128
#: A worker forgets the pre-tokens that it has met when there are more.
KNOWN = 500_000
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
#: \s of the pattern beside ASCII's: fixed values of Unicode's White_Space.
WIDE_SPACES = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_NONE = np.int32(2**31 - 1)


def class_table() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[[9, 10, 11, 12, 13, 32, *WIDE_SPACES]] = SPACE
    return out


_classes: list[np.ndarray] = []


def byte_classes(buf: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of UTF-8 belongs to."""
    if not _classes:
        _classes.append(class_table())
    table = _classes[0]
    out = table[:256][buf]
    at = np.flatnonzero(buf >= 0xC0)
    if len(at):
        b = np.concatenate([buf, np.zeros(3, np.uint8)]).astype(np.uint32)
        lead = b[at]
        two, three = lead < 0xE0, lead < 0xF0
        c1, c2, c3 = b[at + 1] & 63, b[at + 2] & 63, b[at + 3] & 63
        point = np.where(two, (lead & 31) << 6 | c1, np.where(three, (lead & 15) << 12 | c1 << 6 | c2, (lead & 7) << 18 | c1 << 12 | c2 << 6 | c3))
        kind = table[np.minimum(point, 0x10FFFF)]
        out[at], out[at + 1] = kind, kind
        wide = at[~two]
        out[wide + 2] = kind[~two]
        out[at[~three] + 3] = kind[~three]
    return out


def runs(buf: np.ndarray, offs: np.ndarray):
    """Starts, ends, classes of the maximal runs of one class within a row, and which runs end their row."""
    n = len(buf)
    kind = byte_classes(buf)
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    new[offs[:-1][offs[:-1] < n]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n)
    final = np.zeros(n + 1, bool)
    final[offs] = True
    return starts, ends, kind[starts], final[ends]


def contracted(buf, starts, ends, kind, final, free):
    """Of runs of one ' that begin a match: the index of the run of letters after each, and how many bytes it gives."""
    k = np.flatnonzero((kind == OTHER) & (ends - starts == 1) & (buf[starts] == 39) & ~final & free)
    k = k[kind[np.minimum(k + 1, len(kind) - 1)] == LETTER] if len(k) else k
    at = starts[k + 1] if len(k) else k
    size = ends[k + 1] - at if len(k) else k
    a = buf[at]
    b = np.where(size > 1, buf[np.minimum(at + 1, len(buf) - 1)], 0) if len(k) else a
    take = np.where(np.isin(a, [115, 116, 109, 100]), 1, np.where(((a == 114) & (b == 101)) | ((a == 118) & (b == 101)) | ((a == 108) & (b == 108)), 2, 0))
    return k[take > 0] + 1, take[take > 0]


def pretokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of each match of the pattern, and the n+1 offsets of rows into them."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    starts, ends, kind, final = runs(buf, offs)
    begins = np.zeros(len(buf) + 1, bool)
    begins[starts] = True
    gap = np.flatnonzero((kind == SPACE) & ~final)
    last = ends[gap] - 1
    for _ in range(3):
        last -= (buf[last] & 0xC0) == 0x80
    begins[last] = True
    joined = buf[last] == 32
    begins[ends[gap[joined]]] = False
    free = np.ones(len(starts), bool)
    free[gap[joined] + 1] = False
    run, take = contracted(buf, starts, ends, kind, final, free)
    begins[starts[run]] = False
    begins[starts[run] + take] = True
    begins[offs] = False
    filled = offs[:-1][np.diff(offs) > 0]
    begins[filled] = True
    # a run that ends where a contraction does begins there anyway, unless a space there belongs to what follows
    first = np.flatnonzero(begins)
    return first, np.append(first[1:], len(buf)), np.searchsorted(first, offs)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Ranks:
    """Tables of a rank file: small enough to broadcast, as they depend on the vocabulary alone."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.table = HashTable(1 << (4 * len(pairs)).bit_length())
        keys = np.fromiter(pairs, np.uint64, len(pairs))
        self.table.put(mix(keys + np.uint64(1)), np.fromiter(pairs.values(), np.int32, len(pairs)))
        size = max(ranks.values()) + 1
        self.lengths = np.zeros(size, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        by_rank = sorted(ranks.items(), key=lambda x: x[1])
        self.bytes = np.frombuffer(b"".join(t for t, _ in by_rank), np.uint8)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank that each pair merges to, _NONE if it doesn't."""
        keys = mix((a.astype(np.int64).astype(np.uint64) << np.uint64(32) | b.astype(np.int64).astype(np.uint64)) + np.uint64(1))
        out = self.table.get(keys)
        return np.where(out < 0, _NONE, out)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ids, and the n+1 offsets of ids into them."""
        size = self.lengths[ids]
        at = np.concatenate([[0], np.cumsum(size)])
        return self.bytes[np.repeat(self.offsets[ids] - at[:-1], size) + np.arange(at[-1])], at


def merge_matrix(ids: np.ndarray, lengths: np.ndarray, ranks: Ranks) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Merge all rows of a padded matrix; (rows, matrix, lengths) of the rows that finished together."""
    done, rows = [], np.arange(len(ids))
    width = ids.shape[1]
    rank = np.full((len(ids), max(width, 2)), _NONE, np.int32)
    if width > 1:
        r, c = np.nonzero(np.arange(width - 1)[None, :] < (lengths - 1)[:, None])
        rank[r, c] = ranks.rank(ids[r, c], ids[r, c + 1])
    while len(rows):
        j = rank.argmin(1)
        best = rank[np.arange(len(rows)), j]
        over = best == _NONE
        if over.any():
            done.append((rows[over], ids[over], lengths[over]))
            live = ~over
            rows, ids, lengths, rank, j, best = rows[live], ids[live], lengths[live], rank[live], j[live], best[live]
            if not len(rows):
                break
            width = int(lengths.max())
            ids, rank = ids[:, :width], rank[:, : max(width, 2)]
        n = np.arange(len(rows))
        later = np.arange(ids.shape[1])[None, :] > j[:, None]
        ids = np.where(later, np.concatenate([ids[:, 1:], np.full((len(rows), 1), -1, np.int32)], 1), ids)
        ids[n, j] = best
        later = np.arange(rank.shape[1])[None, :] > j[:, None]
        rank = np.where(later, np.concatenate([rank[:, 1:], np.full((len(rows), 1), _NONE, np.int32)], 1), rank)
        lengths = lengths - 1
        right = j + 1 < lengths
        rank[n, j] = _NONE
        rank[n[right], j[right]] = ranks.rank(ids[n[right], j[right]], ids[n[right], j[right] + 1])
        left = j > 0
        rank[n[left], j[left] - 1] = ranks.rank(ids[n[left], j[left] - 1], ids[n[left], j[left]])
    return done


def merge_heap(ids: np.ndarray, ranks: Ranks) -> np.ndarray:
    """The same for one long row."""
    ids = ids.tolist()
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    first = ranks.rank(np.array(ids[:-1]), np.array(ids[1:])).tolist() if n > 1 else []
    heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != _NONE]
    heapq.heapify(heap)
    met: dict[tuple[int, int], int] = {}

    def offer(i):
        k = after[i]
        if i >= 0 and k < n:
            pair = ids[i], ids[k]
            if pair not in met:
                met[pair] = int(ranks.rank(np.array([pair[0]]), np.array([pair[1]]))[0])
            if met[pair] != _NONE:
                heapq.heappush(heap, (met[pair], i, *pair))

    while heap:
        rank, i, a, b = heapq.heappop(heap)
        k = after[i]
        if ids[i] != a or k >= n or ids[k] != b:
            continue
        ids[i], ids[k] = rank, -1
        after[i] = after[k]
        if after[k] < n:
            before[after[k]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return np.array([x for x in ids if x >= 0], np.int32)


class Encoder:
    """Encodes slices of texts; remembers pre-tokens."""

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self.forget()

    def forget(self) -> None:
        self.met = Met(1 << (2 * KNOWN - 1).bit_length())
        self.offsets, self.lengths = np.zeros(KNOWN, np.int64), np.zeros(KNOWN, np.int64)
        self.flat, self.used = np.zeros(1 << 20, np.int32), 0

    def _merged(self, buf, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of pre-tokens stand in flat, and how many they are."""
        size = ends - starts
        grown = self.used + int(size.sum())
        if grown > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(grown - len(self.flat), len(self.flat)), np.int32)])
        lengths, offsets = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        bucket = np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64)
        for k in np.unique(bucket[size <= LONG]):
            of = np.flatnonzero((bucket == k) & (size <= LONG))
            for part in np.array_split(of, max(1, len(of) * int(1 << k) // (1 << 21))):
                width = int(size[part].max())
                column = np.arange(width)
                ids = np.where(column < size[part][:, None], self.ranks.single[buf[np.minimum(starts[part][:, None] + column, len(buf) - 1)]], -1)
                for rows, matrix, n in merge_matrix(ids, size[part], self.ranks):
                    at = self.used + np.cumsum(n) - n
                    offsets[part[rows]], lengths[part[rows]] = at, n
                    total = int(n.sum())
                    self.flat[self.used : self.used + total] = matrix[np.arange(matrix.shape[1])[None, :] < n[:, None]]
                    self.used += total
        for i in np.flatnonzero(size > LONG):
            ids = merge_heap(self.ranks.single[buf[starts[i] : ends[i]]], self.ranks)
            offsets[i], lengths[i] = self.used, len(ids)
            self.flat[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
        return offsets, lengths

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All rows' ids, and the n+1 offsets of rows into them."""
        starts, ends, at = pretokens(buf, offs)
        keys = spans_hash(buf, starts, ends) | np.uint64(1)
        which = self.met.find(buf, starts, ends, keys)
        new = np.flatnonzero(which == -1)
        if len(new):
            fresh, first = np.unique(keys[new], return_index=True)
            first, n = new[first], self.met.n
            if n and n + len(fresh) > KNOWN:
                self.forget()
                return self.encode(buf, offs)
            if n + len(fresh) > len(self.offsets):
                more = np.zeros(n + len(fresh) - len(self.offsets), np.int64)
                self.offsets, self.lengths = np.concatenate([self.offsets, more]), np.concatenate([self.lengths, more])
            self.offsets[n : n + len(fresh)], self.lengths[n : n + len(fresh)] = self._merged(buf, starts[first], ends[first])
            self.met.add(buf, starts[first], ends[first], fresh)
            which[new] = self.met.find(buf, starts[new], ends[new], keys[new])
        place, size = self.offsets[which], self.lengths[which]
        apart = np.flatnonzero(which < 0)
        if len(apart):  # another pre-token has the same hash
            place[apart], size[apart] = self._merged(buf, starts[apart], ends[apart])
        to = np.concatenate([[0], np.cumsum(size)])
        return self.flat[np.repeat(place - to[:-1], size) + np.arange(to[-1])], to[at]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode_decode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row of docs (doc_id, text)."""
    ranks = small_batches(docs).sparkSession.sparkContext.broadcast(Ranks(read_ranks(path or default_path())))

    def run(batches):
        encoder = Encoder(ranks.value)
        for batch in batches:
            buf, offs = text_rows(batch.column(1))
            n, of_ids, of_bytes = [], [], []
            for *_, b, o in slices(buf, offs):
                ids, at = encoder.encode(b, o)
                decoded, place = encoder.ranks.decode(ids)
                raw, out = ids.astype("<u4").view(np.uint8), memoryview(np.ascontiguousarray(decoded))
                for i, k in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    n.append(k - i)
                    of_ids.append(hashlib.sha256(raw[4 * i : 4 * k]).hexdigest())
                    of_bytes.append(hashlib.sha256(out[place[i] : place[k]]).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
