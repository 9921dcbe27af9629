"""Helpers shared by the text operators: shared-folder tables, Arrow slices, hashing of bytes in numpy.

Text reaches numpy as the UTF-8 bytes of an Arrow batch, in slices of a quarter of a megabyte, so that memory does not
depend on how many rows a batch or a partition holds.  One document is never cut: a slice holds at least one row.

Spark keeps a Python worker for later tasks, and with it whatever Arrow and the C library hold on to of the memory that
it no longer uses; after every large batch and at a task's end it goes back to the system.
"""

from __future__ import annotations

import ctypes
import hashlib
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 18

#: The white space of the contracts, [\x20\x09-\x0D].
SPACES = b" \t\n\x0b\x0c\r"


#: Bytes of an Arrow batch on its way to Python and back, about; Spark's own default is 64 MB.
BATCH_BYTES = 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """df, whose session from now on moves Arrow batches of BATCH_BYTES, unless another size than the default is set."""
    key, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if str(conf.get(key)).rstrip("b") == str(64 << 20):
        conf.set(key, str(BATCH_BYTES))
    return df


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return this process's unused memory to the system, Arrow's and, where the C library can, malloc's."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def lean(run):
    """The function of a mapInArrow, whose workers give back at the end of a task what it took."""

    def lean_run(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return lean_run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where it is unset in local mode, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="attestor-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables of cut() that no later job reads."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.cut_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and their n+1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind, size = (np.int64, 8) if wide else (np.int32, 4)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, kind, len(column) + 1, column.offset * size).astype(np.int64) if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offs[0] : offs[-1]], offs - offs[0]


def slices(buf: np.ndarray, offs: np.ndarray, most: int = SLICE_BYTES):
    """(first row, rows after last, bytes, offsets from 0) of consecutive rows, each slice of about `most` bytes."""
    n, at = len(offs) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + most, "right")) - 1)
        yield at, to, buf[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to
    if n and offs[-1] > SLICE_BYTES:
        give_back()


#: Spans of up to so many bytes are hashed in numpy, eight bytes at a time; the few longer ones by BLAKE2b.
SHORT = 64
_rng = np.random.Generator(np.random.PCG64(20240229))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h = h * np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(33)
    return h


def windows(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as a number, with zeros beyond the end."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ndarray((len(buf) + 1,), "<u8", padded, 0, (1,))


def spans_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, seed: int = 0) -> np.ndarray:
    """64-bit hash of each buf[start:end], ASCII letters folded if lower; other seeds give independent hashes.

    Every eight bytes go through a whole mixing round, so that no pattern of bytes cancels out.
    """
    if lower:
        buf = _LOWER[buf]
    win, size = windows(buf), ends - starts
    with np.errstate(over="ignore"):
        out = mix((size.astype(np.uint64) + np.uint64(seed + 1)) * _STEP)
        out = mix(out ^ (win[starts] & _MASKS[np.clip(size, 0, 8)]))
        left, at = np.flatnonzero((size > 8) & (size <= SHORT)), 8
        while len(left):
            out[left] = mix(out[left] * _STEP ^ (win[starts[left] + at] & _MASKS[np.minimum(size[left] - at, 8)]))
            at += 8
            left = left[size[left] > at]
    key = seed.to_bytes(8, "little")
    for i in np.flatnonzero(size > SHORT).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(buf[starts[i] : ends[i]].tobytes(), digest_size=8, key=key).digest(), "little")
    return out


def runs_hash(h: np.ndarray, first: np.ndarray, size: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each run of size hashes from its first on, one mixing round for each."""
    with np.errstate(over="ignore"):
        out = mix((size.astype(np.uint64) + np.uint64(seed + 1)) * _STEP)
        left, k = np.flatnonzero((size > 0) & (size <= SHORT)), 0
        while len(left):
            out[left] = mix(out[left] * _STEP ^ h[first[left] + k])
            k += 1
            left = left[size[left] > k]
    key = seed.to_bytes(8, "little")
    for i in np.flatnonzero(size > SHORT).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(h[first[i] : first[i] + size[i]].tobytes(), digest_size=8, key=key).digest(), "little")
    return out


def same_spans(buf: np.ndarray, starts: np.ndarray, size: np.ndarray, other: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether size bytes from each start are those from the other's place; other ends in eight bytes to spare."""
    a, b = windows(buf), np.ndarray((len(other) - 7,), "<u8", other, 0, (1,))
    out = ((a[starts] ^ b[at]) & _MASKS[np.clip(size, 0, 8)]) == 0
    left, k = np.flatnonzero((size > 8) & (size <= SHORT)), 8
    while len(left):
        out[left] &= ((a[starts[left] + k] ^ b[at[left] + k]) & _MASKS[np.minimum(size[left] - k, 8)]) == 0
        k += 8
        left = left[size[left] > k]
    for i in np.flatnonzero(size > SHORT).tolist():
        out[i] = (buf[starts[i] : starts[i] + size[i]] == other[at[i] : at[i] + size[i]]).all()
    return out


class HashTable:
    """uint64 keys (not 0) to int32 values, open addressing, whole arrays at a time."""

    def __init__(self, size: int):
        self.keys, self.values = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        self.mask = np.uint64(size - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, -1 where there is none."""
        out = np.full(len(keys), -1, np.int32)
        slot = (keys & self.mask).astype(np.int64)
        found = self.keys[slot]
        hit = found == keys
        out[hit] = self.values[slot[hit]]
        left = np.flatnonzero(~hit & (found != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & int(self.mask)
            found = self.keys[slot[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (found != 0)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct new keys."""
        slot = (keys & self.mask).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = keys[free]
            self.values[slot[free]] = values[free]
            won = self.keys[slot[left]] == keys[left]
            self.values[slot[left[won]]] = values[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & int(self.mask)


class Met:
    """Byte strings that have been met, numbered as they came: found by their hash, told apart by their bytes."""

    def __init__(self, size: int = 1 << 20):
        self.table, self.n, self.used = HashTable(size), 0, 0
        self.raw, self.at, self.size = np.zeros(1 << 20, np.uint8), np.zeros(size // 2, np.int64), np.zeros(size // 2, np.int64)

    def find(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The number of each span, -1 if it is new, -2 if another string has its hash."""
        out = self.table.get(keys)
        known = np.flatnonzero(out >= 0)
        number, size = out[known], (ends - starts)[known]
        alike = size == self.size[number]
        alike[alike] = same_spans(buf, starts[known[alike]], size[alike], self.raw, self.at[number[alike]])
        out[known[~alike]] = -2
        return out

    def add(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> None:
        """Number distinct new strings; of those with one hash the first is kept."""
        size = ends - starts
        grown = self.used + int(size.sum())
        if grown + 8 > len(self.raw):
            self.raw = np.concatenate([self.raw, np.zeros(max(grown + 8 - len(self.raw), len(self.raw)), np.uint8)])
        if self.n + len(keys) > len(self.at):
            more = np.zeros(max(self.n + len(keys) - len(self.at), len(self.at)), np.int64)
            self.at, self.size = np.concatenate([self.at, more]), np.concatenate([self.size, more])
            old, self.table = self.table, HashTable(1 << (2 * len(self.at)).bit_length())
            have = old.keys != 0
            self.table.put(old.keys[have], old.values[have])
        at = self.used + np.cumsum(size) - size
        self.raw[self.used : grown] = buf[np.repeat(starts - (at - self.used), size) + np.arange(grown - self.used)]
        self.at[self.n : self.n + len(keys)], self.size[self.n : self.n + len(keys)] = at, size
        self.table.put(keys, np.arange(self.n, self.n + len(keys), dtype=np.int32))
        self.n, self.used = self.n + len(keys), grown


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of non-space in each row, and the n+1 offsets of rows into them."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    ink = ~_IS_SPACE[buf]
    first = np.zeros(n, bool)
    first[offs[:-1][offs[:-1] < n]] = True
    begins = ink.copy()
    begins[1:] &= ~ink[:-1] | first[1:]
    last = np.zeros(n, bool)
    last[offs[1:][offs[1:] > 0] - 1] = True
    stops = ink
    stops[:-1] &= ~ink[1:] | last[:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offs)


_W = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(buf: np.ndarray, offs: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every row's word shingles, in order with repeats, and the n+1 offsets of rows into them.

    A row of fewer than `width` words has its whole sequence as one shingle, one without words has none.
    """
    starts, ends, at = words(buf, offs)
    h = spans_hash(buf, starts, ends, lower=True)
    count = np.diff(at)
    of = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    out_at = np.concatenate([[0], np.cumsum(of)])
    out = np.empty(out_at[-1], np.uint64)
    row = np.repeat(np.arange(len(count)), of)
    place = at[:-1][row] + np.arange(len(out)) - out_at[:-1][row]
    full = count[row] >= width
    with np.errstate(over="ignore"):
        p = place[full]
        total = h[p] * _W[0]
        for k in range(1, width):
            total = mix(total + h[p + k] * _W[min(k, 63)])
        out[full] = total
    rest = np.flatnonzero(~full)
    out[rest] = runs_hash(h, place[rest], count[row[rest]])
    return out, out_at


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that df has no column of, whatever their case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
        taken.add(name.lower())
    return out


#: Bits of the filter of possible(): its size whatever the tables'.
FILTER_BITS = 1 << 24


def possible(df: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of df whose key may be among the one column of wanted, by a broadcast bitmap of fixed size, and those whose isn't.

    A sieve before a join, which still has to follow for the first part: it keeps most of a wide table out of the join's
    shuffle, less so the more keys there are.  Null keys are in the first part.
    """
    slot = F.pmod(F.xxhash64(F.col(wanted.columns[0])), F.lit(FILTER_BITS)) + 1
    parts = wanted.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in parts:
        own = np.frombuffer(bytes(r["bits"]), np.uint8)
        at = (r["part"] - 1) * len(own)
        bits[at : at + len(own)] = own
    shared = df.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def may(slots: pa.Array) -> pa.Array:
        at = slots.to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.array((shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0)

    hit = may(F.pmod(F.xxhash64(F.col(key)), F.lit(FILTER_BITS))) | F.col(key).isNull()
    return df.where(hit), df.where(~hit)


#: Keys with over 1 / HOT of all rows are joined by broadcast: fewer than HOT of them by counting, whatever the size.
HOT = 4096


def spread_join(rows: DataFrame, groups: DataFrame, on: list[str], total: int, how: str = "inner") -> DataFrame:
    """Join rows with groups, which name each key once with its number n of rows, so that no key's rows meet in one task.

    groups should be written, as it is read more than once.
    """
    often, rare = groups.where(F.col("n") > total // HOT).drop("n"), groups.where(F.col("n") <= total // HOT).drop("n")
    rest = rows.join(F.broadcast(often.select(*on)), on, "left_anti").join(rare, on, how)
    return rows.join(F.broadcast(often), on).unionByName(rest)
