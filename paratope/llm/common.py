"""Shared pieces of the corpus operators: scratch tables, word hashing, bounded filters and components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _lean() -> None:
    """Blocks of 4 MB or more are mapped and so go back to the system when freed; Arrow takes its memory from the same allocator."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 8 << 20)  # M_TRIM_THRESHOLD
    except (AttributeError, OSError):  # another C library
        return
    pa.set_memory_pool(pa.system_memory_pool())


_lean()


# ---------------------------------------------------------------- scratch tables in the shared folder
def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a local one where that is unset and all runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().getCheckpointDir().getOrElse(None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="paratope-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m"):
    """While it holds, at most ``size`` passes between Spark and Python at once, however long the texts are, and a query's shuffle files go
    when it has ended, rather than when the driver happens to collect its garbage: what it gives is written or on the driver then."""
    own = {"spark.sql.execution.arrow.maxBytesPerBatch": size, "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    old = {name: spark.conf.get(name, None) for name in own}
    for name, x in own.items():
        spark.conf.set(name, x)
    try:
        yield
    finally:
        for name, x in old.items():
            spark.conf.unset(name) if x is None else spark.conf.set(name, x)


class Scratch:
    """Tables that cut lineage: written once as Parquet in the shared folder, so a lost executor costs no recompute.

    ``drop`` deletes a table that nothing reads any more; tables that a returned DataFrame still reads stay.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.made = 0
        self.paths: dict[int, str] = {}

    def table(self, df: DataFrame, codec: str = "snappy") -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made}"
        with small_batches(self.spark):
            df.write.parquet(path, compression=codec)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        out._scratch = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._scratch)
            path.getFileSystem(conf).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- hashing
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on an array of unsigned 64-bit integers."""
    x = (x + GOLDEN).astype(np.uint64, copy=False)
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        step = np.full(size, BASE if kind == "up" else _INVERSE, dtype=np.uint64)
        step[0] = 1
        have = np.multiply.accumulate(step)
        if size <= 1 << 20:
            _powers[kind] = have
    return have[:n]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, dtype=bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False


class Words:
    """The words of a run of texts: runs of bytes other than space and \\t..\\r, with A-Z in lower case.

    ``lo[i]:hi[i]`` are the words of text i; ``start``/``end`` are byte offsets into ``data``; ``hash`` is a 64-bit
    hash of each word's lower-case bytes.
    """

    __slots__ = ("row0", "data", "off", "start", "end", "lo", "hi", "hash", "valid")

    def __init__(self, row0: int, data: np.ndarray, off: np.ndarray, valid: np.ndarray) -> None:
        self.row0, self.off, self.valid = row0, off, valid
        self.data = data = _LOWER[data]
        word = _WORD[data]
        n = len(data)
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        cut = off[1:-1]
        cut = cut[cut < n]
        begins[cut] = word[cut]
        ends = word.copy()
        ends[:-1] &= ~word[1:]
        cut = off[1:] - 1
        cut = cut[cut >= 0]
        ends[cut] = word[cut]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.lo, self.hi = np.searchsorted(self.start, off[:-1]), np.searchsorted(self.start, off[1:])
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", n), out=total[1:])
        self.hash = mix64((total[self.end] - total[self.start]) * _power("down", n + 1)[self.start])

    def __len__(self) -> int:
        return len(self.off) - 1

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def raw_texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, its offsets and which rows are not null (null counts as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    valid = np.asarray(column.is_valid())
    if not valid.all():
        column = column.fill_null("")
    buffers = column.buffers()
    off = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, off, valid


def words_of(column: pa.Array, chunk: int = 1 << 18) -> Iterator[Words]:
    """Words of each text, some whole texts (about ``chunk`` bytes) at a time, so memory follows the longest text."""
    release()
    data, off, valid = raw_texts(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + chunk, side="right")) - 1)
        j = min(j, n)
        yield Words(i, data[off[i] : off[j]], off[i : j + 1] - off[i], valid[i:j])
        i = j
    del data, off
    tidy()


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k consecutive word hashes; with fewer words, one hash of the whole sequence."""
    n = len(h)
    if n == 0:
        return h[:0]
    if n < k:
        acc = np.array([n], dtype=np.uint64)
        for i in range(n):
            acc = mix64(acc * np.uint64(BASE) + h[i : i + 1])
        return acc
    acc = np.zeros(n - k + 1, dtype=np.uint64)
    for i in range(k):
        acc = acc * np.uint64(BASE) + h[i : n - k + 1 + i]
    return mix64(acc)


# ---------------------------------------------------------------- Arrow helpers
def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def unsigned(column: pa.Array) -> np.ndarray:
    return np.asarray(column).astype(np.int64, copy=False).view(np.uint64)


# ---------------------------------------------------------------- one memo a worker process
_resident: dict = {}


def resident(name, make: Callable):
    """An object that outlives a task in its worker process; another one takes its place, so only one takes up memory."""
    if name not in _resident:
        release()
        _resident[name] = make()
    return _resident[name]


def release() -> None:
    if _resident:
        _resident.clear()
        gc.collect()
        tidy()


def tidy() -> None:
    """Give freed memory back to the system, so that idle worker processes stay small."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


# ---------------------------------------------------------------- a filter of bounded size
class Bloom:
    """A Bloom filter over 64-bit keys. Its size is fixed by ``bits`` and so can be broadcast; a false hit only costs work."""

    def __init__(self, bits: int = 26, parts: list[tuple[int, bytes]] | None = None) -> None:
        self.bits = bits
        self.map = np.zeros(1 << (bits - 3), dtype=np.uint8)
        size = len(self.map) // 64
        for i, b in parts or ():
            self.map[i * size : (i + 1) * size] |= np.frombuffer(b, dtype=np.uint8)

    def _at(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        h = mix64(keys)
        for s in (0, 17, 34):
            yield (h >> np.uint64(s)) & np.uint64((1 << self.bits) - 1)

    def add(self, keys: np.ndarray) -> None:
        for at in self._at(keys):
            np.bitwise_or.at(self.map, at >> np.uint64(3), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)))

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), dtype=bool)
        for at in self._at(keys):
            out &= (self.map[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out


def bloom_bits(keys: int) -> int:
    """log2 of the bits of a filter for so many keys: 12 bits a key, 2**20 to 2**29 bits in all. Beyond 45 million keys more of
    what isn't in it passes, which costs work but changes no result."""
    return min(29, max(20, int(np.ceil(np.log2(12 * max(1, keys))))))


def bloom_of(keys: DataFrame, bits: int) -> Bloom:
    """The filter of a one-column DataFrame of longs: one bitmap a task, merged in 64 slices, 2**bits / 8 bytes in the end."""

    def build(batches):
        own = Bloom(bits)
        for b in batches:
            own.add(unsigned(b.column(0)))
        size = len(own.map) // 64
        for i in range(64):
            part = own.map[i * size : (i + 1) * size]
            if part.any():
                yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "b": pa.array([part.tobytes()], pa.binary())})

    def merge(batches):
        at, out = None, None
        for t in batches:
            for i, b in zip(t.column(0).to_pylist(), t.column(1), strict=True):
                x = np.frombuffer(b.as_buffer(), dtype=np.uint8)
                if i != at:
                    if out is not None:
                        yield pa.RecordBatch.from_pydict({"i": pa.array([at], pa.int32()), "b": pa.array([out.tobytes()], pa.binary())})
                    at, out = i, x.copy()
                else:
                    out |= x
        if out is not None:
            yield pa.RecordBatch.from_pydict({"i": pa.array([at], pa.int32()), "b": pa.array([out.tobytes()], pa.binary())})

    spark = keys.sparkSession
    few = max(1, min(spark.sparkContext.defaultParallelism, 16))
    with small_batches(spark):
        parts = keys.repartition(few).mapInArrow(build, "i int, b binary").repartition(few, "i").sortWithinPartitions("i").mapInArrow(merge, "i int, b binary").toArrow()
    out = Bloom(bits, [])
    size = len(out.map) // 64
    for i, b in zip(parts.column("i").to_pylist(), parts.column("b"), strict=True):
        out.map[i * size : (i + 1) * size] = np.frombuffer(b.as_buffer(), np.uint8)
    return out


def parted(df: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose key (a long) may be in ``keys``, a written table of one column of longs, and rows whose key surely isn't.

    Only the first part, usually a few rows, then needs a join; the second goes on without a shuffle. Only keys pass through Python.
    """
    shared = df.sparkSession.sparkContext.broadcast(bloom_of(keys, bloom_bits(keys.count())))

    @F.arrow_udf("boolean")
    def known(k: pa.Array) -> pa.Array:
        release()
        return pa.array(shared.value.has(unsigned(k)))

    return df.where(known(key)), df.where(~known(key))


# ---------------------------------------------------------------- joins with hot keys
def join_hot(left: DataFrame, right: DataFrame, key: str, counts: DataFrame, total: int, how: str = "left") -> DataFrame:
    """Join on ``key`` (unique in ``right``) when a few keys may hold most rows of ``left``.

    ``counts`` (key, n) tells how often a key is in ``left``. Keys with at least total/10000 rows number at most 10,000, so their
    side is broadcast; all other keys are joined by a shuffle in which none holds more than a ten-thousandth of the rows.
    """
    hot = counts.where(F.col("n") >= max(1000, total // 10_000)).select(key)
    cold_left = left.join(F.broadcast(hot), key, "left_anti")
    hot_right = right.join(F.broadcast(hot), key, "left_semi")
    cold_right = right.join(F.broadcast(hot), key, "left_anti")
    return left.join(F.broadcast(hot_right), key, "inner").unionByName(cold_left.join(cold_right, key, how))


# ---------------------------------------------------------------- connected components
def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node) of the components that the links a-b make among themselves."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    up = np.arange(len(nodes))
    while True:
        px, py = up[x], up[y]
        if (px == py).all():
            break
        lo, hi = np.minimum(px, py), np.maximum(px, py)
        np.minimum.at(up, hi, lo)
        while True:
            nxt = up[up]
            if (nxt == up).all():
                break
            up = nxt
    far = up != np.arange(len(nodes))
    return nodes[far], nodes[up[far]]


def _local_forests(batches):
    a, b = [], []
    for x in batches:
        a.append(np.asarray(x.column(0)))
        b.append(np.asarray(x.column(1)))
        if sum(map(len, a)) > 1 << 20:
            p, q = forest(np.concatenate(a), np.concatenate(b))
            a, b = [p], [q]
    if a:
        p, q = forest(np.concatenate(a), np.concatenate(b))
        yield pa.RecordBatch.from_pydict({"a": pa.array(p, pa.int64()), "b": pa.array(q, pa.int64())})


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the smallest node reachable by links, for every node that has a link to another.

    Each task first shrinks its links to a forest. Then large-star and small-star rounds (Kiveris et al. 2014) alternate until
    the edges stop changing; every round is a pre-aggregated minimum and a join, written to the shared folder.
    """
    edges = scratch.table(links.toDF("a", "b").where("a <> b").mapInArrow(_local_forests, "a long, b long").distinct())
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
        seen = Observation()
        new = scratch.table(small.select("e.a", "e.b").where("a <> b").distinct().observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")))
        now = seen.get
        scratch.drop(edges)
        edges = new
        if state == now:
            return edges.toDF("node", "component")
        state = now


def crc_text(col: str) -> Column:
    """crc32 of the decimal text of an id; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))
