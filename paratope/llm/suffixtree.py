"""Language-model scoring with a probabilistic suffix tree over words.

States are contexts of the last one or more tokens (Ron, Singer and Tishby 1996): a context is kept if it occurs ``LEAST`` times and
its next-token distribution diverges enough from that of its suffix. A token is predicted from the longest kept suffix of what
precedes it. In a state, next tokens seen ``LEAST`` times have a discounted share of their own, and what is left is spread as in
the state's suffix; the root is the add-one unigram model. All counts cover the whole training corpus, so the model grows with it.

The log probability of a token is a sum of terms that each depend on one run of tokens: the root's for the word; for a run that
is a state, its share left to the suffix, met by whatever follows; for a run that is an entry, what corrects both. So a text's
score is the sum of the values of all its runs of up to depth + 1 tokens, and a run without a value adds nothing.

Runs are known by 64-bit keys: a run's key is its context's times ``BASE`` plus its last word's hash. Tables are packed: a row is a
bucket, the keys with the same first bits, as sorted arrays in binary columns. A task gathers runs by the million, counts them and
deals them out a few hundred blobs at a time, which costs a small part of what a row a run would.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paratope.llm.common import BASE, Scratch, Words, crc_text, mix64, shuffle_partitions, words_of

LEAST = 2  # occurrences of a context, and of a next token in it
DISCOUNT = 0.5
END = mix64(np.array([0x656E64], dtype=np.uint64))  # stands for the end in runs
BUCKET = 1 << 19  # runs of a bucket, about
FLUSH = 1 << 21  # runs that a task gathers before it deals them out
HOT_CONTEXT = 1 << 16  # a context of more occurrences has its entries spread over all buckets
SIEVE = 23  # log2 of the words of a filter
HOT_SHARE = 20  # log2 of the most such contexts: with more than 2**36 tokens they have a share of 2**-20 of them
HOT_RUNS = 1 << 19  # the most frequent runs, at most so many, are broadcast with their values; all others are looked up in buckets
DOCS = 60_000  # texts of a scoring batch, at most
B8 = np.uint64(BASE)


# ---------------------------------------------------------------- runs of tokens
def _runs(w: Words, most: int) -> tuple[dict[int, np.ndarray], np.ndarray, np.ndarray]:
    """For each length up to ``most`` the key of the run that ends at each token of start, words, end of all texts; the text of each
    token and its place there. A run of n tokens ends at place n - 1 or later; what lies before is another text's."""
    size = w.hi - w.lo + 2
    text = np.repeat(np.arange(len(w)), size)
    front = np.cumsum(size) - size
    token = np.full(len(text), END[0], dtype=np.uint64)
    token[np.arange(len(w.hash)) + 2 * np.repeat(np.arange(len(w)), w.hi - w.lo) + 1] = w.hash
    keys = {1: token}
    for n in range(2, most + 1):
        keys[n] = np.concatenate([keys[n - 1][:1], keys[n - 1][:-1]]) * B8 + token
    return keys, text, np.arange(len(text)) - front[text]


def _groups(sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new key begins."""
    new = np.ones(len(sorted_keys), dtype=bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.flatnonzero(new)


def _place(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place of each x among sorted keys, -1 where it isn't."""
    if not len(keys):
        return np.full(len(x), -1, dtype=np.int64)
    k = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return np.where(keys[k] == x, k, -1)


# ---------------------------------------------------------------- packed tables
def _bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def _cuts(sorted_keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The buckets of sorted keys and where each lies."""
    b = _bucket(sorted_keys, bits)
    first = [*_groups(b).tolist(), len(b)]
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        yield int(b[lo]), slice(lo, hi)


def _blob(x: np.ndarray) -> bytes:
    """An array's bytes, first bytes first: of sorted keys and small numbers the high ones are alike and so shrink when compressed."""
    x = np.ascontiguousarray(x)
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes() if x.itemsize > 1 else x.tobytes()


def _pack(x: np.ndarray) -> bytes:
    """Keys that recur: the distinct ones in order, as steps, and which one stands at each place, compressed. Keys in order need but a
    flag a place that says where the next one begins."""
    rising = bool((x[1:] >= x[:-1]).all())
    if rising:
        first = _groups(x) if len(x) else np.zeros(0, np.int64)
        known, place = x[first], np.zeros(len(x), dtype=np.uint8)
        place[first[1:]] = 1
    else:
        known, place = np.unique(x, return_inverse=True)
        place = place.astype(np.min_scalar_type(len(known)))
    raw = _blob(np.diff(known, prepend=np.uint64(0))) + _blob(place)
    return np.array([len(known), place.itemsize, rising, len(raw)], dtype=np.int64).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _planes(raw: np.ndarray, kind) -> np.ndarray:
    """The array whose bytes ``_blob`` gave."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).reshape(-1) if size > 1 else raw.view(kind)


class Rows:
    """Rows of a packed table on their way out, in a fixed order of columns; those not given are null."""

    def __init__(self, schema: str) -> None:
        kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
        self.schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])
        self.rows: list[dict] = []

    def add(self, **row) -> None:
        self.rows.append(row)

    def batch(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in self.rows], f.type) for f in self.schema], schema=self.schema)
            self.rows = []


def _buckets(batches, by: str = "b") -> Iterator[tuple[int, list]]:
    """Runs of rows with one value of ``by``; a row is (batch, place)."""
    at, rows = None, []
    for t in batches:
        for i, b in enumerate(t.column(t.schema.get_field_index(by)).to_pylist()):
            if b != at and rows:
                yield at, rows
                rows = []
            at = b
            rows.append((t, i))
    if rows:
        yield at, rows


def _get(row, name: str, kind) -> np.ndarray:
    t, i = row
    return _planes(np.frombuffer(t.column(t.schema.get_field_index(name))[i].as_buffer(), dtype=np.uint8), kind)


def _unpack(row, name: str) -> np.ndarray:
    """The keys that ``_pack`` gave."""
    t, i = row
    buf = t.column(t.schema.get_field_index(name))[i].as_buffer()
    n, size, rising, length = np.frombuffer(buf[:32], dtype=np.int64).tolist()
    raw = np.frombuffer(pa.decompress(buf[32:], length, codec="zstd"), dtype=np.uint8)
    known, place = np.cumsum(_planes(raw[: 8 * n], np.uint64), dtype=np.uint64), _planes(raw[8 * n :], np.dtype(f"u{size}"))
    return known[np.cumsum(place, dtype=np.int64) if rising else place]


def _unpacked(rows: list, name: str) -> np.ndarray:
    return np.concatenate([_unpack(r, name) for r in rows]) if rows else np.zeros(0, dtype=np.uint64)


def _all(rows: list, name: str, kind) -> np.ndarray:
    return np.concatenate([_get(r, name, kind) for r in rows]) if rows else np.zeros(0, dtype=kind)


def _kind(row) -> int:
    t, i = row
    return t.column(t.schema.get_field_index("kind"))[i].as_py()


def _met(spark, *tables: DataFrame, by: str = "b", order: tuple = ()) -> DataFrame:
    """Rows of packed tables with the same bucket together, those of lower kinds first."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out.repartition(shuffle_partitions(spark), by).sortWithinPartitions(by, "kind", *order)


@dataclass
class Sieve:
    """A filter of keys by bucket: a word of 64 bits a few keys, three bits a key. Up to 2**23 words (64 MB) in all, however much text
    there is: with more keys than some forty million more of what isn't in it passes, and with more than 2**19 buckets (two
    terabytes of text) there is no filter. That costs work but changes no result."""

    bits: int
    size: int
    words: np.ndarray

    @staticmethod
    def _at(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        h = mix64(keys)
        mask = np.zeros(len(h), dtype=np.uint64)
        for s in (40, 46, 52):
            mask |= np.uint64(1) << ((h >> np.uint64(s)) & np.uint64(63))
        return h & np.uint64((1 << size) - 1), mask

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.ones(len(keys), dtype=bool)
        at, mask = self._at(keys, self.size)
        return self.words[(keys >> np.uint64(64 - self.bits) << np.uint64(self.size)) | at] & mask == mask


def _sieve(table: DataFrame, keys: int, bits: int, pick) -> Sieve:
    """The filter of about ``keys`` keys, those that ``pick`` gives for a row of a packed table; each row makes its own part."""
    if bits > SIEVE - 4:
        return Sieve(bits, 0, np.zeros(0, dtype=np.uint64))
    size = max(4, min(SIEVE - bits, int(np.ceil(np.log2(max(1, keys) / 4))) - bits))

    def run(batches):
        out = Rows("b int, words binary")
        for b, rows in _buckets(batches):
            words = np.zeros(1 << size, dtype=np.uint64)
            for r in rows:
                np.bitwise_or.at(words, *Sieve._at(pick(r), size))
            out.add(b=b, words=words.tobytes())
            yield from out.batch()

    got = table.mapInArrow(run, "b int, words binary").toArrow()
    words = np.zeros(1 << (bits + size), dtype=np.uint64)
    for b, x in zip(got.column("b").to_pylist(), got.column("words"), strict=True):
        words[b << size : (b + 1) << size] |= np.frombuffer(x.as_buffer(), np.uint64)
    return Sieve(bits, size, words)


# ---------------------------------------------------------------- counting
WORDS = "kind int, b int, n long, total long, k binary, c binary"
TABLE = "kind int, b int, n long, k binary, suf binary, c binary, v binary, below binary, mine binary"
GATHERED = "kind int, b int, ctx binary, nxt binary, c binary"
ASKED = "kind int, b int, origin int, ctx binary, nxt binary, c binary, size binary, suf binary"
STATES = "kind int, b int, k binary, v binary"
SOLVED = "kind int, b int, k binary, suf binary, c binary, v binary, below binary, mine binary, ctx binary, nxt binary, size binary"


def _words(train: DataFrame, bits: int, scratch: Scratch) -> DataFrame:
    """WORDS rows: every token of the training texts and its occurrences."""

    def gather(batches):
        out, have, size = Rows(WORDS), [], 0

        def flush():
            k, c = np.unique(np.concatenate(have), return_counts=True)
            for b, at in _cuts(k, bits):
                out.add(kind=1, b=b, k=_blob(k[at]), c=_blob(c[at].astype(np.int64)))
            have.clear()
            yield from out.batch()

        for t in batches:
            for w in words_of(t.column(0)):
                have.append(np.concatenate([w.hash, np.repeat(END, len(w))]))
                size += len(have[-1])
                if size > FLUSH:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()

    def merge(batches):
        out = Rows(WORDS)
        for b, rows in _buckets(batches):
            k, at = np.unique(_all(rows, "k", np.uint64), return_inverse=True)
            c = np.zeros(len(k), dtype=np.int64)
            np.add.at(c, at, _all(rows, "c", np.int64))
            out.add(kind=0, b=b, n=len(k), total=int(c.sum()), k=_blob(k), c=_blob(c))
            yield from out.batch()

    return scratch.table(_met(train.sparkSession, train.mapInArrow(gather, WORDS)).mapInArrow(merge, WORDS))


def _unigrams(words: DataFrame, room: float) -> DataFrame:
    """The words as a TABLE: all have a value, those seen ``LEAST`` times are contexts."""

    def run(batches):
        out = Rows(TABLE)
        for b, rows in _buckets(batches):
            for r in rows:
                c = _get(r, "c", np.int64)
                out.add(kind=0, b=b, n=int((c >= LEAST).sum()), k=_blob(_get(r, "k", np.uint64)), suf=bytes(8 * len(c)), c=_blob(c), v=_blob(np.log10(c + 1)), below=_blob((c + 1) / room), mine=_blob(c >= LEAST))
                yield from out.batch()

    return words.mapInArrow(run, TABLE)


@dataclass
class Hot:
    """Contexts of very many occurrences: keys in order, sizes, and keys of their suffixes."""

    keys: np.ndarray
    size: np.ndarray
    suf: np.ndarray


def _hot(table: DataFrame, least: int) -> Hot:
    def run(batches):
        for t in batches:
            for i in range(t.num_rows):
                r = (t, i)
                c = _get(r, "c", np.int64)
                at = np.flatnonzero((c >= least) & _get(r, "mine", np.bool_))
                yield pa.RecordBatch.from_pydict({"k": pa.array(_get(r, "k", np.int64)[at]), "c": pa.array(c[at]), "suf": pa.array(_get(r, "suf", np.int64)[at])})

    got = table.mapInArrow(run, "k long, c long, suf long").toArrow()
    k, c, suf = (np.asarray(got.column(x).combine_chunks()) for x in ("k", "c", "suf"))
    order = np.argsort(k.view(np.uint64))
    return Hot(k.view(np.uint64)[order], c[order], suf.view(np.uint64)[order])


def _gather(train: DataFrame, n: int, bits: int, shared) -> DataFrame:
    """GATHERED rows of the runs of n tokens whose context and suffix pass the sieves, dealt by context (hot ones by run)."""

    def run(batches):
        contexts, suffixes, hot = shared.value
        out, ctx, nxt, size = Rows(GATHERED), [], [], 0

        def flush():
            x, y = np.concatenate(ctx), np.concatenate(nxt)
            ctx.clear(), nxt.clear()
            k = x * B8 + y
            order = np.argsort(k)
            first = _groups(k[order])
            c = np.diff(np.append(first, len(k))).astype(np.uint32)
            at = order[first]
            x, y, k = x[at], y[at], k[at]
            deal = np.where(_place(hot.keys, x) >= 0, k, x)
            order = np.lexsort((x, _bucket(deal, bits)))
            deal, x, y, c = deal[order], x[order], y[order], c[order]
            for b, at in _cuts(deal, bits):
                out.add(kind=1, b=b, ctx=_pack(x[at]), nxt=_pack(y[at]), c=_blob(c[at]))
            yield from out.batch()

        for t in batches:
            for w in words_of(t.column(0)):
                keys, _, place = _runs(w, n - 1)
                at = np.flatnonzero(place >= n - 1)
                at = at[contexts.has(keys[n - 1][at - 1])]
                at = at[suffixes.has(keys[n - 1][at])]
                ctx.append(keys[n - 1][at - 1])
                nxt.append(keys[1][at])
                size += len(at)
                if size > FLUSH:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()

    return train.mapInArrow(run, GATHERED)


def _asked(gathered: DataFrame, contexts: DataFrame, bits: int, shared) -> DataFrame:
    """ASKED rows: of kind 1 the entries of a bucket (runs that occur ``LEAST`` times), of kind 2 the keys of their suffixes, each
    once, dealt to the suffixes' buckets."""

    def run(batches):
        _, _, hot = shared.value
        out = Rows(ASKED)
        for b, rows in _buckets(batches):
            own = [r for r in rows if _kind(r) == 1]
            x, y = _unpacked(own, "ctx"), _unpacked(own, "nxt")
            k = x * B8 + y
            order = np.argsort(k)
            first = _groups(k[order])
            if not len(first):
                continue
            c = np.add.reduceat(_all(own, "c", np.uint32)[order].astype(np.int64), first)
            at = order[first][c >= LEAST]
            x, y, c = x[at], y[at], c[c >= LEAST]
            table = [r for r in rows if _kind(r) == 0]
            mine = _all(table, "mine", np.bool_)
            keys, size, suf = (_all(table, name, kind)[mine] for name, kind in (("k", np.uint64), ("c", np.int64), ("suf", np.uint64)))
            known, often = _place(keys, x), _place(hot.keys, x)
            size = np.where(often >= 0, np.append(hot.size, 0)[often], np.append(size, 0)[known])
            suf = np.where(often >= 0, np.append(hot.suf, np.uint64(0))[often], np.append(suf, np.uint64(0))[known])
            at = np.flatnonzero((often >= 0) | (known >= 0))
            at = at[np.argsort(x[at], kind="stable")]
            x, y, c, size, suf = x[at], y[at], c[at], size[at], suf[at] * B8 + y[at]
            if not len(x):
                continue
            out.add(kind=1, b=b, ctx=_blob(x), nxt=_blob(y), c=_blob(c), size=_blob(size), suf=_blob(suf))
            suf = np.unique(suf)
            for to, at in _cuts(suf, bits):
                out.add(kind=2, b=to, origin=b, suf=_blob(suf[at]))
            yield from out.batch()

    return _met(gathered.sparkSession, contexts.select("kind", "b", "k", "suf", "c", "mine"), gathered).mapInArrow(run, ASKED)


def _answers(asked: DataFrame, below: DataFrame) -> DataFrame:
    """(kind, b, origin, below): what the suffixes give each asked key, nothing for one that isn't known; b is who asked."""

    def run(batches):
        out = Rows("kind int, b int, origin int, below binary")
        for b, rows in _buckets(batches):
            table = [r for r in rows if _kind(r) == 0]
            keys, p = _all(table, "k", np.uint64), np.append(_all(table, "below", np.float64), np.nan)
            for r in rows:
                if _kind(r) == 2:
                    t, i = r
                    out.add(kind=3, b=t.column(t.schema.get_field_index("origin"))[i].as_py(), origin=b, below=_blob(p[_place(keys, _get(r, "suf", np.uint64))]))
            yield from out.batch()

    return _met(asked.sparkSession, below.select("kind", "b", "k", "below"), asked.where("kind = 2").select("kind", "b", "origin", "suf")).mapInArrow(run, "kind int, b int, origin int, below binary")


def _cost(entries, total: int):
    """Bits that a state and its entries must earn."""
    return 0.5 * np.log2(max(2, total)) * (1 + entries)


def _emit(out: Rows, bits: int, last: bool, k, suf, c, v, below, mine) -> None:
    """Entries by their keys; of the longest runs only those in kept states matter, and nothing is asked of them again."""
    if last:
        k, c, v, mine, suf, below = k[mine], c[mine], v[mine], mine[mine], suf[:0], below[:0]
    order = np.argsort(k)
    for b, at in _cuts(k[order], bits):
        at = order[at]
        if last:
            out.add(kind=1, b=b, k=_blob(k[at]), suf=b"", c=_blob(c[at]), v=_blob(v[at]), below=b"", mine=_blob(mine[at]))
            continue
        out.add(kind=1, b=b, k=_blob(k[at]), suf=_blob(suf[at]), c=_blob(c[at]), v=_blob(v[at]), below=_blob(below[at]), mine=_blob(mine[at]))


def _solved(asked: DataFrame, answers: DataFrame, bits: int, total: int, last: bool, shared) -> DataFrame:
    """SOLVED rows: of kind 1 entries dealt by their keys, of kind 2 states, of kind 4 the entries of hot contexts, still open."""

    def run(batches):
        _, _, hot = shared.value
        out = Rows(SOLVED)
        for b, rows in _buckets(batches):
            (own,) = [r for r in rows if _kind(r) == 1]
            x, y, c, size, suf = (_get(own, n, t) for n, t in (("ctx", np.uint64), ("nxt", np.uint64), ("c", np.int64), ("size", np.int64), ("suf", np.uint64)))
            below = _all([r for r in rows if _kind(r) == 3], "below", np.float64)[np.unique(suf, return_inverse=True)[1]]
            known = ~np.isnan(below)
            often = known & (_place(hot.keys, x) >= 0)
            if often.any():
                out.add(kind=4, b=b, ctx=_blob(x[often]), nxt=_blob(y[often]), c=_blob(c[often]), size=_blob(size[often]), suf=_blob(suf[often]), below=_blob(below[often]))
            at = np.flatnonzero(known & ~often)
            x, y, c, size, suf, below = (z[at] for z in (x, y, c, size, suf, below))
            first = _groups(x)
            if len(first):
                of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
                share = (c - DISCOUNT) / size
                left = np.maximum(1 - np.add.reduceat(share, first), 1e-12)
                p = share + left[of] * below
                rest = np.maximum(size[first] - np.add.reduceat(c, first), 0)
                gain = np.add.reduceat(c * np.log2(p / below), first) + rest * np.log2(left)
                kept = gain > _cost(np.bincount(of), total)
                out.add(kind=2, b=b, k=_blob(x[first][kept]), v=_blob(np.log10(left[kept])))
                mine = kept[of]
                _emit(out, bits, last, x * B8 + y, suf, c, np.log10(p / left[of] / below), np.where(mine, p, below), mine)
            yield from out.batch()

    return _met(asked.sparkSession, asked.where("kind = 1").drop("origin"), answers, order=("origin",)).mapInArrow(run, SOLVED)


def _hot_states(solved: DataFrame, hot: Hot, total: int) -> tuple[np.ndarray, np.ndarray]:
    """For each hot context log10 of what it leaves to its suffix, and whether it is kept: sums over its entries, wherever they lie."""

    def added(value) -> np.ndarray:
        def run(batches):
            for t in batches:
                for i in range(t.num_rows):
                    r = (t, i)
                    c, size, below = _get(r, "c", np.int64), _get(r, "size", np.int64), _get(r, "below", np.float64)
                    at = _place(hot.keys, _get(r, "ctx", np.uint64))
                    sums = [np.bincount(at, weights=z, minlength=len(hot.keys)) for z in value(at, c, size, below)]
                    here = np.flatnonzero(np.bincount(at, minlength=len(hot.keys)))
                    yield pa.RecordBatch.from_pydict({"h": pa.array(here), "s": pa.array([[s[j] for s in sums] for j in here], pa.list_(pa.float64()))})

        rows = solved.where("kind = 4").select("ctx", "c", "size", "below").mapInArrow(run, "h long, s array<double>")
        got = rows.select("h", F.posexplode("s").alias("i", "x")).groupBy("h", "i").agg(F.sum("x").alias("x")).collect()
        out = np.zeros((3, len(hot.keys)))
        for r in got:
            out[r.i, r.h] = r.x
        return out

    n, own, share = added(lambda at, c, size, below: (np.ones(len(c)), c, (c - DISCOUNT) / size))
    left = np.maximum(1 - share, 1e-12)
    gain = added(lambda at, c, size, below: (c * np.log2(((c - DISCOUNT) / size + left[at] * below) / below),))[0]
    gain += np.maximum(hot.size - own, 0) * np.log2(left)
    return np.log10(left), (n > 0) & (gain > _cost(n, total))


def _hot_entries(solved: DataFrame, hot: Hot, left: np.ndarray, kept: np.ndarray, bits: int, last: bool) -> DataFrame:
    """SOLVED rows of kind 1 of the entries of hot contexts."""

    def run(batches):
        out = Rows(SOLVED)
        for t in batches:
            for i in range(t.num_rows):
                r = (t, i)
                x, y, suf, c, size, below = (_get(r, n, k) for n, k in (("ctx", np.uint64), ("nxt", np.uint64), ("suf", np.uint64), ("c", np.int64), ("size", np.int64), ("below", np.float64)))
                at = _place(hot.keys, x)
                rest, mine = 10.0 ** left[at], kept[at]
                p = (c - DISCOUNT) / size + rest * below
                _emit(out, bits, last, x * B8 + y, suf, c, np.log10(p / rest / below), np.where(mine, p, below), mine)
                yield from out.batch()

    return solved.where("kind = 4").select("ctx", "nxt", "suf", "c", "size", "below").mapInArrow(run, SOLVED)


def _entries(rows: DataFrame, last: bool) -> DataFrame:
    """SOLVED rows of kind 1 put together as a TABLE."""
    need = [("c", np.int64), ("v", np.float64), ("mine", np.bool_)] + ([] if last else [("suf", np.uint64), ("below", np.float64)])

    def run(batches):
        out = Rows(TABLE)
        for b, own in _buckets(batches):
            k = _all(own, "k", np.uint64)
            order = np.argsort(k)
            cols = {n: _blob(_all(own, n, t)[order]) for n, t in need}
            out.add(kind=0, b=b, n=len(k), k=_blob(k[order]), **cols)
            yield from out.batch()

    return _met(rows.sparkSession, rows.select("kind", "b", "k", "suf", "c", "v", "below", "mine")).mapInArrow(run, TABLE)


# ---------------------------------------------------------------- the model
@dataclass
class Model:
    """Packed rows (b, k, c, v, base) of all runs with a value: ``v`` is what each occurrence adds to log10 of a text's probability,
    ``base`` what it adds under the unigram model (above 0 exactly for words). ``unseen`` is log10 of a word never seen."""

    table: DataFrame
    bits: int
    total: int
    unseen: float


VALUES = "kind int, b int, n long, k binary, c binary, v binary, base binary"


def learn(docs: DataFrame, training: Column, scratch: Scratch, depth: int = 2) -> Model:
    """The model of the rows for which ``training`` holds, with contexts of up to ``depth`` tokens."""
    spark = docs.sparkSession
    train = docs.where(training).select("text")
    size = train.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(1, int(np.ceil(np.log2(max(1, size / 8 / BUCKET)))))
    words = _words(train, bits, scratch)
    kinds, total = (int(x) for x in words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first())
    room = float(total + kinds + 1)
    table, made = _unigrams(words, room), [words]
    parts = [_values(table.select("b", "k", "c", "v", "mine"), every=True)]
    for n in range(2, depth + 2):
        keys = int(table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
        often = lambda r: _get(r, "k", np.uint64)[_get(r, "c", np.int64) >= LEAST]
        mine = lambda r: _get(r, "k", np.uint64)[_get(r, "mine", np.bool_)]
        hot = _hot(table, max(HOT_CONTEXT, total >> HOT_SHARE))
        suffixes = _sieve(table, keys, bits, often)
        contexts = _sieve(table, keys, bits, mine) if n > 2 else suffixes
        shared = spark.sparkContext.broadcast((contexts, suffixes, hot))
        last = n == depth + 1
        asked = scratch.table(_asked(_gather(train, n, bits, shared), table, bits, shared), "zstd")
        _collect(spark)
        solved = scratch.table(_solved(asked, _answers(asked, table), bits, total, last, shared), "zstd")
        _collect(spark)
        scratch.drop(asked)
        rows, states = solved.where("kind = 1"), solved.where("kind = 2").select("b", "k", "v")
        if len(hot.keys):
            left, kept = _hot_states(solved, hot, total)
            rows = rows.unionByName(_hot_entries(solved, hot, left, kept, bits, last))
            own = [(b, bytearray(_blob(hot.keys[kept][at])), bytearray(_blob(left[kept][at]))) for b, at in _cuts(hot.keys[kept], bits)]
            if own:
                states = states.unionByName(spark.createDataFrame(own, "b int, k binary, v binary"))
        table = scratch.table(_entries(rows, last), "zstd")
        states = scratch.table(states, "zstd")
        scratch.drop(solved)
        _collect(spark)
        made += [table, states]
        parts += [_values(table.select("b", "k", "c", "v", "mine"), every=False), _values(states, every=True)]
    model = Model(scratch.table(_merged(spark, parts), "zstd"), bits, total, -float(np.log10(room)))
    scratch.drop(*made)
    _collect(spark)
    return model


def _values(rows: DataFrame, every: bool) -> DataFrame:
    """VALUES rows of a table's words (all of them), of its entries in kept states, or of states."""
    words = every and "c" in rows.columns

    def run(batches):
        out = Rows(VALUES)
        for t in batches:
            for i in range(t.num_rows):
                r = (t, i)
                k, v = _get(r, "k", np.uint64), _get(r, "v", np.float64)
                c = _get(r, "c", np.int64) if "c" in t.schema.names else np.zeros(len(k), np.int64)
                at = np.arange(len(k)) if every else np.flatnonzero(_get(r, "mine", np.bool_))
                out.add(kind=1, b=t.column(t.schema.get_field_index("b"))[i].as_py(), k=_blob(k[at]), c=_blob(c[at]), v=_blob(v[at]), base=_blob(v[at] if words else np.zeros(len(at))))
            yield from out.batch()

    return rows.mapInArrow(run, VALUES)


def _merged(spark, parts: list[DataFrame]) -> DataFrame:
    """VALUES rows, one a bucket; a run that is both an entry and a state has the sum of both values."""

    def run(batches):
        out = Rows(VALUES)
        for b, rows in _buckets(batches):
            k, at = np.unique(_all(rows, "k", np.uint64), return_inverse=True)
            c = np.zeros(len(k), np.int64)
            np.maximum.at(c, at, _all(rows, "c", np.int64))
            v, base = (np.bincount(at, weights=_all(rows, n, np.float64), minlength=len(k)) for n in ("v", "base"))
            out.add(kind=0, b=b, n=len(k), k=_blob(k), c=_blob(c), v=_blob(v), base=_blob(base))
            yield from out.batch()

    return _met(spark, *parts).mapInArrow(run, VALUES)


def _collect(spark) -> None:
    """Shuffle files of what is written by now go when the JVM collects what refers to them."""
    spark.sparkContext._jvm.System.gc()


def _frequent(model: Model) -> int:
    """The least power of two such that at most HOT_RUNS runs occur as often."""

    def run(batches):
        for t in batches:
            for i in range(t.num_rows):
                e, n = np.unique(np.frexp(_get((t, i), "c", np.int64).astype(np.float64))[1], return_counts=True)
                yield pa.RecordBatch.from_pydict({"e": pa.array(e.astype(np.int32)), "n": pa.array(n.astype(np.int64))})

    number, cut = 0, 64
    for r in sorted(model.table.select("c").mapInArrow(run, "e int, n long").groupBy("e").agg(F.sum("n").alias("n")).collect(), key=lambda r: -r.e):
        number += r.n
        if number > HOT_RUNS:
            break
        cut = r.e
    return 1 << (max(cut, 1) - 1) if cut < 64 else 1 << 62


def _hot_values(model: Model, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    def run(batches):
        for t in batches:
            for i in range(t.num_rows):
                r = (t, i)
                at = np.flatnonzero(_get(r, "c", np.int64) >= least)
                yield pa.RecordBatch.from_pydict({"k": pa.array(_get(r, "k", np.int64)[at]), "v": pa.array(_get(r, "v", np.float64)[at]), "base": pa.array(_get(r, "base", np.float64)[at])})

    got = model.table.mapInArrow(run, "k long, v double, base double").toArrow()
    k, v, base = (np.asarray(got.column(x).combine_chunks()) for x in ("k", "v", "base"))
    order = np.argsort(k.view(np.uint64))
    return k.view(np.uint64)[order], v[order], base[order]


ROWS = "kind int, b int, batch long, k binary, idx binary, ids binary, valid binary, held binary, n binary, sums binary"
ANSWERS = "kind int, batch long, idx binary, ids binary, valid binary, held binary, n binary, sums binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, held_out: Column, depth: int = 2) -> DataFrame:
    """Log probabilities of all whole texts under the tree and under the add-one unigram model, learnt where ``held_out`` is false.

    Takes (doc_id, text) and returns (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row for each input
    row. Tokens are words (runs of characters other than space and \\t..\\r, A-Z in lower case) and an end, so a null or empty text
    is the end alone. Without training rows every probability is 1. Null and repeated ids pass through, other columns are ignored;
    an empty table gives no rows. Words are known by 64-bit hashes. The model's most frequent runs are broadcast, at most half a
    million; all others are looked up in their buckets.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffixtree")
    flag = F.coalesce(held_out, F.lit(False))
    model = learn(docs, ~flag, scratch, depth)
    least, bits = _frequent(model), model.bits
    keys = int(model.table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    rare = _sieve(model.table, keys, bits, lambda r: _get(r, "k", np.uint64)[_get(r, "c", np.int64) < least])
    shared = spark.sparkContext.broadcast((_hot_values(model, least), rare))

    def run(batches):
        (hot, worth, base), rare = shared.value
        worth, base = np.append(worth, 0.0), np.append(base, 0.0)
        out, number, have, wanted, size, texts = Rows(ROWS), 0, [], [], 0, 0

        def flush():
            nonlocal number
            batch = (TaskContext.get().partitionId() << 32) | number
            number += 1
            ids, held, n, sums = ([x[i] for x in have] for i in range(4))
            ids = pa.concat_arrays(ids)
            out.add(kind=1, b=batch % (1 << bits), batch=batch, ids=_blob(np.asarray(ids.fill_null(0))), valid=_blob(np.asarray(ids.is_valid())), held=_blob(np.concatenate(held)), n=_blob(np.concatenate(n)), sums=_blob(np.concatenate(sums, axis=1)))
            k, of = np.concatenate([x for x, _ in wanted]), np.concatenate([x for _, x in wanted])
            order = np.argsort(k)
            k, of = k[order], of[order].astype(np.uint16)
            for b, at in _cuts(k, bits):
                out.add(kind=2, b=b, batch=batch, k=_pack(k[at]), idx=_blob(of[at]))
            have.clear(), wanted.clear()
            yield from out.batch()

        for t in batches:
            for w in words_of(t.column(1)):
                for lo in range(0, len(w), DOCS):  # words_of gives whole texts, which may be short and many
                    hi = min(lo + DOCS, len(w))
                    if texts + hi - lo > DOCS or size > FLUSH // 2:
                        yield from flush()
                        size = texts = 0
                    part = t.slice(w.row0 + lo, hi - lo)
                    keys, text, place = _runs(w, depth + 1)
                    sums = np.zeros((3, hi - lo))
                    for n, k in keys.items():
                        at = np.flatnonzero((place >= max(1, n - 1)) & (text >= lo) & (text < hi))
                        k, back = np.unique(k[at], return_inverse=True)
                        of, found = text[at] - lo, _place(hot, k)
                        sums[0] += np.bincount(of, weights=worth[found][back], minlength=hi - lo)
                        if n == 1:
                            sums[1] += np.bincount(of, weights=base[found][back], minlength=hi - lo)
                            sums[2] += np.bincount(of, weights=(base[found] > 0)[back], minlength=hi - lo)
                        cold = (found < 0) & rare.has(k)
                        hit = cold[back]
                        wanted.append((k[back[hit]], of[hit] + texts))
                        size += int(hit.sum())
                    have.append((part.column(0), np.asarray(part.column(2)), (w.hi - w.lo + 1)[lo:hi].astype(np.int64), sums))
                    texts += hi - lo
        if have:
            yield from flush()

    def answer(batches):
        out, own = Rows(ANSWERS), ("ids", "valid", "held", "n", "sums")
        for _, rows in _buckets(batches):
            table = [r for r in rows if _kind(r) == 0]
            keys, v, base = (_all(table, n, t) for n, t in (("k", np.uint64), ("v", np.float64), ("base", np.float64)))
            v, base = np.append(v, 0.0), np.append(base, 0.0)
            for r in rows:
                t, i = r
                batch = t.column(t.schema.get_field_index("batch"))[i].as_py()
                if _kind(r) == 1:
                    out.add(kind=1, batch=batch, **{n: _get(r, n, np.uint8).tobytes() for n in own})
                elif _kind(r) == 2:
                    at = _place(keys, _unpack(r, "k"))
                    idx, of = np.unique(_get(r, "idx", np.uint16), return_inverse=True)
                    sums = np.stack([np.bincount(of, weights=x[at], minlength=len(idx)) for x in (v, base, base > 0)])
                    out.add(kind=2, batch=batch, idx=_blob(idx), sums=_blob(sums))
            yield from out.batch()

    def whole(batches):
        for _, rows in _buckets(batches, "batch"):
            own = rows[0]
            n, sums = _get(own, "n", np.int64), _get(own, "sums", np.float64).reshape(3, -1).copy()
            for r in rows[1:]:
                sums[:, _get(r, "idx", np.uint16)] += _get(r, "sums", np.float64).reshape(3, -1)
            first = model_unseen * n
            ids = pa.array(_get(own, "ids", np.int64), mask=~_get(own, "valid", np.bool_))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(_get(own, "held", np.bool_)), pa.array(n), pa.array(np.rint(sums[2]).astype(np.int64)), pa.array(np.full(len(n), model_total)), pa.array(first + sums[1]), pa.array(first + sums[0])],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    model_unseen, model_total = model.unseen, np.int64(model.total)
    asked = docs.select("doc_id", "text", flag.alias("held_out")).mapInArrow(run, ROWS)
    answers = scratch.table(_met(spark, model.table.select("kind", "b", "k", "v", "base"), asked).mapInArrow(answer, ANSWERS))
    scratch.drop(model.table)
    return _met(spark, answers, by="batch").mapInArrow(whole, RESULT)


def held_out(remainder: int = 2, folds: int = 7) -> Column:
    return F.pmod(crc_text("doc_id"), F.lit(folds)) == remainder
