"""Repeated passages by a sparse suffix array: suffixes at minimiser positions, brought together by seed and extended exactly.

Positions are words. In each window of ``window`` consecutive runs of ``seed`` words the run of least hash is selected, by its
content alone, so two copies of a passage of seed + window - 1 words, the least that counts, have a selected position in common:
one with l of the passage's words before the seed and window - 1 - l after it. Suffixes of a seed are therefore grouped by each of
these window splits of their left and right contexts; a group of two or more is a repeat, and the splits of a suffix that are in
one reach from its passage's first to its last word. Seeds of many suffixes are not grouped in a task: there the passages of
seed + window - 1 words around them are counted over the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paratope.llm.common import BASE, Scratch, bloom_bits, bloom_of, join_hot, mix64, shuffle_partitions, signed, words_of

CROWD = 20_000  # a seed of more suffixes (about 4 MB) is not grouped in one task
SUFFIX = "seed long, right binary, left binary, doc_id long, text_hash long, pos int"
MATCH = "doc_id long, text_hash long, start int, end int, other_doc_id long, later boolean, copy_start int, copy_end int"
NONE = np.iinfo(np.int64).min  # stands for a null id


def run_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words of a sequence of word hashes."""
    n = len(h) - k + 1
    total = np.zeros(len(h) + 1, dtype=np.uint64)
    power = np.multiply.accumulate(np.full(len(h) + 1, BASE, dtype=np.uint64))
    back = np.multiply.accumulate(np.full(len(h) + 1, pow(BASE, -1, 1 << 64), dtype=np.uint64))
    np.cumsum(h * power[:-1], out=total[1:])
    return mix64((total[k:] - total[:-k]) * back[:n])


def minimisers(h: np.ndarray, seed: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Selected positions of a sequence of word hashes and the hashes of the runs there (a run of least hash in some window)."""
    n = len(h) - seed + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    run = run_hashes(h, seed)
    width = min(window, n)
    least = np.lib.stride_tricks.sliding_window_view(run, width).argmin(1) + np.arange(n - width + 1)
    at = np.unique(least)
    return at, run[at]


def _suffixes(docs: DataFrame, seed: int, window: int, known) -> DataFrame:
    """Seeds of all selected positions or, with a filter of repeated seeds and the crowded ones, SUFFIX rows of repeated others."""
    reach = window - 1

    def seeds(batches):
        for b in batches:
            for w in words_of(b.column(1)):
                found = [minimisers(w.hash[w.lo[i] : w.hi[i]], seed, window)[1] for i in range(len(w))]
                yield pa.RecordBatch.from_pydict({"seed": pa.array(signed(np.concatenate(found)))})

    def suffixes(batches):
        filt, crowded = known.value
        for b in batches:
            for w in words_of(b.column(1)):
                rows, pos, keys, right, left = [], [], [], [], []
                for i in range(len(w)):
                    h = w.hash[w.lo[i] : w.hi[i]]
                    at, run = minimisers(h, seed, window)
                    hit = filt.has(run) & ~_among(crowded, run)
                    if not hit.any():
                        continue
                    at, run = at[hit], run[hit]
                    small = np.zeros(len(h) + 2 * reach, dtype=">u4")  # 0 stands for no word; big-endian bytes sort as numbers
                    small[reach : reach + len(h)] = (h >> np.uint64(32)).astype(np.uint32) | 1
                    rows.append(np.full(len(at), w.row0 + i))
                    pos.append(at)
                    keys.append(run)
                    right.append(small[(at + seed + reach)[:, None] + np.arange(reach)[None, :]])
                    left.append(small[(at + reach - 1)[:, None] - np.arange(reach)[None, :]])
                if rows:
                    cut = lambda x: pa.array([r.tobytes() for r in np.concatenate(x)], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(keys))), cut(right), cut(left), *(b.column(c).take(pa.array(np.concatenate(rows))) for c in (0, 2)), pa.array(np.concatenate(pos).astype(np.int32))], names=["seed", "right", "left", "doc_id", "text_hash", "pos"])

    return docs.mapInArrow(seeds, "seed long") if known is None else docs.mapInArrow(suffixes, SUFFIX)


def _passages(docs: DataFrame, seed: int, window: int, known) -> DataFrame:
    """(k, doc_id, text_hash, start) of the passages of seed + window - 1 words that hold a selected position of a crowded seed."""
    size = seed + window - 1

    def run(batches):
        _, crowded = known.value
        for b in batches:
            for w in words_of(b.column(1)):
                rows, starts, keys = [], [], []
                for i in range(len(w)):
                    h = w.hash[w.lo[i] : w.hi[i]]
                    if len(h) < size:
                        continue
                    at, found = minimisers(h, seed, window)
                    at = at[_among(crowded, found)]
                    if not len(at):
                        continue
                    start = np.unique(at[:, None] - np.arange(window)[None, :])
                    start = start[(start >= 0) & (start <= len(h) - size)]
                    rows.append(np.full(len(start), w.row0 + i))
                    starts.append(start)
                    keys.append(run_hashes(h, size)[start])
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(keys))), *(b.column(c).take(pa.array(np.concatenate(rows))) for c in (0, 2)), pa.array(np.concatenate(starts).astype(np.int32))], names=["k", "doc_id", "text_hash", "start"])

    return docs.mapInArrow(run, "k long, doc_id long, text_hash long, start int")


def _crowded_matches(passages: DataFrame, size: int) -> DataFrame:
    """MATCH rows of passages that occur twice or more: all but the first meet the first, the first meets the second."""
    place = F.struct("doc_id", "text_hash", "start")
    first = passages.groupBy("k").agg(F.min(place).alias("f"), F.count("*").alias("n")).where("n > 1")
    total = passages.count()
    same = F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("text_hash") == F.col("f.text_hash")) & (F.col("start") == F.col("f.start"))
    met = join_hot(passages, first.select("k", "f"), "k", first.select("k", "n"), total, "inner")
    # Rows that repeat id and text repeat its place as well; then the place is also later than itself.
    twice = met.groupBy("k").agg(F.min(F.when(~same, place)).alias("s"), F.sum(same.cast("int")).alias("m")).withColumn("s", F.when(F.col("m") > 1, F.lit(None)).otherwise(F.col("s")))
    both = first.join(twice, "k")
    other = F.when(same & F.col("s").isNotNull(), F.col("s.doc_id")).otherwise(F.col("f.doc_id"))
    met = join_hot(passages, both.select("k", "f", "s", "m"), "k", first.select("k", "n"), total, "inner")
    apart = ~(F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("text_hash") == F.col("f.text_hash"))) | (F.col("start") >= F.col("f.start") + size)
    end = F.col("start") + size
    copy = F.when(apart, F.col("start")).alias("copy_start"), F.when(apart, end).alias("copy_end")
    return met.select("doc_id", "text_hash", "start", end.alias("end"), other.alias("other_doc_id"), (~same | (F.col("m") > 1)).alias("later"), *copy)


def _among(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(x), dtype=bool)
    return keys[np.minimum(np.searchsorted(keys, x), len(keys) - 1)] == x


def _table(t: pa.Table):
    ids = t.column("doc_id")
    grab = lambda c: np.frombuffer(b"".join(t.column(c).to_pylist()), dtype=np.uint32).reshape(t.num_rows, -1)
    return np.asarray(t.column("seed")), grab("right"), grab("left"), np.asarray(ids.fill_null(NONE)), np.asarray(t.column("text_hash")), np.asarray(t.column("pos"))


def _prefixes(start: np.ndarray, words: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """A hash of each row's first 0, 1, ... words, and how many words there are (0 is no word)."""
    out = [start]
    for c in range(words.shape[1]):
        out.append(mix64(out[-1] * np.uint64(BASE) + words[:, c]))
    none = words == 0
    return out, np.where(none.any(1), none.argmax(1), words.shape[1])


def _matches(t, seed: int, least: int) -> pa.RecordBatch | None:
    """The extent of each row's repeats among all rows of its seed."""
    order = np.lexsort((t[5], t[4], t[3]))
    key, right, left, doc, text, pos = (x[order] for x in t)
    n, reach = len(key), least - seed
    before, n_before = _prefixes(mix64(key.view(np.uint64)), left)
    after, n_after = _prefixes(np.zeros(n, np.uint64), right)
    lo, hi, other = np.full(n, -1), np.full(n, -1), np.full(n, np.iinfo(np.int64).max)
    later = np.zeros(n, dtype=bool)
    copy_lo, copy_hi = np.full(n, -1), np.full(n, -1)  # the same of what has an earlier copy that it doesn't overlap
    for l in range(reach + 1):  # noqa: E741
        at = np.flatnonzero((n_before >= l) & (n_after >= reach - l))
        k = mix64(before[l][at] * np.uint64(BASE) + after[reach - l][at])
        by = np.argsort(k, kind="stable")
        at, k = at[by], k[by]
        new = np.ones(len(k), dtype=bool)
        new[1:] = k[1:] != k[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(k)))
        many = np.repeat(size > 1, size)
        lead = np.repeat(first, size)
        meets = np.where(new, np.minimum(lead + 1, max(0, len(k) - 1)), lead)
        x, y, after_first = at[many], at[meets[many]], ~new[many]
        lo[x] = l
        hi[x] = np.where(hi[x] < 0, reach - l, hi[x])
        other[x] = np.minimum(other[x], doc[y])
        later[x] |= after_first
        z = at[lead[many]]
        c = x[(doc[x] != doc[z]) | (text[x] != text[z]) | (pos[x] - pos[z] >= least)]
        copy_lo[c] = l
        copy_hi[c] = np.where(copy_hi[c] < 0, reach - l, copy_hi[c])
    hit = np.flatnonzero(lo >= 0)
    if not len(hit):
        return None
    none = copy_lo[hit] < 0
    copy = pa.array((pos[hit] - copy_lo[hit]).astype(np.int32), mask=none), pa.array((pos[hit] + seed + copy_hi[hit]).astype(np.int32), mask=none)
    return pa.RecordBatch.from_arrays([pa.array(doc[hit], mask=doc[hit] == NONE), pa.array(text[hit]), pa.array((pos[hit] - lo[hit]).astype(np.int32)), pa.array((pos[hit] + seed + hi[hit]).astype(np.int32)), pa.array(other[hit], mask=other[hit] == NONE), pa.array(later[hit]), *copy], names=["doc_id", "text_hash", "start", "end", "other_doc_id", "later", "copy_start", "copy_end"])


def _found(docs: DataFrame, min_words: int, seed: int) -> DataFrame:
    """MATCH rows of all repeats."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffixes")
    window = min_words - seed + 1
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    repeated = scratch.table(_suffixes(docs, seed, window, None).groupBy("seed").count().where("count > 1"))
    crowded = np.sort(np.asarray(repeated.where(F.col("count") > CROWD).select("seed").toArrow().column(0).combine_chunks()).astype(np.int64).view(np.uint64))
    known = spark.sparkContext.broadcast((bloom_of(repeated.select("seed"), bloom_bits(repeated.count())), crowded))
    rows = _suffixes(docs, seed, window, known).repartition(shuffle_partitions(spark), "seed").sortWithinPartitions("seed")

    def compare(batches):
        """Matches of whole seeds; the last one of a batch may go on in the next."""
        kept = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([b])])
            s = np.asarray(t.column("seed"))
            cut = int(np.flatnonzero(s != s[-1])[-1]) + 1 if s[0] != s[-1] else 0
            kept = t.slice(cut)
            if cut and (m := _matches(_table(t.slice(0, cut)), seed, min_words)) is not None:
                yield m
        if kept is not None and (m := _matches(_table(kept), seed, min_words)) is not None:
            yield m

    matches = rows.mapInArrow(compare, MATCH)
    if len(crowded):
        matches = matches.unionByName(_crowded_matches(scratch.table(_passages(docs, seed, window, known)), min_words))
    return matches


def repeated_passages(docs: DataFrame, min_words: int = 50, seed: int = 30) -> DataFrame:
    """Word spans of at least ``min_words`` words that also occur elsewhere, in another document or further on in the same one.

    Takes (doc_id, text) and returns (doc_id, start, end, n_words, other_doc_id, is_first): overlapping matches of a document are
    merged; start and end count words (runs of characters other than space and \\t..\\r, A-Z in lower case), end exclusive;
    other_doc_id is the smallest document that holds a copy of any ``min_words`` words of it; is_first says that no copy of any
    comes before it in (doc_id, position). Every run of min_words words or more that recurs is found, in its full extent.
    Null, empty and shorter texts have no span. A null id is an id that ranks first. Rows that share an id but not the text have
    spans of their own; rows that repeat both have theirs once, and each is another place where the passage occurs. Other columns are ignored; an empty table gives no rows. Words are known by hashes.
    """
    matches = _found(docs, min_words, seed)
    span = matches.groupBy("doc_id", "text_hash", "start", "end").agg(F.min("other_doc_id").alias("other_doc_id"), F.max("later").alias("later"))
    by = Window.partitionBy("doc_id", "text_hash").orderBy("start", "end")
    islands = span.withColumn("new", (F.col("start") > F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))).cast("int"))
    islands = islands.withColumn("island", F.sum(F.coalesce("new", F.lit(0))).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    merged = islands.groupBy("doc_id", "text_hash", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("other_doc_id").alias("other_doc_id"), (~F.max("later")).alias("is_first"))
    return merged.select("doc_id", "start", "end", (F.col("end") - F.col("start")).alias("n_words"), "other_doc_id", "is_first")


def later_passages(docs: DataFrame, min_words: int = 50, seed: int = 30) -> DataFrame:
    """(doc_id, text_hash, start, end): the word spans, merged, of passages of at least ``min_words`` words that occur before, in a document of
    lesser id or further up in the same one.

    A run of min_words words is such a passage unless it is the first of its kind in ascending (doc_id, text_hash, start), overlaps the first, or
    is the same place in a row that repeats id and text; so each word of it has a copy elsewhere that is no part of it. Otherwise as
    ``repeated_passages``.
    """
    span = _found(docs, min_words, seed).where("copy_start IS NOT NULL").select("doc_id", "text_hash", F.col("copy_start").alias("start"), F.col("copy_end").alias("end")).distinct()
    by = Window.partitionBy("doc_id", "text_hash").orderBy("start", "end")
    islands = span.withColumn("new", (F.col("start") > F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))).cast("int"))
    islands = islands.withColumn("island", F.sum(F.coalesce("new", F.lit(0))).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy("doc_id", "text_hash", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")
