"""Packing token sequences: first-fit decreasing with a tournament tree of bin capacities, in randomised groups."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paratope.llm.bpe import MEMO, encoded
from paratope.llm.common import Scratch

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item. Items go longest first (ties by position) to the leftmost bin that has room.

    The tree's leaves are the free space of bins; an inner node holds the larger of its two children, so the leftmost bin with
    room is found by one walk from the root.
    """
    order = np.argsort(-lengths, kind="stable")
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for item, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        at = 1
        while at < leaves:
            at *= 2
            if tree[at] < n:
                at += 1
        bins[item], offsets[item] = at - leaves, capacity - tree[at]
        tree[at] -= n
        while at > 1:
            at //= 2
            best = tree[2 * at] if tree[2 * at] >= tree[2 * at + 1] else tree[2 * at + 1]
            if tree[at] == best:
                break
            tree[at] = best
    return bins, offsets


def tokenised_pieces(docs: DataFrame, path: str, end_id: int, size: int, memo: int = MEMO) -> DataFrame:
    """Pieces of at most ``size`` ids of each document's ids and ``end_id``: PIECES and a random number ``r`` for grouping."""

    def run(batches):
        end = np.array([end_id], dtype="<u4").tobytes()
        rng = np.random.default_rng(TaskContext.get().partitionId())
        for b in batches:
            rows = []
            for doc, (ids, _) in zip(b.column(0).to_pylist(), encoded(b.column(1), path, memo=memo), strict=True):
                ids += end
                n = len(ids) // 4
                for s in range(0, n, size):
                    own = ids[4 * s : 4 * (s + size)]
                    rows.append((doc, s, len(own) // 4, zlib.crc32(own), n))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in cols), pa.array(rng.random(len(rows)))], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "r"])

    return docs.select("doc_id", "text").mapInArrow(run, f"{PIECES}, r double")


def pack(docs: DataFrame, path: str, end_id: int = 1, size: int = 2048, group: int = 8192, memo: int = MEMO) -> DataFrame:
    """Pack all documents of (doc_id, text) into sequences of at most ``size`` ids.

    Documents longer than ``size`` are cut there; only the last piece of a document is shorter. Pieces are dealt at random to
    groups of about ``group`` pieces, and each group is packed on its own, so a task's work is bounded however often an id or a
    text occurs. Returns PIECES, sequence_id (group number times 2**32 plus the bin's number in the group) and offset. A null or
    empty text is ``end_id`` alone. Null and repeated ids give pieces of their own; other columns are ignored; an empty table
    gives no rows. The random deal is written to the shared folder, so a lost executor doesn't change it.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.table(tokenised_pieces(docs, path, end_id, size, memo))
    groups = max(1, -(-pieces.count() // group))

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("r", "ascending")])
        bins, offsets = first_fit_decreasing(np.asarray(table.column("length")), size)
        ids = np.asarray(table.column("g")) * (1 << 32) + bins
        return table.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"]).append_column("sequence_id", pa.array(ids, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return pieces.withColumn("g", F.floor(F.col("r") * groups)).groupBy("g").applyInArrow(place, f"{PIECES}, sequence_id long, offset long")
