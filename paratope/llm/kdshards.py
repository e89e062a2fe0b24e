"""Sharding by a k-d tree over metadata: nodes are split at weighted medians along their widest dimension.

Rows are points: numbers lie where they are, texts where their hash is, so that equal ones stay together. A node that still holds
several shards' bytes is cut along the dimension in which it is widest, where the running sum of bytes reaches its left child's share.
That place is found for all nodes of a level at once: each task sums bytes in 256 buckets a node, the bucket that holds the place is
cut into 256 again, and so on until the cut is exact or within ``slack``. Where many rows share the value, the search goes on in a
pseudo-random key of each row, so no value is too frequent to be split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paratope.llm.common import Scratch

BUCKETS = 256
SLOT_ROWS = 20_000  # rows of a shard that are numbered in one task
LOW, HIGH = -(1 << 63), (1 << 63) - 1


@dataclass
class Tree:
    """Nodes by number: an inner node sends rows with (position, key) up to its cut to ``left``, others to ``left`` + 1."""

    dim: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    key: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    first: list[int] = field(default_factory=lambda: [0])  # the node's first shard
    shards: list[int] = field(default_factory=lambda: [1])

    def split(self, node: int, dim: int, cut: float, key: int) -> None:
        self.dim[node], self.cut[node], self.key[node], self.left[node] = dim, cut, key, len(self.dim)
        m = self.shards[node]
        for first, n in ((self.first[node], m - m // 2), (self.first[node] + m - m // 2, m // 2)):
            for a, v in ((self.dim, -1), (self.cut, 0.0), (self.key, 0), (self.left, 0), (self.first, first), (self.shards, n)):
                a.append(v)

    def nodes(self, u: Sequence[np.ndarray], t: np.ndarray) -> np.ndarray:
        """The leaf of the present tree that each row is in."""
        dim, cut, key, left = (np.array(x) for x in (self.dim, self.cut, self.key, self.left))
        at = np.zeros(len(t), dtype=np.int64)
        while True:
            inner = np.flatnonzero(dim[at] >= 0)
            if not len(inner):
                return at
            here = at[inner]
            x = np.choose(dim[here], [v[inner] for v in u]) if len(u) < 32 else np.array(u)[dim[here], inner]
            right = (x > cut[here]) | ((x == cut[here]) & (t[inner] > key[here]))
            at[inner] = left[here] + right


def position(kind: T.DataType, c: Column) -> Column:
    """A number for any value: itself, seconds, or a hash of its text; null is null."""
    if isinstance(kind, T.NumericType | T.BooleanType):
        return c.cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    return F.when(c.isNotNull(), F.shiftright(F.xxhash64(c.cast("string")), 12).cast("double"))


def _columns(b: pa.RecordBatch, low: np.ndarray, span: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Positions scaled to 0..1 (null and NaN: 0), keys and weights of a batch (d0, .., key, size)."""
    n = len(low)
    u = [np.nan_to_num(np.clip((np.asarray(b.column(i).cast(pa.float64()).fill_null(np.nan)) - low[i]) / span[i], 0.0, 1.0)) for i in range(n)]
    return u, np.asarray(b.column(n)), np.asarray(b.column(n + 1)).astype(np.float64)


def kd_tree(points: DataFrame, dims: int, shards: int, slack: float = 1e-5) -> tuple[Tree, np.ndarray, np.ndarray]:
    """The tree of ``points`` (d0, d1, .. doubles, key long, size long), a written table, and the scale of its positions.

    A level takes a pass for widths and a few for cuts; a row a node and pass comes to the driver. The shares of a node's children
    are those of their shards; a cut may miss its place by ``slack`` of the node's bytes or by half a row.
    """
    names = [f"d{i}" for i in range(dims)]
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.col(c))
    row = points.agg(*(f(finite(c)).alias(f"{k}{c}") for c in names for k, f in (("lo", F.min), ("hi", F.max)))).first()
    low = np.array([row[f"lo{c}"] or 0.0 for c in names])
    span = np.array([(row[f"hi{c}"] or 0.0) for c in names]) - low
    span[span <= 0] = 1.0
    tree = Tree(shards=[shards])

    def widths(batches):
        sums: dict[int, list] = {}
        for b in batches:
            u, t, w = _columns(b, low, span)
            at = tree.nodes(u, t)
            for node in np.unique(at).tolist():
                own = at == node
                lo, hi = [float(x[own].min()) for x in u], [float(x[own].max()) for x in u]
                s = sums.setdefault(node, [0.0, lo, hi])
                s[0] += float(w[own].sum())
                s[1], s[2] = [min(p) for p in zip(s[1], lo, strict=True)], [max(p) for p in zip(s[2], hi, strict=True)]
        yield pa.RecordBatch.from_pylist([{"node": n, "w": s[0], **{f"lo{i}": x for i, x in enumerate(s[1])}, **{f"hi{i}": x for i, x in enumerate(s[2])}} for n, s in sums.items()], _schema)

    _schema = pa.schema([("node", pa.int64()), ("w", pa.float64()), *((f"{k}{i}", pa.float64()) for k in ("lo", "hi") for i in range(dims))])
    ends = [f"{k}{i}" for k in ("lo", "hi") for i in range(dims)]
    while True:
        many = {n for n in range(len(tree.dim)) if tree.dim[n] < 0 and tree.shards[n] > 1}
        if not many:
            return tree, low, span
        found = points.select(*names, "key", "size").mapInArrow(widths, "node long, w double, " + ", ".join(f"{e} double" for e in ends))
        found = found.groupBy("node").agg(F.sum("w").alias("w"), *((F.min if e.startswith("lo") else F.max)(e).alias(e) for e in ends)).collect()
        open_: dict[int, dict] = {}
        for r in found:
            if r.node in many:
                wide = [r[f"hi{i}"] - r[f"lo{i}"] for i in range(dims)]
                d = int(np.argmax(wide))
                m = tree.shards[r.node]
                open_[r.node] = {"dim": d, "w": r.w, "goal": r.w * (m - m // 2) / m, "by_key": False, "at": 0.0, "lo": r[f"lo{d}"], "hi": r[f"hi{d}"]}
        cuts = _cuts(points.select(*names, "key", "size"), tree, low, span, open_, slack)
        for n in sorted(many):  # a node without rows: its shards stay empty
            tree.split(n, *cuts.get(n, (0, 0.0, HIGH)))


def _cuts(points: DataFrame, tree: Tree, low: np.ndarray, span: np.ndarray, open_: dict[int, dict], slack: float) -> dict[int, tuple[int, float, int]]:
    """(dimension, cut, key) of each open node. ``goal`` is what still has to lie before the cut within the node's present range."""
    done: dict[int, tuple[int, float, int]] = {}
    out = pa.schema([("node", pa.int64()), ("bucket", pa.int32()), ("w", pa.float64()), ("n", pa.int64()), ("lo", pa.float64()), ("hi", pa.float64()), ("tlo", pa.int64()), ("thi", pa.int64())])

    def histogram(batches):
        kept = []
        for b in batches:
            u, t, w = _columns(b, low, span)
            at = tree.nodes(u, t)
            for node, s in open_.items():
                own = np.flatnonzero(at == node)
                x, k, own_w = u[s["dim"]][own], t[own], w[own]
                inside = ((x == s["at"]) & (k >= s["lo"]) & (k <= s["hi"])) if s["by_key"] else ((x >= s["lo"]) & (x <= s["hi"]))
                x, k, own_w = x[inside], k[inside], own_w[inside]
                if not len(x):
                    continue
                if s["by_key"]:
                    ahead, whole = (k.view(np.uint64) - np.int64(s["lo"]).view(np.uint64)).astype(np.float64), float(s["hi"] - s["lo"])
                else:
                    ahead, whole = x - s["lo"], s["hi"] - s["lo"]
                bucket = np.minimum((ahead / whole * BUCKETS).astype(np.int64), BUCKETS - 1) if whole > 0 else np.zeros(len(x), dtype=np.int64)
                order = np.argsort(bucket, kind="stable")
                bucket, x, k, own_w = bucket[order], x[order], k[order], own_w[order]
                cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                n = len(cut)
                kept.append(pa.RecordBatch.from_arrays([pa.array(np.full(n, node)), pa.array(bucket[cut].astype(np.int32)), pa.array(np.add.reduceat(own_w, cut)), pa.array(np.diff(np.append(cut, len(x)))), *(pa.array(f.reduceat(v, cut)) for v in (x, k) for f in (np.minimum, np.maximum))], schema=out))
        if kept:
            t = pa.Table.from_batches(kept).group_by(["node", "bucket"]).aggregate([("w", "sum"), ("n", "sum"), ("lo", "min"), ("hi", "max"), ("tlo", "min"), ("thi", "max")])
            yield from t.rename_columns(out.names).cast(out).to_batches()

    while open_:
        h = points.mapInArrow(histogram, "node long, bucket int, w double, n long, lo double, hi double, tlo long, thi long")
        h = h.groupBy("node", "bucket").agg(F.sum("w").alias("w"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("tlo").alias("tlo"), F.max("thi").alias("thi"))
        goals = F.create_map(*(F.lit(x) for n, s in open_.items() for x in (n, float(s["goal"]))))
        upto = F.sum("w").over(Window.partitionBy("node").orderBy("bucket"))
        h = h.withColumn("upto", upto).withColumn("last", F.max("bucket").over(Window.partitionBy("node")))
        at = h.where(((F.col("upto") >= goals[F.col("node")]) & (F.col("upto") - F.col("w") < goals[F.col("node")])) | ((F.col("bucket") == F.col("last")) & (F.col("upto") < goals[F.col("node")]))).collect()
        for r in at:
            s = open_[r.node]
            before, after = s["goal"] - (r.upto - r.w), r.upto - s["goal"]
            one = r.n == 1 or (r.lo == r.hi and r.tlo == r.thi)
            if one or min(before, after) <= slack * s["w"]:
                d = s["dim"]
                if s["by_key"]:
                    done[r.node] = (d, s["at"], r.thi if after <= before else r.tlo - 1)
                else:
                    done[r.node] = (d, r.hi, HIGH) if after <= before else (d, float(np.nextafter(r.lo, -1.0)), HIGH)
                del open_[r.node]
            elif s["by_key"]:
                s |= {"goal": before, "lo": r.tlo, "hi": r.thi}
            elif r.lo == r.hi:
                s |= {"goal": before, "by_key": True, "at": r.lo, "lo": r.tlo, "hi": r.thi}
            else:
                s |= {"goal": before, "lo": r.lo, "hi": r.hi}
    return done


def kd_shards(rows: DataFrame, size: Column, dims: Sequence[str], shards: int | None = None, target_bytes: int | None = None, slack: float = 1e-5) -> DataFrame:
    """``rows`` with ``shard`` (from 0) and ``slot`` (from 0 in each shard, without gaps, in pseudo-random order).

    ``size`` is a row's bytes (null counts as 0) and ``dims`` names the columns that span the space. Shards number ``shards``, or as
    many as it takes for each to have ``target_bytes`` at most, up to a row's bytes; their sizes are equal up to ``slack`` of the
    whole a level, or a row. Null and NaN lie with a dimension's least value. A row that is larger than a shard stays whole; if there
    are fewer rows than shards, some shards are empty. Rows that repeat others, in all columns too, are rows of their own. Columns
    called shard and slot are replaced; an empty table gives no rows. The driver holds the tree, a few numbers a shard.
    """
    scratch = Scratch(rows.sparkSession, "kd")
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    # Rows that are alike in all columns differ in the key's low bits, by their place in this table, which is written once.
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20))
    key = F.shiftleft(F.shiftright(F.xxhash64(*kept), 20), 20) + salt
    points = scratch.table(rows.select(F.struct(*kept).alias("row"), *(position(kinds[c], F.col(c)).alias(f"d{i}") for i, c in enumerate(dims)), key.alias("key"), F.coalesce(size, F.lit(0)).cast("long").alias("size")))
    if shards is None:
        shards = max(1, -(-(points.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    tree, low, span = kd_tree(points, len(dims), shards, slack)
    kinds_out = np.array(tree.first, dtype=np.int32)

    @F.arrow_udf("int")
    def shard(*cols: pa.Array) -> pa.Array:
        b = pa.RecordBatch.from_arrays([*cols, cols[-1]], names=[str(i) for i in range(len(cols) + 1)])
        u, t, _ = _columns(b, low, span)
        return pa.array(kinds_out[tree.nodes(u, t)], pa.int32())

    placed = scratch.table(points.select("row", "key", shard(*(f"d{i}" for i in range(len(dims))), "key").alias("shard")))
    # Each shard's keys are cut into ranges of about SLOT_ROWS rows; a row's slot is the sum of the ranges before and its place there.
    counts = placed.groupBy("shard").agg(F.ceil(F.count("*") / SLOT_ROWS).cast("long").alias("parts"))
    spread = F.col("key") / F.lit(float(1 << 64)) + 0.5
    ranged = placed.join(counts, "shard").withColumn("part", F.least(F.floor(spread * F.col("parts")), F.col("parts") - 1)).drop("parts")
    before = ranged.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = before.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("base"))
    numbered = ranged.withColumn("place", F.row_number().over(Window.partitionBy("shard", "part").orderBy("key")) - 1)
    return numbered.join(before, ["shard", "part"]).select(*(F.col("row")[c].alias(c) for c in kept), "shard", (F.col("base") + F.col("place")).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, folder: str, rows_a_file: int = 1_000_000) -> None:
    """Parquet files of each shard under ``folder/shard=N``, in the order of slots."""
    part = F.floor(F.col("slot") / rows_a_file)
    sharded.withColumn("__part", part).repartition("shard", "__part").sortWithinPartitions("shard", "slot").drop("__part").write.partitionBy("shard").parquet(folder)


def balanced_shards(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Shards of near equal bytes of (doc_id, text, lang, source, n_chars): a document has its text's UTF-8 bytes and one more.

    Texts are measured in one pass and travel no further. A null text has size 1 and the crc32 of nothing, 0.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", "lang", "source", "n_chars", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = kd_shards(rows, F.col("size"), ["doc_id", "n_chars", "source", "lang"], shards=shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
