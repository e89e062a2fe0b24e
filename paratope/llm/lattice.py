"""Near-duplicate vectors by lattice hashing: rotated blocks decoded to E8 points, neighbouring cells probed, cosine verified.

A random rotation splits a unit vector into blocks of eight coordinates, one table a block. If two unit vectors have cosine of at
least c, their squared distance is at most 2 - 2c, so in at least one of T blocks it is at most (2 - 2c)/T. In each table a vector
lives in the cell of its nearest E8 point and probes every cell that comes within that radius of it, so such a pair meets in
the first block in which it is that near; there, and only there, it is counted. Nothing is missed and no pair is seen twice.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paratope.llm.common import BASE, Scratch, components, forest, mix64, signed

PAIRS = 1 << 15  # pairs whose vectors are held at once
CHUNK = 2048  # vectors of one cell that a task holds at once on either side


def _shells() -> np.ndarray:
    """E8 vectors of squared length 2 and 4: by definition those with all-integer or all-half-integer coordinates, even sum."""
    out = [v for v in itertools.product((-1, 0, 1), repeat=8) if sum(map(abs, v)) in (2, 4)]
    out += [tuple(s * (2 if j == i else 0) for j in range(8)) for i in range(8) for s in (-1, 1)]
    out += [v for v in itertools.product((-0.5, 0.5), repeat=8) if sum(v) % 2 == 0]
    out += [tuple(x * (3 if j == i else 1) for j, x in enumerate(v)) for v in itertools.product((-0.5, 0.5), repeat=8) for i in range(8) if sum(x * (3 if j == i else 1) for j, x in enumerate(v)) % 2 == 0]
    return np.array(out, dtype=np.float64)


SHELLS = _shells()
_LENGTH = np.sqrt((SHELLS**2).sum(1))


def decode_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row (Conway and Sloane 1982): the better of the nearest points of D8 and of D8 shifted by 1/2."""

    def d8(y):
        z = np.rint(y)
        odd = np.flatnonzero(z.sum(1) % 2 != 0)
        gap = y[odd] - z[odd]
        worst = np.abs(gap).argmax(1)
        z[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
        return z

    a, b = d8(x), d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


def probes(x: np.ndarray, home: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, point) of every lattice cell but the home cell that may come within ``radius`` (under 0.44) of each row.

    A cell is that near only if its bisector with the home cell is; points farther than the second shell are too far away.
    """
    rest = x - home
    far = (_LENGTH**2)[None, :] / 2 - rest @ SHELLS.T
    row, at = np.nonzero(far <= (radius * _LENGTH)[None, :])
    return row, home[row] + SHELLS[at]


def rotation(dim: int, seed: int = 8) -> np.ndarray:
    """A random orthogonal map, after padding to a multiple of eight coordinates."""
    size = -(-dim // 8) * 8
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return (q * np.sign(np.diag(r)))[:dim]


def _cell(table: int, label: np.ndarray, point: np.ndarray) -> np.ndarray:
    key = mix64(label.astype(np.int64).view(np.uint64) ^ np.uint64((table + 1) << 40))
    for c in np.rint(2 * point).astype(np.int64).T:
        key = key * np.uint64(BASE) + c.view(np.uint64)
    return mix64(key)


def _runs(batches, keys: int):
    """Sorted Arrow rows as tables, each of all rows that share their first ``keys`` columns (if there are at least two)."""
    kept = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b] if kept is None else [kept, b]).combine_chunks()
        cols = [np.asarray(t.column(i)) for i in range(keys)]
        new = np.zeros(t.num_rows, dtype=bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = np.concatenate([[0], np.flatnonzero(new)])
        for i, j in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if j - i > 1:
                yield t.slice(i, j - i)
        kept = t.slice(int(starts[-1])).combine_chunks().to_batches()[0]
    if kept is not None and kept.num_rows > 1:
        yield pa.Table.from_batches([kept])


def _floats(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    column = column.combine_chunks()
    width = len(column[0].as_buffer())
    off = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[off[0] : off[-1]].reshape(len(column), width).copy().view(kind)


def _tiles(n: int, m: int):
    """Slices that cut an n by m square into tiles of at most CHUNK on a side."""
    for i in range(0, n, CHUNK):
        for j in range(0, m, CHUNK):
            yield slice(i, min(n, i + CHUNK)), slice(j, min(m, j + CHUNK))


def _squares(rows: DataFrame, load: DataFrame, total: int) -> DataFrame:
    """Rows (cell, home, ...) dealt so that each home of a cell meets each member once, in squares of about CHUNK by CHUNK rows.

    Only cells with at least CHUNK rows and a ten-thousandth of all rows are split; they number at most 10,000 and are broadcast.
    """
    hot = load.where(F.col("n") >= max(CHUNK, total // 10_000)).select("cell", F.ceil(F.col("n") / CHUNK).cast("int").alias("parts"))
    cut = rows.join(F.broadcast(hot), "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    x = cut.where("home").withColumn("q", F.explode(others)).withColumn("p", F.col("part")).withColumn("x", F.lit(True))
    y = cut.withColumn("p", F.explode(others)).withColumn("q", F.col("part")).withColumn("x", F.lit(False))
    keep = ["cell", "p", "q", "x", *[c for c in rows.columns if c != "cell"]]
    return x.select(*keep).unionByName(y.select(*keep)).repartition("cell", "p", "q").sortWithinPartitions("cell", "p", "q")


def lattice_groups(vectors: DataFrame, cosine: float = 0.98, seed: int = 8, scale: float = 3.5) -> DataFrame:
    """Links and components of vectors with equal non-null labels and cosine of at least ``cosine`` in double precision.

    Takes (vec_id, embedding array, label) and returns (vec_id, n_links, component_id, kept), a row for each distinct vec_id.
    A null, empty or zero vector, one with null or non-finite components, and a null label link with nothing. Rows that repeat an
    id count once, as their least (label, embedding); rows with a null id come back with a null component_id and are kept.
    Vectors of different lengths link with nothing. Equal vectors of a label are one class, carried with its size, so copies are
    never paired. Other columns are ignored; an empty table gives no rows. Lattice points are those of E8 divided by ``scale``.

    First each cell's members are compared by the table's block alone, and only vectors that have one that near go on; then
    whole vectors of these meet in the same cells, and a cell yields link counts and a spanning forest, not its pairs.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "lattice")
    doubles = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), doubles.alias("e"))
    named = rows.where("vec_id is not null").groupBy("vec_id").agg(F.min(F.struct("label", "e")).alias("x")).select("vec_id", "x.label", "x.e")
    bad = F.col("e").isNull() | F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | F.col("label").isNull() | ~F.exists("e", lambda x: x != 0)
    named = scratch.table(named.withColumn("ok", ~F.coalesce(bad, F.lit(True))))
    classes = scratch.table(named.where("ok").groupBy("label", "e").agg(F.min("vec_id").alias("cls"), F.count("*").alias("w")))

    def near(dim: int) -> float:
        return float(np.sqrt((2 - 2 * cosine) / -(-dim // 8)) * (1 + 1e-9) + 1e-9)

    def unit(flat: pa.Array):
        """(rows, unit vectors) for each length of vector."""
        at, values = np.asarray(flat.offsets), np.asarray(flat.values)
        sizes = np.diff(at)
        for dim in np.unique(sizes).tolist():
            of = np.flatnonzero(sizes == dim)
            v = values[(at[of][:, None] - at[0] + np.arange(dim)[None, :]).ravel()].reshape(-1, dim)
            v = v / np.abs(v).max(1, keepdims=True)
            yield dim, of, v / np.sqrt((v**2).sum(1, keepdims=True))

    def place(batches):
        for b in batches:
            cls, label = np.asarray(b.column(0)), np.asarray(b.column(1))
            for dim, of, v in unit(b.column(2)):
                turned = v @ rotation(dim, seed)
                radius = near(dim)
                grid = max(1.0, min(scale, 0.43 / radius))
                for t in range(turned.shape[1] // 8):
                    block = turned[:, 8 * t : 8 * t + 8]
                    home = decode_e8(block * grid)
                    row, point = probes(block * grid, home, radius * grid)
                    space = label[of] ^ (dim << 32)
                    own, others = signed(_cell(t, space, home)), signed(_cell(t, space[row], point))
                    # Of two near vectors in different cells, the one whose cell's key is less visits the other.
                    visits = others > own[row]
                    row, others = row[visits], others[visits]
                    small = block.astype(np.float32)
                    r = np.concatenate([np.arange(len(of)), row])
                    yield pa.RecordBatch.from_pydict(
                        {"cell": pa.array(np.concatenate([own, others])), "t": pa.array(np.full(len(r), t, np.int32)), "dim": pa.array(np.full(len(r), dim, np.int32)), "home": pa.array(np.arange(len(r)) < len(of)), "cls": pa.array(cls[of][r]), "v": pa.array([x.tobytes() for x in small[r]], pa.binary())}
                    )

    placed = scratch.table(classes.select("cls", "label", "e").mapInArrow(place, "cell long, t int, dim int, home boolean, cls long, v binary"))

    def sift(batches):
        for t in _runs(batches, 3):
            x = np.asarray(t.column("x"))
            if not x.any():
                continue
            v, cls = _floats(t.column("v"), np.float32), np.asarray(t.column("cls"))
            a, b = v[x], v[~x]
            reach = (near(t.column("dim")[0].as_py()) + 1e-5) ** 2
            keep = np.zeros(len(x), dtype=bool)
            for m, n in _tiles(len(a), len(b)):
                close = ((a[m] ** 2).sum(1)[:, None] + (b[n] ** 2).sum(1)[None, :] - 2 * (a[m] @ b[n].T) <= reach + 1e-6) & (cls[x][m, None] != cls[~x][None, n])
                keep[np.flatnonzero(x)[m][close.any(1)]] = True
                keep[np.flatnonzero(~x)[n][close.any(0)]] = True
            if keep.any():
                yield t.filter(pa.array(keep)).select(["cell", "t", "home", "cls"]).combine_chunks().to_batches()[0]

    size = placed.count()
    load = placed.groupBy("cell").agg(F.count("*").alias("n"))
    close = scratch.table(_squares(placed, load, size).mapInArrow(sift, "cell long, t int, home boolean, cls long").distinct())
    scratch.drop(placed)

    def verify(batches):
        for t in _runs(batches, 3):
            x = np.asarray(t.column("x"))
            if not x.any():
                continue
            table = t.column("t")[0].as_py()
            cls, home, w = np.asarray(t.column("cls")), np.asarray(t.column("home")), np.asarray(t.column("w"))
            _, _, v = next(unit(t.column("e").combine_chunks()))
            a, b = v[x], v[~x]
            turned = v @ rotation(v.shape[1], seed)
            ours, theirs = turned[x], turned[~x]
            for m, n in _tiles(len(a), len(b)):
                i, j = np.nonzero((a[m] @ b[n].T >= cosine) & (cls[x][m, None] != cls[~x][None, n]))
                if not len(i):
                    continue
                i, j = i + m.start, j + n.start
                first = np.zeros(len(i), dtype=bool)
                for k in range(0, len(i), PAIRS):  # a few pairs at a time: each takes two whole vectors
                    gap = ours[i[k : k + PAIRS]] - theirs[j[k : k + PAIRS]]
                    blocks = (gap.reshape(len(gap), -1, 8) ** 2).sum(2) <= near(v.shape[1]) ** 2
                    first[k : k + PAIRS] = blocks.any(1) & (blocks.argmax(1) == table)
                i, j = i[first], j[first]
                if not len(i):
                    continue
                p, q, visitor = cls[x][i], cls[~x][j], ~home[~x][j]
                own, at = np.unique(np.concatenate([p, q[visitor]]), return_inverse=True)
                total = np.bincount(at, weights=np.concatenate([w[~x][j], w[x][i][visitor]])).astype(np.int64)
                low, high = forest(p, q)
                yield pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate([own, low])), "b": pa.array(np.concatenate([own, high])), "w": pa.array(np.concatenate([total, np.zeros(len(low), np.int64)]))})

    again = close.groupBy("cell").agg(F.count("*").alias("n"))
    full = _squares(close, again, size).join(classes.select("cls", "e", "w"), "cls").select("cell", "p", "q", "x", "t", "home", "cls", "w", "e")
    full = full.repartition("cell", "p", "q").sortWithinPartitions("cell", "p", "q")
    found = scratch.table(full.mapInArrow(verify, "a long, b long, w long"))
    links = found.where("a = b").groupBy("a").agg(F.sum("w").alias("others"))
    known = components(found.where("a <> b").select("a", "b"), scratch)
    per_class = classes.join(links.withColumnRenamed("a", "cls"), "cls", "left").join(known.withColumnRenamed("node", "cls"), "cls", "left")
    per_class = per_class.select("label", "e", "w", "cls", (F.coalesce("others", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "cls").alias("component_id"))
    single = per_class.where("w = 1").select(F.col("cls").alias("vec_id"), "n_links", "component_id")
    # Members of classes of copies: joined by a hash, then by the vector itself.
    copied = scratch.table(per_class.where("w > 1").withColumn("h", F.xxhash64("label", "e")).select("h", F.col("label").alias("l2"), F.col("e").alias("e2"), "w", "n_links", "component_id"))
    hot = copied.groupBy("h").agg(F.sum("w").alias("n")).where(F.col("n") >= max(1000, named.count() // 10_000)).select("h")
    members = named.where("ok").select("vec_id", F.xxhash64("label", "e").alias("h"), "label", "e")
    same = (F.col("label") == F.col("l2")) & (F.col("e") == F.col("e2"))
    many = members.join(F.broadcast(copied.join(F.broadcast(hot), "h", "left_semi")), "h").where(same)
    many = many.unionByName(members.join(F.broadcast(hot), "h", "left_anti").join(copied.join(F.broadcast(hot), "h", "left_anti"), "h").where(same))
    alone = named.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    result = single.unionByName(many.select("vec_id", "n_links", "component_id")).unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
    nameless = vectors.where("vec_id is null").select(F.col("vec_id").cast("long"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    return result.select(F.col("vec_id").cast("long"), "n_links", "component_id", "kept").unionByName(nameless)
