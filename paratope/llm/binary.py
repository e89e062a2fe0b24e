"""Token-id files: flat unsigned integers with 64-bit document offsets, written in shards and read by memory map."""

from __future__ import annotations

import json
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paratope.llm.bpe import coder, encoded
from paratope.llm.common import shuffle_partitions

#: Layout of a shard: NAME.bin has the ids; NAME.idx has the number of documents n, n + 1 offsets (in ids, from the shard's
#: start), n document ids and n bytes that are 1 where the id is null; all little-endian, the first three kinds 64 bits wide.
MANIFEST = "manifest.json"
SHARD_BYTES = 256 << 20  # of text in a shard, about


def _files(folder: str) -> tuple[pafs.FileSystem, str]:
    fs, path = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    return fs, path


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int = 2, width: int | None = None) -> dict:
    """Write the ids of all documents of (doc_id, text), each followed by ``end_id``, in ascending doc_id order.

    ``width`` is the bytes an id takes (2 or 4; by default the least that the vocabulary needs). Documents are dealt to shards by
    ranges of (doc_id, row), so that an id which many rows share doesn't end in one task; null ids come first, rows of one id
    stay in the order of the input's partitions. Each shard is written under an attempt's own name and then renamed, so a retried or doubled task leaves one
    whole shard. A shard has about SHARD_BYTES of text, and there are as many as shuffle partitions at least; what a task holds is 17
    bytes a document. Shards count from 0; the place of a shard's first id follows from the sizes of those before it, as prefix sums
    over the shards in the manifest. A null text is the empty text: ``end_id`` alone.
    """
    spark = docs.sparkSession
    fs, root = _files(folder)
    fs.create_dir(root, recursive=True)
    width = width or (2 if coder(path).tok.get_vocab_size() <= 1 << 16 else 4)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(shuffle_partitions(spark), -(-size // SHARD_BYTES))
    ordered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")).repartitionByRange(shards, "doc_id", "row").sortWithinPartitions("doc_id", "row")

    def run(batches):
        end = np.array([end_id], dtype="<u4").tobytes()
        own, target = _files(folder)
        task = TaskContext.get()
        shard, attempt = task.partitionId(), task.taskAttemptId()
        name = f"{target}/shard-{shard:05d}"
        offsets, ids, null = array("q", [0]), array("q"), bytearray()
        with own.open_output_stream(f"{name}.bin.{attempt}") as out:
            for b in batches:
                for doc, (encoding, _) in zip(b.column(0).to_pylist(), encoded(b.column(1), path), strict=True):
                    x = np.frombuffer(encoding + end, dtype="<u4")
                    out.write(x.astype(f"<u{width}").tobytes())
                    offsets.append(offsets[-1] + len(x))
                    ids.append(doc or 0)
                    null.append(doc is None)
        with own.open_output_stream(f"{name}.idx.{attempt}") as out:
            for part in (array("q", [len(ids)]), offsets, ids):
                out.write(np.frombuffer(part, dtype="i8").astype("<i8").tobytes())
            out.write(bytes(null))
        for kind in ("bin", "idx"):
            own.move(f"{name}.{kind}.{attempt}", f"{name}.{kind}")
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "docs": pa.array([len(ids)], pa.int64()), "tokens": pa.array([int(offsets[-1])], pa.int64())})

    made = sorted(map(tuple, ordered.select("doc_id", "text").mapInArrow(run, "shard long, docs long, tokens long").collect()))
    bases = np.concatenate([[0], np.cumsum([t for _, _, t in made])]).astype(int).tolist()
    manifest = {"width": width, "tokens": bases[-1], "shards": [{"name": f"shard-{s:05d}", "docs": d, "tokens": t, "base": base} for (s, d, t), base in zip(made, bases, strict=False)]}
    with fs.open_output_stream(f"{root}/{MANIFEST}") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


class Shard:
    """A shard opened for reading. Local files are memory-mapped, so only the pages that are touched are read; elsewhere the ids of the
    documents asked for are read, and the index as a whole."""

    def __init__(self, folder: str, name: str, width: int) -> None:
        fs, root = _files(folder)
        self.width = width
        if isinstance(fs, pafs.LocalFileSystem):
            self.file, idx = pa.memory_map(f"{root}/{name}.bin"), pa.memory_map(f"{root}/{name}.idx").read_buffer()
        else:
            self.file, idx = fs.open_input_file(f"{root}/{name}.bin"), fs.open_input_file(f"{root}/{name}.idx").read_buffer()
        n = int(np.frombuffer(idx, dtype="<i8", count=1)[0])
        self.offsets = np.frombuffer(idx, dtype="<i8", count=n + 1, offset=8)
        self.docs = np.frombuffer(idx, dtype="<i8", count=n, offset=8 * (n + 2))
        self.null = np.frombuffer(idx, dtype="u1", count=n, offset=8 * (2 * n + 2)).astype(bool)

    def __len__(self) -> int:
        return len(self.docs)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.block(i, i + 1)

    def block(self, lo: int, hi: int) -> np.ndarray:
        """The ids of documents lo to hi, one after another; a view of the mapped file where there is one."""
        start, end = int(self.offsets[lo]), int(self.offsets[hi])
        if start == end:
            return np.zeros(0, dtype=f"<u{self.width}")
        self.file.seek(start * self.width)
        return np.frombuffer(self.file.read_buffer((end - start) * self.width), dtype=f"<u{self.width}")


def read_manifest(folder: str) -> dict:
    fs, root = _files(folder)
    with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
        return json.loads(f.read())


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files: ``start`` counts the ids of all documents before it,
    the crc32 is over the ids as little-endian unsigned 32-bit integers. An empty folder of shards gives no rows."""
    manifest = read_manifest(folder)
    width = manifest["width"]
    shards = spark.createDataFrame([(s["name"], s["base"]) for s in manifest["shards"]], "name string, base long").repartition(max(1, len(manifest["shards"])))

    def run(batches):
        for b in batches:
            for name, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = Shard(folder, name, width)
                for lo in range(0, len(s), 1024):
                    hi = min(len(s), lo + 1024)
                    ids, at = s.block(lo, hi), s.offsets[lo : hi + 1] - s.offsets[lo]
                    crc = [zlib.crc32(ids[i:j].astype("<u4").tobytes()) for i, j in zip(at[:-1], at[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s.docs[lo:hi], pa.int64(), mask=s.null[lo:hi]), pa.array(s.offsets[lo:hi] + base, pa.int64()), pa.array(np.diff(s.offsets[lo : hi + 1]), pa.int64()), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
