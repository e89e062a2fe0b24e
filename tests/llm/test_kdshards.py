"""K-d sharding: balance, whole results and slots, on hot values, copies, nulls and repeated rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from paratope.llm import kdshards

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, row int, key string"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    out = []
    for i in range(3000):
        text = None if i % 97 == 0 else "é" * rng.randint(0, 200) if i % 3 else "the same text"
        out.append((i, text, rng.choice(["en", "de", None]), "hot" if i % 3 == 0 else f"s{rng.randint(0, 9)}", len(text or ""), "x", 1, "k"))
    out += [out[5]] * 900 + [(None, "no id", None, None, None, "x", 1, "k")] * 30
    return spark.createDataFrame(out, SCHEMA).repartition(5)


def shards_of(df):
    by = defaultdict(list)
    for r in df.collect():
        by[r.shard].append(r)
    return by


@pytest.mark.parametrize("n", [1, 2, 7, 16])
def test_shards_are_whole_and_near_equal(docs, n):
    by = shards_of(kdshards.balanced_shards(docs, n))
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1) for r in docs.collect())
    assert Counter((r.doc_id, r.size) for x in by.values() for r in x) == want
    assert set(by) == set(range(n))
    sizes = [sum(r.size for r in x) for x in by.values()]
    largest = max(r.size for x in by.values() for r in x)
    assert max(sizes) - min(sizes) <= 2 * largest * max(1, n.bit_length() - 1)
    for x in by.values():
        assert sorted(r.slot for r in x) == list(range(len(x)))
        assert all(r.law == "bytes" and r.grown_shard is None for r in x)


def test_checksums(docs):
    import zlib

    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in kdshards.balanced_shards(docs, 4).collect())


def test_first_cut_is_the_weighted_median_of_the_widest_dimension(spark):
    rng = np.random.default_rng(2)
    x, y, w = rng.normal(size=500), rng.integers(0, 3, 500), rng.integers(1, 50, 500)
    df = spark.createDataFrame([(float(a), int(b), int(c)) for a, b, c in zip(x, y, w)], "x double, y int, w long").repartition(4)
    by = shards_of(kdshards.kd_shards(df, F.col("w"), ["x", "y"], shards=2, slack=0.0))
    order = np.argsort(x)
    run = np.cumsum(w[order])
    cut = int(np.argmin(np.abs(run - run[-1] / 2)))
    assert sorted(r.x for r in by[0]) == sorted(x[order[: cut + 1]].tolist())


def test_target_bytes_and_large_rows(spark):
    df = spark.createDataFrame([(i, 1000 if i == 3 else 10) for i in range(100)], "id long, w long")
    by = shards_of(kdshards.kd_shards(df, F.col("w"), ["id"], target_bytes=250))
    assert max(by) < 8 and sum(len(x) for x in by.values()) == 100
    assert sorted(sum(r.w for r in x if r.id != 3) for x in by.values())[-1] <= 1250


def test_many_shards_and_parts_of_slots(spark, docs, monkeypatch):
    monkeypatch.setattr(kdshards, "SLOT_ROWS", 100)
    by = shards_of(kdshards.kd_shards(docs, F.octet_length("text"), ["doc_id", "lang"], shards=3))
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
    few = shards_of(kdshards.kd_shards(docs.where("doc_id < 5"), F.octet_length("text"), ["doc_id"], shards=40))
    assert sum(map(len, few.values())) == 5 and max(few) < 40


def test_empty_and_files(spark, docs, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert kdshards.balanced_shards(none, 16).collect() == []
    assert kdshards.kd_shards(none, F.octet_length("text"), ["doc_id"], target_bytes=100).collect() == []
    kdshards.write_shards(kdshards.kd_shards(docs, F.octet_length("text"), ["doc_id", "source"], shards=4), str(tmp_path / "out"), rows_a_file=300)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 4
