"""Each corpus operator against brute force on small tables with nulls, empty texts, copies, repeated ids and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paratope.llm import binary, bpe, langid, lattice, njoin, packing, simhash, suffixes, suffixtree, units
from paratope.llm.common import Scratch, components, join_hot

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, key string, start int, row string"


def vocabulary(seed, n=300):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng, words = random.Random(3), vocabulary(1)
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    line, passage = prose(7), prose(60)
    out = [prose(rng.randint(20, 150)) for _ in range(60)]
    base = prose(120).split()
    for _ in range(20):  # near copies
        w = list(base)
        for _ in range(rng.randint(1, 12)):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append(" ".join(w))
    out += [out[0]] * 5 + [out[1].upper()]  # copies
    out += [f"{prose(30)}\n{line}\n{prose(20)}" for _ in range(8)]
    out += [f"{prose(25)}\n{passage}\n{prose(15)}" for _ in range(5)]
    out += [None, "", "  \n\t ", "a", "a b", "A  B", "é ü ß " * 10, "x" * 3000, " ".join(["again"] * 200)]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "aa" if i % 2 else "bb", "k", 1, "r") for i, t in enumerate(texts)]
    rows += [(0, texts[0], "aa", "k", 1, "r"), (None, texts[2], None, "k", 1, "r"), (None, None, None, "k", 1, "r"), (7, "another text under the same id here", "aa", "k", 1, "r")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(t, k=5):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def linked(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return [find(i) for i in range(n)]


def test_components_and_hot_join(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (3, 30), (5, 5)], "a long, b long")
    assert {(r.node, r.component) for r in components(links, Scratch(spark, "t")).collect()} == {(2, 1), (3, 1), (30, 1), (8, 7), (9, 7)}
    left = spark.createDataFrame([(1, i) for i in range(2000)] + [(2, 0), (3, 0)], "k long, v long")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k long, x string")
    out = join_hot(left, right, "k", left.groupBy("k").agg(F.count("*").alias("n")), 2002).collect()
    assert Counter(r.x for r in out) == {"a": 2000, "b": 1, None: 1}


@pytest.mark.parametrize("least, crowd, part", [(njoin.LEAST, njoin.CROWD, njoin.PART), (2, 2, 5)])
def test_ngram_join(docs, none, monkeypatch, least, crowd, part):
    # With the small limits, pairs of frequent shingles carry the near copies, and groups are compared in many parts.
    for name, value in (("LEAST", least), ("CROWD", crowd), ("PART", part)):
        monkeypatch.setattr(njoin, name, value)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    s = [shingles(t) for _, t in rows]
    links = [(i, j) for i in range(len(s)) for j in range(i) if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j])]
    root, least_id = linked(len(s), links), {}
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            least_id[r] = min(least_id.get(r, 10**9), rows[i][0])
    want = Counter((d, len(s[i]), least_id.get(root[i], d)) for i, (d, _) in enumerate(rows))
    assert Counter(map(tuple, njoin.jaccard_groups(docs).collect())) == want
    assert njoin.jaccard_groups(none).count() == 0


def test_crowded_groups_lose_no_pair():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 1 << 63, 40).astype(np.uint64) << np.uint64(1)) for _ in range(8)]
    sets += [np.unique(np.concatenate([s[:-4], rng.integers(0, 1 << 63, 4).astype(np.uint64)])) for s in sets]
    sets.sort(key=len)
    hists, n = np.array([njoin.histogram(s) for s in sets], dtype=object), np.array([len(s) for s in sets])
    found = {tuple(sorted((int(a), int(b)))) for x, y in njoin._close_pairs(hists, n, np.arange(len(sets)), 75, 100) for a, b in zip(x, y, strict=True)}
    want = {(i, j) for j in range(len(sets)) for i in range(j) if 4 * len(np.intersect1d(sets[i], sets[j])) >= 3 * len(np.union1d(sets[i], sets[j]))}
    assert want and want <= found


def test_one_of_each(docs, none):
    kept = njoin.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[0] == 1 and 80 not in ids and ids[None] == 2 and ids[7] == 2
    assert njoin.one_of_each(none).count() == 0


def test_lattice(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 20))
    x[40:80] = x[0] + rng.normal(size=(40, 20)) * 0.12
    x[80:90] = x[3]
    rows = [(i, [float(v) for v in x[i]], i % 2) for i in range(120)]
    rows += [(200, None, 0), (201, [0.0] * 20, 0), (202, [1.0, None], 0), (203, [float("nan")] * 20, 0), (204, rows[3][1], None), (205, [float("inf")] * 20, 1), (None, rows[3][1], 1), (3, rows[3][1], 1), (206, [], 1), (207, [1.0], 1), (208, [2.0], 1)]
    got = {r.vec_id: r for r in lattice.lattice_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("cls", F.lit("clash")), 0.95).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = [(i, j) for i in range(120) for j in range(i) if i % 2 == j % 2 and u[i] @ u[j] >= 0.95]
    root, n = linked(120, links), Counter(k for p in links for k in p)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (n[i], root[i], root[i] == i) for i in range(120)) and len(links) > 100
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in (200, 201, 202, 203, 204, 205, 206))
    assert (got[208].n_links, got[208].component_id) == (1, 207) and got[None].component_id is None and len(got) == 130
    assert lattice.lattice_groups(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_e8_points():
    x = np.random.default_rng(2).normal(size=(200, 8))
    p = lattice.decode_e8(x)
    assert ((np.rint(2 * p) == 2 * p).all(1)).all() and (p.sum(1) % 2 == 0).all() and len(lattice.SHELLS) == 240 + 2160
    d = ((x[:, None, :] - p[:, None, :] - lattice.SHELLS[None]) ** 2).sum(2).min(1)
    assert (((x - p) ** 2).sum(1) <= d + 1e-9).all()


def test_suffix_array(docs, none, texts):
    spans = suffixes.repeated_passages(docs, min_words=50).collect()
    have = defaultdict(list)
    for r in spans:
        have[r.doc_id].append((r.start, r.end))
    assert all(e - s >= 50 for v in have.values() for s, e in v)
    passage = [i for i, t in enumerate(texts) if t and t.count("\n") == 2 and len(t.split("\n")[1].split()) == 60]
    for i in passage:
        lo = len(texts[i].split("\n")[0].split())
        assert any(s <= lo and e >= lo + 60 for s, e in have[i])
    assert not any(i in have for i in range(5, 60) if i not in (0, 1, 2, 7)) and 100 not in have
    assert suffixes.repeated_passages(none).count() == 0


@pytest.mark.parametrize("crowd", [20_000, 5])
def test_suffix_array_is_exact(spark, monkeypatch, crowd):
    """Spans, first copies and smallest partners equal brute force where boilerplate follows heads that few documents share."""
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    rng, words = random.Random(4), vocabulary(8, 3000)
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = []
    for size in (32, 40, 49, 50, 60):
        hot, heads = prose(size), [prose(22) for _ in range(12)]
        texts += [f"{prose(rng.randint(0, 9))} {h} {hot} {prose(rng.randint(0, 9))}" for h in heads * 2]
        texts += [f"{prose(30)} {hot} {prose(30)}" for _ in range(40)]
    texts += [texts[3] + " " + prose(5) + " " + texts[3], "again " * 80]
    rng.shuffle(texts)
    grams = defaultdict(list)
    for d, t in enumerate(texts):
        w = t.split()
        for i in range(len(w) - 49):
            grams[tuple(w[i : i + 50])].append((d, i))
    spans = defaultdict(list)
    for at in grams.values():
        for d, i in at if len(at) > 1 else ():
            spans[d].append((i, min(x[0] for x in at if x != (d, i)), (d, i) > min(at)))
    want = set()
    for d, found in spans.items():
        islands = []
        for i, other, later in sorted(found):
            if islands and i <= islands[-1][1]:
                a, _, o, n = islands.pop()
                islands.append((a, i + 50, min(o, other), n or later))
            else:
                islands.append((i, i + 50, other, later))
        want |= {(d, a, b, o, not n) for a, b, o, n in islands}
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = suffixes.repeated_passages(frame, min_words=50).collect()
    assert {(r.doc_id, r.start, r.end, r.other_doc_id, r.is_first) for r in got} == want and len(got) == len(want)


def test_units(docs, none, texts):
    removed = units.repeated_units(docs, units.LINE, 5)
    seen, want = {}, set()
    keyed = sorted(((r.doc_id if r.doc_id is not None else -1, r.h, r.text) for r in docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect() if r.text))
    for i, h, t in keyed:
        for u, line in enumerate(t.split("\n")):
            w = tuple(line.encode().lower().split())
            if len(w) >= 5:
                first = seen.setdefault(w, (i, h, u))
                if first != (i, h, u):
                    want.add((i, u, first[0], first[2]))
    assert {(-1 if r.doc_id is None else r.doc_id, r.unit, -1 if r.first_doc_id is None else r.first_doc_id, r.first_unit) for r in removed.collect()} == want
    clash = docs.withColumns({"kept_at": F.lit("clash"), "__cuts": F.lit(1), "__hash": F.lit(2)})
    cut = units.without_units(clash, removed, units.LINE)
    assert cut.columns == [*docs.columns, "__cuts", "__hash", "kept_at"] and cut.count() == docs.count()
    lines = Counter(tuple(line.encode().lower().split()) for r in cut.select("doc_id", "text").distinct().collect() if r.text for line in r.text.split("\n"))
    assert all(n == 1 for w, n in lines.items() if len(w) >= 5)
    for r in cut.collect():
        original = [t for i, _, t in keyed if i == r.doc_id]
        if r.text and len(original) == 1:
            assert all(original[0][a : a + 3] in r.text for a in r.kept_at)
    assert units.repeated_units(none).count() == 0 and units.without_units(none, units.repeated_units(none)).count() == 0


def test_repeated_passages(docs, none):
    rows = sorted({(r.doc_id if r.doc_id is not None else -1, r.h, r.text) for r in docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect() if r.text})
    lines = [(i, h, [(u, tuple(x.encode().lower().split())) for u, x in enumerate(t.split("\n"))]) for i, h, t in rows]
    count, first = Counter(), {}
    for r in docs.collect():
        count.update(w for x in (r.text or "").split("\n") if (w := tuple(x.encode().lower().split())))
    for i, h, ls in lines:
        for u, w in ls:
            first.setdefault(w, (i, h, u))
    want = Counter()
    for i, h, ls in lines:
        run = []
        for u, w in [*((u, w) for u, w in ls if w), (None, ())]:
            if w and count[w] > 1:
                run.append((u, w))
                continue
            n = sum(len(x) for _, x in run)
            want.update((i, v, len(x), n, first[x][0], first[x][2], first[x] != (i, h, v)) for v, x in run if n >= 20)
            run = []
    got = units.repeated_passages(docs, units.LINE, 20).collect()
    one = lambda x: -1 if x is None else x
    assert Counter((one(r.doc_id), r.unit, r.words, r.run_words, one(r.first_doc_id), r.first_unit, r.removed) for r in got) == want and len(want) > 10
    assert units.repeated_passages(none).count() == 0


def test_unit_sql(spark):
    import duckdb

    from paratope.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = queries.QUERIES["op5_unit_hash"](spark, sf)
    want = con.execute(queries.ORACLES["op5_unit_hash"])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert Counter(tuple(r[n] for n in names) for r in got.collect()) == Counter(want.fetchall())


def test_streams_of_keys():
    """Groups are told and neighbours compared alike however the rows are cut into batches."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        rows = sorted((int(a), int(b), 1) for a, b in rng.integers(0, [6, 4], size=(rng.integers(0, 30), 2)))
        cuts = sorted(rng.integers(0, len(rows) + 1, 4).tolist())
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        frames = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in p], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32()))], names=["sig", "cls", "n"]) for p in parts]
        got = [tuple(r.values()) for t in njoin.shared_keys(frames) for r in t.to_pylist()]
        by = defaultdict(set)
        for s, c, _ in rows:
            by[s].add(c)
        assert sorted(got) == sorted((s, c, 1, min(v)) for s, v in by.items() if len(v) > 1 for c in v)
        pairs = set()
        for (sig, cls, _), begin in njoin.neighbours(frames, 3):
            for shift in (1, 2, 3):
                for i in range(max(0, begin - shift), len(sig) - shift):
                    if sig[i] == sig[i + shift]:
                        pairs.add((int(sig[i]), int(cls[i]), int(cls[i + shift])))
        assert pairs == {(rows[i][0], rows[i][1], rows[j][1]) for j in range(len(rows)) for i in range(max(0, j - 3), j) if rows[i][0] == rows[j][0]}


def test_language(spark, none):
    rng = random.Random(5)
    mine = {"aa": vocabulary(11, 200), "bb": [w.translate(str.maketrans("abcdefghijklmnop", "qrstuvwxyzàéüßñç")) for w in vocabulary(12, 200)]}
    rows = [(i, " ".join(rng.choice(mine[k]) for _ in range(rng.randint(5, 60))), k) for i, k in enumerate(["aa", "bb"] * 90)]
    rows += [(500, None, "aa"), (501, "", None), (502, "123 --- 4", "bb"), (None, rows[0][1], "aa"), (503, "€ ßß 世界 Ω", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    models = langid.fit(frame, ~langid.held_out())
    got = {r.doc_id: r for r in langid.identify(frame, models).collect()}
    held = [(i, k) for i, _, k in rows[:180] if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(got[i].lang_pred == k for i, k in held) >= 0.98 * len(held) and not any(got[i].rejected for i, _ in held)
    assert all(got[i].lang_pred == "und" and got[i].rejected and got[i].score == 0 for i in (500, 501, 502)) and got[503].lang_pred in ("aa", "bb")
    assert all(0 <= r.score <= 1 for r in got.values()) and langid.accepted(frame, models).count() == sum(not r.rejected for r in langid.identify(frame, models).collect())
    assert langid.identify(none, langid.fit(none, F.lit(True))).count() == 0
    untaught = langid.identify(frame, langid.fit(frame.where("false"), F.lit(True))).first()
    assert untaught.lang_pred == "und" and untaught.rejected


def test_language_models_are_distributions():
    m = langid.train({"aa": {"abc": 3, "abd": 1, "b": 2}, "bb": {"cab": 2, "dd": 5}}, 3)
    letters = "abcd"
    for prefix in ("", "a", "ab", "dd"):
        for j in range(2):
            p = 0.0
            for c in (*letters, "\x03"):
                whole = m.word_bits([prefix + c])[0, j] if c != "\x03" else m.word_bits([prefix])[0, j]
                codes, place, _ = langid._symbols([prefix + c] if c != "\x03" else [prefix])
                del codes, place
                front = _front(m, prefix, j)
                p += 2 ** -(_front(m, prefix + c, j) - front) if c != "\x03" else 2 ** -(whole - front)
            assert p == pytest.approx(1 - _unknown(m, prefix, j), abs=1e-5)


def _front(m, prefix, j):
    """Bits of a prefix without the word's end."""
    probe = m.word_bits([prefix + "a"])[0, j]
    codes, place, of = langid._symbols([prefix + "a"])
    h = langid._hashes(codes, m.order)
    total = 0.0
    for i in np.flatnonzero(place > 0)[: len(prefix)]:
        p = m.floor
        for n in range(1, min(m.order, place[i] + 1) + 1):
            keys, weights = m.contexts[n - 1]
            k = np.searchsorted(keys, h[n - 1][i - 1])
            if k == len(keys) or keys[k] != h[n - 1][i - 1]:
                continue
            g, parts = m.grams[n - 1]
            q = np.searchsorted(g, h[n][i])
            p = p * weights[k, j] + (parts[q, j] if q < len(g) and g[q] == h[n][i] else 0)
        total -= math.log2(p)
    del probe, of
    return total


def _unknown(m, prefix, j):
    """What the models leave for letters they don't know: the floor through all the contexts' weights."""
    codes, place, _ = langid._symbols([prefix + "\x7f"])
    h = langid._hashes(codes, m.order)
    i = len(prefix) + 1
    p = m.floor
    for n in range(1, min(m.order, place[i] + 1) + 1):
        keys, weights = m.contexts[n - 1]
        k = np.searchsorted(keys, h[n - 1][i - 1])
        if k < len(keys) and keys[k] == h[n - 1][i - 1]:
            p *= weights[k, j]
    return p


NASTY = ["a", "b", "the", "THE", "'s", "'re", "'", "!", "é", "é", "Σ", "ς", "日本語", "1", "23", " ", "  ", "\n", "\t", "\x1c", " ", "​", "　", "<|endoftext|>", "😀", "İ", "-", "_"]


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("leaf", [40, 4096])
def test_encoding_is_the_librarys(path, leaf):
    rng, tok, coder = random.Random(9), Tokenizer.from_file(path), bpe.Coder(path, leaf=leaf, memo=500)
    dense = [x for x in NASTY if not x.isspace()]
    cases = ["".join(rng.choice(NASTY) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    cases += ["".join(rng.choice(dense) for _ in range(rng.randint(50, 1500))) for _ in range(30)] + ["a" * 3000, "!" * 2000, "lower" * 900, " " * 500, "'s" * 700]
    for t in cases:
        want = tok.encode(t, add_special_tokens=False).ids
        ids, decimal = next(coder.encode_many([t], True))
        assert np.frombuffer(ids, "<u4").tolist() == want and decimal[:-1] == ",".join(map(str, want)).encode()
        if path == BYTE:
            assert coder.decode(ids) == tok.decode(want, skip_special_tokens=False)


def test_digests(docs, none):
    tok = Tokenizer.from_file(BYTE)
    want = Counter()
    for r in docs.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.digests(docs, BYTE).collect())) == want
    assert {r.decoded for r in bpe.encode_decode(docs, BYTE).collect()} == {r.text or "" for r in docs.collect()}
    assert bpe.digests(none, BYTE).count() == 0


def ids_of(tok, text, end):
    return [*tok.encode(text or "", add_special_tokens=False).ids, end]


def test_packing(docs, none):
    tok = Tokenizer.from_file(WORD)
    got = packing.pack(docs, WORD, 1, 256, group=40).collect()
    want = Counter()
    for r in docs.collect():
        ids = ids_of(tok, r.text, 1)
        for s in range(0, len(ids), 256):
            part = np.array(ids[s : s + 256], "<u4")
            want[r.doc_id, s, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    assert sum(r.length for r in got) / (256 * len(by)) > 0.8
    assert packing.pack(none, WORD).count() == 0


def test_first_fit_decreasing():
    lengths = np.random.default_rng(4).integers(1, 100, 300)
    bins, _ = packing.first_fit_decreasing(lengths, 100)
    free: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):
        k = next((k for k, f in enumerate(free) if f >= lengths[i]), len(free))
        if k == len(free):
            free.append(100)
        free[k] -= lengths[i]
        assert bins[i] == k


def test_token_files(docs, none, spark, tmp_path):
    tok = Tokenizer.from_file(WORD)
    binary.write_tokens(docs, f"file://{tmp_path}/a", WORD, 2)
    got = sorted(map(tuple, binary.read_tokens(spark, f"file://{tmp_path}/a").collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r[0] for r in got), key=lambda i: (i is not None, i or 0))
    assert [r[1] for r in got] == list(np.cumsum([0, *(r[2] for r in got)])[:-1])
    want = Counter((r.doc_id, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for r in docs.collect() for x in [ids_of(tok, r.text, 2)])
    assert Counter((r[0], r[2], r[3]) for r in got) == want
    manifest = binary.read_manifest(f"file://{tmp_path}/a")
    assert manifest["width"] == 2 and manifest["tokens"] == sum(r[2] for r in got)
    binary.write_tokens(none, str(tmp_path / "b"), WORD, 2)
    assert binary.read_tokens(spark, str(tmp_path / "b")).count() == 0


def test_simhash(docs, none, spark):
    got = simhash.edited_fingerprints(docs.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()
    rows = sorted((r.doc_id, r.text or "") for r in docs.where("doc_id is not null").dropDuplicates(["doc_id"]).collect())
    by = {r.doc_id: r for r in got}
    for k, (i, t) in enumerate(rows):
        j, n = rows[(k + 1) % len(rows)]
        half = len(t) // 2
        r = by[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256((t[: len(t) - half] + n[:half]).encode()).hexdigest()
        assert r.near_next == 1 - (int(r.fingerprint, 16) ^ int(by[j].fingerprint, 16)).bit_count() / 64
        assert r.near_edited == 1 - (int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)).bit_count() / 64
    same = defaultdict(set)
    for i, t in rows:
        same[t].add(by[i].fingerprint)
    assert all(len(v) == 1 for v in same.values())
    assert simhash.edited_fingerprints(docs).count() == docs.count() and simhash.edited_fingerprints(none).count() == 0
    one = simhash.edited_fingerprints(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).first()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()


def test_fingerprint_votes(spark):
    text = "one two three four five six seven two three"
    row = spark.createDataFrame([(text,)], "text string").select(simhash.terms(F.col("text"), 2).alias("t")).first()
    assert len(row.t) == 8
    bits = [sum((h >> k) & 1 for h in row.t) * 2 > 8 for k in range(64)]
    got = simhash.fingerprints(spark.createDataFrame([(1, text)], "i int, text string"), ["i"], 2).first().fingerprint
    assert got & (2**64 - 1) == sum(1 << k for k, b in enumerate(bits) if b)


def test_radius_search(spark):
    rng = random.Random(8)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in list(prints[:20]):
        for d in range(1, 6):
            q = p
            for k in rng.sample(range(64), d):
                q ^= 1 << k
            prints.append(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in [*signed, signed[0], None]], "fingerprint long")
    want = {(min(a, b), max(a, b), ((a ^ b) & (2**64 - 1)).bit_count()) for i, a in enumerate(signed) for b in signed[:i] if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    got = [tuple(r) for r in simhash.within_radius(frame, 3).collect()]
    assert set(got) == want and len(got) == len(want) > 40


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_suffix_array_keeps_rows_of_one_id_apart(spark, monkeypatch, crowd):
    """Spans of rows that share an id are not joined; null ids and rows that repeat id and text are defined."""
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    rng, words = random.Random(9), vocabulary(5, 3000)
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    a, b, c, d = (prose(60) for _ in range(4))
    rows = [(1, f"{prose(40)} {a}"), (1, f"{prose(50)} {b}"), (2, f"{a} {prose(9)}"), (3, f"{b} {prose(9)}"), (None, f"{c} {prose(5)}"), (None, f"{prose(7)} {c}"), (4, d), (4, d)]
    got = sorted((r.doc_id or -1, r.start, r.end, r.n_words, r.other_doc_id or -1, r.is_first) for r in suffixes.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    spans = sorted((i, s, e) for i, s, e, *_ in got)
    assert spans == [(-1, 0, 60), (-1, 7, 67), (1, 40, 100), (1, 50, 110), (2, 0, 60), (3, 0, 60), (4, 0, 60)]
    assert all(n == 60 for _, _, _, n, _, _ in got)
    assert {(i, o) for i, _, _, _, o, _ in got} == {(-1, -1), (1, 2), (1, 3), (2, 1), (3, 1), (4, 4)}


def test_suffix_tree(docs, none, spark):
    got = suffixtree.score(docs, suffixtree.held_out()).collect()
    rows = docs.collect()
    words = lambda t: [*(t or "").encode().lower().split(), None]
    c = Counter(w for r in rows if zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 7 != 2 for w in words(r.text))
    n, v = sum(c.values()), len(c)
    want = Counter((r.doc_id, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)) for r in rows for w in [words(r.text)])
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert suffixtree.score(none, suffixtree.held_out()).count() == 0
    all_held = suffixtree.score(docs, F.lit(True)).first()
    assert all_held.train_tokens == 0 and all_held.score == 0 and all_held.n_known == 0


class SlowTree:
    """The same model in dictionaries of tuples."""

    def __init__(self, texts, depth):
        self.depth, self.c, runs, number = depth, Counter(), Counter(), 0
        for t in texts:
            w = [0, *(t or "").encode().lower().split(), 0]
            self.c.update(w[1:])
            runs.update(tuple(w[i : i + n]) for n in range(2, depth + 2) for i in range(len(w) - n + 1))
        number = sum(self.c.values())
        self.room = number + len(self.c) + 1
        contexts = {(w,): n for w, n in self.c.items() if n > 1}
        below, self.states = {(w,): (n + 1) / self.room for w, n in self.c.items() if n > 1}, {}
        for n in range(2, depth + 2):
            entries, next_contexts, next_below = defaultdict(dict), {}, {}
            for r, c in runs.items():
                if len(r) == n and c > 1 and r[:-1] in contexts and r[1:] in below:
                    entries[r[:-1]][r[-1]] = c
            for x, e in entries.items():
                share = {w: (c - 0.5) / contexts[x] for w, c in e.items()}
                left = max(1 - sum(share.values()), 1e-12)
                p = {w: s + left * below[*x[1:], w] for w, s in share.items()}
                gain = sum(c * math.log2(p[w] / below[*x[1:], w]) for w, c in e.items()) + max(contexts[x] - sum(e.values()), 0) * math.log2(left)
                kept = gain > 0.5 * math.log2(max(2, number)) * (1 + len(e))
                for w, c in e.items():
                    next_below[*x, w] = p[w] if kept else below[*x[1:], w]
                    if kept:
                        next_contexts[*x, w] = c
                if kept:
                    self.states[x] = left, p
            contexts, below = next_contexts, next_below

    def p(self, before, w):
        for d in range(min(self.depth, len(before)), 0, -1):
            x = tuple(before[-d:])
            if x in self.states:
                left, p = self.states[x]
                return p[w] if w in p else left * self.p(x[1:], w)
        return (self.c[w] + 1) / self.room

    def score(self, text):
        w = [0, *(text or "").encode().lower().split(), 0]
        return sum(math.log10(self.p(w[:i], w[i])) for i in range(1, len(w)))


def test_a_filter_of_fixed_size_passes_all_beyond_its_buckets(spark, docs, none, monkeypatch):
    """With no room for the buckets there is no filter, and scores are the same; contexts of any size may be spread."""
    want = {r.doc_id: r.score for r in suffixtree.score(docs.where("doc_id is not null"), suffixtree.held_out()).collect()}
    monkeypatch.setattr(suffixtree, "SIEVE", 4)
    monkeypatch.setattr(suffixtree, "HOT_CONTEXT", 1)
    got = {r.doc_id: r.score for r in suffixtree.score(docs.where("doc_id is not null"), suffixtree.held_out()).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-9, abs_tol=1e-9) for i in want)


def test_slow_tree_states_are_distributions():
    tree = SlowTree(["a b c " * 30 + "b a d"] * 20, 3)
    assert {1, 2} <= {len(x) for x in tree.states}
    for before in ([], [b"a"], [b"b"], [b"a", b"b"], [b"b", b"a"], [b"c", b"a"], [0, b"a", b"b"], [b"z"]):
        assert sum(tree.p(before, w) for w in tree.c) + tree.p(before, b"unseen") == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize("depth, limits", [(2, {}), (3, {"HOT_CONTEXT": 30, "HOT_RUNS": 50, "BUCKET": 200, "FLUSH": 500, "DOCS": 7})])
def test_suffix_tree_is_exact(spark, none, monkeypatch, depth, limits):
    """Scores are those of the model in dictionaries, hot contexts and runs or not; the limits only part the work."""
    for name, value in limits.items():
        monkeypatch.setattr(suffixtree, name, value)
    rng, words = random.Random(9), vocabulary(5, 1500)
    texts = [" ".join(rng.choice(words) for _ in range(100)) for _ in range(150)]
    pairs = [f"the {a} {b} {c}" for a, b, c in zip(words[:300:3], words[1:300:3], words[2:300:3], strict=True)]
    texts += [" ".join(rng.choice(pairs) for _ in range(40)) for _ in range(100)] + ["qqqq zzzz"] * 3 + [texts[0]]
    train = len(texts)
    texts += [pairs[7], "", None, "not seen", "qqqq zzzz", texts[3], "again " * 300]
    frame = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, score double").repartition(3)
    tree = SlowTree(texts[:train], depth)
    assert len(tree.states) > 200
    found = {r.doc_id: r for r in suffixtree.score(frame, F.col("doc_id") >= train, depth).collect()}
    assert len(found) == len(texts) and found[train + 4].score > found[train + 4].base_score + 4
    for i, t in enumerate(texts):
        assert found[i].score == pytest.approx(tree.score(t), abs=1e-6)


@pytest.mark.parametrize("keys", [[], [7], [5, 5, 5], [0, 1, 1, 2**64 - 1], [9, 3, 9, 2**63, 3]])
def test_packed_keys_round_trip(keys):
    x = np.array(keys, dtype=np.uint64)
    row = (pa.record_batch({"k": pa.array([suffixtree._pack(x)], pa.binary())}), 0)
    back = suffixtree._unpack(row, "k")
    assert back.dtype == np.uint64 and back.tolist() == keys
