"""Removal of passages that occur before, wherever their lines break, against brute force."""

import random

import corpus_pipeline
import pytest

from paratope.llm import suffixes, units


def spans_of(texts, size):
    """Words of runs of ``size`` words that aren't the first of their kind and don't overlap it, as merged spans."""
    first, out = {}, {}
    for i, t in enumerate(texts):
        words, marked = (t or "").lower().split(), set()
        for s in range(len(words) - size + 1):
            at = first.setdefault(tuple(words[s : s + size]), (i, s))
            if at[0] != i or s - at[1] >= size:
                marked.update(range(s, s + size))
        edges = sorted(x for x in marked if x - 1 not in marked), sorted(x + 1 for x in marked if x + 1 not in marked)
        out[i] = list(zip(*edges, strict=True))
    return out


@pytest.mark.parametrize("crowd", [20_000, 3])
def test_later_passages(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    rng = random.Random(5)
    prose = lambda n: "".join(f"w{rng.randrange(5000)}{rng.choice([' ', chr(10), '  '])}" for _ in range(n))
    shared = [prose(n) for n in (50, 60, 90, 49)]
    texts = [prose(rng.randint(0, 40)) + rng.choice(shared) + prose(rng.randint(0, 30)) + rng.choice(shared).upper() + prose(5) for _ in range(25)]
    texts += [None, "", "la " * 70, "x " + "la " * 230, "a b c " * 60, shared[2] + shared[2]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want, got = spans_of(texts, 50), {i: [] for i in range(len(texts))}
    found = suffixes.later_passages(docs)
    for r in found.collect():
        got[r.doc_id].append((r.start, r.end))
    merged = {}
    for i, own in got.items():  # touching spans are one
        out = []
        for s, e in sorted(own):
            out[-1:] = [(out[-1][0], max(e, out[-1][1]))] if out and s <= out[-1][1] else [*out[-1:], (s, e)]
        merged[i] = out
    assert merged == want and sum(map(len, want.values())) > 20
    kept = {r.doc_id: r.text for r in units.without_units(docs, found, "").collect()}
    for i, t in enumerate(texts):
        words = (t or "").split()
        gone = {x for s, e in want[i] for x in range(s, e)}
        assert (kept[i] or "").split() == [w for k, w in enumerate(words) if k not in gone] and (gone or kept[i] == t)


def test_rows_that_repeat_id_and_text(spark):
    text = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(1, text), (1, text), (None, "x " + text)], "doc_id long, text string")
    assert [tuple(r) for r in suffixes.later_passages(docs).select("doc_id", "start", "end").distinct().collect()] == [(1, 0, 80)]
    assert suffixes.later_passages(docs.where("doc_id = 1")).count() == 0


def test_the_pipeline_removes_passages_within_lines(spark):
    rng = random.Random(6)
    prose = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    shared = prose(55).split()
    rows = [(i, f"{prose(30)} {' '.join(shared[: 9 + i])}\n{' '.join(shared[9 + i :])} {prose(20)}", "aa", "s", 1) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.repeated_lines(spark, docs, "").collect()}
    assert got[0].text == rows[0][1]
    for i in range(1, 4):
        assert got[i].text.split() == rows[i][1].split()[:30] + rows[i][1].split()[-20:] and got[i].n_chars == len(got[i].text)


def test_cuts_need_one_python_worker_a_task(spark):
    """The filter of texts that may have cuts and the cutting itself used to run in one task, with a worker each."""
    docs = spark.createDataFrame([(i, f"a b c d e f\nown {i}") for i in range(4)], "doc_id long, text string")
    left = units.without_units(docs, units.repeated_units(docs))
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    branches = plan.split("ArrowEvalPython")
    assert len(branches) == 3  # cutting in one branch of the union, the filter in the other
    assert sorted(r.text for r in left.collect()) == ["a b c d e f\nown 0", "own 1", "own 2", "own 3"]
