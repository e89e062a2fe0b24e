"""The three-way merge against a merge in dictionaries."""

import random

import pytest

from paratope.llm import merge
from paratope.llm.merge import ADDED, CHANGED, DROP, DROPPED, EDIT, INSERT

BASE = "doc_id long, text string, lang string, source string, k long, version int, c0 string"
LOG = "doc_id long, kind int, lang string, source string, text string, changes array<struct<line:int,op:int,text:string>>, k int"
NAMES = ("lang", "source")


def plain(base, left, right):
    """{id: (columns, text, counts)} of rows and logs with one row an id and kind."""
    out = {}
    logs = [{(r[0], r[1]): r for r in x} for x in (left, right)]
    for i in {r[0] for r in base} | {r[0] for x in (left, right) for r in x if r[1] == ADDED}:
        row = next((r for r in base if r[0] == i), None)
        n = [0, 0, 0, 0]

        def settle(was, a, b, kind, n=n):
            """The state after both changes; None is no change."""
            a, b = (x if x != was else None for x in (a, b))
            if a is not None and b is not None and a != b:
                n[kind(a, b)] += 1
            elif a is not None or b is not None:
                n[0] += 1
            return b if b is not None else a if a is not None else was

        if row is None:
            made = [x.get((i, ADDED)) for x in logs]
            values = [m and (m[2], m[3], m[4]) for m in made]
            state = settle(None, *values, lambda a, b: 3)
            out[i] = (*state[:2], state[2], *n)
            continue
        cols, lines = [row[2] or "", row[3] or ""], (row[1] or "").split("\n")
        gone = [(i, DROPPED) in x for x in logs]
        own = [x.get((i, CHANGED)) for x in logs]
        edits = [{} if o is None else {(c[0], c[1] == INSERT): (c[1], c[2]) for c in o[5] or () if c[1] == INSERT or 0 <= c[0] < len(lines)} for o in own]
        edits = [{k: v for k, v in e.items() if v != (EDIT, lines[k[0]] if not k[1] else None)} for e in edits]
        new = [[None, None] if o is None else [o[2], o[3]] for o in own]
        changed = [bool(e) or any(v is not None and v != c for v, c in zip(w, cols)) for e, w in zip(edits, new)]
        if any(gone):
            fought = (gone[0] and not gone[1] and changed[1]) or (gone[1] and not gone[0] and changed[0])
            n[2 if fought else 0] = 1
            if not (fought and gone[0]):
                out[i] = (None, None, None, *n)
                continue
            edits[0], new[0], keep = {}, [None, None], list(n)
        cols = [settle(c, *v, lambda a, b: 1) for c, v in zip(cols, zip(*new))]
        text = []
        for j in range(-1, len(lines)):
            if j >= 0:
                s = settle((None, lines[j]), *(e.get((j, False)) for e in edits), lambda a, b: 2 if DROP in (a[0], b[0]) else 1)
                text += [s[1]] if s[0] != DROP else []
            s = settle(None, *(e.get((j, True)) for e in edits), lambda a, b: 3)
            text += [s[1]] if s else []
        out[i] = (*cols, "\n".join(text), *(keep if any(gone) else n))
    return out


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b!", "", "c d", "ü"])
    base = [(i, rng.choice([None, "", "\n".join(word() for _ in range(rng.randint(1, 9)))]), rng.choice([None, "en", ""]), rng.choice(["s", None])) for i in range(300)]

    def log():
        out = []
        for i, text, *_ in base:
            what = rng.choice([CHANGED] * 6 + [DROPPED, None])
            n = len((text or "").split("\n"))
            if what == CHANGED:
                ch = {}
                for j in range(-1, n):
                    if j >= 0 and rng.random() < 0.4:
                        ch[j, False] = (j, DROP, None) if rng.random() < 0.4 else (j, EDIT, word())
                    if rng.random() < 0.3:
                        ch[j, True] = (j, INSERT, rng.choice(["x", "y", "z\nz"]))
                out.append((i, CHANGED, rng.choice([None, "", "de", "fr"]), rng.choice([None, "s", "t"]), None, list(ch.values())))
            elif what == DROPPED:
                out.append((i, DROPPED, None, None, None, []))
            if rng.random() < 0.4:
                out.append((-1 - i, ADDED, "en", rng.choice(["", "q"]), rng.choice(["!", "?"]), []))
        return out

    return base, log(), log()


def frames(spark, base, left, right):
    logs = [spark.createDataFrame([(*r, 1) for r in x], LOG).repartition(3) for x in (left, right)]
    return spark.createDataFrame([(*r, 7, 1, "x") for r in base], BASE).repartition(3), *logs


def found(df):
    return {r.doc_id: (r.lang, r.source, r.text, *(r[c] for c in merge.COUNTS)) for r in df.collect()}


@pytest.mark.parametrize("run", [merge.RUN_BYTES, 2000])
def test_merge_equals_dictionaries(spark, tables, run, monkeypatch):
    monkeypatch.setattr(merge, "RUN_BYTES", run)
    df = merge.merge_branches(*frames(spark, *tables))
    got = found(df)
    assert df.columns == ["doc_id", *NAMES, "text", *merge.COUNTS]
    assert got == plain(*tables)
    assert {3, 4, 5, 6} <= {i for v in got.values() for i, x in enumerate(v) if i > 2 and x}


def test_defined_cases(spark):
    base = [(None, "a\nb", "en", "s"), (1, "x", "en", "s"), (1, "x", "en", "s"), (2, "long " * 3_000_000, None, None)]
    left = [(None, CHANGED, "de", None, None, [(0, EDIT, "A"), (9, EDIT, "past the end")]), (1, ADDED, "zz", "zz", "ignored", []), (5, CHANGED, "xx", None, None, [])]
    right = [(None, CHANGED, None, "", None, [(1, DROP, None)]), (2, CHANGED, "", None, None, [])]
    got = found(merge.merge_branches(*frames(spark, base, left, right)))
    assert got == {None: ("de", "", "A", 4, 0, 0, 0), 1: ("en", "s", "x", 0, 0, 0, 0), 2: ("", "", "long " * 3_000_000, 0, 0, 0, 0)}


def test_empty_tables(spark, tables):
    base, left, right = tables
    assert found(merge.merge_branches(*frames(spark, [], [], []))) == {}
    assert found(merge.merge_branches(*frames(spark, base, [], []))) == plain(base, [], [])
    assert found(merge.merge_branches(*frames(spark, [], left, right))) == plain([], left, right)
    assert merge.merged_branches(frames(spark, [], [], [])[0]).count() == 0


def test_coded_branches_follow_the_rule(spark):
    import zlib

    base = [(i, "a\n\nb" if i % 2 else None, "en", None) for i in range(40)] + [(None, "t", "en", "s")]
    log = {(r.doc_id, r.kind): r for r in merge.coded_branch(frames(spark, base, [], [])[0], "R").collect()}
    code = lambda i, name: zlib.crc32(f"R:{i}:{name}".encode()) % 7
    for i, text, _, _ in base[:-1]:
        row = code(i, "row")
        assert ((i, DROPPED) in log) == (row == 0) and ((i, CHANGED) in log) == (row != 0)
        assert ((-1 - i, ADDED) in log) == (row in (3, 4))
        if row in (3, 4):
            assert log[-1 - i, ADDED].text == ("!" if row == 3 else "?") and log[-1 - i, ADDED].source == ""
        if row:
            r, lines = log[i, CHANGED], (text or "").split("\n")
            assert r.lang == {0: "", 1: "en!", 2: "en?"}.get(code(i, "lang"))
            want = [{0: (j, DROP, None), 1: (j, EDIT, x + "!"), 2: (j, EDIT, x + "?"), 3: (j, INSERT, "!"), 4: (j, INSERT, "?")}.get(code(i, j)) for j, x in enumerate(lines)]
            assert [tuple(c) for c in r.changes] == [w for w in want if w]
    assert (None, CHANGED) not in log
