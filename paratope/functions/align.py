"""Pairwise local alignment and primer matching, as NumPy inside Arrow-batched pandas UDFs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from paratope.functions.sequences import IUPAC

# The BLOSUM62 substitution matrix.
RESIDUES = "ARNDCQEGHILKMFPSTWYVBZX*"
BLOSUM62 = """
 4 -1 -2 -2  0 -1 -1  0 -2 -1 -1 -1 -1 -2 -1  1  0 -3 -2  0 -2 -1  0 -4
-1  5  0 -2 -3  1  0 -2  0 -3 -2  2 -1 -3 -2 -1 -1 -3 -2 -3 -1  0 -1 -4
-2  0  6  1 -3  0  0  0  1 -3 -3  0 -2 -3 -2  1  0 -4 -2 -3  3  0 -1 -4
-2 -2  1  6 -3  0  2 -1 -1 -3 -4 -1 -3 -3 -1  0 -1 -4 -3 -3  4  1 -1 -4
 0 -3 -3 -3  9 -3 -4 -3 -3 -1 -1 -3 -1 -2 -3 -1 -1 -2 -2 -1 -3 -3 -2 -4
-1  1  0  0 -3  5  2 -2  0 -3 -2  1  0 -3 -1  0 -1 -2 -1 -2  0  3 -1 -4
-1  0  0  2 -4  2  5 -2  0 -3 -3  1 -2 -3 -1  0 -1 -3 -2 -2  1  4 -1 -4
 0 -2  0 -1 -3 -2 -2  6 -2 -4 -4 -2 -3 -3 -2  0 -2 -2 -3 -3 -1 -2 -1 -4
-2  0  1 -1 -3  0  0 -2  8 -3 -3 -1 -2 -1 -2 -1 -2 -2  2 -3  0  0 -1 -4
-1 -3 -3 -3 -1 -3 -3 -4 -3  4  2 -3  1  0 -3 -2 -1 -3 -1  3 -3 -3 -1 -4
-1 -2 -3 -4 -1 -2 -3 -4 -3  2  4 -2  2  0 -3 -2 -1 -2 -1  1 -4 -3 -1 -4
-1  2  0 -1 -3  1  1 -2 -1 -3 -2  5 -1 -3 -1  0 -1 -3 -2 -2  0  1 -1 -4
-1 -1 -2 -3 -1  0 -2 -3 -2  1  2 -1  5  0 -2 -1 -1 -1 -1  1 -3 -1 -1 -4
-2 -3 -3 -3 -2 -3 -3 -3 -1  0  0 -3  0  6 -4 -2 -2  1  3 -1 -3 -3 -1 -4
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4  7 -1 -1 -4 -3 -2 -2 -1 -2 -4
 1 -1  1  0 -1  0  0  0 -1 -2 -2  0 -1 -2 -1  4  1 -3 -2 -2  0  0  0 -4
 0 -1  0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1  1  5 -2 -2  0 -1 -1  0 -4
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1  1 -4 -3 -2 11  2 -3 -4 -3 -2 -4
-2 -2 -2 -3 -2 -1 -2 -3  2 -1 -1 -2 -1  3 -3 -2 -2  2  7 -1 -3 -2 -1 -4
 0 -3 -3 -3 -1 -2 -2 -3 -3  3  1 -2  1 -1 -2 -2  0 -3 -1  4 -3 -2 -1 -4
-2 -1  3  4 -3  0  1 -1  0 -3 -4  0 -3 -3 -2  0 -1 -4 -3 -3  4  1 -1 -4
-1  0  0  1 -3  3  4 -2  0 -3 -3  1 -1 -3 -1  0 -1 -3 -2 -2  1  4 -1 -4
 0 -1 -1 -1 -2 -1 -1 -1 -1 -1 -1 -1 -1 -1 -2  0  0 -2 -1 -1 -1 -1 -1 -4
-4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4 -4  1
"""


@lru_cache
def scores(kind: str) -> np.ndarray:
    """A 128 by 128 table of substitution scores by character code."""
    if kind == "protein":
        m = np.full((128, 128), -4)
        m[np.ix_(*[[ord(c) for c in RESIDUES]] * 2)] = np.array([list(map(int, row.split())) for row in BLOSUM62.strip().splitlines()])
    elif kind == "dna":
        m = np.full((128, 128), -2)
        np.fill_diagonal(m, 1)
    else:  # codes that share a base score 5, others -4
        m = np.full((128, 128), -4)
        for a, x in IUPAC.items():
            for b, y in IUPAC.items():
                m[ord(a), ord(b)] = 5 if set(x) & set(y) else -4
    return m


def local(a: str, b: str, kind: str, gap: int) -> tuple[int, list[tuple[int, int]]]:
    """Score and aligned places (i, j), -1 for a gap, of the best local alignment with linear gaps.

    Among alignments of one score the one that ends first in ``a``, then in ``b``, is taken; on its way back it prefers a pair.
    """
    if not a or not b:
        return 0, []
    x = np.frombuffer(a.upper().encode("ascii", "replace"), np.uint8)
    y = np.frombuffer(b.upper().encode("ascii", "replace"), np.uint8)
    s = scores(kind)[x[:, None], y[None, :]]
    # Rows run over the shorter text, so that the vectors are long and few.
    turned = len(a) > len(b)
    if turned:
        s = s.T
    h = np.zeros((s.shape[0] + 1, s.shape[1] + 1), dtype=np.int64)
    steps = gap * np.arange(s.shape[1] + 1)
    for i in range(1, s.shape[0] + 1):
        row = np.maximum(0, np.maximum(h[i - 1, :-1] + s[i - 1], h[i - 1, 1:] + gap))
        # gaps along the row: the best of all starts, a running maximum once the slope is taken out
        h[i, 1:] = np.maximum(0, np.maximum.accumulate(np.concatenate([[0], row]) - steps)[1:] + steps[1:])
    if turned:
        h, s = h.T, s.T
    best = int(h.max())
    if best == 0:
        return 0, []
    i, j = map(int, np.argwhere(h == best)[0])
    path = []
    while i > 0 and j > 0 and h[i, j] > 0:
        if h[i, j] == h[i - 1, j - 1] + s[i - 1, j - 1]:
            i, j = i - 1, j - 1
            path.append((i, j))
        elif h[i, j] == h[i - 1, j] + gap:
            i -= 1
            path.append((i, -1))
        else:
            j -= 1
            path.append((-1, j))
    return best, path[::-1]


def best_alignment(seq: str, query: str, dna: bool) -> tuple[int, int, bool] | None:
    """1-based start and end of a query within a sequence, and whether the alignment has a gap.

    The start is moved over query letters that the local alignment left out in front.
    """
    if not dna:
        seq, query = seq.replace("*", "X"), query.replace("*", "X")
    _, path = local(seq, query, "dna" if dna else "protein", -2 if dna else -100)
    pairs = [(i, j) for i, j in path if i >= 0 and j >= 0]
    if not pairs:
        return None
    start = max(0, pairs[0][0] - pairs[0][1])
    end = min(len(seq), pairs[-1][0] + 1 + (len(query) - 1 - pairs[-1][1]))
    return start + 1, end, len(pairs) < len(path)


def best_ungapped(seqs: list[str], query: str) -> list[tuple[int, int, bool] | None]:
    """``best_alignment`` of proteins where no gap can pay, for many sequences at once."""
    return [p and (*p[:2], False) for p in ungapped_paths(seqs, query)]


def ungapped_paths(seqs: list[str], query: str) -> list[tuple[int, int, int] | None]:
    """Start and end as ``best_alignment`` gives them, and the 1-based place of the first aligned letter, of proteins where no gap can
    pay: scores run along diagonals only."""
    table, query = scores("protein"), query.upper().replace("*", "X")
    out: list[tuple[int, int, int] | None] = [None] * len(seqs)
    order = sorted(range(len(seqs)), key=lambda i: len(seqs[i]))
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi + 1 - lo) * (len(seqs[order[hi]]) + 1) <= 1 << 17:
            hi += 1
        own, lo = order[lo:hi], hi
        width = len(seqs[own[-1]])
        if not width:
            continue
        sizes = np.array([len(seqs[i]) for i in own])
        codes = np.full((len(own), width), 127, dtype=np.uint8)  # no residue: -4 to all
        codes[np.arange(width)[None, :] < sizes[:, None]] = np.frombuffer("".join(seqs[i] for i in own).upper().replace("*", "X").encode("ascii", "replace"), np.uint8)
        h = np.zeros((len(query) + 1, len(own), width + 1), dtype=np.int16)
        for j, c in enumerate(query):
            h[j + 1, :, 1:] = np.maximum(h[j, :, :-1] + table[:, ord(c)].astype(np.int16)[codes], 0)
        each = h.max(0)
        best = each.max(1)
        row = np.arange(len(own))
        i = (each == best[:, None]).argmax(1)
        j = (h[:, row, i] == best[None, :]).argmax(0)
        back = np.zeros(len(own), dtype=np.int64)
        live = best > 0
        while live.any():
            live &= (i - back > 0) & (j - back > 0) & (h[np.maximum(j - back - 1, 0), row, np.maximum(i - back - 1, 0)] > 0)
            back += live
        start = np.maximum(0, i - 1 - (j - 1))
        end = np.minimum(sizes, i + len(query) - j)
        for k in np.flatnonzero(best > 0).tolist():
            out[own[k]] = (int(start[k]) + 1, int(end[k]), int(i[k] - back[k]))
    return out


@lru_cache
def no_gap_pays(query: str) -> bool:
    return bool(query) and query.isascii() and sum(int(scores("protein")[:, ord(c)].max()) for c in query.upper()) <= 100


ALIGNED = "struct<start:int,end:int,gapped:boolean>"


def aligned_to(query: str, dna: bool):
    """A pandas UDF that aligns a fixed query to each sequence."""

    @F.pandas_udf(ALIGNED)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in parts:
            found = [best_alignment(x, query, dna) if x else None for x in s]
            yield pd.DataFrame([f or (None, None, None) for f in found], columns=["start", "end", "gapped"])

    return run


def aligned_pairs(dna: bool):
    """A pandas UDF that aligns each query to the sequence beside it."""

    @F.pandas_udf(ALIGNED)
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for s, q in parts:
            found: list = [None] * len(s)
            by: dict[str, list[int]] = {}
            for i, (x, y) in enumerate(zip(s, q, strict=True)):
                if x and y:
                    by.setdefault(y, []).append(i)
            for y, own in by.items():
                texts = [s.iloc[i] for i in own]
                got = best_ungapped(texts, y) if not dna and no_gap_pays(y) else [best_alignment(x, y, dna) for x in texts]
                for i, g in zip(own, got, strict=True):
                    found[i] = g
            yield pd.DataFrame([f or (None, None, None) for f in found], columns=["start", "end", "gapped"])

    return run


PATH = "struct<start:int,end:int,first:int>"


def path_behind(query: str, lead: int):
    """A pandas UDF that aligns a fixed protein, for which no gap can pay, to what follows the first ``lead`` letters of each sequence;
    places count from the sequence's front. What follows more letters, up to ``first``, has the same alignment."""

    @F.pandas_udf(PATH)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in parts:
            found = ungapped_paths([(x or "")[lead:] for x in s], query)
            yield pd.DataFrame([tuple(v + lead for v in f) if f else (None, None, None) for f in found], columns=["start", "end", "first"])

    return run


PRIMER = "struct<id:string,mismatch:int,indel:int,start:int,end:int>"
REMEMBERED = 200_000


def match_pattern(seq: str, patterns: list[tuple[str, str]], extend5: bool) -> tuple[str, int, int, int, int]:
    """The best of several IUPAC patterns in a sequence: its id, 1-based places in the pattern of the first mismatch and the first
    indel (0: none), and the 1-based span in the sequence. An exact match ends the search; ties go to the earlier pattern; if a
    pattern doesn't align at all, nothing matches and the id is ``nan``."""
    best = None
    for name, pattern in patterns:
        score, path = local(seq, pattern, "iupac", -5)
        if not path:
            return "nan", 0, 0, 0, 0
        pairs = [(i, j) for i, j in path if i >= 0 and j >= 0]
        table = scores("iupac")
        code = lambda c: ord(c.upper()) if c.isascii() else ord("?")
        missed = [j + 1 for i, j in pairs if table[code(seq[i]), code(pattern[j])] < 0]
        gaps = [max((y for x, y in path[:k] if y >= 0), default=-1) + 1 if j < 0 else j + 1 for k, (i, j) in enumerate(path) if i < 0 or j < 0]
        front = pairs[0][1]
        lead = range(1, front + 1) if extend5 else ()
        missed = [*[p for p in lead], *missed]
        if pairs[-1][1] < len(pattern) - 1:
            missed.append(pairs[-1][1] + 2)
        start = max(0, pairs[0][0] - (front if extend5 else 0))
        got = (name, min(missed, default=0), min(gaps, default=0), start + 1, pairs[-1][0] + 1)
        if score == 5 * len(pattern):
            return got
        if best is None or score > best[0]:
            best = (score, got)
    return best[1] if best else ("nan", 0, 0, 0, 0)


def primer_matcher(patterns: list[tuple[str, str]], extend5: bool = True):
    """A pandas UDF over sequences for a few patterns."""

    @F.pandas_udf(PRIMER)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict = {}  # a window is matched once a task, not once a row
        for s in parts:
            if len(known) > REMEMBERED:
                known.clear()
            for x in s.unique():
                if x not in known:
                    known[x] = match_pattern(x, patterns, extend5) if x else ("nan", 0, 0, 0, 0)
            yield pd.DataFrame([known[x] for x in s], columns=["id", "mismatch", "indel", "start", "end"])

    return run


def best_identity(short: str, long: str) -> int:
    """The most identical places of the shorter sequence, or its reverse complement, laid without gaps along the longer one."""
    if len(short) > len(long):
        short, long = long, short
    if not short:
        return 0
    y = np.lib.stride_tricks.sliding_window_view(np.frombuffer(long.encode(), np.uint8), len(short))
    other = short.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    return int(max((y == np.frombuffer(s.encode(), np.uint8)).sum(1).max() for s in (short, other)))


def centre_star(seqs: list[str], gap: int = -2) -> list[str]:
    """A multiple alignment of a small group: every sequence is aligned to the one nearest to all others, gaps are merged."""
    if len(seqs) < 2:
        return list(seqs)
    total = [sum(_global(a, b, gap)[0] for b in seqs) for a in seqs]
    centre = seqs[int(np.argmax(total))]
    pieces = []
    widest = [0] * (len(centre) + 1)
    for s in seqs:
        ops = _global(centre, s, gap)[1]
        inserts, letters, at = [""] * (len(centre) + 1), ["-"] * len(centre), 0
        for i, j in ops:
            if i < 0:
                inserts[at] += s[j]
            else:
                letters[i] = s[j] if j >= 0 else "-"
                at = i + 1
        pieces.append((inserts, letters))
        widest = [max(w, len(x)) for w, x in zip(widest, inserts, strict=True)]
    return ["".join(x.ljust(w, "-") + (letters[i] if i < len(letters) else "") for i, (x, w) in enumerate(zip(inserts, widest, strict=True))) for inserts, letters in pieces]


def _global(a: str, b: str, gap: int) -> tuple[int, list[tuple[int, int]]]:
    h = np.zeros((len(a) + 1, len(b) + 1), dtype=np.int64)
    h[:, 0], h[0, :] = gap * np.arange(len(a) + 1), gap * np.arange(len(b) + 1)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(h[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] + gap, h[i, j - 1] + gap)
    i, j, ops = len(a), len(b), []
    while i or j:
        if i and j and h[i, j] == h[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -1):
            i, j = i - 1, j - 1
            ops.append((i, j))
        elif i and h[i, j] == h[i - 1, j] + gap:
            i -= 1
            ops.append((i, -1))
        else:
            j -= 1
            ops.append((-1, j))
    return int(h[-1, -1]), ops[::-1]
