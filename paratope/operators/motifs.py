"""Position-specific motif models: construction, scanning, enrichment and background models."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paratope.functions.align import centre_star
from paratope.functions.sequences import IUPAC, ambiguous_regex, canonical, reverse_complement
from paratope.functions.stats import hypergeometric_tail_udf, log2_sum
from paratope.plans.shared import written

BASES = "ACGT"
UNIFORM = {b: 0.25 for b in BASES}
FLIP = str.maketrans("ACGT", "TGCA")
_OTHER = re.compile("[^ACGT]")
_DIGIT = np.full(256, 4, dtype=np.int32)
_DIGIT[[ord(b) for b in BASES]] = range(4)


@dataclass
class Motif:
    """A motif of some width: fractions and log-likelihood ratios, one row a place and one column a base."""

    fractions: np.ndarray
    background: np.ndarray
    floor: float = -100.0

    @classmethod
    def from_counts(cls, counts: np.ndarray, background: dict[str, float] = UNIFORM, beta: float = 0.01) -> Motif:
        """Columns are filled up to the largest total by background, then take a share ``beta`` of background."""
        bg = np.array([background[b] for b in BASES])
        counts = np.asarray(counts, dtype=float)
        counts = counts + (counts.sum(1).max() - counts.sum(1))[:, None] * bg
        total = counts.sum(1, keepdims=True)
        return cls((counts + beta * bg * total) / (total * (1 + beta)), bg)

    @classmethod
    def from_text(cls, text: str, background: dict[str, float] = UNIFORM, beta: float = 0.05) -> Motif:
        rows = [[1.0 if b in IUPAC.get("N" if c == "." else c.upper(), "") else 0.0 for b in BASES] for c in text]
        return cls.from_counts(np.array(rows) / np.maximum(np.sum(rows, axis=1, keepdims=True), 1), background, beta)

    @classmethod
    def from_sequences(cls, seqs: list[str], background: dict[str, float] = UNIFORM) -> Motif:
        """One count of background is added to each column."""
        bg = np.array([background[b] for b in BASES])
        counts = np.array([[sum(s[i] == b for s in seqs) for b in BASES] for i in range(len(seqs[0]))], dtype=float)
        return cls((counts + bg) / (counts.sum(1, keepdims=True) + 1), bg)

    @classmethod
    def from_ratios(cls, ratios: np.ndarray, background: dict[str, float] = UNIFORM) -> Motif:
        """From log2 likelihood ratios; a place's fractions are scaled to sum to one."""
        bg = np.array([background[b] for b in BASES])
        f = bg * 2.0 ** np.asarray(ratios, dtype=float)
        return cls(f / f.sum(1, keepdims=True), bg)

    @classmethod
    def random(cls, width: int, rng: np.random.Generator, background: dict[str, float] = UNIFORM) -> Motif:
        return cls(rng.dirichlet(np.ones(4), width), np.array([background[b] for b in BASES]))

    def __len__(self) -> int:
        return len(self.fractions)

    # ------------------------------------------------ changed copies
    def with_background(self, background: dict[str, float]) -> Motif:
        return Motif(self.fractions, np.array([background[b] for b in BASES]), self.floor)

    def with_pseudocounts(self, beta: float) -> Motif:
        """A share ``beta`` of background, for one of the motif, is mixed into each place."""
        return Motif((self.fractions + beta * self.background) / (1 + beta), self.background, self.floor)

    def denoised(self, least: float = 0.5) -> Motif:
        """Places of under ``least`` bits become background."""
        return Motif(np.where((self.bits < least)[:, None], self.background, self.fractions), self.background, self.floor)

    def merged(self, other: Motif, shift: int) -> Motif:
        """Both motifs, the other one moved by ``shift`` places: means where both lie, one of them elsewhere, background between."""
        lo, hi = min(0, shift), max(len(self), shift + len(other))
        rows = []
        for i in range(lo, hi):
            own = [m.fractions[j] for m, j in ((self, i), (other, i - shift)) if 0 <= j < len(m)]
            rows.append(np.mean(own, axis=0) if own else self.background)
        return Motif(np.array(rows), self.background, self.floor)

    def shuffled_places(self, rng: np.random.Generator) -> Motif:
        return Motif(self.fractions[rng.permutation(len(self))], self.background, self.floor)

    def shuffled_bases(self, rng: np.random.Generator) -> Motif:
        """The fractions of each place dealt to other bases."""
        return Motif(np.array([rng.permutation(f) for f in self.fractions]), self.background, self.floor)

    @property
    def code_ratios(self) -> dict[str, np.ndarray]:
        """The ratios of each ambiguity code at each place: the best of its bases; 0 for codes of three bases and more."""
        r = self.ratios
        return {c: r[:, [BASES.index(b) for b in s]].max(1) if len(s) <= 2 else np.zeros(len(self)) for c, s in IUPAC.items() if c != "U"}

    @property
    def ratios(self) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.maximum(np.log2(self.fractions / self.background), self.floor)

    @property
    def bits(self) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.nansum(np.where(self.fractions > 0, self.fractions * np.log2(self.fractions), 0), axis=1) + 2

    @property
    def best(self) -> float:
        return float(self.ratios.max(1).sum())

    @property
    def consensus(self) -> str:
        """A letter a place: none under a quarter bit, lower case under one bit; two or more bases of like weight as their code."""
        codes = {v: k for k, v in IUPAC.items() if k != "U"}
        out = []
        for f, b in zip(self.fractions, self.bits, strict=True):
            if b < 0.25:
                out.append(".")
                continue
            like = "".join(x for x, p in zip(BASES, f, strict=True) if p > f.max() / 2)
            out.append(codes[like] if b >= 1 else codes[like].lower())
        return "".join(out)

    def reverse(self) -> Motif:
        return Motif(self.fractions[::-1, ::-1], self.background[::-1], self.floor)

    def part(self, start: int, end: int) -> Motif:
        """Places start to end; those outside the motif are background."""
        rows = [self.fractions[i] if 0 <= i < len(self) else self.background for i in range(start, end)]
        return Motif(np.array(rows), self.background, self.floor)

    def trimmed(self, least: float = 0.1) -> Motif:
        keep = np.flatnonzero(self.bits > least)
        return self.part(int(keep[0]), int(keep[-1]) + 1) if len(keep) else self

    def _tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Scores of each character code at each place, forward and for the reverse complement; made once."""
        found = self.__dict__.get("_made")
        if found is None:
            fwd, rev, at = np.zeros((len(self), 128)), np.zeros((len(self), 128)), [ord(b) for b in BASES]
            fwd[:, at], rev[:, at] = self.ratios, self.ratios[::-1, ::-1]
            found = self.__dict__["_made"] = fwd, rev
        return found

    def _word_scores(self) -> np.ndarray:
        """Scores of all words by their number in base 5 (4: no base), on either strand; made once."""
        found = self.__dict__.get("_words")
        if found is None:
            number, found = np.arange(5 ** len(self)), np.zeros((2, 5 ** len(self)))
            for i in range(len(self)):
                letter = np.frombuffer(b"ACGT-", np.uint8)[number // 5 ** (len(self) - 1 - i) % 5]
                for row, table in zip(found, self._tables(), strict=True):
                    row += table[i][letter]
            self.__dict__["_words"] = found
        return found

    def scores(self, seq: str) -> tuple[np.ndarray, np.ndarray]:
        """Scores at every start on either strand; letters that aren't bases score nothing."""
        codes = np.frombuffer(seq.upper().encode("ascii", "replace"), np.uint8)
        n = len(codes) - len(self) + 1
        if n < 1:
            return np.zeros(0), np.zeros(0)
        if len(self) <= 7:  # the few words' scores are added up once, place by place, and looked up
            key, digits = np.zeros(n, dtype=np.int32), _DIGIT[codes]
            for i in range(len(self)):
                key = key * 5 + digits[i : i + n]
            both = self._word_scores()
            return both[0][key], both[1][key]
        fwd, rev = self._tables()
        out = np.zeros((2, n))
        for i in range(len(self)):
            here = codes[i : i + n]
            out[0] += fwd[i][here]
            out[1] += rev[i][here]
        return out[0], out[1]

    def score(self, word: str) -> float:
        return float(self.scores(word[: len(self)])[0][0])

    def scores_above(self, seq: str, cut: float) -> float:
        """Sum of the scores above ``cut`` of either strand; what a hit covers isn't looked at again."""
        fwd, rev = self.scores(seq)
        best, at, total = np.maximum(fwd, rev), 0, 0.0
        while at < len(best):
            if best[at] > cut:
                total += float(best[at])
                at += len(self)
            else:
                at += 1
        return total

    def total(self, seq: str) -> float:
        """log2 of the summed odds of all places of both strands."""
        fwd, rev = self.scores(seq)
        return log2_sum([*fwd.tolist(), *rev.tolist()]) if len(fwd) else -math.inf

    def starts(self, seq: str, cut: float) -> list[int]:
        """Places that score at least ``cut`` on either strand."""
        fwd, rev = self.scores(seq)
        return np.flatnonzero(np.maximum(fwd, rev) >= cut).tolist()

    def separate_starts(self, seq: str, cut: float) -> list[int]:
        """Of the ``starts`` those that don't begin inside one taken before."""
        out: list[int] = []
        for s in self.starts(seq, cut):
            if not out or s >= out[-1] + len(self):
                out.append(s)
        return out

    def masked(self, seq: str, cut: float) -> str:
        """The sequence with N in place of all hits."""
        out = list(seq)
        for s in self.starts(seq, cut):
            out[s : s + len(self)] = "N" * len(self)
        return "".join(out)

    def neighbourhoods(self, seq: str, cut: float, flank: int, mask: bool = False) -> list[str]:
        """The stretches within ``flank`` letters of a hit, those that touch as one; hits are N's if they are to be masked."""
        text, out = self.masked(seq, cut) if mask else seq, []
        for s in self.starts(seq, cut):
            lo, hi = max(0, s - flank), min(len(seq), s + len(self) + flank)
            if out and lo <= out[-1][1]:
                out[-1] = (out[-1][0], hi)
            else:
                out.append((lo, hi))
        return [text[a:b] for a, b in out]

    def scan_short(self, seq: str, factor: float = 0.8) -> list[tuple[int, float, str]]:
        """(place in the motif, score, strand) of a sequence shorter than the motif, laid along it, where it scores above ``factor``
        of what those places can score at best."""
        out, n = [], len(seq)
        for strand, m in (("+", self), ("-", self.reverse())):
            for i in range(len(m) - n + 1):
                part = m.part(i, i + n)
                score = part.score(seq)
                if score > factor * part.best:
                    out.append((i if strand == "+" else len(m) - n - i, score, strand))
        return sorted(out)

    def best_match(self, seq: str) -> tuple[float, int, str, str] | None:
        """Score, start, strand and word, as on its strand, of the best place."""
        fwd, rev = self.scores(seq)
        if not len(fwd):
            return None
        i = int(np.maximum(fwd, rev).argmax())
        word = seq[i : i + len(self)].upper()
        return (float(fwd[i]), i, "+", word) if fwd[i] >= rev[i] else (float(rev[i]), i, "-", word.translate(FLIP)[::-1])

    def threshold(self, seqs: list[str], z: float = 1.0) -> float:
        """Mean of the best scores of some sequences less z sample standard deviations."""
        x = np.array([self.best_score(q) for q in seqs])
        return float(x.mean() - z * (x.std(ddof=1) if len(x) > 1 else 0.0))

    def scan(self, seq: str, threshold: float | None = None, factor: float = 0.7) -> list[tuple[int, int, float, str]]:
        """(start, end, score, strand) of places that score above the threshold, by default ``factor`` of the best score; the
        forward strand is given where it scores at least as high."""
        cut = factor * self.best if threshold is None else threshold
        fwd, rev = self.scores(seq)
        best = np.maximum(fwd, rev)
        at = np.flatnonzero(best > cut)
        return [(i, i + len(self), x, "+" if ahead else "-") for i, x, ahead in zip(at.tolist(), best[at].tolist(), (fwd[at] >= rev[at]).tolist(), strict=True)]

    def best_score(self, seq: str) -> float:
        fwd, rev = self.scores(seq)
        return float(max(fwd.max(), rev.max())) if len(fwd) else float("-inf")

    def emit(self, rng: np.random.Generator) -> str:
        return "".join(BASES[rng.choice(4, p=f / f.sum())] for f in self.fractions)

    def best_words(self, least: float) -> list[tuple[str, float]]:
        """All words that score at least ``least``, highest first; prefixes that can't reach it are cut off."""
        r = self.ratios
        ahead = np.concatenate([np.cumsum(r.max(1)[::-1])[::-1], [0]])
        found: list[tuple[str, float]] = []

        def grow(word: str, score: float):
            i = len(word)
            if score + ahead[i] < least:
                return
            if i == len(self):
                found.append((word, score))
                return
            for b, x in zip(BASES, r[i], strict=True):
                grow(word + b, score + x)

        grow("", 0.0)
        return sorted(found, key=lambda x: (-x[1], x[0]))


def pfm(seqs: DataFrame, group: str, seq: str = "seq") -> DataFrame:
    """(group, pos, letter, cnt) over all sequences of a group, short ones padded with ``-`` to its longest."""
    # One pass: a sequence gives its letters and, one place behind them, a mark without a letter. The marks up to a place are padding.
    letters = F.concat(F.filter(F.split(F.col(seq), ""), lambda x: x != ""), F.array(F.lit("")))
    counts = seqs.select(F.col(group), F.posexplode(letters).alias("pos", "letter")).groupBy(group, "pos", "letter").agg(F.count("*").alias("cnt"))
    own = F.collect_list(F.when(F.col("letter") != "", F.struct("letter", "cnt"))).alias("__own")
    places = counts.groupBy(group, "pos").agg(own, F.sum(F.when(F.col("letter") == "", F.col("cnt"))).alias("__ended"))
    upto = F.sum("__ended").over(Window.partitionBy(group).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    padded = F.array(F.struct(F.lit("-").alias("letter"), F.coalesce(F.col("__upto"), F.lit(0)).alias("cnt")))
    rows = places.withColumn("__upto", upto).where(F.size("__own") > 0).select(group, "pos", F.inline(F.concat("__own", padded)))
    return rows.groupBy(group, "pos", "letter").agg(F.sum("cnt").alias("cnt")).where("cnt > 0")


def stable_sample(rows: DataFrame, group: str, seq: str = "seq", most: int = 20, seed: int = 1986) -> DataFrame:
    """(group, seq): up to ``most`` different sequences of each group, those of least seeded hash, the same on every run. Each task
    keeps its own least ones before anything is shuffled."""
    order = Window.partitionBy(group).orderBy(F.xxhash64(F.lit(seed), seq), seq)
    some = rows.where(f"{seq} <> ''").select(group, seq).distinct().withColumn("__k", F.row_number().over(order))
    return some.where(F.col("__k") <= most).drop("__k")


def aligned(rows: DataFrame, group: str, seq: str = "seq", most: int = 20, gap: int = -2) -> DataFrame:
    """(group, seq, aligned): a multiple alignment of the ``stable_sample`` of each group, by the centre star: all others are aligned to
    the one nearest to them all. Aligned texts of a group are of one length; a group has ``most`` rows, so a task's state is small."""
    kind = rows.schema[group].dataType.simpleString()

    def star(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(seq)
        return f.assign(aligned=centre_star(f[seq].tolist(), gap))[[group, seq, "aligned"]]

    return stable_sample(rows, group, seq, most).groupBy(group).applyInPandas(star, f"{group} {kind}, {seq} string, aligned string")


def consensus(counts: DataFrame, group: str) -> DataFrame:
    """The commonest letter of each place, the first in the alphabet on a tie."""
    best = F.row_number().over(Window.partitionBy(group, "pos").orderBy(F.desc("cnt"), "letter"))
    return counts.withColumn("rn", best).where("rn = 1").select(group, "pos", "letter", "cnt")


def degenerate_consensus(counts: DataFrame, *group: str) -> DataFrame:
    """(group, pos, letter): the base of over half and twice the next, else the code of two with over three quarters, else that of
    three if the fourth never occurs, else N (Cavener 1987). Letters other than bases don't count."""
    rows = counts.where(F.col("letter").isin(*BASES)).groupBy(*group, "pos").agg(*(F.coalesce(F.sum(F.when(F.col("letter") == b, F.col("cnt"))), F.lit(0)).alias(b) for b in BASES))
    ranked = F.sort_array(F.array(*(F.struct(F.col(b).alias("c"), F.lit(b).alias("b")) for b in BASES)), asc=False)
    codes = {"".join(sorted(x)): c for c, x in IUPAC.items() if c != "U"}
    code = F.create_map(*(F.lit(x) for p in codes.items() for x in p))

    def letter(r):
        name = lambda k: code[F.array_join(F.sort_array(F.transform(F.slice(r, 1, k), lambda x: x["b"])), "")]
        total = r[0]["c"] + r[1]["c"] + r[2]["c"] + r[3]["c"]
        sure = (2 * r[0]["c"] > total) & (r[0]["c"] > 2 * r[1]["c"])
        return F.when(sure, r[0]["b"]).when(4 * (r[0]["c"] + r[1]["c"]) > 3 * total, name(2)).when(r[3]["c"] == 0, name(3)).otherwise("N")

    return rows.select(*group, "pos", F.transform(F.array(ranked), letter)[0].alias("letter"))


HITS = "array<struct<start:int,end:int,score:double,strand:string>>"


def scanner(motif: Motif, factor: float = 0.7):
    """A pandas UDF: hits of a motif in each sequence."""

    @F.pandas_udf(HITS)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([[dict(zip(("start", "end", "score", "strand"), h, strict=True)) for h in motif.scan(x, factor=factor)] if x else [] for x in s])

    return run


def best_scorer(motif: Motif):
    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([motif.best_score(x) if x else float("-inf") for x in s], dtype=float)

    return run


def best_scores(motifs: list[Motif]):
    """A pandas UDF: the best score of each motif in each sequence, all from one reading of the sequence."""

    @F.pandas_udf("array<double>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([[m.best_score(x) if x else float("-inf") for m in motifs] for x in s])

    return run


def sitemap(probes: DataFrame, motifs: dict[str, Motif], factor: float = 0.7) -> DataFrame:
    """(probe_id, motif, start, end, score, strand) of all hits of labelled motifs."""
    out = None
    for name, m in motifs.items():
        rows = probes.select("probe_id", F.lit(name).alias("motif"), F.inline(scanner(m, factor)("seq")))
        out = rows if out is None else out.unionByName(rows)
    return out


def kmer_counts(seqs: DataFrame, k: int, seq: str = "seq") -> DataFrame:
    """(w, cnt) of all runs of k letters as they stand. Some megabytes of text are counted at once by numbers of their letters, and
    only different words leave the task."""

    def run(batches):
        for b in batches:
            held, size = [], 0
            for text in [*b.column(0).to_pylist(), None]:
                if text is not None and len(text) >= k:
                    held.append(text)
                    size += len(text)
                if held and (text is None or size >= 1 << 21):
                    yield from _words_of(held, k)
                    held, size = [], 0

    rows = seqs.select(F.upper(seq).alias("s")).mapInArrow(run, "w string, n long")
    return rows.groupBy("w").agg(F.sum("n").alias("cnt"))


def _words_of(texts: list[str], k: int):
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = np.flatnonzero(np.bincount(points))
    codes = np.searchsorted(letters, np.arange(letters[-1] + 1))[points]
    ends = np.cumsum([len(t) for t in texts])
    own = np.ones(len(points), dtype=bool)
    for j in range(1, k):  # runs that would reach into the next text
        own[ends - j] = False
    own = own[: len(points) - k + 1]
    n = len(letters)
    if n**k < 1 << 62:
        key = np.zeros(len(own), dtype=np.int64)
        for j in range(k):
            key = key * n + codes[j : j + len(own)]
        key = key[own]
        if n**k <= 1 << 22:
            count = np.bincount(key, minlength=1)
            words = np.flatnonzero(count)
            count = count[words]
        else:
            words, count = np.unique(key, return_counts=True)
        made = np.empty((len(words), k), dtype=np.uint32)
        for j in reversed(range(k)):
            words, made[:, j] = words // n, letters[words % n]
    else:
        made, count = np.unique(np.lib.stride_tricks.sliding_window_view(points, k)[own], axis=0, return_counts=True)
    for lo in range(0, len(made), 1 << 16):
        text = np.ascontiguousarray(made[lo : lo + (1 << 16)]).tobytes().decode("utf-32-le", "surrogatepass")
        yield pa.RecordBatch.from_arrays([pa.array([text[i : i + k] for i in range(0, len(text), k)], pa.string()), pa.array(count[lo : lo + (1 << 16)], pa.int64())], names=["w", "n"])


MOST_COUNTED = 11  # letters of the longest words that a task counts by a table of all of them


def canonical_counts(seqs: DataFrame, widths: Sequence[int], seq: str = "seq") -> DataFrame:
    """(k, key, w, cnt) of canonical k-mers of a few widths, MOST_COUNTED at most, in one pass; those with N are left out.

    A k-mer of bases is ``key``, its number to the base four, and a task counts these in a table of all k-mers, so what leaves it is bounded
    however much it reads; one that holds another letter is ``w``.
    """
    widths = sorted(set(widths))
    if widths and widths[-1] > MOST_COUNTED:
        raise ValueError(f"words have {MOST_COUNTED} letters at most")
    code = np.full(256, 4, dtype=np.int64)
    code[[ord(b) for b in BASES]] = range(4)

    def out(k: list, key: list, w: list, n: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(key, pa.int64()), pa.array(w, pa.string()), pa.array(n, pa.int64())], names=["k", "key", "w", "n"])

    def add(texts: list[str], counts: dict[int, np.ndarray]) -> None:
        letters = code[np.frombuffer("-".join(texts).encode("ascii", "replace"), np.uint8)]  # what parts two texts is no base
        bases = letters < 4
        key, whole = np.zeros(len(letters), dtype=np.int64), np.ones(len(letters), dtype=bool)
        for k in range(1, widths[-1] + 1):
            n = len(letters) - k + 1
            if n < 1:
                break
            key, whole = (key[:n] << 2) | (letters[k - 1 :] & 3), whole[:n] & bases[k - 1 :]
            if k in counts:
                counts[k] += np.bincount(key[whole], minlength=4**k)

    def run(batches):
        counts = {k: np.zeros(4**k, dtype=np.int64) for k in widths}
        for b in batches:
            odd: Counter = Counter()
            held, size = [], 0
            for text in [*b.column(0).to_pylist(), None]:
                if text:
                    held.append(text)
                    size += len(text)
                    for k in widths:
                        starts = {x for m in _OTHER.finditer(text) for x in range(max(0, m.start() - k + 1), min(m.start(), len(text) - k) + 1)}
                        odd.update(w for x in starts if "N" not in (w := text[x : x + k]))
                if held and (text is None or size >= 1 << 21):
                    add(held, counts)
                    held, size = [], 0
            if odd:
                yield out([len(w) for w in odd], [None] * len(odd), list(odd), list(odd.values()))
        for k, count in counts.items():
            found = np.flatnonzero(count)
            left, turned = found.copy(), np.zeros(len(found), dtype=np.int64)
            for _ in range(k):
                turned, left = (turned << 2) | (3 - (left & 3)), left >> 2
            least = np.minimum(found, turned)
            total = np.zeros(4**k, dtype=np.int64)
            np.add.at(total, least, count[found])
            found = np.flatnonzero(total)
            for lo in range(0, len(found), 1 << 16):
                own = found[lo : lo + (1 << 16)]
                yield out(np.full(len(own), k), own, [None] * len(own), total[own])

    rows = seqs.select(F.upper(seq).alias("s")).mapInArrow(run, "k int, key long, w string, n long")
    return rows.withColumn("w", canonical(F.col("w"))).groupBy("k", "key", "w").agg(F.sum("n").alias("cnt"))


def _kmer_of(k: int) -> Column:
    return F.coalesce("w", F.translate(F.lpad(F.conv(F.col("key").cast("string"), 10, 4), k, "0"), "0123", BASES)).alias("kmer")


def top_kmers(seqs: DataFrame, k: int, n: int | None = None, seq: str = "seq") -> DataFrame:
    """(kmer, cnt) of canonical k-mers, most frequent first, ties by k-mer; those with N are left out."""
    if k <= MOST_COUNTED:
        counts = canonical_counts(seqs, [k], seq).select(_kmer_of(k), "cnt")
    else:
        words = kmer_counts(seqs, k, seq).where(~F.contains("w", F.lit("N")))
        counts = words.groupBy(canonical(F.col("w")).alias("kmer")).agg(F.sum("cnt").alias("cnt"))
    return counts if n is None else counts.orderBy(F.desc("cnt"), "kmer").limit(n)


def top_kmers_of(seqs: DataFrame, widths: Sequence[int], n: int, seq: str = "seq") -> dict[int, DataFrame]:
    """``top_kmers`` of several widths; those of MOST_COUNTED letters at most are counted in one pass."""
    few = [k for k in widths if k <= MOST_COUNTED]
    counts = written(canonical_counts(seqs, few, seq), "kmers") if few else None
    top = lambda k: counts.where(F.col("k") == k).select(_kmer_of(k), "cnt").orderBy(F.desc("cnt"), "kmer").limit(n)
    return {k: top(k) if k in few else top_kmers(seqs, k, n, seq) for k in widths}


def pattern_match(probes: DataFrame, pattern: str) -> DataFrame:
    """(probe_id, hit): whether an IUPAC pattern occurs on either strand."""
    r = ambiguous_regex(pattern)
    s = F.upper("seq")
    return probes.select("probe_id", (s.rlike(r) | reverse_complement(s).rlike(r)).alias("hit"))


def enrichment(matches: DataFrame, subset: DataFrame) -> DataFrame:
    """(found, draws, marked, total, p): upper tail of the hits among a subset of the probes."""
    own = subset.select("probe_id").distinct().withColumn("own", F.lit(True))
    one = matches.join(own, "probe_id", "left").agg(F.count_if(F.col("hit") & F.col("own")).alias("found"), F.count_if(F.col("own")).alias("draws"), F.count_if("hit").alias("marked"), F.count("*").alias("total"))
    return one.withColumn("p", hypergeometric_tail_udf("found", "draws", "marked", "total"))


def group_specificity(scored: DataFrame, subset: DataFrame, top: int = 100) -> DataFrame:
    """Hypergeometric tail of a subset among all probes that score at least as high as the (top + 1)-th, ties included."""
    cut = scored.orderBy(F.desc("score"), "probe_id").limit(top + 1).agg(F.min("score").alias("cut"))
    hit = scored.crossJoin(F.broadcast(cut)).select("probe_id", (F.col("score") >= F.col("cut")).alias("hit"))
    return enrichment(hit, subset)


def site_histogram(probes: DataFrame, regex: str) -> DataFrame:
    """(n_sites, probes) of non-overlapping hits on the forward strand."""
    return probes.select(F.regexp_count(F.upper("seq"), F.lit(regex)).alias("n_sites")).groupBy("n_sites").agg(F.count("*").alias("probes"))


def markov(seqs: DataFrame, order: int, seq: str = "seq") -> DataFrame:
    """(kmer, cnt, p) of all (order + 1)-mers on both strands: p is the last letter's probability after the others, one count added
    to each letter."""
    one = kmer_counts(seqs, order + 1, seq).where("w RLIKE '^[ACGT]+$'")
    counts = one.select(F.explode(F.array("w", reverse_complement(F.col("w")))).alias("kmer"), "cnt").groupBy("kmer").agg(F.sum("cnt").alias("cnt"))
    prefix = F.sum("cnt").over(Window.partitionBy(F.expr(f"substring(kmer, 1, {order})")))
    return counts.withColumn("p", F.round((F.col("cnt") + 1) / (prefix + 4), 9))


def log_background(model: dict[str, float], seq: str, order: int) -> float:
    """log2 probability of a sequence's letters after the first ``order``."""
    return math.fsum(math.log2(model.get(seq[i - order : i + 1], 0.25)) for i in range(order, len(seq)))
