"""Metrics of thousands of motifs at once, in one pass over the probes.

A motif is a set of words (an ambiguous text, a gapped word, or all words that a matrix scores above a threshold). Words with the same
significant places share a shape; at each place of a probe the letters of each shape are packed into one number and looked up in
the sorted words. A task adds up its probes, so a row for each motif and number of sites leaves it, whatever the probes' number.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from paratope.functions.sequences import IUPAC
from paratope.functions.stats import binomial_tails, chi2_tail, hypergeometric_tails
from paratope.operators.motifs import BASES, FLIP, MOST_COUNTED, Motif, top_kmers, top_kmers_of

MOST_WORDS = 1 << 20  # words looked up in one pass; more motifs take more passes
MOST_OF_ONE = 1 << 16  # words that a motif may stand for
RUN = 1 << 16  # letters looked at together
HELD = 1 << 20  # rows of a task that are held before they are added up
_CODE = np.full(256, 4, dtype=np.int64)
for _i, _b in enumerate(BASES):
    _CODE[[ord(_b), ord(_b.lower())]] = _i


def text_words(text: str) -> list[str]:
    """The words that an ambiguous text stands for; N (or a full stop) stays as a place that may hold anything."""
    options = ["N" if c in "N." else IUPAC.get(c, "") for c in text.upper()]
    size = int(np.prod([float(len(o)) for o in options])) if options else 0
    if not size or size > MOST_OF_ONE or set("".join(options)) == {"N"}:
        raise ValueError(f"{text!r} stands for {size} words")
    return ["".join(w) for w in product(*options)]


def matrix_words(motif: Motif, factor: float) -> list[str]:
    """The words that score at least ``factor`` of the matrix's best."""
    found = [w for w, _ in motif.best_words(factor * motif.best)]
    if len(found) > MOST_OF_ONE:
        raise ValueError(f"{len(found)} words score {factor} of the best")
    return found


@dataclass
class Words:
    """Words of many motifs by shape: for each, the significant places, sorted keys and the motif of each key."""

    names: list[str]
    widths: np.ndarray
    shapes: list[tuple[tuple[int, ...], int, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, motifs: dict[str, Sequence[str]]) -> Words:
        """Both strands of each word are entered, so that a site is found on either."""
        by: dict[tuple, tuple[list, list]] = {}
        widths = np.zeros(len(motifs), dtype=np.int64)
        for m, words in enumerate(motifs.values()):
            if len({len(w) for w in words}) != 1:
                raise ValueError("a motif's words have one length")
            widths[m] = len(words[0])
            for w in {x for word in words for x in (word, word.translate(FLIP)[::-1])}:
                at = tuple(i for i, c in enumerate(w) if c != "N")
                if len(at) > 31:
                    raise ValueError("a word has 31 significant places at most")
                key = 0
                for i in at:
                    key = key * 4 + BASES.index(w[i])
                keys, of = by.setdefault((at, len(w)), ([], []))
                keys.append(key)
                of.append(m)
        shapes = []
        for (at, width), (keys, of) in sorted(by.items()):
            k, m = np.array(keys, dtype=np.int64), np.array(of, dtype=np.int64)
            order = np.argsort(k, kind="stable")
            shapes.append((at, width, k[order], m[order]))
        return cls(list(motifs), widths, shapes)

    def sites(self, seqs: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(motif, sequence, sites, starts): how often each motif that occurs does so, without sites that begin inside one counted
        before, and with them."""
        pad = int(self.widths.max()) if len(self.widths) else 1
        raw = [np.frombuffer(s.encode("ascii", "replace"), np.uint8) for s in seqs]
        sizes = np.array([len(x) + pad for x in raw], dtype=np.int64)
        whole = int(sizes.sum())
        text, inside, owner = np.full(whole, 4, dtype=np.int64), np.zeros(whole, dtype=bool), np.repeat(np.arange(len(raw)), sizes)
        for x, at in zip(raw, (np.cumsum(sizes) - sizes).tolist(), strict=True):
            text[at : at + len(x)] = _CODE[x]
            inside[at : at + len(x)] = True
        runs: dict[int, tuple[np.ndarray, np.ndarray]] = {1: (text & 3, text < 4)}
        found, out = [], []
        for (at, width, *_), index in zip(self.shapes, self._indexes(), strict=True):
            n = whole - width + 1
            if n < 1:
                continue
            fits = inside[:n] & inside[width - 1 :]  # pads are as wide as any motif, so both ends lie in one sequence
            key = np.zeros(n, dtype=np.int64)
            for first, size in _stretches(at):
                letters, bases = _run(runs, size)
                fits &= bases[first : first + n]
                key = (key << 2 * size) | letters[first : first + n]
            place = np.flatnonzero(fits)
            lo, many = index.rows(key[place])
            total = int(many.sum())
            row = np.repeat(np.arange(len(place)), many)
            which = np.arange(total) - np.repeat(np.cumsum(many) - many, many) + lo[row]
            if index.alone:  # these motifs have one width and occur in no other shape: hits are sorted by a short number
                motif, place = index.local[which], place[row]
                order = np.argsort(motif, kind="stable")
                motif, place = index.motifs[motif[order]], place[order]
                out.append(_counted(motif, place, width, owner, whole, pad, len(raw)))
            else:
                found.append(index.of[which] * (whole + pad) + place[row])
        if found:
            motif, place = np.divmod(np.unique(np.concatenate(found)), whole + pad)
            out.append(_counted(motif, place, self.widths[motif], owner, whole, pad, len(raw)))
        if not out:
            return (np.zeros(0, dtype=np.int64),) * 4
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def _indexes(self) -> list[_Index]:
        """How keys are looked up, made once in a task."""
        if (made := self.__dict__.get("_made")) is None:
            shapes = np.zeros(len(self.widths), dtype=np.int64)
            for *_, of in self.shapes:
                shapes[np.unique(of)] += 1
            made = self.__dict__["_made"] = [_Index(len(at), keys, of, bool((shapes[of] == 1).all())) for at, _, keys, of in self.shapes]
        return made


class _Index:
    """The motifs of each key of a shape: by a table of all keys if these are few, else by search. ``alone``: no motif is in another shape
    and there are few, whose short numbers are ``local``."""

    def __init__(self, places: int, keys: np.ndarray, of: np.ndarray, alone: bool):
        self.keys, self.of = keys, of
        self.first = np.searchsorted(keys, np.arange(4**places + 1)) if places <= 10 else None
        self.motifs, local = np.unique(of, return_inverse=True)
        self.alone = alone and len(self.motifs) <= 1 << 16
        self.local = local.astype(np.uint16) if self.alone else None

    def rows(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key's motifs begin, and how many there are."""
        if self.first is not None:
            lo, hi = self.first[key], self.first[key + 1]
        else:
            lo, hi = np.searchsorted(self.keys, key, side="left"), np.searchsorted(self.keys, key, side="right")
        return lo, hi - lo


def _stretches(at: Sequence[int]) -> list[tuple[int, int]]:
    """(first, size) of the stretches of neighbouring places."""
    out: list[tuple[int, int]] = []
    for i in at:
        if out and sum(out[-1]) == i:
            out[-1] = out[-1][0], out[-1][1] + 1
        else:
            out.append((i, 1))
    return out


def _run(runs: dict[int, tuple[np.ndarray, np.ndarray]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of the ``size`` letters from each place on, and whether all are bases; shapes share them."""
    for k in range(2, size + 1):
        if k not in runs:
            letters, bases = runs[k - 1]
            runs[k] = (letters[:-1] << 2) | runs[1][0][k - 1 :], bases[:-1] & runs[1][1][k - 1 :]
    return runs[size]


def _counted(motif: np.ndarray, place: np.ndarray, width, owner: np.ndarray, whole: int, pad: int, seqs: int):
    """(motif, sequence, sites, starts) from hits by motif and place; ``width`` is one number or one for each hit."""
    one = motif * (whole + pad) + place
    width = np.broadcast_to(width, len(one))
    free = np.ones(len(one), dtype=bool)
    free[1:] = one[1:] - one[:-1] >= width[:-1]
    taken = free.copy()
    front = np.flatnonzero(free[:-1] & ~free[1:])  # only stretches of overlapping sites are followed
    while len(front):  # from each site on to the first one past its end, within stretches of overlapping sites
        front = np.searchsorted(one, one[front] + width[front])
        front = front[front < len(one)]
        front = front[~free[front]]
        taken[front] = True
    group = motif * seqs + owner[place]
    cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, dtype=np.int64)
    m, s = np.divmod(group[cut], max(1, seqs))
    return m, s, np.add.reduceat(taken.astype(np.int64), cut) if len(cut) else cut, np.diff(np.append(cut, len(group)))


_OUT = pa.schema([("motif", pa.int64()), ("own", pa.bool_()), ("sites", pa.int64()), ("starts", pa.int64()), ("probes", pa.int64()), ("bases", pa.int64())])


def site_histograms(probes: DataFrame, subset: DataFrame, motifs: dict[str, Sequence[str]], omit: DataFrame | None = None) -> DataFrame:
    """(motif, own, sites, starts, probes, bases): for each motif, how many probes of the subset and of the others hold how many sites.

    ``probes`` is (probe_id, seq). Probes without a site aren't listed; those in ``omit`` are left out; those without a text hold
    nothing. Sites lie on either strand; ``sites`` leaves out those that begin inside one counted before, ``starts`` doesn't.
    """
    rows = _marked(probes, subset, omit).select("own", "seq").where("seq <> ''")
    out = None
    for batch in _batches(motifs):
        words = Words.of(batch)

        def count(batches, words=words):
            kept: list[pa.Table] = []

            def summed():
                t = pa.concat_tables(kept).group_by(["motif", "own", "sites", "starts"]).aggregate([("probes", "sum"), ("bases", "sum")])
                return t.rename_columns(_OUT.names).cast(_OUT)

            for b in batches:
                own, seqs = np.asarray(b.column(0).cast(pa.int8())).astype(bool), b.column(1).to_pylist()
                lengths = np.array([len(s) for s in seqs], dtype=np.int64)
                ends = np.cumsum(lengths)
                lo = 0
                while lo < len(seqs):
                    hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + RUN, side="right")))
                    m, s, sites, starts = words.sites(seqs[lo:hi])
                    kept.append(pa.Table.from_arrays([pa.array(m), pa.array(own[lo:hi][s]), pa.array(sites), pa.array(starts), pa.array(np.ones(len(m), np.int64)), pa.array(lengths[lo:hi][s])], schema=_OUT))
                    lo = hi
                    if sum(map(len, kept[1:])) > HELD:
                        kept[:] = [summed()]
            if kept:
                yield from summed().to_batches()

        part = rows.mapInArrow(count, "motif long, own boolean, sites long, starts long, probes long, bases long")
        part = part.groupBy("motif", "own", "sites", "starts").agg(F.sum("probes").alias("probes"), F.sum("bases").alias("bases"))
        named = _names(probes.sparkSession, words.names)
        part = part.join(named, "motif").drop("motif").withColumnRenamed("name", "motif").select(*_OUT.names)
        out = part if out is None else out.unionByName(part)
    return probes.sparkSession.createDataFrame([], "motif string, own boolean, sites long, starts long, probes long, bases long") if out is None else out


def _names(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame(pd.DataFrame({"motif": np.arange(len(names)), "name": names}), "motif long, name string")


def _batches(motifs: dict[str, Sequence[str]]) -> Iterable[dict[str, Sequence[str]]]:
    batch, size = {}, 0
    for name, words in motifs.items():
        if batch and size + len(words) > MOST_WORDS:
            yield batch
            batch, size = {}, 0
        batch[name] = words
        size += len(words)
    if batch:
        yield batch


def _marked(probes: DataFrame, subset: DataFrame, omit: DataFrame | None) -> DataFrame:
    own = subset.select("probe_id").distinct().withColumn("own", F.lit(True))
    probes = probes.select("probe_id", "seq")
    if omit is not None:
        probes = probes.join(omit.select("probe_id"), "probe_id", "left_anti")
    return probes.join(own, "probe_id", "left").select(F.coalesce("own", F.lit(False)).alias("own"), F.coalesce("seq", F.lit("")).alias("seq"))


@F.pandas_udf(DoubleType())
def _hyper(found: pd.Series, draws: pd.Series, marked: pd.Series, total: pd.Series) -> pd.Series:
    return pd.Series(hypergeometric_tails(found.to_numpy(), draws.to_numpy(), marked.to_numpy(), total.to_numpy()))


@F.pandas_udf(DoubleType())
def _binomial(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
    return pd.Series(binomial_tails(k.to_numpy(), n.to_numpy(), p.to_numpy()))


@F.pandas_udf(DoubleType())
def _chi2(seen: pd.Series, every: pd.Series) -> pd.Series:
    return pd.Series([chi2_classes(s, e) for s, e in zip(seen, every, strict=True)], dtype=float)


def chi2_classes(seen: Sequence[float], every: Sequence[float]) -> float:
    """Chi-square tail of the classes of a subset against those of all. Folded from the right: a class that has fewer than five,
    seen or expected, is carried into the one before it; two classes stay at least."""
    total, own = sum(every), sum(seen)
    if not total or not own:
        return 1.0
    terms, carried = [], np.zeros(2)
    for i, pair in reversed(list(enumerate(zip(seen, (e * own / total for e in every), strict=True)))):
        carried = carried + pair
        if i < 2 or carried.min() >= 5:
            terms.append(tuple(carried))
            carried = np.zeros(2)
    return chi2_tail(sum((s - w) ** 2 / w for s, w in terms if w > 0), len(terms) - 1)


METRICS = ("probe", "site", "repeated", "base", "over_represented", "share", "chi2", "mncp", "roc_auc")


def totals(probes: DataFrame, subset: DataFrame, omit: DataFrame | None = None) -> DataFrame:
    """One row (draws, total, own_bases, all_bases)."""
    rows = _marked(probes, subset, omit)
    return rows.agg(F.count_if("own").alias("draws"), F.count("*").alias("total"), F.coalesce(F.sum(F.when(F.col("own"), F.length("seq"))), F.lit(0)).alias("own_bases"), F.coalesce(F.sum(F.length("seq")), F.lit(0)).alias("all_bases"))


def metrics(histograms: DataFrame, totals: DataFrame, by: Sequence[str] = ("motif",), site: int = 2, repeats: int = 2, cap: int = 4) -> DataFrame:
    """(by, found, marked, draws, total, probe, site, repeated, base, over_represented, share, chi2, mncp, roc_auc) of each motif that
    occurs, from its histogram.

    probe: hypergeometric tail of the subset's probes with a site. site: the same of probes with at least ``site`` starts. repeated:
    each probe counts ``repeats`` times, with as many of its sites at most. base: sites among bases. over_represented: binomial
    tail of the subset's sites, at most ``cap`` a probe, expected by its share of the bases. share: of the subset's probes. chi2: tail
    over classes of 0, 1, .. 5 and more sites. mncp and roc_auc: mean normalised conditional probability, and the share of pairs of
    a subset's and another probe in which the former has more sites, ties counting half. Of no draws, p is 1 and mncp too.
    """
    key = list(by)
    own, n, draws, total = F.col("own"), F.col("probes"), F.col("draws"), F.col("total")
    of = lambda c, v: F.coalesce(F.sum(F.when(c, v)), F.lit(0)).cast("long")
    # For each number of sites: probes of the subset and others with as many, the same of those with enough starts, and with more sites.
    many = F.col("starts") >= site
    levels = histograms.groupBy(*key, "sites").agg(of(own, n).alias("a"), of(~own, n).alias("b"), of(own & many, n).alias("a2"), of(many, n).alias("n2"))
    down = Window.partitionBy(*key).orderBy(F.desc("sites"))
    levels = levels.withColumns({"up_a": F.sum("a").over(down), "up_b": F.sum("b").over(down)}).crossJoin(F.broadcast(totals))
    others, both = total - draws, F.col("a") + F.col("b")
    times = lambda c, k: F.sum(c * (F.least("sites", F.lit(k)) if k else F.col("sites"))).cast("long")
    classes = [F.least("sites", F.lit(5)) == i for i in range(1, 6)]
    rows = levels.groupBy(*key).agg(
        F.sum("a").alias("found"), F.sum(both).alias("marked"), F.sum("a2").alias("f2"), F.sum("n2").alias("m2"),
        times(F.col("a"), repeats).alias("fr"), times(both, repeats).alias("mr"), times(F.col("a"), 0).alias("fb"), times(both, 0).alias("mb"),
        times(F.col("a"), cap).alias("fo"), times(both, cap).alias("mo"), F.array(*(of(c, F.col("a")) for c in classes)).alias("seen"), F.array(*(of(c, both) for c in classes)).alias("every"),
        F.sum(F.col("a") * (F.col("up_a") / draws) / ((F.col("up_a") + F.col("up_b")) / total)).alias("cond"),
        F.sum(F.col("a") * (others - F.col("up_b") + F.col("b") / 2)).alias("wins"), F.max("up_a").alias("a"), F.max("up_b").alias("b"),
    ).crossJoin(F.broadcast(totals))
    tail = lambda f, d, m, t: F.when(F.col(f) > 0, _hyper(F.col(f), d, F.col(m), t)).otherwise(1.0)
    zero = lambda listed, all_: F.concat(F.array(all_ - F.aggregate(listed, F.lit(0).cast("long"), lambda x, y: x + y)), listed).cast("array<double>")
    idle_own, idle_other = draws - F.col("a"), others - F.col("b")
    return rows.select(
        *key, "found", "marked", "draws", "total", tail("found", draws, "marked", total).alias("probe"), tail("f2", draws, "m2", total).alias("site"), tail("fr", repeats * draws, "mr", repeats * total).alias("repeated"),
        tail("fb", F.col("own_bases"), "mb", F.col("all_bases")).alias("base"), F.when(F.col("fo") > 0, _binomial("fo", "mo", F.col("own_bases") / F.col("all_bases"))).otherwise(1.0).alias("over_represented"),
        F.coalesce(F.try_divide(F.col("found"), draws), F.lit(0.0)).alias("share"), _chi2(zero(F.col("seen"), draws), zero(F.col("every"), total)).alias("chi2"),
        F.coalesce(F.try_divide(F.col("cond") + idle_own, draws), F.lit(1.0)).alias("mncp"), F.coalesce(F.try_divide(F.col("wins") + idle_own * idle_other / 2, draws * others), F.lit(0.5)).alias("roc_auc"),
    )


def evaluate_all(probes: DataFrame, subset: DataFrame, motifs: dict[str, Sequence[str]], omit: DataFrame | None = None, **options) -> DataFrame:
    """``metrics`` of many motifs, one pass over the probes for each MOST_WORDS words."""
    return metrics(site_histograms(probes, subset, motifs, omit), totals(probes, subset, omit), **options)


def best_thresholds(probes: DataFrame, subset: DataFrame, motifs: dict[str, Motif], factors: Sequence[float] = tuple(0.5 + i / 20 for i in range(10)), metric: str = "probe") -> DataFrame:
    """(motif, factor, p): for each matrix the share of its best score at which ``metric`` is least, the highest on a tie; all matrices
    and shares in one pass. Matrices that never occur are left out; shares at which one stands for over MOST_OF_ONE words too."""
    tried, names = {}, []
    for name, m in motifs.items():
        for f in factors:
            try:
                words = matrix_words(m, f)
            except ValueError:
                continue
            tried[str(len(names))] = words
            names.append((name, float(f)))
    spark = probes.sparkSession
    table = spark.createDataFrame([(str(i), n, f) for i, (n, f) in enumerate(names)], "motif string, name string, factor double")
    found = evaluate_all(probes, subset, tried).select("motif", F.col(metric).alias("p")).join(table, "motif")
    first = F.row_number().over(Window.partitionBy("name").orderBy("p", F.desc("factor")))
    return found.withColumn("rn", first).where("rn = 1").select(F.col("name").alias("motif"), "factor", "p")


# ---------------------------------------------------------------- where motifs come from
def all_words(k: int) -> dict[str, list[str]]:
    """Every word of k bases and its reverse complement as one motif, by the first of the two."""
    out = {}
    for letters in product(BASES, repeat=k):
        w = "".join(letters)
        if w <= w.translate(FLIP)[::-1]:
            out[w] = [w]
    return out


def frequent_words(seqs: DataFrame, widths: Iterable[int], n: int) -> dict[str, list[str]]:
    """The n most frequent words of each width (``seqs`` has a column seq), a few rows on the driver."""
    return {r.kmer: [r.kmer] for top in top_kmers_of(seqs, list(widths), n).values() for r in top.where("kmer RLIKE '^[ACGT]+$'").collect()}


def word_probes(probes: DataFrame, subset: DataFrame, width: int) -> DataFrame:
    """(motif, found, marked, draws, total, probe) of every word of ``width`` bases that the subset's probes hold on either strand, by the first
    of a word and its reverse complement: probes of the subset and of all with it, and the hypergeometric tail, as ``evaluate_all`` has
    them. A task counts words of up to MOST_COUNTED letters in a table of all of them."""
    if not 1 <= width <= 31:
        raise ValueError("a word has 1 to 31 letters")

    def out(key: np.ndarray, found: np.ndarray, marked: np.ndarray):
        for lo in range(0, len(key), 1 << 16):
            part = [pa.array(x[lo : lo + (1 << 16)].astype(np.int64)) for x in (key, found, marked)]
            yield pa.RecordBatch.from_arrays(part, names=["key", "found", "marked"])

    def run(batches):
        table = np.zeros((2, 4**width), dtype=np.int64) if width <= MOST_COUNTED else None
        for b in batches:
            mine, seqs = np.asarray(b.column(0).cast(pa.int8())).astype(bool), b.column(1).to_pylist()
            ends = np.cumsum([len(s) for s in seqs])
            lo = 0
            while lo < len(seqs):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + 16 * RUN, side="right")))
                owner, key = _canonical(seqs[lo:hi], width)
                words, size = None, 4**width
                if table is None:
                    words, key = np.unique(key, return_inverse=True)
                    size = max(1, len(words))
                owner, key = np.divmod(np.unique(owner * size + key), size)  # a probe counts once
                marked, found = (np.bincount(x, minlength=size) for x in (key, key[mine[lo:hi][owner]]))
                if table is None:
                    yield from out(words, found[: len(words)], marked[: len(words)])
                else:
                    table += found, marked
                lo = hi
        if table is not None:
            words = np.flatnonzero(table[1])
            yield from out(words, table[0][words], table[1][words])

    rows = _marked(probes, subset, None).where("seq <> ''").mapInArrow(run, "key long, found long, marked long")
    counts = rows.groupBy("key").agg(F.sum("found").alias("found"), F.sum("marked").alias("marked")).where("found > 0")
    letters = F.concat(*(F.substring(F.lit(BASES), (F.shiftright("key", 2 * j).bitwiseAND(3) + 1).cast("int"), F.lit(1)) for j in reversed(range(width))))
    one = counts.crossJoin(F.broadcast(totals(probes, subset)))
    return one.select(letters.alias("motif"), "found", "marked", "draws", "total", _hyper("found", "draws", "marked", "total").alias("probe"))


def _canonical(seqs: Sequence[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, key) of each window of bases: the lesser number, in base 4, of its letters and their reverse complement's."""
    raw = [_CODE[np.frombuffer(s.encode("ascii", "replace"), np.uint8)] for s in seqs]
    text = np.concatenate([x for codes in raw for x in (codes, [4])]) if raw else np.zeros(0, dtype=np.int64)
    n = max(0, len(text) - width + 1)
    owner = np.repeat(np.arange(len(raw)), [len(x) + 1 for x in raw])[:n]
    key, turned, plain = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for j in range(width):
        letter = text[j : j + n]
        key, turned = (key << 2) | (letter & 3), turned | ((3 - (letter & 3)) << 2 * j)
        plain &= letter < 4
    return owner[plain], np.minimum(key, turned)[plain]


def texts(listed: Iterable[str]) -> dict[str, list[str]]:
    """Ambiguous or gapped texts, such as those of ``functions.words``."""
    return {t: text_words(t) for t in listed}


def matrices(motifs: dict[str, Motif], factor: float = 0.7) -> dict[str, list[str]]:
    return {name: matrix_words(m, factor) for name, m in motifs.items()}


def scores(p: Column) -> Column:
    """-log10 of a tail, to four digits."""
    return F.round(F.abs(F.log10(F.greatest(p, F.lit(1e-299)))), 4)
