"""Motif discovery by expectation maximisation: zero or one occurrence a sequence, many seeds in one job a round.

A round sees a sequence's windows only by their words and their odds under a Markov background, which stay as they are. So a written
table holds, for each width, the different words of each sequence with the sum of their windows' odds; a word and its reverse
complement are one. A round's E step looks up each word's score and adds up by word, a few operations a word of a sequence and seed,
and a task sends back one small matrix for each seed. Wider seeds than TABLED are numbered in each round from the letters themselves.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paratope.operators import motif_table
from paratope.operators.motifs import BASES, MOST_COUNTED, Motif, best_scores, canonical_counts, group_specificity
from paratope.plans.shared import dropped, written

ROW = 1 << 15  # letters of a packed row, about; a round's arrays then fit a core's cache
TABLED = 8  # letters of the widest words that are summed once, before the rounds
FEW_ROWS = 16  # rows of a table that pass between Spark and Python at once
FEW = 1024  # matrices of a round that come to the driver one by one; more are added up before
_CODE = np.full(256, 4, dtype=np.int64)
for _i, _b in enumerate(BASES):
    _CODE[[ord(_b), ord(_b.lower())]] = _i


@dataclass
class Background:
    """log2 probabilities of a base after up to ``order`` others; ``tables[k]`` is indexed by the number of k + 1 letters in base 4."""

    tables: list[np.ndarray]

    @classmethod
    def of(cls, seqs: DataFrame, order: int) -> Background:
        """From all sequences on both strands, one count added to each base; 4 ** (order + 1) rows come to the driver."""
        if order + 1 > MOST_COUNTED:
            raise ValueError(f"the background has order {MOST_COUNTED - 1} at most")
        counts = [np.zeros(4 ** (k + 1)) for k in range(order + 1)]
        for r in canonical_counts(seqs, range(1, order + 2)).where("key IS NOT NULL").toLocalIterator():
            turned = reduce(lambda x, j: 4 * x + 3 - (r.key >> 2 * j) % 4, range(r.k), 0)
            for n in (r.key, turned):  # one that is its own reverse complement counts twice
                counts[r.k - 1][n] += r.cnt
        tables = [np.log2(((c + 1).reshape(-1, 4) / (c.reshape(-1, 4).sum(1, keepdims=True) + 4)).ravel()) for c in counts]
        return cls(tables)

    @classmethod
    def even(cls) -> Background:
        return cls([np.full(4, -2.0)])

    @property
    def order(self) -> int:
        return len(self.tables) - 1

    @property
    def bases(self) -> dict[str, float]:
        return dict(zip(BASES, (2.0 ** self.tables[0]).tolist(), strict=True))

    def windows(self, codes: np.ndarray, width: int) -> np.ndarray:
        """log2 probability that the background puts on each window and takes from what follows: that of the window and the
        ``order`` letters after it, given those before, less that of these letters by themselves. Other letters count 1/4."""
        n, k = len(codes), self.order
        after = np.zeros((k + 1, n))  # after[j]: each letter given the j before it, or as many as there are
        key = np.zeros(n, dtype=np.int64)
        known = np.ones(n, dtype=bool)
        for j in range(k + 1):
            shifted = np.full(n, 4, dtype=np.int64)
            shifted[j:] = codes[: n - j]
            known &= shifted < 4
            key += (shifted & 3) * 4**j
            after[j] = np.where(known, self.tables[j][key], after[j - 1] if j else -2.0)
        upto = np.concatenate([[0.0], np.cumsum(after[k])])
        alone = np.zeros(n + 1)
        for j in range(k):
            own = after[j]
            alone[: max(0, n - j)] += own[j:]
        at = np.arange(n - width + 1)
        return upto[np.minimum(n, at + width + k)] - upto[at] - alone[at + width]

    def odds(self, text: np.ndarray, width: int) -> np.ndarray:
        """The inverse of what ``windows`` gives, as an odd, for sequences with a mark (4) behind each: a letter and the ``order`` before
        it are one number in base 5, whose factors are looked up."""
        k = self.order
        if k > 6:
            return 2.0 ** -self.windows(text.astype(np.int64), width)
        own, after = _factors(tuple(t.tobytes() for t in self.tables))
        whole = np.concatenate([np.full(k, 4, np.uint8), text, np.full(k, 4, np.uint8)]).astype(np.int64)
        key = _sliding(whole, k + 1, lambda a, b, size: a * 5**size + b)
        n = len(text) - width + 1
        out = _sliding(own[key[: len(text)]], width, lambda a, b, size: a * b)
        for j in range(k):
            out = out * after[j][key[width + j : width + j + n]]
        return out


@lru_cache
def _factors(tables: tuple[bytes, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """By a letter and those before it in base 5 (4: no base): the inverse of its probability, and for each number of letters before it
    this over the inverse given those alone."""
    logs, k = [np.frombuffer(t) for t in tables], len(tables) - 1
    number = np.arange(5 ** (k + 1))
    key, known, upto = np.zeros(len(number), dtype=np.int64), np.ones(len(number), dtype=bool), []
    for j in range(k + 1):
        digit = number // 5**j % 5
        known = known & (digit < 4)
        key += (digit & 3) * 4**j
        upto.append(np.where(known, logs[j][key], upto[-1] if j else -2.0))
    return 2.0 ** -upto[k], [2.0 ** (upto[j] - upto[k]) for j in range(k)]


_PACKED = pa.schema([("part", pa.int32()), ("text", pa.binary()), ("size", pa.binary())])


def packed(seqs: DataFrame, background: Background) -> DataFrame:
    """A written table of packed rows for each part: the letters' codes with a mark behind each sequence, and the sequences' lengths,
    about ROW letters a row. Windows and their odds follow from these in each round, so a letter costs a byte before compression.
    Long sequences stay whole, one a row."""

    def run(batches):
        for part, text, size in _rows(batches, ROW):
            row = part, text.tobytes(), size.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _PACKED.types, strict=True)], schema=_PACKED)

    return _dealt(seqs, run, _PACKED, "letters", "zstd")


def _dealt(seqs: DataFrame, run, schema: pa.Schema, name: str, compression: str) -> DataFrame:
    """What ``run`` makes of (seq, part), dealt evenly, as a written table."""
    own = F.col("part").cast("int") if "part" in seqs.columns else F.lit(-1)
    kind = {pa.int32(): "int", pa.binary(): "binary"}
    texts = seqs.select("seq", own.alias("part")).where("seq <> ''").repartition(max(1, int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return written(texts.mapInArrow(run, ", ".join(f"{f.name} {kind[f.type]}" for f in schema)), name, compression=compression)


def _rows(batches, most: int):
    """(part, text, sizes) of some sequences of a part, about ``most`` letters: their codes with a mark behind each, and their lengths."""
    for b in batches:
        parts = np.asarray(b.column(1).fill_null(-1))
        for part in np.unique(parts).tolist():
            held, size = [], 0
            for s in [*b.column(0).filter(pa.array(parts == part)).to_pylist(), None]:
                if s is not None:
                    held.append(_CODE[np.frombuffer(s.encode("ascii", "replace"), np.uint8)].astype(np.uint8))
                    size += len(s)
                if held and (s is None or size >= most):
                    yield part, np.concatenate([x for codes in held for x in (codes, _MARK)]), np.array([len(x) for x in held], np.int64)
                    held, size = [], 0


@contextmanager
def _small_batches(spark):
    """While it holds, FEW_ROWS rows at most pass between Parquet, Spark and Python at once; they are long here."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    old = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, str(FEW_ROWS))
    try:
        yield
    finally:
        for n, x in zip(names, old, strict=True):
            spark.conf.set(n, x)


_SUMMED = pa.schema([("part", pa.int32()), ("words", pa.int32()), ("word", pa.binary()), ("odds", pa.binary()), ("many", pa.binary()), ("size", pa.binary())])


def summed(seqs: DataFrame, background: Background, width: int) -> DataFrame:
    """A written table of the words of some sequences for each part, of a width of at most TABLED: the words of each sequence that has some, by
    the number of the lesser of a word and its reverse complement, with the sum of their windows' odds, how many words a sequence has, and
    the sequences' lengths. The odds are single precision, so a word of a sequence costs six bytes before they are
    compressed, here and not by Parquet, so that a round's bytes stay few until they are looked at."""

    def run(batches):
        for part, text, sizes in _rows(batches, 4 * ROW):
            if (windows := _windows(text, sizes, width, background)) is None:
                continue
            _, word, odds, first, own = windows
            owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(word))))
            key, at = np.unique(owner * 4**width + _least(width)[word], return_inverse=True)
            owner, word = np.divmod(key, 4**width)
            packs = word.astype(np.uint16), np.bincount(at, weights=odds).astype(np.float32)
            row = part, len(word), *(pa.compress(x.tobytes(), codec="zstd", asbytes=True) for x in packs), np.bincount(owner).astype(np.int32).tobytes(), own.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _SUMMED.types, strict=True)], schema=_SUMMED)

    return _dealt(seqs, run, _SUMMED, "words", "uncompressed")


_MARK = np.array([4], dtype=np.uint8)


def _sliding(x: np.ndarray, width: int, join) -> np.ndarray:
    """What ``join`` makes of each ``width`` neighbours, by doubling; it takes two runs and the length of the later one."""
    n, out, at, size, left = len(x) - width + 1, None, 0, 1, width
    while True:
        if left & 1:
            part = x[at : at + n]
            out = part if out is None else join(out, part, size)
            at += size
        left >>= 1
        if not left:
            return out
        x = join(x[:-size], x[size:], size)
        size *= 2


def _keys(text: np.ndarray, width: int) -> np.ndarray:
    """The number, in base 4, of the letters of each window."""
    return _sliding((text & 3).astype(np.int64), width, lambda a, b, size: (a << 2 * size) | b)


@lru_cache
def _letters(width: int) -> np.ndarray:
    """All words of a width as codes, by their numbers."""
    return ((np.arange(4**width)[:, None] >> 2 * np.arange(width)[::-1]) & 3).astype(np.uint8)


@lru_cache
def _least(width: int) -> np.ndarray:
    """The number of the lesser of each word of a width and its reverse complement."""
    words = _letters(width).astype(np.int64)
    return np.minimum(np.arange(4**width), ((3 - words) << 2 * np.arange(width)).sum(1))


def _windows(text: np.ndarray, sizes: np.ndarray, width: int, background: Background):
    """The windows of bases of a packed row: their different words (codes; all of them if they are few), each window's word, the inverse
    of its background's odds, and where the windows of each sequence that has some begin, with its length."""
    n = len(text) - width + 1
    if n < 1:
        return None
    bad = np.concatenate([[0], np.cumsum(text > 3, dtype=np.int32)])
    plain = bad[width:] == bad[:-width]
    start = np.cumsum(sizes + 1) - sizes - 1
    many = np.diff(np.append(0, np.cumsum(plain))[np.minimum(n, np.append(start, len(text)))])
    if not many.any():
        return None
    odds = background.odds(text, width)[plain]
    if width <= 8:
        words, word = _letters(width), _keys(text, width)[plain]
    elif width <= 31:
        key, word = np.unique(_keys(text, width)[plain], return_inverse=True)
        words = ((key[:, None] >> 2 * np.arange(width)[::-1]) & 3).astype(np.uint8)
    else:
        rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, width)[plain])
        different, word = np.unique(rows.view(np.dtype((np.void, width))).ravel(), return_inverse=True)
        words = np.frombuffer(different.tobytes(), np.uint8).reshape(-1, width)
    own = many > 0
    return words, word, odds, (np.cumsum(many) - many)[own], sizes[own]


def _odds_of(matrix: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(len(matrix))
    return 2.0 ** matrix[at, words].sum(1), 2.0 ** matrix[::-1][at, 3 - words].sum(1)


def _expected(windows: tuple, both: np.ndarray, gamma: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights by word, and expected occurrences, log2-likelihood over the background and sequences of a packed row; ``both`` are the
    words' odds on either strand together."""
    words, word, odds, first, sizes = windows
    return _weighed(len(words), word, odds, first, np.diff(np.append(first, len(word))), sizes, both, gamma)


def _weighed(words: int, word: np.ndarray, odds: np.ndarray, first: np.ndarray, many: np.ndarray, sizes: np.ndarray, both: np.ndarray, gamma: float) -> tuple[np.ndarray, np.ndarray]:
    rate = gamma / sizes
    sums = np.add.reduceat(both[word] * odds, first) * rate
    whole = 1 - gamma + sums
    by_word = np.bincount(word, weights=odds * np.repeat(rate / whole, many), minlength=words)
    return by_word, np.array([(sums / whole).sum(), np.log2(whole).sum(), len(sizes)])


def _counts(words: np.ndarray, by_word: np.ndarray, forward: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Expected counts by place and base."""
    width = words.shape[1]
    counts = np.zeros((width, 4))
    for j in range(width):
        counts[j] += np.bincount(words[:, j], weights=by_word * forward, minlength=4)
        counts[width - 1 - j] += np.bincount(3 - words[:, j], weights=by_word * back, minlength=4)
    return counts


@dataclass
class _Search:
    """A seed's present state."""

    seed: str
    matrix: np.ndarray  # log2 probabilities
    gamma: float
    beta: float
    without: int | None  # the part of the sequences that this seed doesn't see
    counts: np.ndarray | None = None
    gain: float = 0.0
    rounds: int = 0
    done: bool = False

    def step(self, counts: np.ndarray, occurrences: float, gain: float, n: int, prior: float, bases: np.ndarray, stop: float, rounds: int) -> None:
        """The M step: counts with pseudocounts, a share of occurrences drawn towards the prior, and an end once the matrix stands
        still. Fixed values: four fifths prior to one fifth found."""
        self.counts, self.gain, self.rounds = counts, gain, self.rounds + 1
        column = counts.sum(1, keepdims=True)
        with np.errstate(divide="ignore"):
            new = np.log2((counts + self.beta * bases * column) / (column + self.beta))
        moved = float(np.sqrt(((2.0**self.matrix - 2.0**new) ** 2).sum()))
        self.matrix, self.gamma = new, 0.8 * prior + 0.2 * occurrences / max(1, n)
        self.done = moved <= stop or self.rounds >= rounds or not column.any()


def em(seqs: DataFrame, seeds: dict[str, Motif], background: Background, gamma: float = 0.2, beta: float | dict[str, float] = 0.001, stop: float = 1e-3, rounds: int = 499, without: dict[str, int] | None = None) -> dict[str, tuple[Motif, float, float, int]]:
    """{seed: (motif, share, gain, rounds)} of all seeds over the column ``seq``: the share of sequences with an occurrence, mixed with
    the prior ``gamma``, the log2-likelihood of the last round over the background's, and the rounds it took.

    A round is one job for all seeds that haven't ended. A seed ends when its matrix moves by ``stop`` at most. Null and empty
    sequences, those shorter than a seed and those without a window of bases take no part; if none is left a seed ends as it was.
    ``beta`` may differ between seeds. With a column ``part`` (a number), a seed in ``without`` doesn't see the sequences of that
    part, so that all folds of a cross-validation are searched together.
    """
    bases = np.array([background.bases[b] for b in BASES])
    with np.errstate(divide="ignore"):
        states = [_Search(name, np.log2(m.fractions), gamma, beta[name] if isinstance(beta, dict) else beta, (without or {}).get(name)) for name, m in seeds.items()]
    # One width after the other, so that one table is on disk at a time; all wide ones together.
    groups: dict[int, list[int]] = {}
    for i, s in enumerate(states):
        groups.setdefault(min(len(s.matrix), TABLED + 1), []).append(i)
    for width, own in groups.items():
        table = summed(seqs, background, width) if width <= TABLED else packed(seqs, background)
        _search(table, states, own, background, bases, gamma, stop, rounds)
        dropped(table)
    final = lambda s: seeds[s.seed] if s.counts is None or not s.counts.any() else Motif.from_counts(s.counts, background.bases, 0.001)
    return {s.seed: (final(s), s.gamma, s.gain, s.rounds) for s in states}


def _search(table: DataFrame, states: list[_Search], own: list[int], background: Background, bases: np.ndarray, gamma: float, stop: float, rounds: int) -> None:
    """Rounds of the states numbered ``own`` over their table, until all have ended."""
    tabled = len(states[own[0]].matrix) <= TABLED
    tasks = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while open_ := [i for i in own if not states[i].done]:
        now = [(i, states[i].matrix, states[i].gamma, states[i].without) for i in open_]

        def by_words(batches, now=now):
            sums: dict[int, list] = {}
            tables = {i: _odds_of(m, _letters(len(m))) for i, m, *_ in now}
            both = {i: forward + back for i, (forward, back) in tables.items()}
            for b in batches:
                for r in range(b.num_rows):
                    part, n = (b.column(c)[r].as_py() for c in range(2))
                    word, odds = (np.frombuffer(pa.decompress(b.column(c)[r].as_buffer(), n * np.dtype(t).itemsize, codec="zstd"), t) for c, t in ((2, np.uint16), (3, np.float32)))
                    many, sizes = (np.frombuffer(b.column(c)[r].as_buffer(), t) for c, t in ((4, np.int32), (5, np.int64)))
                    word, odds, first = word.astype(np.int64), odds.astype(np.float64), np.cumsum(many) - many
                    for i, matrix, share, other in now:
                        if part != other:
                            found = _weighed(4 ** len(matrix), word, odds, first, many, sizes, both[i], share)
                            sums[i] = [x + y for x, y in zip(sums[i], found, strict=True)] if i in sums else [*found]
            yield from _sent({i: (_counts(_letters(len(m)), sums[i][0], *tables[i]), sums[i][1]) for i, m, *_ in now if i in sums})

        def by_letters(batches, now=now):
            sums: dict[int, list] = {}
            for b in batches:
                for r in range(b.num_rows):
                    part, text, sizes = b.column(0)[r].as_py(), np.frombuffer(b.column(1)[r].as_buffer(), np.uint8), np.frombuffer(b.column(2)[r].as_buffer(), np.int64)
                    for width in sorted({len(m) for _, m, _, other in now if part != other}):
                        if (windows := _windows(text, sizes, width, background)) is None:
                            continue
                        for i, matrix, share, other in now:
                            if len(matrix) != width or part == other:
                                continue
                            forward, back = _odds_of(matrix, windows[0])
                            by_word, rest = _expected(windows, forward + back, share)
                            found = _counts(windows[0], by_word, forward, back)
                            sums[i] = [sums[i][0] + found, sums[i][1] + rest] if i in sums else [found, rest]
            yield from _sent(sums)

        sums = table.mapInArrow(by_words if tabled else by_letters, _SENT)
        found: dict[int, dict[int, float]] = {i: {} for i in open_}
        if tasks * len(open_) > FEW:
            sums = sums.groupBy("seed", "at").agg(F.sum("x").alias("x"))
        with _small_batches(table.sparkSession):
            came = sums.collect()
        for r in came:
            found[r.seed][r["at"]] = found[r.seed].get(r["at"], 0.0) + r.x
        for i, x in found.items():
            if not x:
                states[i].done = True
                continue
            flat = np.array([x[j] for j in range(len(x))])
            states[i].step(flat[:-3].reshape(-1, 4), flat[-3], float(flat[-2]), int(flat[-1]), gamma, bases, stop, rounds)


_SENT = "seed int, at int, x double"


def _sent(sums: dict[int, tuple[np.ndarray, np.ndarray]]):
    """What a task sends back: a row for each number."""
    for i, (counts, rest) in sums.items():
        flat = np.concatenate([counts.ravel(), rest])
        yield pa.RecordBatch.from_pydict({"seed": pa.array(np.full(len(flat), i, np.int32)), "at": pa.array(np.arange(len(flat), dtype=np.int32)), "x": pa.array(flat)})


def seed_matrices(texts: Sequence[str], background: Background, beta: float = 0.02) -> dict[str, Motif]:
    return {t: Motif.from_text(t, background.bases, beta) for t in texts}


def em_table(seqs: DataFrame, texts: Sequence[str], order: int = 2, **options) -> DataFrame:
    """(seed, consensus, share, gain, rounds) of seeds given as texts, with the sequences' own Markov background."""
    background = Background.of(seqs, order)
    found = em(seqs, seed_matrices(texts, background), background, **options)
    return seqs.sparkSession.createDataFrame([(t, m.consensus, float(share), float(gain), n) for t, (m, share, gain, n) in found.items()], "seed string, consensus string, share double, gain double, rounds int")


# ---------------------------------------------------------------- seeds and the whole search
def words_of_top_probes(probes: DataFrame, scores: DataFrame, n: int, width: int) -> list[str]:
    """Words of ``width`` bases that occur more than once in the ``n`` probes of highest score (probe_id, score), most frequent first,
    one of a word and its reverse complement."""
    top = scores.orderBy(F.desc("score"), "probe_id").limit(n).select("probe_id")
    counts = motif_table.top_kmers(probes.join(F.broadcast(top), "probe_id", "left_semi"), width).where("cnt > 1 AND kmer RLIKE '^[ACGT]+$'")
    return [r.kmer for r in counts.orderBy(F.desc("cnt"), "kmer").collect()]


def enriched_words(probes: DataFrame, subset: DataFrame, width: int, kept: int = 20) -> list[str]:
    """Of all words that the subset's probes hold the ``kept`` of least hypergeometric tail, all tried in one pass."""
    rows = motif_table.word_probes(probes, subset, width)
    return [r.motif for r in rows.orderBy("probe", "motif").limit(kept).collect()]


def discover(probes: DataFrame, subset: DataFrame, width: int = 7, seeds: Sequence[str] = (), top: int = 0, scores: DataFrame | None = None, enriched: int = 20, order: int = 2, factor: float = 0.7, **options) -> DataFrame:
    """Motifs of the subset's probes, by EM from given texts, from words of the ``top`` best scored probes and from the ``enriched``
    words; each with how it does among all probes.

    Returns (seed, consensus, share, gain, rounds, p, specificity, found): p is the hypergeometric tail of the subset's probes with
    a site of at least ``factor`` of the best score, ``specificity`` that of the subset among the hundred best probes and ``found``
    the subset's share with a site. The background is that of all probes.
    """
    texts = list(seeds)
    if top and scores is not None:
        texts += words_of_top_probes(probes, scores, top, width)
    if enriched:
        texts += enriched_words(probes, subset, width, kept=enriched)
    background = Background.of(probes, order)
    own = probes.join(subset.select("probe_id").distinct(), "probe_id", "left_semi")
    found = em(own, seed_matrices(dict.fromkeys(texts), background), background, **options)
    spark = probes.sparkSession
    named = {}
    for t, (m, *_) in found.items():
        try:
            named[t] = motif_table.matrix_words(m, factor)
        except ValueError:
            continue  # a matrix that says almost nothing: its words aren't counted
    tails = {r.motif: r for r in motif_table.evaluate_all(probes, subset, named).collect()}
    rows = []
    # A word's score on either strand is the same sum in another order: its last digits must not part probes that tie.
    scores = F.transform(best_scores([m for m, *_ in found.values()])("seq"), lambda x: F.round(x, 9))
    scored = written(probes.select("probe_id", scores.alias("scores")), "scores")
    for k, (t, (m, share, gain, n)) in enumerate(found.items()):
        r = tails.get(t)
        special = group_specificity(scored.select("probe_id", F.col("scores")[k].alias("score")), subset).first().p
        rows.append((t, m.consensus, float(share), float(gain), n, float(r.probe) if r else 1.0, float(special), float(r.share) if r else 0.0))
    dropped(scored)
    return spark.createDataFrame(rows, "seed string, consensus string, share double, gain double, rounds int, p double, specificity double, found double")
