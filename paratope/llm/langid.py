"""Language identification: interpolated Kneser-Ney character models, one a language, stored in sorted hash arrays.

A model predicts the letters of a word one after another, and its end, from up to ``order`` - 1 symbols before it in the word.
The language of least cross-entropy per symbol wins. Held-out training documents calibrate the confidence and the rejection.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paratope.llm.common import BASE, crc_text, mix64, resident, small_batches, tidy

WORD = re.compile(r"[^\W\d_]+")
START, END = 2, 3
UNKNOWN = "und"


def words_in(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words' symbols with START and END, each symbol's place in its word and the word it is of."""
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    of = np.repeat(np.arange(len(words)), sizes)
    return codes, np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes), of


def _hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 0..order the hash of the n symbols that end at each place (places too near the front hold no meaning)."""
    out, acc = [np.zeros(len(codes), dtype=np.uint64)], np.zeros(len(codes), dtype=np.uint64)
    power = np.ones(1, dtype=np.uint64)
    for n in range(1, order + 1):
        moved = np.zeros(len(codes), dtype=np.uint64)
        moved[n - 1 :] = codes[: len(codes) - n + 1]
        acc = acc + (moved + np.uint64(1)) * power
        power = power * np.uint64(BASE)
        out.append(mix64(acc ^ np.uint64(n << 56)))
    return out


@dataclass
class Models:
    """Sorted hashes of n-grams and of contexts for each n, with a row of values for each: one value a language."""

    langs: list[str]
    order: int
    floor: float
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    scale: float = 1.0
    mean: dict[str, float] = field(default_factory=dict)
    limit: dict[str, float] = field(default_factory=dict)

    def word_bits(self, words: list[str]) -> np.ndarray:
        """Bits that each language's model needs for each word and its end."""
        codes, place, of = _symbols(words)
        h = _hashes(codes, self.order)
        at = np.flatnonzero(place > 0)
        p = np.full((len(at), len(self.langs)), self.floor)
        for n in range(1, self.order + 1):
            far = np.flatnonzero(place[at] >= n - 1)
            i = at[far]
            keys, weights = self.contexts[n - 1]
            k = np.minimum(np.searchsorted(keys, h[n - 1][i - 1]), len(keys) - 1)
            known = keys[k] == h[n - 1][i - 1]
            far, i, k = far[known], i[known], k[known]
            q = p[far] * weights[k]
            keys, parts = self.grams[n - 1]
            k = np.minimum(np.searchsorted(keys, h[n][i]), len(keys) - 1)
            q += np.where((keys[k] == h[n][i])[:, None], parts[k], 0)
            p[far] = q
        out = np.zeros((len(words), len(self.langs)))
        np.add.at(out, of[at], -np.log2(p))
        return out


def train(counts: dict[str, dict[str, int]], order: int) -> Models:
    """Interpolated Kneser-Ney models from word counts by language, with one discount an order: n1 / (n1 + 2 n2).

    Below the highest order an n-gram counts how many different symbols precede it; those at a word's front count occurrences.
    """
    langs = sorted(counts)
    alphabet = {c for w in counts.values() for word in w for c in word}
    made: list[list[dict]] = [[] for _ in range(order + 1)]
    for lang in langs:
        words = sorted(counts[lang])
        codes, place, of = _symbols(words)
        h, weight = _hashes(codes, order), np.array([counts[lang][w] for w in words], dtype=np.float64)[of]
        types = []
        for n in range(1, order + 1):
            i = np.flatnonzero(place >= max(1, n - 1))
            keys, first, back = np.unique(h[n][i], return_index=True, return_inverse=True)
            i0 = i[first]
            types.append({"key": keys, "raw": np.bincount(back, weights=weight[i]), "front": place[i0] == n - 1, "ctx": h[n - 1][i0 - 1], "suffix": h[n - 1][i0]})
        for n in range(order, 0, -1):
            t = types[n - 1]
            if n == order:
                c = t["raw"]
            else:
                up = types[n]
                before, size = np.unique(up["suffix"], return_counts=True)
                k = np.minimum(np.searchsorted(before, t["key"]), len(before) - 1)
                c = np.where(t["front"] & (n > 1), t["raw"], np.where(before[k] == t["key"], size[k], t["raw"]))
            once, twice = (c == 1).sum(), (c == 2).sum()
            d = once / (once + 2 * twice) if once else 0.5
            ctx, back = np.unique(t["ctx"], return_inverse=True)
            total, kinds = np.bincount(back, weights=c), np.bincount(back)
            made[n].append({"key": t["key"], "part": np.maximum(c - d, 0) / total[back], "ctx": ctx, "weight": np.bincount(back, weights=np.minimum(c, d)) / total, "kinds": kinds})
    m = Models(langs, order, 1.0 / (len(alphabet) + 2))

    def joined(rows, key, value, missing):
        keys = np.unique(np.concatenate([r[key] for r in rows]))
        out = np.full((len(keys), len(rows)), missing, dtype=np.float32)
        for j, r in enumerate(rows):
            out[np.searchsorted(keys, r[key]), j] = r[value]
        return keys, out

    for n in range(1, order + 1):
        m.grams.append(joined(made[n], "key", "part", 0.0))
        m.contexts.append(joined(made[n], "ctx", "weight", 1.0))
    return m


class Scorer:
    """Bits of words, remembered up to a bound (then forgotten all at once; results don't depend on it)."""

    def __init__(self, models: Models, memo: int = 400_000) -> None:
        self.models, self.bound = models, memo
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.bits = np.zeros((1024, len(self.models.langs)), dtype=np.float32)
        self.size = np.zeros(1024, dtype=np.int64)

    def _learn(self, words: set[str]) -> None:
        new = list(words.difference(self.at))
        if len(self.at) + len(new) > self.bound:
            self.clear()
            new = list(words)
        first = len(self.at)
        while len(self.size) < first + len(new):
            self.bits, self.size = np.concatenate([self.bits, np.zeros_like(self.bits)]), np.concatenate([self.size, np.zeros_like(self.size)])
        for lo in range(0, len(new), 20_000):
            some = new[lo : lo + 20_000]
            letters = np.array([any(c.isalpha() for c in w) for w in some])
            self.bits[first + lo : first + lo + len(some)] = np.where(letters[:, None], self.models.word_bits(some), 0)
            self.size[first + lo : first + lo + len(some)] = np.where(letters, [len(w) + 1 for w in some], 0)
        self.at.update(zip(new, range(first, first + len(new)), strict=True))

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each text and its bits per symbol by language."""
        split = [words_in(t) if t else [] for t in texts]
        self._learn(set().union(*split))
        n, bits = np.zeros(len(texts), dtype=np.int64), np.zeros((len(texts), len(self.models.langs)))
        for i, words in enumerate(split):
            if words:
                k = np.fromiter(map(self.at.__getitem__, words), dtype=np.int64, count=len(words))
                n[i], bits[i] = self.size[k].sum(), self.bits[k].sum(0, dtype=np.float64)
        return n, bits / np.maximum(n, 1)[:, None]


SHORT = 200  # symbols at which a text's own length adds as much spread to its cross-entropy as its kind


def _deviation(h: np.ndarray, n: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return (h - mean) * np.sqrt(n / (n + SHORT))


def calibrate(m: Models, lang: list[str], n: np.ndarray, h: np.ndarray) -> None:
    """Fit the confidence's scale by likelihood, and set for each language how far above its mean a cross-entropy may lie:
    half more than the farthest of its held-out documents, plus 1.5 bits, so texts that mix two languages stay and noise goes."""
    if not len(n):
        m.mean = dict.fromkeys(m.langs, 0.0)
        m.limit = dict.fromkeys(m.langs, float("inf"))
        return
    true = np.array([m.langs.index(x) for x in lang])
    best = h.argmin(1)

    def loss(scale):
        z = -(h - h.min(1, keepdims=True)) * np.minimum(n, SHORT)[:, None] * scale
        return -(z[np.arange(len(z)), true] - np.log(np.exp(z).sum(1))).mean()

    m.scale = float(min(2.0 ** np.arange(-8, 2), key=loss))
    for j, name in enumerate(m.langs):
        own = (true == j) & (best == j)
        m.mean[name] = float(h[own, j].mean()) if own.any() else 0.0
        m.limit[name] = float(1.5 * max(0.0, _deviation(h[own, j], n[own], m.mean[name]).max()) + 1.5) if own.any() else float("inf")


def fit(docs: DataFrame, train_filter, order: int = 4, max_docs: int = 2000) -> Models:
    """Models from at most about ``max_docs`` labelled documents a language (a bounded sample, chosen by a hash of the id), of
    which a fifth only calibrates. Rows with a null lang or text, or without a letter, teach nothing."""
    spark = docs.sparkSession
    rows = docs.where("lang is not null and text is not null").where(train_filter).select("lang", "text", F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1 << 30)).alias("u"))
    sizes = docs.where("lang is not null").where(train_filter).groupBy("lang").count()
    chosen = rows.join(F.broadcast(sizes), "lang").where(F.col("u") < F.least(F.lit(1.0), F.lit(float(max_docs)) / F.col("count")) * (1 << 30)).select("lang", "text", (F.pmod("u", F.lit(5)) == 0).alias("hold"))

    def count(batches):
        seen: dict[str, Counter] = {}
        for b in batches:
            for lang, text, hold in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if not hold:
                    seen.setdefault(lang, Counter()).update(w for w in words_in(text) if any(c.isalpha() for c in w))
        for lang, c in seen.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(c), pa.string()), "word": pa.array(list(c), pa.string()), "n": pa.array(list(c.values()), pa.int64())})

    with small_batches(spark):
        table = chosen.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    counts: dict[str, dict[str, int]] = {}
    for lang, word, n in zip(*(table.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
        counts.setdefault(lang, {})[word] = n
    if not counts:
        return Models([], order, 1.0)
    models = train(counts, order)
    del table, counts
    tidy()
    shared = spark.sparkContext.broadcast(models)
    names = models.langs

    def measure(batches):
        s = Scorer(shared.value)
        for b in batches:
            keep = [(x, t) for x, t, hold in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True) if hold and x in names]
            if keep:
                n, h = s.entropies([t for _, t in keep])
                yield pa.RecordBatch.from_pydict({"lang": pa.array([x for x, _ in keep]), "n": pa.array(n), "h": pa.array(list(h), pa.list_(pa.float64()))})

    with small_batches(spark):
        got = chosen.mapInArrow(measure, "lang string, n long, h array<double>").where("n > 0").orderBy("lang", "n", "h").toArrow()
    calibrate(models, got.column("lang").to_pylist(), np.array(got.column("n").to_pylist(), dtype=np.int64), np.array(got.column("h").to_pylist()).reshape(got.num_rows, len(names)))
    return models


def scorer(name: str, models: Models, memo: int = 400_000) -> Scorer:
    """The worker process's scorer of these models; it outlives a task, so words are scored once a worker."""
    return resident(("scorer", name), lambda: Scorer(models, memo))


def judge(s: Scorer, texts: list[str | None]):
    """Language, confidence, bits per symbol, rejection and number of symbols of each text."""
    m = s.models
    if not m.langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), np.ones(len(texts), bool), np.zeros(len(texts), np.int64)
    n, h = s.entropies(texts)
    j = h.argmin(1)
    best = h[np.arange(len(j)), j]
    z = np.exp(-(h - best[:, None]) * (np.minimum(n, SHORT)[:, None] * m.scale))
    mean, limit = np.array([m.mean[x] for x in m.langs])[j], np.array([m.limit[x] for x in m.langs])[j]
    return [m.langs[k] if c else UNKNOWN for k, c in zip(j, n, strict=True)], np.where(n > 0, 1 / z.sum(1), 0.0), best, (n == 0) | (_deviation(best, n, mean) > limit), n


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """(doc_id, lang_pred, score, cross_entropy, rejected) of each document of (doc_id, text), a row for each input row.

    A null text, or one without a letter, has lang_pred ``und``, score 0 and a null cross_entropy, and is rejected, as is every
    text if nothing was learnt. A text is also rejected if its cross-entropy under its best language lies beyond the calibrated
    limit. Ties go to the language that sorts first. Null and repeated ids pass through; other columns are ignored.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(models), uuid.uuid4().hex

    def run(batches):
        m = shared.value
        s = scorer(name, m)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                names, score, best, rejected, n = judge(s, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(best, mask=n == 0), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")


def accepted(docs: DataFrame, models: Models, memo: int = 100_000) -> DataFrame:
    """The rows of ``docs`` that ``identify`` doesn't reject, with all their columns; only the texts pass through Python."""
    shared, name = docs.sparkSession.sparkContext.broadcast(models), uuid.uuid4().hex

    @F.arrow_udf("boolean")
    def good(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        s = scorer(name, shared.value, memo)
        for texts in parts:
            kept = [~judge(s, texts.slice(lo, 256).to_pylist())[3] for lo in range(0, len(texts), 256)]
            yield pa.array(np.concatenate(kept) if kept else np.zeros(0, bool))

    return docs.where(good("text"))


def held_out(remainder: int = 1, folds: int = 3):
    return F.pmod(crc_text("doc_id"), F.lit(folds)) == remainder
