"""BPE encoding and decoding with public vocabularies: memoised units, and tree concatenation for long unsplit text.

A text is cut before white space that follows other text. No pre-tokenisation pattern here crosses such a place, so the ids of a
text are those of its units one after another, and a unit's ids are remembered. A unit longer than ``leaf`` characters is cut in
halves again and again, the leaves are encoded in parallel by a few threads, and neighbours are joined bottom-up: a window around
the join is encoded again and grows until its ids agree with both sides.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paratope.llm.common import resident

# White space as the vocabularies' patterns mean it (Unicode White_Space); \x1c-\x1f are not in it.
SPACE = "\t-\r \x85\xa0  -     　"
_KEEP = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_PLAIN = re.compile("[ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+[.,;:]?").fullmatch
_DROP = re.compile(f"[^{SPACE}]+")
MEMO = 2_000_000  # units remembered by a worker, about 200 bytes each
AGREE = 4  # ids that must be equal on either side of a join
EDGE = 4  # ids at a window's right edge that may differ because the window ends there
THREADS = 4  # that encode a long unit's leaves; the library gives up the interpreter's lock meanwhile


class Coder:
    """A vocabulary file of the tokenizers library, with a bounded memo of units (cleared when full; results don't depend on it)."""

    def __init__(self, path: str, leaf: int = 4096, memo: int = MEMO) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker has one core; threads only add to its work
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.leaf, self.limit = leaf, memo
        self.drops_space = self.tok.normalizer is not None
        self.memo: dict[str, bytes] = {}
        self.text_memo: dict[str, bytes] = {}
        self._bytes: list[bytes] | None = None

    # ------------------------------------------------ encoding
    def units(self, text: str) -> list[str]:
        if not self.drops_space:
            return _KEEP.findall(text)
        # str.split agrees with SPACE but for four control characters
        return _DROP.findall(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()

    def _learn(self, units: set[str]) -> None:
        memo = self.memo
        new = [u for u in units.difference(memo) if len(u) <= self.leaf]
        if len(memo) + len(new) > self.limit:
            memo.clear()
            self.text_memo.clear()
            new = [u for u in units if len(u) <= self.leaf]
        self._learn_words([u for u in new if _PLAIN(u)])
        rest = [u for u in new if u not in memo]
        for u, e in zip(rest, self.tok.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            memo[u] = array("I", e.ids).tobytes()

    def _learn_words(self, plain: list[str]) -> None:
        """Encode plain words as one text of lines, which costs far less than a call each. A word is one pre-token, a mark after
        it another, and so is a line end if white space is kept; if the count doesn't tally, nothing is learnt here."""
        for k in range(0, len(plain), 1000):
            some = plain[k : k + 1000]
            e = self.tok.encode("\n".join(some), add_special_tokens=False)
            parts = np.array([1 if u[-1].isalpha() else 2 for u in some]) + (not self.drops_space)
            last = np.cumsum(parts) - (not self.drops_space)
            words = e.word_ids
            if not words or words[-1] is None or words[-1] + 1 != last[-1]:
                continue
            words, raw = np.array(words), array("I", e.ids).tobytes()
            begin = (4 * np.searchsorted(words, last - parts + (not self.drops_space))).tolist()
            end = (4 * np.searchsorted(words, last)).tolist()
            self.memo.update(zip(some, [raw[i:j] for i, j in zip(begin, end, strict=True)], strict=True))

    def encode_many(self, texts: list[str], decimal: bool = False) -> Iterator[tuple[bytes, bytes | None]]:
        """The ids of each whole text as little-endian unsigned 32-bit integers; with ``decimal``, also as decimal numbers, each
        followed by a comma. What the texts share is encoded once."""
        split = [self.units(t) for t in texts]
        self._learn(set().union(*split))
        memo = self.memo
        for units in split:
            try:
                ids = b"".join([memo[u] for u in units])
            except KeyError:
                ids = b"".join([memo[u] if len(u) <= self.leaf else self.encode_unsplit(u) for u in units])
            yield ids, self._decimal(units) if decimal else None

    def encode(self, text: str) -> bytes:
        return next(self.encode_many([text]))[0]

    def encode_unsplit(self, text: str) -> bytes:
        """Ids of one long unit by tree concatenation."""
        return self._tree(text, *self._leaves(text))[0].astype("<u4").tobytes()

    def _leaves(self, text: str):
        cuts = [(0, len(text))]
        while any(b - a > self.leaf for a, b in cuts):
            cuts = [c for a, b in cuts for c in (((a, (a + b) // 2), ((a + b) // 2, b)) if b - a > self.leaf else ((a, b),))]
        return cuts, self._parts(text, cuts)

    def _parts(self, text: str, cuts: list[tuple[int, int]]):
        out, encode = [], lambda c: self.tok.encode(text[c[0] : c[1]], add_special_tokens=False)
        if len(cuts) > 1:
            with ThreadPoolExecutor(THREADS) as threads:
                found = list(threads.map(encode, cuts))
        else:
            found = [encode(cuts[0])]
        for (a, _), e in zip(cuts, found, strict=True):
            at = np.array(e.offsets, dtype=np.int64).reshape(-1, 2) + a
            out.append((np.array(e.ids, dtype=np.int64), at[:, 0], at[:, 1]))
        return out

    def _tree(self, text: str, cuts, parts):
        while len(parts) > 1:
            joined, spans = [], []
            for i in range(0, len(parts) - 1, 2):
                joined.append(self._join(text, cuts[i], parts[i], cuts[i + 1], parts[i + 1]))
                spans.append((cuts[i][0], cuts[i + 1][1]))
            if len(parts) % 2:
                joined.append(parts[-1])
                spans.append(cuts[-1])
            cuts, parts = spans, joined
        return parts[0]

    def _join(self, text: str, left, a, right, b):
        """Encode a window around the join again, larger and larger, until it agrees with both sides.

        Adjacent ids decide a byte-pair encoding: a sequence is the encoding of its text exactly if each neighbouring pair is
        the encoding of that pair's text. So once the window has ids of the left side at its start and ids of the right side
        further on, at the same places in the text, all pairs of the spliced sequence have been seen together.
        """
        width = 16
        while True:
            i = max(0, len(a[0]) - width)
            while i > 0 and a[2][i - 1] != a[1][i]:
                i -= 1
            j = min(len(b[0]), width)
            while j < len(b[0]) and b[2][j - 1] != b[1][j]:
                j += 1
            lo = int(a[1][i]) if i else left[0]
            hi = int(b[1][j]) if j < len(b[0]) else right[1]
            w = self._parts(text, [(lo, hi)])[0]
            starts = i == 0 or (len(w[0]) >= AGREE and len(a[0]) - i >= AGREE and all((x[:AGREE] == y[i : i + AGREE]).all() for x, y in zip(w, a, strict=True)))
            if starts and j == len(b[0]):
                return tuple(np.concatenate([x[:i], y]) for x, y in zip(a, w, strict=True))
            if starts:
                for k in range(len(w[0]) - EDGE - AGREE, 0, -1):
                    m = int(np.searchsorted(b[1], w[1][k]))
                    if m + AGREE <= j and all((x[k : k + AGREE] == y[m : m + AGREE]).all() for x, y in zip(w, b, strict=True)) and w[2][k - 1] == w[1][k]:
                        return tuple(np.concatenate([x[:i], y[:k], z[m:]]) for x, y, z in zip(a, w, b, strict=True))
            if i == 0 and j == len(b[0]):
                return w
            width *= 2

    def _decimal(self, units: list[str]) -> bytes:
        memo, texts = self.memo, self.text_memo
        out = []
        for u in units:
            d = texts.get(u)
            if d is None:
                ids = np.frombuffer(memo[u] if len(u) <= self.leaf else self.encode_unsplit(u), dtype="<u4").tolist()
                d = b"%s," % ",".join(map(str, ids)).encode() if ids else b""
                if len(u) <= self.leaf:
                    texts[u] = d
            out.append(d)
        return b"".join(out)

    # ------------------------------------------------ decoding
    def _table(self) -> list[bytes]:
        """Bytes of each id. Byte-level vocabularies write bytes as printable characters: visible Latin-1 ones stand for
        themselves, the other bytes for the characters from U+0100 on, in ascending order."""
        if self._bytes is None:
            seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
            rest = [b for b in range(256) if b not in set(seen)]
            back = {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(rest)}
            words = self.tok.get_vocab(with_added_tokens=True)
            added = {i: t.content for i, t in self.tok.get_added_tokens_decoder().items()}
            table = [b""] * (max(words.values()) + 1)
            for w, i in words.items():
                table[i] = added[i].encode() if i in added else bytes(back[c] for c in w)
            self._bytes = table
        return self._bytes

    def decode(self, ids: bytes) -> str:
        """The text of byte-level ids, as the library's decode(ids, skip_special_tokens=False) gives it."""
        table = self._table()
        return b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


def coder(path: str, memo: int = MEMO) -> Coder:
    """One coder a worker process."""
    return resident(("coder", path, memo), lambda: Coder(path, memo=memo))


def encoded(column: pa.Array, path: str, decimal: bool = False, rows: int = 256, memo: int = MEMO) -> Iterator[tuple[bytes, bytes | None]]:
    """``encode_many`` over a column of texts, ``rows`` at a time; null is the empty text."""
    for i in range(0, len(column), rows):
        yield from coder(path, memo).encode_many([t or "" for t in column.slice(i, rows).to_pylist()], decimal)


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Token ids and the decoded text of each document.

    Takes (doc_id, text); returns (doc_id, ids array<int>, decoded string), a row for each input row in no order. A null text is
    the empty text, which has no ids. Null and repeated ids pass through; other columns are ignored.
    """

    def run(batches):
        c = coder(path)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                ids = [x for x, _ in encoded(part.column(1), path)]
                arrays = pa.array([np.frombuffer(x, dtype="<u4").astype(np.int32) for x in ids], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), arrays, pa.array([c.decode(x) for x in ids])], names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """As ``encode_decode``, but only counts and SHA-256 digests leave the worker: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""

    def run(batches):
        c, sha = coder(path), hashlib.sha256
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for ids, decimal in encoded(b.column(1), path, decimal=True):
                n.append(len(ids) // 4)
                ids_sha.append(sha(decimal[:-1]).hexdigest())
                text_sha.append(sha(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
