"""Substring dedup over words by recompression.

Rounds name runs of equal symbols and then pairs (left, right), where a fixed
coin of its name makes every symbol left or right. Names are hashes of what they
stand for, hence the same in all documents without a dictionary, and a round
looks one symbol to either side. So equal word strings get the same symbols but
for some near their ends. For every symbol the words that settle it are known:
a symbol whose words all lie within a window is in every copy of that window.

Two exchanges follow. The first tells which symbols occur elsewhere; a window with a
settled symbol that doesn't can't repeat. In the second a window that is left goes by
its symbol string: the words before its settled symbols, those symbols, the words
behind them. Copies have the same string wherever they stand; all but the earliest
window of each string are covered. Strings are compared by 96 bits.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, counted, documents, mix, n_buckets, real_id, repeated_marks, total_bytes, unpack, word_hashes

#: Words in a window, and rounds of naming: a level-3 symbol has 2.4 words on average.
WINDOW, ROUNDS = 20, 3
_RUN, _LEFT, _RIGHT = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_COINS = np.random.default_rng(5).integers(1, 2**63, ROUNDS, dtype=np.uint64)
#: Further than any window: the text's end leaves a symbol unsettled.
FAR = np.int64(1) << 40


#: Stands after each text of a block; joins no run and no pair, and leaves what it would settle unsettled.
BAR = np.uint64(0)


def _runs(sym: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Names maximal runs. A run is settled by itself and the symbols beside it. Last: which symbols begin the new ones."""
    new = np.flatnonzero(np.r_[True, sym[1:] != sym[:-1]])
    n = np.diff(np.r_[new, len(sym)]).astype(np.uint64)
    name = np.where(n > 1, mix(sym[new] * _RUN + n), sym[new])
    before, after = np.r_[-FAR, low], np.r_[high, FAR]
    end = np.r_[new[1:], len(sym)]
    return name, before[new], after[end], new


def _pairs(sym: np.ndarray, low: np.ndarray, high: np.ndarray, level: int):
    """Names pairs of a left and a right symbol. A pair is settled by its two; a lone symbol by the neighbour it didn't take."""
    right = (mix(sym ^ _COINS[level]) & np.uint64(1)).astype(bool)
    word = sym != BAR
    pair = np.r_[~right[:-1] & right[1:] & word[:-1] & word[1:], False]
    second = np.r_[False, pair[:-1]]
    name = sym.copy()
    after = np.r_[sym[1:], BAR]
    name[pair] = mix(sym[pair] * _LEFT + after[pair] * _RIGHT)
    low_before, high_after = np.r_[-FAR, low[:-1]], np.r_[high[1:], FAR]
    lo = np.where(~pair & right, low_before, low)
    hi = np.where(pair | ~right, high_after, high)
    keep = np.flatnonzero(~second)
    return name[keep], lo[keep], hi[keep], keep


def parse(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, low, high, start) of the top symbols of texts with a BAR after each: words [low, high) settle a symbol, far off if
    a text's end has a say; start is its first word."""
    sym, low = words, np.arange(len(words), dtype=np.int64)
    high, start = low + 1, low
    for level in range(ROUNDS):
        for step in (_runs, lambda *x: _pairs(*x, level)):  # noqa: B023
            bar = sym == BAR
            sym, low, high, kept = step(sym, np.where(bar, -FAR, low), np.where(bar, FAR, high))
            start = start[kept]
    return sym, low, high, start


def split(text: str) -> list[bytes]:
    return text.encode().split()


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word hashes of the texts of at least WINDOW words, a BAR after each; which texts, and where each starts."""
    words = [split(t) for t in texts]
    own = np.array([i for i, w in enumerate(words) if len(w) >= WINDOW], np.int64)
    size = np.array([len(words[i]) + 1 for i in own], np.int64)
    start = np.cumsum(size) - size
    out = np.full(int(size.sum()), BAR, np.uint64)
    place = np.ones(len(out), bool)
    place[start + size - 1] = False
    out[place] = np.maximum(word_hashes(list(chain.from_iterable(words[i] for i in own))), np.uint64(1))
    return out, own, start


def _symbol_marks(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    h, own, _ = _joined(texts)
    sym, _, _, _ = parse(h)
    word = sym != BAR
    lens = np.zeros(len(texts), np.int64)
    lens[own] = np.bincount((np.cumsum(~word) - ~word)[word], minlength=len(own))
    return sym[word], lens, counted(lens), [b""] * len(texts)


class Strings:
    """Hashes of ranges of a sequence, by sums of its values times powers of an odd number (and its inverse modulo 2^64)."""

    def __init__(self, values: np.ndarray, factor: int):
        powers = lambda x: np.cumprod(np.r_[np.uint64(1), np.full(len(values), x, np.uint64)])
        self.back = powers(pow(factor, -1, 1 << 64))
        self.sums = np.r_[np.uint64(0), np.cumsum(mix(values) * powers(factor)[:-1])]

    def of(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[first]) * self.back[first] + (end - first).astype(np.uint64))


def window_names(h: np.ndarray, parsed: tuple, at: np.ndarray, begin: np.ndarray, end: np.ndarray, factor: int) -> np.ndarray:
    """The hash of each window's symbol string. at: first words of windows; begin, end: the bounds of their texts."""
    sym, low, high, start = parsed
    # a symbol that its text's start or end has a say in lies in no window
    text = np.searchsorted(end, start, side="left")
    low, high = np.where(low < 0, begin[text] - 1, low), np.where(high > len(h), end[text] + 1, high)
    bar = sym == BAR
    low, high = np.where(bar, start, low), np.where(bar, start + 1, high)
    i, j = np.searchsorted(low, at, side="left"), np.searchsorted(high, at + WINDOW, side="right")
    none = j <= i
    first, last = np.where(none, at, start[np.minimum(i, len(sym) - 1)]), np.where(none, at, np.r_[start, len(h)][j])
    words, symbols = Strings(h, factor), Strings(sym ^ _RUN, factor)
    i, j = np.where(none, 0, i), np.where(none, 0, j)
    return mix(words.of(at, first) * _LEFT + symbols.of(i, j) * _RIGHT + words.of(last, at + WINDOW))


def _window_marks(texts: list[str], hits: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list, np.ndarray]:
    """The windows that no lone symbol refutes."""
    h, own, start = _joined(texts)
    parsed = parse(h)
    sym, low, high, _ = parsed
    word = sym != BAR
    first = np.cumsum(np.bincount((np.cumsum(~word) - ~word)[word], minlength=len(own)))
    first = np.r_[0, first]
    met = [unpack(hits[i])[0].astype(np.int64) + a for i, a in zip(own.tolist(), first.tolist(), strict=False) if hits[i] is not None]
    lone = np.ones(int(word.sum()), bool)
    lone[np.concatenate(met) if met else np.empty(0, np.int64)] = False
    low, high = low[word], high[word]
    lone &= (low >= 0) & (high <= len(h)) & (high - low <= WINDOW)
    n = max(len(h) - WINDOW + 1, 0)
    refuted = np.zeros(n + 1, np.int64)
    np.add.at(refuted, np.clip(high[lone] - WINDOW, 0, n), 1)
    np.add.at(refuted, np.clip(low[lone] + 1, 0, n), -1)
    bars = np.r_[0, np.cumsum(h == BAR)]
    whole = bars[WINDOW : WINDOW + n] == bars[:n]  # no text ends in the window
    at = np.flatnonzero((np.cumsum(refuted[:n]) == 0) & whole)
    of = np.searchsorted(start, at, side="right") - 1
    lens = np.zeros(len(texts), np.int64)
    lens[own] = np.bincount(of, minlength=len(own))
    if not len(at):
        return np.empty(0, np.uint64), lens, at, [b""] * len(texts), np.empty(0, np.uint32)
    name, more = (window_names(h, parsed, at, start, np.flatnonzero(h == BAR), int(f)) for f in (_LEFT, _RIGHT))
    return name, lens, at - start[of], [b""] * len(texts), (more >> np.uint64(32)).astype(np.uint32)


def remove_later_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, kept, n_words, n_removed) of every row; kept holds the kept words, joined by one space.

    A word is removed if a 20-word window covers it whose words also start
    earlier: in a smaller doc_id (null is the smallest), or earlier in the same
    document. Texts under one doc_id are ordered by their hash; rows equal in id
    and text are one document and get the same answer. A null text has no words.
    Empty input: no rows. Extra columns are ignored. One plan without a cut: the
    shuffle of the texts is used for both joins.
    """
    body = documents(docs, text, key)
    buckets = n_buckets(total_bytes(body))
    symbols = repeated_marks(body, _symbol_marks, buckets, want_places=True).where("n_marks > 0").select(*KEY, "hits").dropDuplicates(KEY)
    windows = repeated_marks(body.join(symbols, KEY).select(*KEY, "text", "hits"), _window_marks, buckets, want_places=True, later=True, extra="hits", through=True)
    found = windows.where("n_hits > 0").select(*KEY, F.col("hits").alias("later")).dropDuplicates(KEY)

    def run(batches):
        for batch in batches:
            kept, n, gone = [], [], []
            for t, later in zip(batch["text"], batch["later"].to_pylist(), strict=True):
                words = split(t.as_py())
                n.append(len(words))
                if later is not None:
                    at = unpack(later)[0].astype(np.int64)
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + WINDOW, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]
                gone.append(n[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64())], names=["doc_id", "kept", "n_words", "n_removed"])

    joined = body.join(found, KEY, "left").select(*KEY, "text", "later")
    return joined.mapInArrow(run, "doc_id long, kept string, n_words long, n_removed long").withColumn("doc_id", real_id("doc_id"))


def summary(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
