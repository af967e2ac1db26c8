"""Periodic runs of words by seed-and-extend on diagonals (operator 11).

A run is a stretch of consecutive words of one text with smallest period q
(words q apart are equal) and a length of at least ``max(MIN_LENGTH, 2 * q)``
that no neighbouring word extends. On the diagonal of lag q, which compares
each word with the one q later, such a stretch is a match of at least
``max(MIN_LENGTH - q, q)`` words: the guaranteed overlap of that lag.

Method. Lags are taken in brackets of doubling size.

1. Index: in a bracket of lags from ``lo`` on, every match of the guaranteed
   overlap holds a k-gram that starts at a multiple of some step, with
   ``k + step - 1`` no longer than the overlap (:func:`brackets`). K-grams have
   exact names: equal k-grams of one text have equal names (prefix doubling,
   which names a gram of 2k words by the pair of its halves; grams that occur
   once drop out early).
2. Enumerate: for each k-gram at a multiple of the step, its occurrences in
   the same text at the bracket's lags, found by two binary searches in the
   index.
3. Extend: a pair is extended both ways by the names (one step for each power
   of two). A table of the furthest word covered on each lag lets all other
   pairs of that stretch go unseen.
4. A stretch that several lags describe has its least lag as period; the other
   lags are multiples of it.

Scale. A bracket has ``n / step`` indexed k-grams with fewer than ``2 * step``
occurrences each in reach, so a text of n words gives O(n) pairs a bracket and
O(n log n) in all, whatever repeats in it (also if it is one word n times).
Texts are judged where they are read: no shuffle. Memory follows a slice of
about a megabyte of text, or one text if that is longer (about ``4 * log2(n)``
bytes a word).

Edge cases. A null or empty text has no words, no runs and an empty ``kept``.
Repeated rows are judged alike and stay repeated; null ids stay null. An empty
table gives an empty result. Columns other than the id and the text are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, mapped
from tidemark.llm.textscan import Words, mix

MIN_LENGTH = 12
#: Pairs that are held at once.
PAIRS = 1 << 22

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = "doc_id {id}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, kept string"


def brackets(longest: int, least: int = MIN_LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """``lo, hi, level, step``: lags of ``lo <= q < hi`` by k-grams of ``2**level`` words at multiples of ``step``."""
    lo = 1
    while 2 * lo <= longest:
        hi = 2 * lo
        overlap = min(max(least - q, q) for q in {lo, hi - 1, min(max(least // 2, lo), hi - 1)})
        level = max((overlap + 1).bit_length() - 2, 0)
        yield lo, hi, level, overlap - (1 << level) + 1
        lo = hi


class Names:
    """Names of the grams of 1, 2, 4, ... words of a slice: equal where the words are equal and in one text, -1 where nothing is."""

    def __init__(self, keys: np.ndarray):
        self.n = len(keys)
        self.levels = [self._named(np.arange(self.n), keys)]

    def _named(self, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = np.full(self.n + 1, -1, np.int32)
        if len(at):
            _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
            often = count > 1
            dense = np.cumsum(often) - 1
            kept = often[name]
            out[at[kept]] = dense[name[kept]]
        return out

    def level(self, j: int) -> np.ndarray:
        while len(self.levels) <= j:
            half, k = self.levels[-1], 1 << (len(self.levels) - 1)
            at = np.flatnonzero(half[: max(self.n - 2 * k + 1, 0)] >= 0)
            at = at[half[at + k] >= 0]
            self.levels.append(self._named(at, half[at].astype(np.int64) * (self.n + 1) + half[at + k]))
        return self.levels[j]

    def grow(self) -> None:
        """All levels that have a gram twice."""
        j = 0
        while (self.level(j) >= 0).any():
            j += 1

    def ahead(self, i: np.ndarray, lag: np.ndarray) -> np.ndarray:
        """How many words from ``i`` on equal those ``lag`` later."""
        to = i.copy()
        for j in range(len(self.levels) - 1, -1, -1):
            a, b = self.levels[j][to], self.levels[j][np.minimum(to + lag, self.n)]
            to[(a >= 0) & (a == b)] += 1 << j
        return to - i

    def behind(self, i: np.ndarray, lag: np.ndarray) -> np.ndarray:
        """How many words before ``i`` equal those ``lag`` later."""
        to = i.copy()
        for j in range(len(self.levels) - 1, -1, -1):
            back = to - (1 << j)
            a, b = self.levels[j][np.maximum(back, 0)], self.levels[j][np.maximum(back + lag, 0)]
            step = (back >= 0) & (a >= 0) & (a == b)
            to[step] = back[step]
        return i - to


def _pairs(name: np.ndarray, n: int, lo: int, hi: int, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """First words and lags of the occurrence pairs of one bracket, in parts of about ``PAIRS``."""
    at = np.flatnonzero(name >= 0)
    index = np.sort(name[at].astype(np.int64) * (n + 1) + at)
    seeds = at[at % step == 0]
    own = name[seeds].astype(np.int64) * (n + 1)
    first = np.searchsorted(index, own + np.minimum(seeds + lo, n))
    count = np.searchsorted(index, own + np.minimum(seeds + hi, n)) - first
    seeds, own, first, count = (x[count > 0] for x in (seeds, own, first, count))
    part = np.cumsum(count) // PAIRS
    for p in np.unique(part):
        s, f, c, o = (x[part == p] for x in (seeds, first, count, own))
        take = np.repeat(f - (np.cumsum(c) - c), c) + np.arange(c.sum())
        i = np.repeat(s, c)
        yield i, index[take] - np.repeat(o, c) - i


def _extended(names: Names, text: np.ndarray, i: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and lag of the stretches that hold the pairs, each once for a text and lag."""
    n = names.n + 1
    diagonal = np.unique(text[i].astype(np.int64) * n + lag, return_inverse=True)[1]
    key = diagonal * n + i
    order = np.argsort(key)
    key, i, lag = key[order], i[order], lag[order]
    end_of = np.r_[np.flatnonzero(np.diff(key // n)) + 1, len(key)]
    head = np.r_[0, end_of[:-1]]  # each diagonal's next pair
    found = []
    while len(head):
        a, q = i[head], lag[head]
        covered = a + names.ahead(a, q)  # the furthest word covered on each diagonal
        found.append((a - names.behind(a, q), covered + q, q))
        head = np.searchsorted(key, key[head] - a + covered)
        left = head < end_of
        head, end_of = head[left], end_of[left]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def find_runs(w: Words, least: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (word indices of the slice) and period of all runs, by start and period."""
    none = np.zeros(0, np.int64)
    names = Names(mix(w.hash() ^ mix(w.text.astype(np.uint64))))
    names.grow()
    found = [(none, none, none)]
    for lo, hi, level, step in brackets(int(w.count.max(initial=0)), least):
        if level < len(names.levels):
            for i, lag in _pairs(names.levels[level], names.n, lo, hi, step):
                start, end, q = _extended(names, w.text, i, lag)
                keep = end - start >= np.maximum(least, 2 * q)
                found.append((start[keep], end[keep], q[keep]))
    start, end, q = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    same = np.zeros(len(start), bool)
    same[1:] = (start[1:] == start[:-1]) & (end[1:] == end[:-1])
    start, end, q = start[~same], end[~same], q[~same]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def joined(w: Words, keep: np.ndarray) -> pa.Array:
    """Each text's words that ``keep`` marks, one space between."""
    at = np.flatnonzero(keep)
    data = np.concatenate([w.data, np.array([0x20], np.uint8)])
    size = w.end[at] - w.start[at] + 1
    first = np.cumsum(size) - size
    take = np.repeat(w.start[at] - first, size) + np.arange(size.sum())
    if len(at):
        take[first + size - 1] = len(w.data)
    out = data[take].tobytes()
    bounds = np.r_[0, np.cumsum(np.bincount(w.text[at], weights=size, minlength=len(w.count)).astype(np.int64))]
    texts = [out[a : max(b - 1, a)] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return pa.array(texts, pa.binary()).cast(pa.string())


def _judged(least: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = Words(batch.column(1))
        start, end, q = find_runs(w, least)
        gone = np.zeros(len(w) + 1, np.int64)
        np.add.at(gone, start + q, 1)
        np.add.at(gone, end, -1)
        of = w.text[start]
        runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - w.first[of], end - start, q)], fields=list(_RUN))
        offsets = np.r_[0, np.cumsum(np.bincount(of, minlength=len(w.count)))]
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs)
        kept = joined(w, np.cumsum(gone)[:-1] == 0)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(w.count, pa.int64()), lists, kept], names=["doc_id", "n_words", "runs", "kept"])

    return run


def periodic_runs(docs: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """``doc_id, n_words, runs, kept`` of every row of ``docs(doc_id, text)``.

    ``runs``: ``start`` (word number from 0), ``length``, ``period``, by start
    and period. ``kept``: the words that no run holds after its first period,
    one space between.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return mapped(rows, _judged(least), _SCHEMA.format(id=dict(rows.dtypes)["doc_id"]))


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in a tenth of the documents the words from some place on are made periodic.

    With ``h = crc32(decimal doc_id)`` and ``g = h div 10``: where ``h % 10`` is 0
    and the text has n > 0 words, each word ``i >= a`` becomes word
    ``a + (i - a) % p``, ``a = g % n``, ``p = 1 + (n - a) div (3 + g % 8)``.
    A document without an id stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    n = F.size(words).cast("bigint")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))

    def word(i: Column) -> Column:
        return F.get(F.col("w"), F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))

    chosen = F.coalesce(h % 10 == 0, F.lit(False)) & F.col("text").rlike(WORD)
    x = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    x = x.withColumn("w", F.when(chosen, words))
    x = x.withColumn("n", F.when(chosen, n)).withColumn("a", F.when(chosen, a)).withColumn("p", F.when(chosen, p))
    altered = F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), word), " ")
    return x.select("doc_id", F.when(F.col("w").isNotNull(), altered).otherwise(F.col("text")).alias("text"))
