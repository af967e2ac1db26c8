"""Removal of repeated passages by seed and extend (operator 3).

A window is ``length`` consecutive words of one document. A word goes if a
window over it has the same words as a window that starts earlier (in a
document of smaller id, or earlier in the same one). What goes are the maximal
repeats of ``length`` words or more, less their first occurrence. Windows are
judged on the input, not on what is left.

Method. Anchors are chosen by winnowing: of the ``length - SEED + 1`` seeds of
``SEED`` words in a window, the one with the least hash is the window's
anchor, so equal windows have equal anchors at equal places. An anchor speaks
for a run of neighbouring windows; its *span* is all their words.

1. Seed and extend. Anchors are shuffled by seed. Occurrences with equal
   seeds are extended both ways over their spans at once, by 128 bits of hash:
   occurrences with equal spans have all windows equal, so all but the first
   go whole. A seed that occurs once needs no more. Where one seed has
   different spans, the match ends inside of them, and only the first
   occurrence of each span is left to be looked at closer.
2. For those, and only those, the single windows are hashed (128 bits),
   shuffled and compared in the same way.
3. The ranges of a document are joined to its text, merged and cut out.

Scale. Between a sixth and a ninth of the words are anchors. Before each shuffle a
task keeps only the first occurrence of each anchor and span in a slice of
text, as later ones are already known to go; so a passage that stands in a
third of all documents gives a few rows for each slice, not one for each
occurrence. Texts are shuffled by document id only, once in the plan (the second join
reuses the exchange). Nothing is collected or paired.

Edge cases. A null text has no words. Rows that repeat a doc_id are separate
texts in the order of their content; null ids come last. Texts shorter than a
window lose nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import mapped
from tidemark.llm.textscan import Words, mix, ngrams, seed

LENGTH, SEED = 20, 5

_ANCHORS = "a bigint, b bigint, c bigint, id bigint, copy bigint, at int, n int, kind int"


def sliding_first_min(x: np.ndarray, width: int) -> np.ndarray:
    """Index of the first least value in each window of ``width``."""
    best, at, done = x, np.arange(len(x)), 1
    while done < width:
        step = min(done, width - done)
        left, right = best[: len(best) - step], best[step:]
        take = right < left
        best, at = np.where(take, right, left), np.where(take, at[step:], at[: len(at) - step])
        done += step
    return at


class Sums:
    """Hashes of any ranges of word hashes from running sums; equal words give equal hashes wherever they stand."""

    def __init__(self, words: np.ndarray, salt: int):
        base = int(seed(2000 + salt)) | 1
        n = len(words) + 1
        up = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, base, np.uint64)])
        self.down = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, pow(base, -1, 1 << 64), np.uint64)])
        self.sums = np.r_[np.uint64(0), np.cumsum(words * up[:-1])]

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] ^ mix((end - start).astype(np.uint64)))


def window_anchors(w: Words, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows with one anchor: first word of the run, number of windows, anchor's first word, seed hash."""
    none = np.zeros(0, np.int64)
    if len(w) < length:
        return none, none, none, np.zeros(0, np.uint64)
    hashes = w.hash()
    seeds = ngrams(hashes, k)
    at = sliding_first_min(seeds, length - k + 1)
    inside = np.flatnonzero(w.text[: len(at)] == w.text[length - 1 :])
    at = at[inside]
    if not len(at):
        return none, none, none, np.zeros(0, np.uint64)
    # an anchor lies inside its windows, so windows of one anchor are of one text
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1)])
    return inside[new], np.diff(np.r_[new, len(at)]), at[new], seeds[at[new]]


def _ranges(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching ranges of each text as one."""
    if not len(text):
        return text, start, end
    order = np.lexsort((start, text))
    text, start, end = text[order], start[order], end[order]
    reach = np.maximum.accumulate(end + text * (1 << 40)) - text * (1 << 40)
    new = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (start[1:] > reach[:-1])])
    return text[new], start[new], np.maximum.reduceat(end, new)


def _rows(batch: pa.RecordBatch, w: Words, text: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray, at: np.ndarray, n: np.ndarray, length: int) -> pa.RecordBatch:
    """Rows of ``_ANCHORS``: the slice's first occurrence of each key, and the ranges of words of the others."""
    ids = batch.column(batch.schema.get_field_index("id"))
    number = batch.column(batch.schema.get_field_index("copy"))
    value, second = ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False), number.to_numpy(zero_copy_only=False)
    by = np.lexsort((second, value))
    rank = np.empty(len(by), np.int64)  # equal for rows that repeat
    rank[by] = np.cumsum(np.r_[True, (value[by][1:] != value[by][:-1]) | (second[by][1:] != second[by][:-1])])
    place = at - w.first[text]
    order = np.lexsort((place, rank[text], c, b, a))
    text, a, b, c, at, n, place = (x[order] for x in (text, a, b, c, at, n, place))
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])][: len(a)])
    head = np.repeat(new, np.diff(np.r_[new, len(a)]))
    first = (rank[text] == rank[text[head]]) & (place == place[head])
    known_text, known_start, known_end = _ranges(text[~first], at[~first], (at + n + length - 1)[~first])
    own = [np.concatenate([x[first], y]) for x, y in ((text, known_text), (at, known_start))]
    size = np.concatenate([n[first], known_end - known_start])
    kind = np.repeat(np.array([0, 1], np.int32), [first.sum(), len(known_text)])
    # ranges that are known travel with the rest, each under a key of its own
    spare = mix(mix(value[known_text].astype(np.uint64) ^ seed(77)) + known_start.astype(np.uint64))
    keys = [np.concatenate([x[first], spare]).view(np.int64) for x in (a, b, c)]
    place = pa.array(own[0])
    return pa.RecordBatch.from_arrays(
        [*[pa.array(k) for k in keys], ids.take(place), number.take(place), pa.array(own[1] - w.first[own[0]], pa.int32()), pa.array(size, pa.int32()), pa.array(kind)],
        names=["a", "b", "c", "id", "copy", "at", "n", "kind"],
    )


def _anchor_rows(length: int, k: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = Words(batch.column(batch.schema.get_field_index("text")))
        at, n, anchor, seeds = window_anchors(w, length, k)
        sums = [Sums(w.hash(x), x).hash(at, at + n + length - 1) for x in (0, 1)]
        place = mix(sums[1] + (anchor - at).astype(np.uint64))  # the anchor's place in the span counts
        return _rows(batch, w, w.text[at] if len(at) else at, seeds, sums[0], place, at, n, length)

    return run


def _window_rows(length: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = Words(batch.column(batch.schema.get_field_index("text")))
        lists = batch.column(batch.schema.get_field_index("close"))
        flat = lists.flatten()
        text = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        at, n = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        start = np.repeat(at + w.first[text], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        text = np.repeat(text, n)
        one, two = (Sums(w.hash(x), x).hash(start, start + length) for x in (0, 1))
        return _rows(batch, w, text, one, two, np.zeros(len(start), np.uint64), start, np.ones(len(start), np.int64), length)

    return run


def _order() -> list[Column]:
    return [F.col("id").asc_nulls_last(), F.col("copy"), F.col("at")]


def _lists(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("id", "copy").agg(F.collect_list(F.struct("at", "n")).alias(name))


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Cuts each text's ranges out."""
    text = batch.column(batch.schema.get_field_index("text"))
    lists = batch.column(batch.schema.get_field_index("gone"))
    w = Words(text)
    flat = lists.flatten()
    own = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    at, n = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
    own, start, end = _ranges(own, at, at + n)
    gone = np.zeros(len(w) + 1, np.int64)
    np.add.at(gone, w.first[own] + start, 1)
    np.add.at(gone, w.first[own] + end, -1)
    gone = np.cumsum(gone)[:-1] > 0
    removed = np.bincount(w.text[gone], minlength=len(text))
    # kept words and one space after each, in one buffer
    keep = np.flatnonzero(~gone)
    data = np.concatenate([w.data, np.array([0x20], np.uint8)])
    size = w.end[keep] - w.start[keep] + 1
    first = np.cumsum(size) - size
    take = np.repeat(w.start[keep] - first, size) + np.arange(size.sum())
    if len(keep):
        take[first + size - 1] = len(w.data)
    out = data[take].tobytes()
    bounds = np.r_[0, np.cumsum(np.bincount(w.text[keep], weights=size, minlength=len(text)).astype(np.int64))]
    texts = [out[a : b - 1] if b > a else b"" for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    columns = [batch.column(batch.schema.get_field_index("id")), pa.array(w.count, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept"])


def _judged(rows: DataFrame, length: int) -> DataFrame:
    """``id, copy, at, n``; ``gone``: n words from there go; ``close``: n windows from there must be looked at one by one."""
    rows = rows.repartition("a")
    same = Window.partitionBy("a", "b", "c").orderBy(*_order())
    seeds = Window.partitionBy("a")
    rows = rows.withColumn("place", F.rank().over(same)).withColumn("mixed", F.min("b").over(seeds) != F.max("b").over(seeds))
    known = F.col("kind") == 1
    return rows.select(
        "id", "copy", "at", F.when(known | (F.col("place") == 1), F.col("n")).otherwise(F.col("n") + (length - 1)).alias("n"),
        (known | (F.col("place") > 1)).alias("gone"), (~known & (F.col("place") == 1) & F.col("mixed")).alias("close"),
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the kept words, one space between) of every row of ``docs(doc_id, text)``."""
    base = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = base.select("id", F.xxhash64("text").alias("copy"), "text")  # texts that share an id are told apart by hash
    judged = _judged(mapped(texts, _anchor_rows(length, k), _ANCHORS), length)
    close = _lists(judged.where("close"), "close")
    windows = mapped(_beside(texts, close, "inner"), _window_rows(length), _ANCHORS)
    gone = judged.where("gone").select("id", "copy", "at", "n").unionByName(_judged(windows, length).where("gone").select("id", "copy", "at", "n"))
    return mapped(_beside(texts, _lists(gone, "gone"), "left"), _cut, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def _beside(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    lists = lists.withColumnsRenamed({"id": "id2", "copy": "copy2"})
    return texts.join(lists, F.col("id").eqNullSafe(F.col("id2")) & (F.col("copy") == F.col("copy2")), how).drop("id2", "copy2")
