"""Packing of token streams into training sequences (operator 4).

Documents are tokenized, closed by an end id, and laid into sequences of at
most ``length`` tokens with little padding. The result has a row for each
piece; every token lies in exactly one piece.

Method, bounded-space online packing: each partition keeps at most ``OPEN``
open windows. What is longer than a window fills windows of its own; the rest
goes to the open window that it fits best. If it fits none and all are open,
the fullest is emitted: with at most ``SLACK`` free tokens as it is, else
filled up with the document's head, and the search goes on with the rest. The
windows that are open at a partition's end are merged: those of ``MERGED``
partitions at a time are packed again, piece by piece, largest first.

Tokens. The tokenizer never joins across white space, so equal words have
equal ids: a worker keeps the ids of the words it has seen (``CACHED`` at
most, then it starts afresh) and tokenizes only new ones. A final mark of
punctuation after a Latin letter is looked up by itself, and letters are
lower-cased as the tokenizer would.

Scale. No text or id is shuffled; only the pieces of leftover windows move, a
bounded number for each group of partitions. Memory: one slice of text, the
word cache and the open windows. Sequence ids come from the partition, so a
rerun gives the same ones.

Edge cases. A null or empty text is its end id alone. Repeated rows are
packed each. An empty table gives no rows.
"""

from __future__ import annotations

import os
import string
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settled
from tidemark.llm.textscan import Words, lane, slices

LENGTH = 4096
END_ID = 2
OPEN, SLACK, MERGED = 16, 64, 32
CACHED = 1_000_000

FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
SCHEMA = ", ".join(f"{c} bigint" for c in FIELDS)

_LETTER = np.isin(np.arange(256), list(string.ascii_letters.encode()))
_MARK = np.isin(np.arange(256), list(b".,;:!?"))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Encoder:
    """Ids of texts by word lookup; exact for tokenizers that never join across white space and lower-case."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.keys, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        if len(self.keys) + len(keys) > CACHED:
            self.clear()
        got = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        count = np.array([len(x) for x in got], np.int64)
        first = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in got for i in x), np.uint32, count.sum())])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.first, self.count = np.insert(self.keys, at, keys), np.insert(self.first, at, first), np.insert(self.count, at, count)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and each text's number of ids."""
        w = Words(texts)
        data = w.data if b"<|" in w.data.tobytes() else _LOWER[w.data]
        marked = np.zeros(len(w), bool)
        long = np.flatnonzero(w.end - w.start > 1)
        marked[long] = _MARK[data[w.end[long] - 1]] & _LETTER[data[w.end[long] - 2]]
        times = 1 + marked
        start, end, text = np.repeat(w.start, times), np.repeat(w.end, times), np.repeat(w.text, times)
        mark = np.cumsum(times)[marked] - 1
        start[mark] = end[mark] - 1
        end[mark - 1] -= 1
        keys, at, back = np.unique(lane(0).hash(data, start, end), return_index=True, return_inverse=True)
        while True:
            known = np.searchsorted(self.keys, keys)
            new = known == len(self.keys) if not len(self.keys) else self.keys[np.minimum(known, len(self.keys) - 1)] != keys
            if not new.any():
                break
            if len(self.keys) + new.sum() > CACHED:  # all words of this slice must be in the cache together
                self.clear()
                new[:] = True
            self._learn(keys[new], [data[a:b].tobytes().decode() for a, b in zip(start[at[new]], end[at[new]], strict=True)])
        first, count = self.first[known][back], self.count[known][back]
        own = np.bincount(text, weights=count, minlength=len(texts)).astype(np.int64)
        spread = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return self.ids[spread], own


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Packer:
    """The open windows of one partition. Rows are ``FIELDS`` tuples; ``leftover`` returns those of windows still open."""

    def __init__(self, first_id: int, length: int = LENGTH):
        self.length, self.next = length, first_id
        self.free: list[tuple[int, int]] = []  # (free tokens, window), in order
        self.pieces: dict[int, list[tuple]] = {}
        self.done: list[tuple] = []

    def _put(self, window: int, free: int, piece: tuple) -> None:
        self.pieces[window].append((*piece, window, self.length - free))
        free -= piece[2]
        if free:
            insort(self.free, (free, window))
        else:
            self.done += self.pieces.pop(window)

    def _new(self) -> tuple[int, int]:
        window, self.next = self.next, self.next + 1
        self.pieces[window] = []
        return self.length, window

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, start = len(ids), 0

        def piece(n: int) -> tuple:
            return doc_id, start, n, zlib.crc32(ids[start : start + n].tobytes()), total

        while start < total:
            left = total - start
            if left >= self.length:
                free, window = self._new()
                n = self.length
            else:
                n, best = left, bisect_left(self.free, (left, -1))
                if best < len(self.free):
                    free, window = self.free.pop(best)
                elif len(self.free) < OPEN:
                    free, window = self._new()
                elif self.free[0][0] > SLACK:
                    free, window = self.free.pop(0)
                    n = free
                else:
                    self.done += self.pieces.pop(self.free.pop(0)[1])
                    free, window = self._new()
            self._put(window, free, piece(n))
            start += n

    def emit(self) -> list[tuple]:
        out, self.done = self.done, []
        return out

    def leftover(self) -> list[tuple]:
        return [x for w in sorted(self.pieces) for x in self.pieces[w]]


def _batch(rows: list[tuple], group: int | None) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(FIELDS)
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], pa.array([group] * len(rows), pa.int64())], names=[*FIELDS, "merge_group"])


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """A row (``FIELDS``) for each piece of each document of ``docs(doc_id, text)``; ``tokenizer`` is a file's path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer = Packer(part << 24, length)
        for batch in batches:
            for own in slices(batch):
                ids, count = encoder(tokenizer).encode(own.column(1))
                ends = np.cumsum(count)
                ids = np.insert(ids.astype("<u4"), ends, end_id)
                ends = ends + np.arange(1, len(ends) + 1)
                for doc_id, a, b in zip(own.column(0).to_pylist(), np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True):
                    packer.add(doc_id, ids[a:b])
                yield _batch(packer.emit(), None)
        yield _batch(packer.leftover(), part // MERGED)

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "sequence_id", "offset"], ascending=[False, True, True], ignore_index=True)
        first, used, free, place = (1 << 52) + (int(key[0]) << 24), [], [], []
        for n in rows["length"].tolist():
            best = bisect_left(free, (n, -1))
            room, window = free.pop(best) if best < len(free) else (length, len(used))
            if window == len(used):
                used.append(0)
            place.append((first + window, used[window]))
            used[window] += n
            if room > n:
                insort(free, (room - n, window))
        rows["sequence_id"], rows["offset"] = [p[0] for p in place], [p[1] for p in place]
        return rows[list(FIELDS)]

    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = settled(base.mapInArrow(run, f"{SCHEMA}, merge_group bigint"), "pieces")
    open_ones = pieces.where(F.col("merge_group").isNotNull())
    merged = open_ones.groupBy("merge_group").applyInPandas(merge, SCHEMA)
    return pieces.where(F.col("merge_group").isNull()).select(*FIELDS).unionByName(merged)
