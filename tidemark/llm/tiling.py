"""Benchmark decontamination by greedy string tiling (operator 5).

A document is contaminated by a benchmark item if tiles, common runs of at
least five words, cover at least half of the item's words. Tiles may lie in
any order, so a passage whose sentences were shuffled is found too.

Method. Texts are lower-cased and cut into words at white space and ASCII
punctuation. Rolling Karp-Rabin hashes of five words seed the search: the
document's distinct hashes are joined with those of the items, but for an
item's most common ones (the stem of a question) as long as the words of these
alone are short of the threshold: who shares no other can't reach it. A pair
whose seeds cannot reach the threshold is left, before any place of the
document is looked at; for the others the seeds are joined along diagonals to longest matches, the longest that is free in both texts is
marked, the parts of others that it covers are cut off, and so on until no
match of five words is left. The item's marked share is its coverage.

Scale. The benchmark is the stated query set: it goes to the tasks in blocks
of about ``BLOCK_BYTES`` of text, whatever its size, and each block is held
against every document. Blocks run one after the other and what each finds is
written, so the driver holds a few blocks and plans don't grow with their number.
A task holds a slice of text, a block, and the seeds of one pair at a time.
Documents are not paired, and not shuffled unless the benchmark has several
blocks: then :func:`decontaminate` joins them with what was found.

Edge cases. Null and empty texts match nothing; items shorter than five words
have no tiles and are never reported. An item_id in several rows counts with
its best coverage. Repeated documents are each reported, a row for each of
their rows, also without a doc_id. An empty benchmark or
table gives an empty result. Other columns of the table pass through
:func:`decontaminate`, whatever their names.
"""

from __future__ import annotations

import heapq
import string
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mapped, packed, settled, text_key
from tidemark.llm.textscan import SEPARATORS, Words, inside, ngrams, runs
from tidemark.session import scratch_path

MIN_TILE = 5
COVERAGE = 0.5
#: Bytes of benchmark text that go to the tasks at once.
BLOCK_BYTES = 8 << 20
_BITS = 20
#: Seeds of pairs that are expanded at once.
_PART = 1 << 20

_CUTS = SEPARATORS.copy()
_CUTS[list(string.punctuation.encode())] = True


def normal_words(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """Lower-cased words without punctuation, and their hashes."""
    w = Words(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")), _CUTS)
    return w, w.hash()


class Block:
    """Items of the benchmark, with their seeds.

    ``own``: seeds by item and place (those of item i from ``of[i]`` to ``of[i + 1]``);
    ``seeds``, ``item``: those that are looked up for candidates, in order of hash.
    """

    def __init__(self, rows: list[tuple[int | None, str | None]], min_tile: int, coverage: float = 0.0):
        w, self.hashes = normal_words(pa.array([t for _, t in rows], pa.string()))
        self.ids, self.first, self.k, self.coverage = [i for i, _ in rows], w.first, min_tile, coverage
        at = np.flatnonzero(inside(w, min_tile))
        self.own, item = ngrams(self.hashes, min_tile)[at], w.text[at]
        self.of = np.searchsorted(item, np.arange(len(rows) + 1))
        looked = np.flatnonzero(self._telling(item))
        looked = looked[np.argsort(self.own[looked], kind="stable")]
        self.seeds, self.item = self.own[looked], item[looked]
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[self.own >> np.uint64(64 - _BITS)] = True

    def _telling(self, item: np.ndarray) -> np.ndarray:
        """All seeds but each item's most common ones whose words together are short of the coverage."""
        _, at, n = np.unique(self.own, return_inverse=True, return_counts=True)
        times, out = n[at], np.ones(len(self.own), bool)
        for i in np.unique(item[times > 1]):
            a, b = self.of[i], self.of[i + 1]
            need, words = self.coverage * (self.first[i + 1] - self.first[i]), set()
            for place in np.argsort(-times[a:b], kind="stable"):
                words.update(range(place, place + self.k))
                if times[a + place] == 1 or len(words) >= need:
                    break
                out[a + place] = False
        return out

    def candidates(self, text: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """``text * items + item`` of the pairs that share a looked-up seed, in order, expanded in parts of bounded size."""
        low, high = (np.searchsorted(self.seeds, grams, side=s) for s in ("left", "right"))
        some = np.flatnonzero(high > low)
        text, low, n = text[some], low[some], (high - low)[some]
        part, out = np.cumsum(n) // _PART, [np.zeros(0, np.int64)]
        for s, m in zip(*runs(part), strict=True):
            x = slice(s, s + m)
            seed = np.repeat(low[x], n[x]) + _within(n[x])
            out.append(np.unique(np.repeat(text[x], n[x]) * len(self.ids) + self.item[seed]))
        return np.unique(np.concatenate(out))


def _within(n: np.ndarray) -> np.ndarray:
    """0.. to n - 1 for each n, one after the other."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def tiles(hits: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from all (document place, item place) of equal runs of k words: (document place, item place, length)."""
    order = np.lexsort((hits[:, 0], hits[:, 0] - hits[:, 1]))
    hits = hits[order]
    line = hits[:, 0] - hits[:, 1]
    new = np.r_[True, (line[1:] != line[:-1]) | (hits[1:, 0] != hits[:-1, 0] + 1)]
    start = np.flatnonzero(new)
    length = np.diff(np.r_[start, len(hits)]) + k - 1
    heap = [(-int(n), int(i), int(j)) for n, (i, j) in zip(length, hits[start], strict=True)]
    heapq.heapify(heap)
    in_doc, in_item, out = set(), set(), []
    while heap:
        n, i, j = heapq.heappop(heap)
        free = [x for x in range(-n) if i + x not in in_doc and j + x not in in_item]
        if len(free) == -n:
            out.append((i, j, -n))
            in_doc.update(range(i, i - n))
            in_item.update(range(j, j - n))
            continue
        at = 0
        for x in range(1, len(free) + 1):  # what is left of the match between marked words
            if x == len(free) or free[x] != free[x - 1] + 1:
                if x - at >= k:
                    heapq.heappush(heap, (at - x, i + free[at], j + free[at]))
                at = x
    return out


def covered(texts: pa.Array, block: Block, coverage: float) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """(text index, item index, tiles) of each text and item whose tiles reach the coverage."""
    k, items = block.k, len(block.ids)
    w, hashes = normal_words(texts)
    grams = ngrams(hashes, k)
    if not len(grams) or not len(block.seeds):
        return
    at = np.flatnonzero(block.maybe[grams >> np.uint64(64 - _BITS)])
    at = at[w.text[at] == w.text[at + k - 1]]
    at = at[np.lexsort((grams[at], w.text[at]))]
    text, own = w.text[at], grams[at]
    if not len(at):
        return
    new = np.r_[True, (text[1:] != text[:-1]) | (own[1:] != own[:-1])]
    begin = np.searchsorted(text, np.arange(len(texts) + 1))
    for t, i in zip(*np.divmod(block.candidates(text[new], own[new]), items), strict=True):
        part, size = slice(begin[t], begin[t + 1]), block.first[i + 1] - block.first[i]
        low, high = (np.searchsorted(own[part], block.own[block.of[i] : block.of[i + 1]], side=s) for s in ("left", "right"))
        place = np.flatnonzero(high > low)
        # the words that the seeds cover are at least those of the tiles
        if k + np.minimum(k, np.diff(place)).sum() < coverage * size:
            continue
        n = (high - low)[place]
        where = at[part][np.repeat(low[place], n) + _within(n)] - w.first[t]
        found = tiles(np.stack([where, np.repeat(place, n)], axis=1), k)
        if sum(x[2] for x in found) >= coverage * size:
            yield int(t), int(i), found


def blocks(benchmark: DataFrame, min_tile: int = MIN_TILE, coverage: float = COVERAGE, block_bytes: int | None = None) -> Iterator[Block]:
    """The benchmark in blocks of bounded size, each row in one."""
    rows, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("bigint").alias("i"), F.col("text").cast("string").alias("t")).toLocalIterator():
        rows.append((row.i, row.t))
        size += len(row.t or "") + 16
        if size >= (block_bytes or BLOCK_BYTES):
            yield Block(rows, min_tile, coverage)
            rows, size = [], 0
    if rows:
        yield Block(rows, min_tile, coverage)


_HIT = "doc_id bigint, k1 bigint, k2 bigint, item_id bigint, n_tiles bigint, longest_tile bigint, tiled_words bigint, item_words bigint"


def _hits(docs: DataFrame, found_in: Iterator[Block], coverage: float) -> DataFrame:
    """What each block finds, settled block by block: a row for each text, item and block, with the number of its rows."""
    names = [x.split()[0] for x in _HIT.split(", ")]
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = base.select("text", "doc_id", *text_key())

    def search(block: Block):
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            best: dict[tuple[int, int | None], tuple[float, tuple[int, ...]]] = {}
            for t, i, found in covered(batch.column(0), block, coverage):
                n = [x[2] for x in found]
                words = int(block.first[i + 1] - block.first[i])
                own, key = (sum(n) / words, (len(n), max(n), sum(n), words)), (t, block.ids[i])
                best[key] = max(best.get(key, own), own)
            ids = [batch.column(c).to_pylist() for c in (1, 2, 3)] if best else []
            rows = [(*(x[t] for x in ids), item, *own) for (t, item), (_, own) in best.items()]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else [[]] * len(names))], names=names)

        return run

    path, schema = scratch_path(docs.sparkSession, "tiles"), f"{_HIT}, copies bigint"
    docs.sparkSession.createDataFrame([], schema).write.parquet(path)
    for block in found_in:
        # each row of the table gives an item once; rows of equal doc_id and text are counted
        part = mapped(base, search(block), _HIT).groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
        part.write.mode("append").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, min_tile: int = MIN_TILE) -> DataFrame:
    """``doc_id, item_id, n_tiles, longest_tile, tiled_words, item_words, coverage`` of each contaminated document and item."""
    out = _hits(docs, blocks(benchmark, min_tile, coverage), coverage).withColumn("share", F.col("tiled_words") / F.col("item_words"))
    names = ["n_tiles", "longest_tile", "tiled_words", "item_words"]
    best = F.max(F.struct("share", *names)).alias("best")
    out = out.groupBy("doc_id", "k1", "k2", "item_id").agg(best, F.max("copies").alias("copies"))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return out.select("doc_id", "item_id", *[f"best.{c}" for c in names], F.col("best.share").alias("coverage"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, min_tile: int = MIN_TILE) -> DataFrame:
    """The documents that no item covers, with their own columns."""
    rows = packed(docs)
    schema = rows.schema

    def keep(block: Block):
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            ok = np.ones(batch.num_rows, bool)
            ok[[t for t, _, _ in covered(batch.column(1), block, coverage)]] = False
            return batch.filter(pa.array(ok))

        return run

    found_in = blocks(benchmark, min_tile, coverage)
    first, second = next(found_in, None), next(found_in, None)
    if second is None:
        return (mapped(rows, keep(first), schema) if first else rows).select("row.*")
    hits = _hits(docs, chain([first, second], found_in), coverage).select(F.col("k1").alias("h1"), F.col("k2").alias("h2")).distinct()
    keyed = rows.select("row", *text_key())
    return keyed.join(settled(hits, "contaminated"), (F.col("k1") == F.col("h1")) & (F.col("k2") == F.col("h2")), "left_anti").select("row.*")
