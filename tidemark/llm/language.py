"""Document scores by masked pseudo-likelihood (operator 10).

A window network predicts the class of every word from the classes on both
sides: ``softmax(tanh(L[left] + R[right] + b) W + c)``. A document's score is
the sum of the log-probabilities of its words, each masked itself.

Words are lower-cased and cut at white space and ASCII punctuation. Every
distinct word of the corpus is in the vocabulary, a Spark table of words and
counts that grows with the corpus. The network's ``VOCABULARY`` classes are a
boundary mark for the ends of a text, the most frequent words, each a class of
its own, and 16 classes by length for all other words.

Every word is predicted by three: the network (the probability of the word's
class times the word's share of the class in the corpus), the whole word on the
left and the whole word on the right. A word beside predicts by the other
places of the corpus where it stands (the masked place is never counted):
``(same + 1 / v) / (others + 1)``, with ``same`` of the ``others`` having the masked
word there and ``v`` the number of distinct words and the end of a text. Where the
word beside has a class of its own, or a text ends, the network takes its part,
as it sees that side as it is. The three are multiplied with a third of the
weight each: a geometric mean of probabilities, which adds up to one at most
over all words (Hoelder), so scores are log-probabilities and never too good.

Training covers every token of every document. The network sees a token
through the classes beside it only, so the counts of (left, right, token) hold
all there is to learn for it: tasks count them, Spark adds them up, and numpy
fits the network to the exact likelihood of the whole corpus, weighing each
cell by its count. That table has at most ``VOCABULARY**3`` cells (2 million) at
any input size, and tasks score by looking up the network's log-probabilities.
The words and what stands beside each are counted in Spark and grow with
the corpus. Fixed seeds and whole counts make runs repeatable.

Scale. Two passes count (words; cells), one scores; texts are never shuffled.
Word counts are combined for each slice and then by Spark. A word without a
class of its own is sent once, to the places of the same word: that gives its
share and what it predicts for the words on both sides. It holds at most one in
``VOCABULARY - SHAPES`` of all tokens, and Spark's windows spill. The words beside
are sent as 24 bits, so of ``others`` places about ``others / 2**24`` are taken for
the same by mistake. Terms are added up as whole billionths, in any order the same.

Edge cases. A null or empty text has no tokens, score 0 and a null mean. Rows
that repeat count and are scored each, and are context for each other. An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm.common import mapped, settled
from tidemark.llm.textscan import Words, mix
from tidemark.llm.tiling import normal_words

VOCABULARY, SHAPES = 128, 16
HIDDEN, STEPS, LEARN = 16, 120, 0.05


def _count_words(batch: pa.RecordBatch) -> pa.RecordBatch:
    w, hashes = normal_words(batch.column(batch.schema.get_field_index("text")))
    words, at, n = np.unique(hashes, return_index=True, return_counts=True)
    shape = np.minimum(w.end - w.start, SHAPES)[at]
    return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(shape, pa.int32()), pa.array(n, pa.int64())], names=["word", "shape", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, shape, n``: every distinct word's hash, length class and count."""
    counts = mapped(docs.select("text"), _count_words, "word bigint, shape int, n bigint")
    return settled(counts.groupBy("word").agg(F.min("shape").alias("shape"), F.sum("n").alias("n")), "words")


def _frequent(words: DataFrame, size: int = VOCABULARY) -> np.ndarray:
    top = words.orderBy(F.desc("n"), "word").limit(size - SHAPES - 1).collect()
    return np.sort(np.array([r.word for r in top], np.int64).view(np.uint64))


def vocabulary(docs: DataFrame, size: int = VOCABULARY) -> np.ndarray:
    """Hashes of the most frequent words, in order."""
    return _frequent(word_counts(docs), size)


def tokens(texts: pa.Array, frequent: np.ndarray) -> tuple[Words, np.ndarray]:
    """The token of each word: 1.. for frequent words, then a class by length."""
    w, hashes = normal_words(texts)
    at = np.searchsorted(frequent, hashes)
    known = frequent[np.minimum(at, max(len(frequent) - 1, 0))] == hashes if len(frequent) else np.zeros(len(w), bool)
    shape = VOCABULARY - SHAPES + np.minimum(w.end - w.start, SHAPES) - 1
    return w, np.where(known, 1 + at, shape)


def beside(w: Words, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the words left and right of each word; 0 beyond a text's ends."""
    left, right = np.zeros_like(values), np.zeros_like(values)
    if len(w) > 1:
        same = w.text[1:] == w.text[:-1]
        left[1:], right[:-1] = values[:-1] * same, values[1:] * same
    return left, right


def cells(texts: pa.Array, frequent: np.ndarray) -> tuple[Words, np.ndarray]:
    """The (left, right, token) cell of each word as one number; 0 beyond a text's ends."""
    w, token = tokens(texts, frequent)
    left, right = beside(w, token)
    return w, (left * VOCABULARY + right) * VOCABULARY + token


def cell_counts(docs: DataFrame, frequent: np.ndarray) -> np.ndarray:
    """How often each (left, right, token) stands in the corpus."""

    def count(batches):
        total = np.zeros(VOCABULARY**3, np.int64)  # of the task
        from tidemark.llm.textscan import slices

        for batch in batches:
            for part in slices(batch):
                total += np.bincount(cells(part.column(part.schema.get_field_index("text")), frequent)[1], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["cell", "n"])

    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "cell int, n bigint")
    got = counts.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # VOCABULARY**3 rows at most
    out = np.zeros(VOCABULARY**3)
    out[got["cell"].to_numpy()] = got["n"].to_numpy()
    return out.reshape(VOCABULARY, VOCABULARY, VOCABULARY)


class WindowNetwork:
    """Predicts a token from its left and right neighbour."""

    def __init__(self, counts: np.ndarray, hidden: int = HIDDEN, steps: int = STEPS):
        v, random = len(counts), np.random.default_rng(0)
        self.left, self.right = (random.normal(0, 0.3, (v, hidden)).astype(np.float32) for _ in "lr")
        self.bias, self.out = np.zeros(hidden, np.float32), random.normal(0, 0.3, (hidden, v)).astype(np.float32)
        unigram = counts.sum(axis=(0, 1)) + 1
        self.prior = np.log(unigram / unigram.sum()).astype(np.float32)
        seen = counts.sum(axis=2)
        total = seen.sum()
        if not total:
            return
        l, r = np.nonzero(seen)  # noqa: E741
        target, weight = (counts[l, r] / total).astype(np.float32), (seen[l, r] / total).astype(np.float32)
        names = ("left", "right", "bias", "out", "prior")
        first, second = ({k: np.zeros_like(getattr(self, k)) for k in names} for _ in "fs")
        for step in range(1, steps + 1):
            h = np.tanh(self.left[l] + self.right[r] + self.bias)
            error = np.exp(self._log(h)) * weight[:, None] - target
            back = (error @ self.out.T) * (1 - h * h)
            to = {"left": np.zeros_like(self.left), "right": np.zeros_like(self.right), "bias": back.sum(axis=0), "out": h.T @ error, "prior": error.sum(axis=0)}
            np.add.at(to["left"], l, back)
            np.add.at(to["right"], r, back)
            for k in names:  # Adam
                first[k] = 0.9 * first[k] + 0.1 * to[k]
                second[k] = 0.99 * second[k] + 0.01 * to[k] ** 2
                setattr(self, k, getattr(self, k) - LEARN * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8))

    def _log(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.out + self.prior
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def table(self) -> np.ndarray:
        """Log-probability of each token between each pair of neighbours."""
        v = len(self.left)
        return np.concatenate([self._log(np.tanh(self.left[i] + self.right + self.bias)) for i in range(v)]).astype(np.float32).reshape(-1)


def _places(w: Words, cell: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, word and sides of each word without a class of its own; sides: ``left << 30 | right << 6 | shape << 2 | thirds``."""
    first, hashes = VOCABULARY - SHAPES, w.hash()
    left, right = beside(w, np.maximum((mix(hashes) >> np.uint64(40)).astype(np.int64), 1))
    at = np.flatnonzero(cell % VOCABULARY >= first)
    sides = (left[at] << 30) | (right[at] << 6) | ((cell[at] % VOCABULARY - first) << 2) | thirds(cell[at])
    return rows[w.text[at]], hashes[at].view(np.int64), sides


def thirds(cell: np.ndarray) -> np.ndarray:
    """The network's part of each word's prediction: a third and one for each side without a whole word to tell."""
    pair, first = cell // VOCABULARY, VOCABULARY - SHAPES
    return 3 - (pair // VOCABULARY >= first) - (pair % VOCABULARY >= first)


def place_terms(places: DataFrame, sizes: dict[int, int], distinct: int) -> DataFrame:
    """``places`` with ``term``: what each place adds beyond the network's classes, in billionths.

    The share of its word, and the predictions that its word makes for the words beside it.
    """
    side = F.col("sides")
    left, right = F.shiftright(side, 30).alias("left"), F.shiftright(side, 6).bitwiseAND(F.lit((1 << 24) - 1)).alias("right")
    cols = ["row", "doc_id", "n_tokens", "class_ll"]
    by_right, by_left = (Window.partitionBy("word").orderBy(c) for c in ("right", "left"))
    whole = by_right.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    peers = (Window.currentRow, Window.currentRow)
    found = places.repartition("word").select(*cols, "word", "sides", left, right)
    found = found.select(*cols, "word", "sides", "left", "right", F.count("sides").over(whole).alias("n"), F.count("sides").over(by_right.rangeBetween(*peers)).alias("to_right"))
    found = found.withColumn("to_left", F.count("sides").over(by_left.rangeBetween(*peers)))
    size = F.element_at(F.array(*[F.lit(float(sizes.get(i + 1, 1))) for i in range(SHAPES)]), (F.shiftright(side, 2).bitwiseAND(F.lit(15)) + 1).cast("int"))
    tells = lambda c, same: F.when(F.col(c) == 0, 0.0).otherwise(F.log((F.col(same) - 1 + F.lit(1 / distinct)) / F.col("n")))
    total = side.bitwiseAND(F.lit(3)) * F.log(F.col("n") / size) + tells("left", "to_left") + tells("right", "to_right")
    return found.select(*cols, F.round(total / 3 * 1e9).cast("bigint").alias("term"))


def score_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, pseudo_ll, mean_ll`` of every row of ``docs(doc_id, text)``."""
    words, context = word_counts(docs), docs.sparkSession.sparkContext
    frequent = _frequent(words)
    rest = words.where(~F.col("word").isin(frequent.view(np.int64).tolist())) if len(frequent) else words
    sizes = {r["shape"]: r["size"] for r in rest.groupBy("shape").agg(F.sum("n").alias("size")).collect()}  # SHAPES rows
    table = context.broadcast(WindowNetwork(cell_counts(docs, frequent)).table())

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        """A row for each text, then one for each place."""
        texts, ids, rows = (batch.column(batch.schema.get_field_index(c)) for c in ("text", "doc_id", "row"))
        w, cell = cells(texts, frequent)
        rows, many = rows.to_numpy(), len(texts)
        by_class = np.bincount(w.text, weights=table.value[cell].astype(np.float64) * thirds(cell), minlength=many) / 3
        row, word, sides = _places(w, cell, rows)
        none = lambda kind: pa.nulls(len(row), kind)
        columns = {
            "row": pa.array(np.r_[rows, row]),
            "word": pa.array(np.r_[mix(rows.astype(np.uint64)).view(np.int64), word]),  # texts spread over the tasks
            "sides": pa.concat_arrays([pa.nulls(many, pa.int64()), pa.array(sides, pa.int64())]),
            "doc_id": pa.concat_arrays([ids, none(pa.int64())]),
            "n_tokens": pa.concat_arrays([pa.array(w.count, pa.int64()), none(pa.int64())]),
            "class_ll": pa.concat_arrays([pa.array(by_class, pa.float64()), none(pa.float64())]),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    places = mapped(base, score, "row bigint, word bigint, sides bigint, doc_id bigint, n_tokens bigint, class_ll double", ("text", "doc_id", "row"))
    terms = place_terms(places, sizes, words.count() + 1)
    parts = [F.max(c).alias(c) for c in ("doc_id", "n_tokens", "class_ll")]
    out = terms.groupBy("row").agg(F.coalesce(F.sum("term"), F.lit(0)).alias("terms"), *parts)
    out = out.select("doc_id", "n_tokens", (F.col("class_ll") + F.col("terms") / F.lit(1e9)).alias("pseudo_ll"))
    return out.withColumn("mean_ll", F.when(F.col("n_tokens") > 0, F.col("pseudo_ll") / F.col("n_tokens")))
