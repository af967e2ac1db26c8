"""Quality by attention-based multiple-instance learning (operator 12).

Only whole documents are labelled, not their passages. A document is a bag of
passages of ``PASSAGE`` consecutive words (the last may be shorter; each word
is in one). Each passage is encoded on its own, a gated attention network says
how much each passage counts, and the weighted mean of the encodings is scored::

    h_k = tanh(x_k W + b)
    e_k = (tanh(h_k V) * sigmoid(h_k U)) . w      a = softmax(e) over the document
    score = sigmoid(sum(a_k h_k) . c + c0)

All of W, b, V, U, w, c, c0 are learnt together from the documents' labels (Adam on
the log loss, in numpy). x_k are shares of byte classes (letters of both cases, digits,
symbols, stops, line ends, bytes of other alphabets), the mean word length,
the share of different words, of words equal to the one before, and the size.

Fit. On at most ``TRAIN_DOCS`` labelled documents, those of least hash of the
id, of at most ``TRAIN_PASSAGES`` passages each: the only sample, and the only
thing that comes to the driver (at most 115 MB of encodings, some MB as a
rule). The ids of the sample are picked from the labels alone, so no text is
shuffled. The fitted network is a few thousand numbers, sent with the tasks.

Scoring reads every whole text where it lies: no shuffle. Memory follows a
slice of about a megabyte, or one text if that is longer.

Edge cases. A null or empty text is one passage without words. Labels that
repeat an id count by their mean, null ones not at all; of documents that
repeat an id one is learnt from, each is scored. Without any label of either class the score is the labels' mean,
or 0.5. Repeated rows are scored alike and stay repeated; null ids stay null
and are never learnt from. An empty table gives an empty result. Columns other
than the id and the text are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mapped
from tidemark.llm.textscan import Words, mix

PASSAGE = 64
TRAIN_DOCS, TRAIN_PASSAGES = 8_000, 256
HIDDEN, GATES = 16, 8
EPOCHS, BATCH, RATE, DECAY = 40, 64, 0.01, 1e-4

_CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b"!?", b".,;:", b"\n", b"\"'()[]{}-_/\\+=@^~`")
_CLASS_OF = np.full(256, len(_CLASSES), np.int64)  # the last class: all other ASCII bytes
for _i, _of in enumerate(_CLASSES):
    _CLASS_OF[list(_of)] = _i
_CLASS_OF[0x80:] = len(_CLASSES) + 1
N_CLASSES = len(_CLASSES) + 2
FEATURES = N_CLASSES + 4


def encode(texts: pa.Array, passage: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """The passages' features, text by text, and each text's first passage (one more entry than texts)."""
    w = Words(texts)
    count = np.maximum(-(-w.count // passage), 1)
    first = np.r_[0, np.cumsum(count)]
    n = int(first[-1])
    inside = np.arange(len(w)) - w.first[w.text]
    own = first[w.text] + inside // passage  # each word's passage
    start = np.full(n, -1, np.int64)
    head = np.flatnonzero(inside % passage == 0)
    start[own[head]] = w.start[head]
    # bytes from a passage's first word to the next one's; those before a text's first word are its first passage's
    empty = start < 0
    start[empty] = w.at[:-1][np.searchsorted(first, np.flatnonzero(empty), side="right") - 1]
    start[first[:-1]] = w.at[:-1]
    size = np.diff(np.r_[start, len(w.data)])
    of_byte = np.repeat(np.arange(n), size)
    shares = np.bincount(of_byte * N_CLASSES + _CLASS_OF[w.data], minlength=n * N_CLASSES).reshape(n, N_CLASSES) / np.maximum(size, 1)[:, None]
    words = np.bincount(own, minlength=n)
    most = np.maximum(words, 1)
    length = np.bincount(own, weights=w.end - w.start, minlength=n) / most
    key = w.hash()
    once = np.unique(mix(key ^ mix(own.astype(np.uint64))), return_index=True)[1]
    different = np.bincount(own[once], minlength=n) / most
    again = np.zeros(len(w), bool)
    again[1:] = (key[1:] == key[:-1]) & (w.text[1:] == w.text[:-1])
    doubled = np.bincount(own[again], minlength=n) / most
    x = np.column_stack([shares, np.log1p(length), different, doubled, np.log1p(words)])
    return x.astype(np.float32), first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Attention:
    """The network: parameters, forward pass, gradients and fit."""

    def __init__(self, features: int = FEATURES, hidden: int = HIDDEN, gates: int = GATES):
        rng = np.random.default_rng(12)
        self.mean, self.scale, self.constant = np.zeros(features), np.ones(features), 0.5
        self.p = {
            "W": rng.normal(0, features**-0.5, (features, hidden)), "b": np.zeros(hidden),
            "V": rng.normal(0, hidden**-0.5, (hidden, gates)), "U": rng.normal(0, hidden**-0.5, (hidden, gates)), "w": np.zeros(gates),
            "c": np.zeros(hidden), "c0": np.zeros(1),
        }

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of bags and what they come from; ``x``: scaled features, ``first``: each bag's first row and the end."""
        p, at, n = self.p, first[:-1], np.diff(first)
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, at), n))
        a /= np.repeat(np.add.reduceat(a, at), n)
        z = np.add.reduceat(a[:, None] * h, at, axis=0)
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["c0"])}

    def gradients(self, x: np.ndarray, first: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss of the bags."""
        p, f, at, n = self.p, self.forward(x, first), first[:-1], np.diff(first)
        d = (f["y"] - label) / len(label)
        dz = np.repeat(d[:, None] * p["c"], n, axis=0)
        da = (dz * f["h"]).sum(1)
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, at), n))
        dt = de[:, None] * p["w"] * f["s"] * (1 - f["t"] ** 2)
        ds = de[:, None] * p["w"] * f["t"] * f["s"] * (1 - f["s"])
        dh = (f["a"][:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - f["h"] ** 2)
        return {
            "W": x.T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": (f["t"] * f["s"]).T @ de,
            "c": f["z"].T @ d, "c0": np.array([d.sum()]),
        }

    def fit(self, x: np.ndarray, first: np.ndarray, label: np.ndarray, epochs: int = EPOCHS) -> Attention:
        if len(label):
            self.constant = float(label.mean())
        if len(np.unique(label)) < 2:
            return self
        self.mean, self.scale = x.mean(0, dtype=float), x.std(0, dtype=float) + 1e-3
        x, rng, step = self._scaled(x), np.random.default_rng(7), 0
        m, v = ({k: np.zeros_like(g) for k, g in self.p.items()} for _ in range(2))
        for epoch in range(epochs):
            order = rng.permutation(len(label))
            for i in range(0, len(order), BATCH):
                bags = order[i : i + BATCH]
                n = first[bags + 1] - first[bags]
                ends = np.r_[0, np.cumsum(n)]
                rows = np.repeat(first[bags] - ends[:-1], n) + np.arange(ends[-1])
                step += 1
                rate = RATE * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for k, g in self.gradients(x[rows], ends, label[bags]).items():
                    g = g + DECAY * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= rate * m[k] / (np.sqrt(v[k]) + 1e-8)
        self.constant = None
        return self

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def score(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each bag's score and each passage's attention."""
        if self.constant is not None:
            n = np.diff(first)
            return np.full(len(n), self.constant), np.repeat(1 / n, n)
        f = self.forward(self._scaled(x), first)
        return f["y"], f["a"]


def _sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """``id, label, passages, size`` of the documents to learn from."""
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    labels = labels.groupBy(F.col("doc_id").alias("id")).agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    chosen = labels.orderBy(F.xxhash64("id"), "id").limit(limit)  # at most `limit` short rows: small enough to broadcast
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "id")
    kind = dict(texts.dtypes)["id"]

    def encoded(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        x, first = encode(batch.column(1))
        n = np.diff(first)
        few = np.flatnonzero(n <= TRAIN_PASSAGES)
        parts = pa.array([x[first[i] : first[i + 1]].tobytes() for i in few], pa.binary())
        at = pa.array(few, pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at), parts], names=["id", "label", "x"])

    rows = mapped(texts.select("id", "text", "label"), encoded, f"id {kind}, label int, x binary")
    return rows.groupBy("id", "label").agg(F.min("x").alias("x"))


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> Attention:
    """The network learnt from ``labels(doc_id, label 0/1)`` of ``docs(doc_id, text)``."""
    got = _sample(docs, labels, limit).toPandas().sort_values("id", ignore_index=True)
    parts = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in got["x"]]
    first = np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int64)
    x = np.concatenate(parts) if parts else np.zeros((0, FEATURES), np.float32)
    return Attention().fit(x, first, got["label"].to_numpy(float))


def score_documents(docs: DataFrame, model: Attention) -> DataFrame:
    """``doc_id, score, n_passages, top_word, top_weight`` of every row of ``docs(doc_id, text)``.

    ``score``: 0 to 1, higher for label 1. ``top_word``: number of the first
    word of the passage that counts most, ``top_weight`` its attention.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, first = encode(batch.column(1))
        score, weight = model.score(x, first)
        order = np.lexsort((np.arange(len(weight)), -weight, np.repeat(np.arange(len(score)), np.diff(first))))
        top = order[first[:-1]]
        columns = [pa.array(score, pa.float64()), pa.array(np.diff(first), pa.int64()), pa.array((top - first[:-1]) * PASSAGE, pa.int64()), pa.array(weight[top], pa.float64())]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "score", "n_passages", "top_word", "top_weight"])

    return mapped(rows, scored, f"doc_id {kind}, score double, n_passages bigint, top_word bigint, top_weight double")
