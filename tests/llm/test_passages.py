"""Operator 12: encodings and network against plain versions, accuracy on rows that were held out."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import passages
from tidemark.llm.registry import QUERIES

SF = "/root/testdata/sf0.01"


def plain_encoding(text):
    """Features of each passage, passage by passage."""
    raw = (text or "").encode()
    spans, i = [], 0
    while i < len(raw):
        if raw[i] in b" \t\n\x0b\x0c\r":
            i += 1
            continue
        j = i
        while j < len(raw) and raw[j] not in b" \t\n\x0b\x0c\r":
            j += 1
        spans.append((i, j))
        i = j
    words = [raw[a:b] for a, b in spans]
    starts = [spans[k][0] if k else 0 for k in range(0, len(spans), passages.PASSAGE)] or [0]
    out = []
    for k, a in enumerate(starts):
        data = raw[a : starts[k + 1] if k + 1 < len(starts) else len(raw)]
        own = words[k * passages.PASSAGE : (k + 1) * passages.PASSAGE]
        before = words[k * passages.PASSAGE - 1] if k else None
        shares = [sum(b in c for b in data) for c in passages._CLASSES]
        shares += [sum(b < 0x80 for b in data) - sum(shares), sum(b >= 0x80 for b in data)]
        n = max(len(own), 1)
        doubled = sum(x == y for x, y in zip(own, [before, *own[:-1]], strict=True)) if own else 0
        out.append([*[s / max(len(data), 1) for s in shares], math.log1p(sum(map(len, own)) / n), len(set(own)) / n, doubled / n, math.log1p(len(own))])
    return out


def test_encoding_equals_plain_version():
    rng = random.Random(1)
    texts = [None, "", " \n ", "a", "Ünï 12 #!", "x " * 64, "x " * 65, " lead\n" + brute.prose(rng, 200), brute.prose(rng, 128), "la la la. " * 100, "z" * 5000]
    x, first = passages.encode(pa.array(texts, pa.string()))
    want = [plain_encoding(t) for t in texts]
    assert np.diff(first).tolist() == [len(p) for p in want]
    np.testing.assert_allclose(x, np.array([f for p in want for f in p]), atol=1e-5)


@pytest.fixture(scope="module")
def bags():
    rng = np.random.default_rng(3)
    first = np.r_[0, np.cumsum(rng.integers(1, 9, 60))]
    return rng.normal(size=(first[-1], passages.FEATURES)), first, rng.integers(0, 2, 60).astype(float)


def random_net():
    net, rng = passages.Attention(), np.random.default_rng(5)
    net.p = {k: rng.normal(0, 0.4, v.shape) for k, v in net.p.items()}
    return net


def test_forward_equals_plain_version(bags):
    x, first, _ = bags
    net = random_net()
    p, got = net.p, net.forward(x, first)
    for i in range(len(first) - 1):
        e, hs = [], []
        for row in x[first[i] : first[i + 1]]:
            h = [math.tanh(sum(row[f] * p["W"][f, j] for f in range(len(row))) + p["b"][j]) for j in range(passages.HIDDEN)]
            gate = 0.0
            for g in range(passages.GATES):
                t = math.tanh(sum(h[j] * p["V"][j, g] for j in range(passages.HIDDEN)))
                s = 1 / (1 + math.exp(-sum(h[j] * p["U"][j, g] for j in range(passages.HIDDEN))))
                gate += t * s * p["w"][g]
            e.append(gate)
            hs.append(h)
        total = sum(math.exp(v) for v in e)
        z = [sum(math.exp(v) / total * h[j] for v, h in zip(e, hs, strict=True)) for j in range(passages.HIDDEN)]
        y = 1 / (1 + math.exp(-(sum(a * b for a, b in zip(z, p["c"], strict=True)) + p["c0"][0])))
        assert got["y"][i] == pytest.approx(y)


def test_gradients_are_those_of_the_loss(bags):
    x, first, label = bags
    net = random_net()

    def loss():
        y = net.forward(x, first)["y"]
        return -np.mean(label * np.log(y) + (1 - label) * np.log(1 - y))

    for name, g in net.gradients(x, first, label).items():
        for at in list(np.ndindex(g.shape))[:: max(g.size // 7, 1)]:
            old = net.p[name][at]
            net.p[name][at] = old + 1e-5
            up = loss()
            net.p[name][at] = old - 1e-5
            down = loss()
            net.p[name][at] = old
            assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_attention_finds_the_passage_that_decides(docs_of, spark):
    """Bags whose label hangs on one passage among many: found on documents that were not learnt from."""
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(700):
        w, bad, n = brute.prose(rng, rng.randint(64, 640)).split(), i % 2, 0
        if bad:
            n = 64 * rng.randrange(max(len(w) // 64, 1))
            w[n : n + 64] = [x + "###" for x in w[n : n + 64]]
        rows.append((i, " ".join(w), n))
        labels.append((i, 1 - bad))
    docs = docs_of([r[:2] for r in rows])
    told = spark.createDataFrame(labels, "doc_id bigint, label int")
    model = passages.fit(docs, told.where("doc_id < 500"))
    out = {r.doc_id: r for r in passages.score_documents(docs, model).collect()}
    held = [r for r in rows if r[0] >= 500]
    assert np.mean([(out[i].score >= 0.5) == (i % 2 == 0) for i, _, _ in held]) > 0.97
    assert np.mean([out[i].top_word == n for i, _, n in held if i % 2]) > 0.9


def test_query_on_held_out_rows(spark):
    out = QUERIES["op12_attention_quality"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = out.join(labels, "doc_id", "left").collect()
    assert len(rows) == docs
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.quality is not None]
    bad, good = [r for r in held if r.quality == 0], [r for r in held if r.quality == 1]
    assert len(bad) > 5 and len(good) > 40
    assert np.mean([r.predicted == 0 for r in bad]) > 0.8
    assert np.mean([r.predicted == 1 for r in good]) > 0.98


def test_labels_of_held_out_rows_do_not_matter(spark, tmp_path):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    turned.write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{SF}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    a, b = ({r.doc_id: r.score for r in QUERIES["op12_attention_quality"](spark, d).collect()} for d in (SF, str(tmp_path)))
    assert a == b


def test_odd_tables(spark, docs_of):
    none = spark.createDataFrame([], "doc_id bigint, label int")
    docs = docs_of([(1, None), (1, "x " * 400), (None, "a"), (2, ""), (2, ""), (3, "é " * 20000)])
    assert passages.score_documents(docs_of([]), passages.fit(docs_of([]), none)).collect() == []
    assert {r.score for r in passages.score_documents(docs, passages.fit(docs, none)).collect()} == {0.5}
    some = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (2, None), (None, 0), (3, 0), (9, 0)], "doc_id bigint, label int")
    out = passages.score_documents(docs, passages.fit(docs, some)).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id == 2}) == 1
    only = spark.createDataFrame([(1, 1), (2, 1)], "doc_id bigint, label int")
    assert {r.score for r in passages.score_documents(docs, passages.fit(docs, only)).collect()} == {1.0}
