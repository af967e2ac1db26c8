"""Operator 11 against comparing all words at all lags."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tidemark.llm import periodic
from tidemark.llm.textscan import Words


def runs_of(w, least=12):
    """(start, length, period) of all runs, by start and period."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)  # the least period comes first
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def kept(w):
    gone = {i for s, n, q in runs_of(w) for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def altered(i, text):
    w = brute.words(text)
    h = zlib.crc32(str(i).encode())
    g = h // 10
    if h % 10 or not w:
        return w
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    out = ["", None, " \n", "a " * 11, "a " * 12, "a " * 1500, "a b " * 6, "a b c d e f g " * 2, "a b a b a b a c " * 40]
    for size in (2, 3, 5):
        for n in (30, 200, 700):
            out.append(" ".join(rng.choice("abcde"[:size]) for _ in range(n)))
    thue, fib = "a", ["a", "ab"]
    while len(thue) < 512:
        thue += thue.translate(str.maketrans("ab", "ba"))
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    out += [" ".join(thue), " ".join(fib[-1])]
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 5)):
            unit = [rng.choice("abcdefghij") for _ in range(rng.choice((1, 2, 3, 5, 6, 7, 11, 12, 13, 16, 31, 40)))]
            parts += (unit * 8)[: rng.randint(len(unit), 5 * len(unit))] + [brute.prose(rng, rng.randint(0, 4))]
        out.append("\t ".join(parts))
    return out


def test_every_match_holds_a_seed():
    for lo, hi, level, step in periodic.brackets(1 << 14):
        for q in range(lo, min(hi, lo + 500)):
            assert (1 << level) + step - 1 <= max(12 - q, q)
            assert step >= 1


def test_runs_equal_brute_force(texts):
    w = Words(pa.array(texts, pa.string()))
    start, end, q = periodic.find_runs(w)
    for t, text in enumerate(texts):
        own = w.text[start] == t if len(start) else np.zeros(0, bool)
        got = list(zip((start[own] - w.first[t]).tolist(), (end[own] - start[own]).tolist(), q[own].tolist(), strict=True))
        assert got == runs_of(brute.words(text)), text


def test_parts_of_pairs_find_the_same(texts, monkeypatch):
    w = Words(pa.array(texts, pa.string()))
    whole = periodic.find_runs(w)
    monkeypatch.setattr(periodic, "PAIRS", 64)
    for a, b in zip(whole, periodic.find_runs(w), strict=True):
        assert a.tolist() == b.tolist()


def test_pairs_stay_linear():
    n = 1 << 15
    names = periodic.Names(np.zeros(n, np.uint64))
    names.grow()
    for lo, hi, level, step in periodic.brackets(n):
        assert sum(len(i) for i, _ in periodic._pairs(names.level(level), n, lo, hi, step)) <= 3 * n


def test_operator_keeps_all_rows(spark, docs_of, texts):
    rows = list(enumerate(texts)) + [(None, "b " * 20), (None, None), (3, texts[3]), (4, texts[4])]
    out = periodic.periodic_runs(docs_of(rows)).collect()
    assert len(out) == len(rows)
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.kept) for r in out)
    want = sorted((str(i), len(w), runs_of(w), kept(w)) for i, w in ((i, brute.words(t)) for i, t in rows))
    assert got == want
    assert periodic.periodic_runs(docs_of([])).collect() == []


def test_planted_words(docs_of):
    rng = random.Random(2)
    rows = [(i, brute.prose(rng, rng.choice((0, 1, 2, 40, 300)))) for i in range(300)] + [(None, "a b"), (7, None)]
    got = sorted((str(r.doc_id), " ".join(brute.words(r.text))) for r in periodic.planted(docs_of(rows)).collect())
    assert got == sorted((str(i), " ".join(altered(i, t) if i is not None else brute.words(t))) for i, t in rows)


def test_query_digests(spark, docs_of, tmp_path):
    import hashlib

    from tidemark.llm.registry import QUERIES

    rng = random.Random(4)
    rows = [(i, brute.prose(rng, rng.choice((0, 5, 60, 400)))) for i in range(150)] + [(1000, "x y z " * 30), (1001, None)]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    seen = 0
    for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect():
        w = altered(r.doc_id, dict(rows)[r.doc_id])
        runs = runs_of(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        told = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *told)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)) and r.collapsed_sha256 == sha(kept(w))
        seen += bool(runs)
    assert seen > 5
