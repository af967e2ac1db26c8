"""Operators 1, 3, 5 and 8 against brute force, with the odd cases."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import minhash, quality, substrings, textscan, tiling


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    base = [brute.prose(rng, n) for n in (60, 150, 400, 30, 80)]
    rows = list(enumerate(base))
    for text in base:
        for edits in (0, 1, 1, 2, 3, 6):
            w = text.split()
            for _ in range(edits):
                w[rng.randrange(len(w))] = brute.prose(rng, 1)
            rows.append((len(rows), " ".join(w)))
    shared = brute.prose(rng, 45)
    for _ in range(12):
        rows.append((len(rows), f"{brute.prose(rng, rng.randint(0, 40))}\n{shared}\t{brute.prose(rng, rng.randint(0, 40))}"))
    odd = [None, "", " \n\t ", "one", "one", "two words", "a b c d", "a b c d", None, "é " * 30, "ü" * 5000, "la " * 3000, brute.prose(rng, 9000)]
    return rows + [(len(rows) + i, t) for i, t in enumerate(odd)]


def test_words_and_hashes():
    texts = pa.array(["a  b\n\x0bc", None, "", "ça va\x1cb", "b c"])
    w = textscan.Words(texts)
    assert w.count.tolist() == [3, 0, 0, 2, 2]
    assert [w.bytes(i).decode() for i in range(len(w))] == ["a", "b", "c", "ça", "va\x1cb", "b", "c"]
    h = w.hash()
    assert h[1] == h[5] and h[2] == h[6] and len(set(h.tolist())) == 5


def test_signature_agreement_is_the_weighted_similarity():
    rng = np.random.default_rng(1)
    m, same, trials = 64, 0, 60
    for t in range(trials):
        element = rng.integers(0, 2**63, 40).astype(np.uint64)
        a, b = np.repeat([3, 1], 20), np.r_[np.repeat(2, 10), np.repeat(3, 10), np.repeat(1, 10), np.repeat(5, 10)]
        s = minhash.bag_minhash(np.repeat([0, 1], 40), np.r_[element, element], np.r_[a, b], 2, m)
        same += (s[0] == s[1]).mean() / trials
    expected = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs(same - expected) < 4 * np.sqrt(expected * (1 - expected) / (m * trials))


def test_overlap_counts_repeats():
    pairs = [("a b c d e a b c d e a b c d e", "a b c d e"), ("x y", "x y"), ("", ""), (None, "a"), ("a b c d e f", "f e d c b a")]
    got = minhash.overlap(pa.array([a for a, _ in pairs], pa.string()), pa.array([b for _, b in pairs], pa.string()))
    assert got.tolist() == pytest.approx([brute.similarity(a, b) for a, b in pairs])


def test_near_classes(docs_of, corpus):
    got = {r.doc_id: r.class_id for r in minhash.near_classes(docs_of(corpus)).collect()}
    assert got == brute.near_classes(corpus)
    kept = minhash.near_dedup(docs_of(corpus))
    assert kept.columns == docs_of(corpus).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_near_classes_of_a_large_group_with_outliers(docs_of):
    """Copies that only the base links, and members of the same buckets that no text links."""
    rng = random.Random(5)
    base = brute.prose(rng, 150).split()
    rows = [(1000, " ".join(base))]
    for i in range(120):
        w = list(base)
        for _ in range(rng.choice((1, 2, 3, 3, 4, 6))):
            w[rng.randrange(len(w))] = brute.prose(rng, 1)
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.class_id for r in minhash.near_classes(docs_of(rows)).collect()}
    assert got == brute.near_classes(rows)


def test_near_classes_of_repeated_and_null_ids(docs_of):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (None, "x y z"), (3, "a b c d e f"), (None, None)]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.class_id if r.class_id is not None else -1) for r in minhash.near_classes(docs_of(rows)).collect())
    assert got == [(-1, -1), (-1, -1), (-1, 3), (3, 3), (5, 3), (5, 3)]
    assert [r.doc_id for r in minhash.near_dedup(docs_of(rows)).collect()].count(3) == 1


def test_classes_are_of_texts_not_ids(docs_of):
    """Ids that name several texts, and near copies without an id."""
    rng = random.Random(6)
    one, two, three, four = (brute.prose(rng, 120) for _ in range(4))
    near = lambda t: t + " " + brute.prose(rng, 1)
    rows = [(7, one), (7, two), (8, near(one)), (9, near(two)), (None, near(one)), (None, three), (None, near(three)), (6, four), (7, two), (None, None), (4, None), (4, None), (7, None)]
    by_text = {t: i for i, (_, t) in enumerate(rows)}
    told = brute.near_classes([(i, t) for t, i in by_text.items() if t is not None])
    docs = docs_of(rows)
    got = sorted(map(repr, ((r.doc_id, r.class_id) for r in minhash.near_classes(docs).collect())))
    least = lambda t: min((i for i, u in rows if u is not None and i is not None and told[by_text[u]] == told[by_text[t]]), default=None)
    assert got == sorted(map(repr, ((i, least(t) if t is not None else i) for i, t in rows)))
    kept = minhash.near_dedup(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect() if r.text != three and r.text != rows[6][1]) == Counter([(7, one), (7, two), (6, four), (None, None), (4, None), (7, None)])
    assert sum(r.text in (three, rows[6][1]) for r in kept.collect()) == 1


def test_a_family_that_shares_a_template_makes_no_pairs(spark, docs_of):
    """260 shared words and 44 own ones, similarity about 0.74: all in common buckets, none alike."""
    rng = random.Random(3)
    shared = brute.prose(rng, 260)
    counts = []
    for n in (60, 180):
        texts = [(i, f"{shared} {brute.prose(rng, 44)}") for i in range(n)]
        still = spark.createDataFrame([(1, i, i) for i in range(n)], "key bigint, node bigint, label bigint")
        rest = minhash._rest(still, spark.createDataFrame(texts, "node bigint, text string"))
        counts.append(rest.count())
    assert counts == [0, 0]
    texts += [(1000 + i, t + " end") for i, t in texts[:20]]  # and pairs that are alike are all found
    still = spark.createDataFrame([(1, i, i) for i, _ in texts], "key bigint, node bigint, label bigint")
    rest = minhash._rest(still, spark.createDataFrame(texts, "node bigint, text string"))
    assert {(r.v, r.u) for r in rest.collect()} == {(i, 1000 + i) for i in range(20)}


def test_remove_repeats(docs_of, corpus):
    rng = random.Random(9)
    passage = brute.prose(rng, 25)
    rows = corpus + [(500 + i, f"{passage} {brute.prose(rng, i)} {passage}") for i in range(6)] + [(600, "w " * 25), (601, "w " * 19), (602, "w " * 20)]
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(docs_of(rows)).collect()}
    assert got == brute.remove_repeats(rows)


@pytest.mark.parametrize(("length", "k"), [(5, 2), (8, 8), (3, 1)])
def test_remove_repeats_at_other_lengths(docs_of, length, k):
    rng = random.Random(length)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))) for i in range(40)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(docs_of(rows), length, k).collect()}
    assert got == brute.remove_repeats(rows, length)


def test_remove_repeats_of_repeated_rows(docs_of):
    text = brute.prose(random.Random(2), 40)
    got = substrings.remove_repeats(docs_of([(1, text), (1, text), (None, text), (2, text)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 40), (1, 0), (1, 0), (2, 40)]


def test_features(corpus):
    texts = [t for _, t in corpus] + ["a\na\n a\n\n\nb\nb\nb", "# $ x|<>", "a b c a b c a", "x\r\nx\r\n", "é\né"]
    got = quality.text_features(pa.array(texts, pa.string()))
    assert list(zip(*[got[c].tolist() for c in quality.FEATURES], strict=True)) == [brute.features(t) for t in texts]


def test_hosts_with_many_failures_lose_all_documents(docs_of):
    rng = random.Random(1)
    rows = [(i, brute.prose(rng, 60) if i % 10 else "too short") for i in range(200)]
    rows += [(i, brute.prose(rng, 60) if i % 20 == 0 else "too short") for i in range(200, 400)] + [(400, "short"), (401, brute.prose(rng, 60))]
    hosts = {i: "good" if i < 200 else "bad" if i < 400 else None if i == 401 else "tiny" for i, _ in rows}
    docs = docs_of(rows, hosts)
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.quality_rules(docs).collect()}
    assert all(got[i] == (i % 10 == 0, i % 10 != 0) for i in range(200))
    assert all(got[i] == (i % 20 != 0, False) for i in range(200, 400))
    assert got[401] == (False, True)
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, x in got.items() if x[1]}


def test_filter_has_rules_for_symbols_lines_and_word_length(docs_of):
    rng = random.Random(2)
    prose = brute.prose
    edge = " ".join(f"{prose(rng, 12)} #" for _ in range(8))  # 8 symbols among 104 words, under the limit
    rows = [(i, prose(rng, 60)) for i in range(60)]
    junk = {100: prose(rng, 60) + " ### $$$ <|>", 101: "\n".join([prose(rng, 30)] * 2 + ["a line"] + ["b line"] * 3), 102: " ".join(prose(rng, 60).split() + ["x" * 900]), 103: " ".join(rng.choice("abcdefghij") for _ in range(200))}
    rows += [*junk.items(), (104, edge), (105, None)]
    rows += [(200 + i, prose(rng, 60) + (" #" * 9 if i % 5 < 2 else "")) for i in range(60)] + [(299, edge)]
    rows += [(300 + i, prose(rng, 60) + (" #" * 9 if i % 5 else "")) for i in range(60)]
    hosts = {i: "good" if i < 200 else "mixed" if i < 300 else "bad" for i, _ in rows}
    docs = docs_of(rows, hosts)
    got = {r.doc_id for r in quality.quality_filter(docs).collect()}
    verdicts = quality.quality_rules(docs).collect()
    assert {r.doc_id for r in verdicts if r.kept} == got
    assert any(not r.base_failed and not r.kept for r in verdicts)
    # the mixed host's rate of two fifths lowers the limit for its own documents, the bad host goes as a whole
    assert got == {*range(60), 104} | {200 + i for i in range(60) if i % 5 >= 2}


def test_tiling_with_common_stems():
    """Items with shared stems against plain tiling, whatever seeds are looked up; many of them in bounded memory."""
    import tracemalloc

    rng = random.Random(21)
    stem = brute.prose(rng, 6)
    items = [f"{stem} {brute.prose(rng, rng.choice((3, 5, 7, 20)))}" for _ in range(40)] + [stem, f"{stem} {stem} {stem} {stem}", "of it " * 9]
    docs = [f"{brute.prose(rng, 30)} {x} {brute.prose(rng, 30)}" for x in items[::3]] + [f"{stem} " * 30, "of it " * 40, brute.prose(rng, 50)]
    docs += [" ".join([*x.split()[8:], *brute.prose(rng, 9).split(), *x.split()[:8]]) for x in items[:40:4]]
    block = tiling.Block(list(enumerate(items)), 5, 0.5)
    assert len(block.seeds) < len(block.own)
    got = {(t, i): sum(x[2] for x in found) for t, i, found in tiling.covered(pa.array(docs), block, 0.5)}
    want = {}
    for t, d in enumerate(docs):
        for i, x in enumerate(items):
            n = sum(brute.tiling(d.split(), x.split(), 5))
            if n >= 0.5 * len(x.split()):
                want[t, i] = n
    assert got == want and len(want) > 25
    many = tiling.Block([(i, f"{stem} {brute.prose(rng, 20)}") for i in range(8000)], 5, 0.5)
    doc = pa.array([f"{stem} {brute.prose(rng, 3)} " * 1000])
    tracemalloc.start()
    assert not list(tiling.covered(doc, many, 0.5))
    assert tracemalloc.get_traced_memory()[1] < 50 << 20
    tracemalloc.stop()


def test_tiles_against_plain_greedy_tiling():
    rng = random.Random(4)
    for _ in range(60):
        doc, item = ([rng.choice("abcd") for _ in range(rng.randint(1, 40))] for _ in "xy")
        texts = pa.array([" ".join(doc)])
        block = tiling.Block([(1, " ".join(item))], 3)
        got = [sorted((t[2] for t in found), reverse=True) for _, _, found in tiling.covered(texts, block, 1e-9)]
        want = brute.tiling(doc, item, 3)
        assert [sum(g) for g in got] == ([sum(want)] if want else []) or sorted(got[0], reverse=True) == sorted(want, reverse=True)


def test_contamination(docs_of, spark):
    rng = random.Random(8)
    items = [brute.prose(rng, n) for n in (20, 40, 8, 3)]
    w = items[1].split()
    moved = " ".join(w[30:] + brute.prose(rng, 9).split() + w[:15] + brute.prose(rng, 3).split() + w[15:30])
    rows = [
        (1, f"{brute.prose(rng, 300)} {items[0].upper()}! {brute.prose(rng, 20)}"), (2, moved), (3, brute.prose(rng, 500)), (4, " ".join(w[:19])),
        (5, " ".join(w[:20])), (6, None), (7, ""), (8, f"{items[2]}, {items[0]}"), (9, items[3]), (8, f"{items[2]}, {items[0]}"),
    ]
    bench = spark.createDataFrame([*enumerate(items), (9, None), (10, ""), (0, "other words")], "item_id bigint, text string")
    docs = docs_of(rows)
    got = tiling.contaminated(docs, bench)
    assert {(r.doc_id, r.item_id, r.tiled_words) for r in got.collect()} == {(1, 0, 20), (2, 1, 40), (5, 1, 20), (8, 0, 20), (8, 2, 8)}
    clean = tiling.decontaminate(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [3, 4, 6, 7, 9]


@pytest.mark.parametrize("block_bytes", [8 << 20, 200])
def test_each_contaminated_row_is_reported(docs_of, spark, monkeypatch, block_bytes):
    monkeypatch.setattr(tiling, "BLOCK_BYTES", block_bytes)
    rng = random.Random(11)
    items = [brute.prose(rng, 20) for _ in range(3)]
    bench = spark.createDataFrame([*enumerate(items), (0, items[0]), (0, items[0] + " and more")], "item_id bigint, text string")
    rows = [(1, f"a {items[0]}"), (1, f"a {items[0]}"), (1, f"other {items[0]} {items[1]}"), (None, items[0]), (None, items[0]), (None, f"{items[0]} {items[2]}"), (2, "none")]
    docs = docs_of(rows)
    got = sorted((r.doc_id or -1, r.item_id, r.tiled_words) for r in tiling.contaminated(docs.repartition(4), bench).collect())
    assert got == [(-1, 0, 20)] * 3 + [(-1, 2, 20)] + [(1, 0, 20)] * 3 + [(1, 1, 20)]
    assert [r.doc_id for r in tiling.decontaminate(docs, bench).collect()] == [2]


def test_plans_do_not_grow_with_the_benchmark(docs_of, spark, monkeypatch):
    rng = random.Random(8)
    items = [brute.prose(rng, 20) for _ in range(6)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    docs = docs_of([(i, t) for i, t in enumerate(items)] + [(50, None), (51, "clean"), (None, brute.prose(rng, 40))])
    monkeypatch.setattr(tiling, "BLOCK_BYTES", 200)
    assert len(list(tiling.blocks(bench))) > 2
    found, clean = tiling.contaminated(docs, bench), tiling.decontaminate(docs, bench)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (found, clean)]
    assert not any("MapInArrow" in p for p in plans)
    assert found.count() == 6 and {r.doc_id for r in clean.collect()} == {50, 51, None}


def test_benchmark_in_blocks(docs_of, spark):
    rng = random.Random(8)
    items = [brute.prose(rng, 20) for _ in range(30)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    assert len(list(tiling.blocks(bench, block_bytes=600))) > 3
    docs = docs_of([(i, f"{brute.prose(rng, 30)} {t}") for i, t in enumerate(items)])
    old, tiling.BLOCK_BYTES = tiling.BLOCK_BYTES, 600
    try:
        assert tiling.contaminated(docs, bench).count() == 30 and tiling.decontaminate(docs, bench).count() == 0
    finally:
        tiling.BLOCK_BYTES = old


@pytest.mark.parametrize("operator", [
    minhash.near_classes, minhash.near_dedup, substrings.remove_repeats, quality.quality_rules, quality.quality_filter,
    lambda d: tiling.contaminated(d, d.select(F.col("doc_id").alias("item_id"), "text")), lambda d: tiling.decontaminate(d, d.select(F.col("doc_id").alias("item_id"), "text")),
])
def test_empty_tables(docs_of, operator):
    assert operator(docs_of([])).count() == 0
