"""Operators 2, 4, 6, 7, 9 and 10: round trips, brute force and held-out accuracy, with the odd cases."""

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from tidemark.llm import chat, language, packing, secrets, sharding, urls
from tidemark.llm.registry import op9_randomness, tokenizer_path
from tidemark.llm.secrets_sql import SECRETS_SQL


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows = [(i, brute.prose(rng, rng.choice((3, 30, 300, 900)))) for i in range(60)]
    odd = [None, "", "  ", "Él, d'été! «x»", "x<|endoftext|>Y", "A<|ENDOFTEXT|>", "co\u0301te\u0301.", "ΑΣ. don't,", "\u3000a\u00a0b", "İI,", "1,000.5; a-b_c", "😀,😀", "x" * 4000, "é" * 3000, "la " * 9000]
    return rows + [(len(rows) + i, t) for i, t in enumerate(odd)]


def test_word_lookup_equals_the_tokenizer(corpus):
    whole = Tokenizer.from_file(tokenizer_path())
    ids, count = packing.Encoder(tokenizer_path()).encode(pa.array([t for _, t in corpus], pa.string()))
    want = [whole.encode(t or "", add_special_tokens=False).ids for _, t in corpus]
    assert count.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_word_lookup_with_a_small_cache(corpus, monkeypatch):
    texts = [pa.array([t], pa.string()) for _, t in corpus]
    want = [packing.Encoder(tokenizer_path()).encode(t)[0].tolist() for t in texts]
    monkeypatch.setattr(packing, "CACHED", 50)
    small = packing.Encoder(tokenizer_path())
    assert [small.encode(t)[0].tolist() for t in texts] == want


def test_packing_holds_every_token_once(docs_of, corpus):
    corpus = [*corpus, (0, corpus[0][1]), (None, "no id")]
    got = packing.pack_documents(docs_of(corpus).repartition(5), tokenizer_path()).collect()
    whole, pieces, seqs = Tokenizer.from_file(tokenizer_path()), defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        seqs[r.sequence_id].append((r.offset, r.length))
    texts = defaultdict(list)
    for i, t in corpus:
        texts[i].append(t)
    for i, own in texts.items():
        ids = np.array(whole.encode(own[0] or "", add_special_tokens=False).ids + [packing.END_ID], "<u4")
        rows = sorted(pieces[i], key=lambda r: r.start)
        assert sum(r.length for r in rows) == len(ids) * len(own)
        for r in rows:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        if len(own) == 1:
            assert [r.start for r in rows] == np.cumsum([0] + [r.length for r in rows])[:-1].tolist()
    for parts in seqs.values():
        parts.sort()
        assert [p[0] for p in parts] == np.cumsum([0] + [p[1] for p in parts])[:-1].tolist() and sum(p[1] for p in parts) <= packing.LENGTH


def test_packer_wastes_little():
    rng = np.random.default_rng(0)
    packer = packing.Packer(0)
    for i in range(3000):
        packer.add(i, np.arange(rng.integers(1, 6000), dtype="<u4"))
        assert len(packer.free) <= packing.OPEN
    used = defaultdict(int)
    for row in packer.emit():
        used[row[5]] += row[2]
    assert all(packing.LENGTH - packing.SLACK <= n <= packing.LENGTH for n in used.values())


def test_best_fit_decreasing():
    assert sharding.best_fit_decreasing([4, 8, 1, 4, 2, 1], 10) == [1, 0, 1, 1, 0, 1]
    assert sharding.best_fit_decreasing([4, 4, 4], 5, limit=2) is None
    assert sharding.best_fit_decreasing([30, 1], 10) == [0, 1]
    sizes = [random.Random(1).randint(1, 1000) for _ in range(400)]
    bins = sharding.near_equal(sizes, 8)
    sums = [sum(s for s, b in zip(sizes, bins, strict=True) if b == k) for k in range(8)]
    assert max(sums) - min(sums) <= 0.01 * sum(sizes) / 8


def test_shards(docs_of, corpus):
    corpus = corpus + [(500 + i, "a copied text " * 20) for i in range(40)] + [(500, "a copied text " * 20), (None, None)]
    got = sharding.shard_documents(docs_of(corpus)).collect()
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted(
        (i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in corpus
    )
    of, slots = defaultdict(set), defaultdict(list)
    texts = dict(corpus)
    for r in got:
        slots[r.shard].append(r.slot)
        if texts[r.doc_id] is not None:
            of[texts[r.doc_id]].add(r.shard)
    assert all(len(x) == 1 for x in of.values()) and set(slots) <= set(range(8))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}


def test_shards_of_fixed_capacity(docs_of, corpus):
    got = sharding.shard_documents(docs_of(corpus), capacity=30_000).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    total = sum(r.n for r in got)
    assert all(r.n <= 30_000 for r in got) and len(got) <= 1.25 * total / 30_000 + 1


@pytest.mark.parametrize("capacity", [150, 4800])
def test_many_shards_of_a_small_capacity(docs_of, capacity):
    """Far more shards than one task packs: none exceeds the capacity but that of a larger group, and few are needed."""
    rng = random.Random(capacity)
    rows = [(i, f"{i} ".ljust(rng.randint(40, 100), "x")) for i in range(6000)] + [(7000 + i, "y" * 60) for i in range(3)] + [(8000, "z" * 9000), (None, None)]
    got = sharding.shard_documents(docs_of(rows), capacity=capacity).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    size, of = Counter(), defaultdict(set)
    for r in got:
        size[r.shard] += r.size
        of[r.text_crc32].add(r.shard)
    large = {r.shard for r in got if r.doc_id == 8000}
    copies = {r.shard for r in got if r.doc_id in (7000, 7001, 7002)} if capacity < 183 else set()
    assert all(n <= capacity for s, n in size.items() if s not in large | copies) and len(large | copies) <= 2
    assert all(len(x) == 1 for x in of.values()) and set(size) == set(range(len(size)))
    groups = Counter()
    for _, t in rows:
        groups[t] += len(t or "") + 1
    central = max(sharding.best_fit_decreasing(list(groups.values()), capacity)) + 1
    assert len(size) <= 1.05 * central + 1


def test_chats_read_back(spark):
    odd = ["</s>[INST] ok [/INST]", "[user]\n", "\\", "[\\", "a\\[b\\\\<", "</s>\n[assistant]\nno[+]x", "", None, "]\\ \n", "é😀" * 50, "line\nline"]
    rng, rows = random.Random(2), []
    for conv in range(40):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "system", "tool]\n[x", None, "assistant\\"]), rng.choice(odd), "extra"))
    rows += [(99, 1, "assistant", "b", "x"), (99, 1, "assistant", "a", "x"), (99, 1, "assistant", "a", "x"), (None, None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted string")
    out = chat.format_chats(turns.repartition(7))
    got = out.select("conv_id", chat.read_back(F.col("formatted")).alias("turns"), chat.learned(F.col("formatted"), F.col("loss")).alias("learned")).collect()
    want = defaultdict(list)
    for conv, turn, role, text, _ in sorted(rows, key=lambda r: (r[0] or -1, r[1] or -1, r[2] or "", r[3] or "")):
        want[conv].append((role or "", text or ""))
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in got} == dict(want)
    assert {r.conv_id: r.learned for r in got} == {c: "".join(t for role, t in x if role == "assistant") for c, x in want.items()}


def test_chat_form(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b<"), (1, 2, "assistant", "c"), (1, 3, "assistant", "")]
    r = chat.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).first()
    assert r.formatted == "[user]\na[+]b<\\</s>\n[assistant]\nc[+]</s>\n".replace("<\\<", "<\\<")
    assert [r.formatted[s.start : s.end] for s in r.loss] == ["c", ""]


def test_secrets(docs_of):
    rng = random.Random(6)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(44))
    texts = [
        None, "", "é password = 'abc' token: \"abcdef1\" 😀 API-KEY=xyzxyz api_KEY:: xyzxyz SECRET=token:abcdefgh", "x AKIA" + "A1" * 8 + " AKIASHORT AKIAAKIA" + "9" * 12,
        "0123456789abcdef01234567 0123456789ABCDEF01234567 " + "f" * 23, "token=" + "0a" * 20 + "," + "0a" * 20, "paſsword=abcdefgh", f"é a {key} b", "ab1" * 12,
        "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", "password=" + "x" * 50_000, ("secret = abcdefg; " * 500),
        "\ufeffsecret=abcdefg\ufeffsecret=abcdefg\ufeff", "secret=" + "0a" * 20 + "AKIA" + "A1" * 9 + " x", f"{'q' * 25} AKIA{'B' * 16}{key}",
    ]
    docs = docs_of(list(enumerate(texts)))
    got = {r.doc_id: r for r in secrets.scan(docs).collect()}
    assert {i: [(s.start, s.kind, s.end) for s in r.base] for i, r in got.items()} == {i: brute.secrets(t) for i, t in enumerate(texts)}
    added = {i: [(s.start, s.end) for s in r.spans if s.kind == 3] for i, r in got.items()}
    assert added.pop(7) == [(4, 4 + len(key))] and not any(added.values())
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns
    for r in clean.collect():
        spans, text = got[r.doc_id].spans, texts[r.doc_id]
        if not spans:
            assert r.text == text
        else:
            out, at = "", 0
            for s in spans:
                if s.start >= at:
                    out += text[at : s.start] + secrets.MASK
                at = max(at, s.end)
            assert r.text == out + text[at:] and r.n_chars == len(r.text)


def test_battery_separates_random_from_regular(spark):
    rng = random.Random(1)
    pick = lambda abc, n: "".join(rng.choice(abc) for _ in range(n))
    random_ones = [pick(abc, n) for abc in ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0123456789") for n in (40, 64, 200) for _ in range(30)]
    regular = [pick("ab1", n) for n in (40, 64, 200) for _ in range(30)] + ["".join(sorted(pick("0123456789abcdef", n))) for n in (40, 64, 200) for _ in range(30)]
    rows = spark.createDataFrame([(t,) for t in random_ones + regular], "text string")
    span = F.array(F.struct(F.lit(0).alias("start"), F.lit(3).alias("kind"), F.length("text").alias("end"), F.col("text").alias("token")))
    tests = rows.withColumn("tests", secrets._battery(span))
    cut = secrets.cutoffs(tests)
    got = [r.tests[0].bin < cut.get(r.tests[0].band, 10**9) for r in tests.collect()]
    assert sum(got[: len(random_ones)]) >= 0.95 * len(random_ones) and sum(got[len(random_ones) :]) <= 0.1 * len(regular)


def _accepted(spark, tokens):
    rows = spark.createDataFrame([(t,) for t in tokens], "text string").coalesce(1)
    found = secrets.found(rows)
    return [len(r.spans) for r in found.withColumn("spans", secrets.accepted(secrets.cutoffs(found))).collect()]


def test_keys_of_letters_and_long_words(spark):
    """Recall and precision where keys without a digit stand among ten times as many long words and names."""
    rng = random.Random(8)
    low = "abcdefghijklmnopqrstuvwxyz"
    parts = "heit lich keit ung ein schaft tion ment ness able inter counter over ship hood ation ical ing er".split()

    def word():
        out, cap = "", rng.random() < 0.3
        sep = rng.choice(("", "", "", "_", "-"))
        while len(out) < 20:
            part = rng.choice(parts)
            out += (sep if out else "") + (part.title() if cap else part)
        return out

    keys = ["".join(rng.choice(abc) for _ in range(n)) for abc in (low, low.upper(), low + low.upper()) for n in (20, 24, 31) for _ in range(20)]
    words = [word() for _ in range(10 * len(keys))]
    got = _accepted(spark, keys + words)
    kept, false = sum(got[: len(keys)]), sum(got[len(keys) :])
    assert kept >= 0.8 * len(keys) and false <= 0.25 * (kept + false), (kept, false, len(keys))
    assert _accepted(spark, ["1" * 23, "_" * 40, "------------------------", "12345678901234567890"]) == [0] * 4


def test_a_text_with_many_matches(spark):
    """Spans and masks of 40,000 matches, as many tokens beside them, and their running sums in blocks."""
    import re

    text = " ".join(f"token=abcdef{i:05d} {'az' * 10}{i:05d}" for i in range(40_000))
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    got = secrets.scan(docs).select("base", "spans").first()
    assert [(s.start, s.end) for s in got.base] == [m.span() for m in re.finditer("token=abcdef[0-9]{5}", text)]
    clean, want = secrets.redact(docs).first().text, text
    for s in reversed(got.spans):
        want = want[: s.start] + secrets.MASK + want[s.end :]
    assert clean == want and clean.count(secrets.MASK) >= 40_000


def test_secrets_equal_their_sql(spark, tmp_path):
    """Tokens of all encodings and lengths, random and regular ones, in texts that have base spans too."""
    rng = random.Random(4)
    alphabets = [abc for _, abc in secrets.ALPHABETS] + ["ab1", "abcdefghijk23", "aeinrst", "aeinrstX_", "0123456789", secrets._ANY]
    rows = []
    for i in range(300):
        words = [brute.prose(rng, 3)]
        for _ in range(rng.randint(0, 3)):
            words.append("".join(rng.choice(alphabets[i % len(alphabets)]) for _ in range(rng.choice((19, 20, 31, 40, 70, 130, 300)))))
        if i % 9 == 0:
            words.append(f"é secret = '{words[-1]}'")
        rng.shuffle(words)
        rows.append((i, " ".join(words), None))
    rows += [(400, None, None), (401, "", None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, other string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op9_randomness(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    res = con.execute(SECRETS_SQL)
    names = [d[0] for d in res.description]
    want = {r[0]: r for r in res.fetchall()}
    have = {r.doc_id: tuple(r[c] for c in names) for r in got.collect()}
    assert have == want
    assert sum("random" in r[names.index("spans")] for r in want.values()) > 30
    assert sum("random" not in r[names.index("spans")] for r in want.values()) > 30


def test_url_parts_and_rules(spark):
    rows = ["https://A.Example.org/en/1?x=/es/", "http://org/", "x://org", "ftp://forg/", None, "no scheme/en/1", "http://é.COM/fr/é#y", "a://b.com?u=://org/", "http://example.org/es/x", "http://notexample.org/es/x", "://", "http://com/de/"]
    name, says = urls.rule()
    got = urls.parts(spark.createDataFrame([(u,) for u in rows], "url string")).select("host", "path", name, says).collect()
    assert [tuple(r) for r in got] == [
        ("a.example.org", "/en/1", "example.org/en/1", "block"), ("org", "/", "org/", "allow"), ("org", "", None, None), ("forg", "/", None, None), ("", "", None, None), ("", "", None, None),
        ("é.com", "/fr/é", "com/fr/", "allow"), ("b.com", "", None, None), ("example.org", "/es/x", "example.org/es/", "block"), ("notexample.org", "/es/x", "org/", "allow"), ("", "", None, None), ("com", "/de/", "com/de/", "block"),
    ]


def test_url_trees_on_held_out_urls(spark):
    rng = random.Random(3)

    def url(bad):
        host = brute.prose(rng, 1) + (".net" if rng.random() < 0.5 else ".info")
        path = "/".join(brute.prose(rng, 1) for _ in range(rng.randint(1, 3)))
        return f"http://{host}/{path}" + (f"/{rng.randint(10**8, 10**9)}?a=1&b={rng.randint(1, 99)}" if bad else "")

    rows = [(i, url(i % 3 == 0), i % 3 == 0) for i in range(900)]
    full = spark.createDataFrame([(i, u, float(b)) for i, u, b in rows], "page_id bigint, url string, bad double")
    got = urls.judge_urls(full.where("page_id >= 600").drop("bad").withColumn("score", F.lit("x")), full.where("page_id < 600")).collect()
    assert len(got) == 300 and sum((r.verdict == "block") == rows[r.page_id][2] for r in got) >= 290


def test_urls_without_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c"), (2, None), (2, None), (3, "http://x.com/de/")], "page_id int, url string")
    got = urls.judge_urls(pages, pages.limit(0).select("url", F.lit(1).alias("bad"))).collect()
    assert sorted((r.page_id, r.verdict) for r in got) == [(1, "allow"), (2, "allow"), (2, "allow"), (3, "block")]
    assert urls.judge_urls(pages.limit(0), pages.select("url", F.lit(1).alias("bad"))).count() == 0


def test_cells_are_counted_over_all_tokens(docs_of, corpus):
    docs = docs_of(corpus)
    frequent = language.vocabulary(docs)
    counts = language.cell_counts(docs.repartition(3), frequent)
    _, cell = language.cells(pa.array([t for _, t in corpus], pa.string()), frequent)
    assert (counts.reshape(-1) == np.bincount(cell, minlength=counts.size)).all()
    w, token = language.tokens(pa.array(["a, b. A", None, "b"]), frequent)
    _, cell = language.cells(pa.array(["a, b. A", None, "b"]), frequent)
    v = language.VOCABULARY
    a, b, c, d = token.tolist()
    assert a == c and b == d
    assert cell.tolist() == [b * v + a, (a * v + c) * v + b, b * v * v + c, d]


def test_network_learns_both_sides():
    """The middle of x ? y is decided by the two sides together."""
    v = 8
    counts = np.zeros((v, v, v))
    for left in (1, 2):
        for right in (3, 4):
            counts[left, right, 5 + (left + right) % 2] = 100
    model = language.WindowNetwork(counts)
    table = model.table().reshape(v, v, v)
    assert np.allclose(np.exp(table).sum(axis=2), 1, atol=1e-3)
    assert all(math.exp(table[left, right, 5 + (left + right) % 2]) > 0.9 for left in (1, 2) for right in (3, 4))


def test_scores_prefer_the_corpus_language(docs_of):
    rng = random.Random(3)
    order = "ba ce di fo gu ha".split()
    fluent = [" ".join(order[(s + i) % 6] for i in range(60)) for s in range(60)]
    shuffled = [" ".join(rng.choice(order) for _ in range(60)) for _ in range(6)]
    rows = list(enumerate(fluent + shuffled)) + [(200, None), (201, ""), (202, "x"), (202, "x")]
    got = language.score_documents(docs_of(rows)).collect()
    score = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and score[200].n_tokens == 0 and score[200].pseudo_ll == 0 and score[201].mean_ll is None
    assert min(score[i].mean_ll for i in range(60)) > max(score[60 + i].mean_ll for i in range(6))


def plain_scores(rows, table, top):
    """Scores place by place: a geometric mean of the network, the word on the left and the word on the right."""
    v, shapes = language.VOCABULARY, language.SHAPES
    order = {w: 1 + i for i, w in enumerate(sorted(top, key=lambda w: language.normal_words(pa.array([w]))[1][0]))}
    token = lambda w: 0 if w is None else order.get(w, v - shapes - 1 + min(len(w), shapes))
    cube = table.astype(float).reshape(v, v, v)
    texts = [[None, *(t or "").split(), None] for _, t in rows]
    n = Counter(w for ws in texts for w in ws[1:-1])
    size = Counter()
    for w, k in n.items():
        if w not in top:
            size[min(len(w), shapes)] += k
    pairs = Counter(p for ws in texts for p in zip(ws, ws[1:]))
    out = []
    for ws in texts:
        total = 0.0
        for x, w, y in zip(ws, ws[1:], ws[2:]):
            net = math.exp(cube[token(x), token(y), token(w)]) * (1 if w in top else n[w] / size[min(len(w), shapes)])
            tell = lambda z, pair: net if z is None or z in top else (pairs[pair] - 1 + 1 / (len(n) + 1)) / n[z]  # noqa: E731, B023
            total += (math.log(net) + math.log(tell(x, (x, w))) + math.log(tell(y, (w, y)))) / 3
        out.append(total)
    return out


def check_scores(docs, rows, top):
    got = language.score_documents(docs).collect()
    table = language.WindowNetwork(language.cell_counts(docs, language.vocabulary(docs))).table()
    want = sorted((i or -1, len((t or "").split()), x) for (i, t), x in zip(rows, plain_scores(rows, table, set(top))))
    found = sorted((r.doc_id or -1, r.n_tokens, r.pseudo_ll) for r in got)
    assert [x[:2] for x in found] == [x[:2] for x in want]
    assert [x[2] for x in found] == pytest.approx([x[2] for x in want], abs=1e-6)
    return got


def test_every_word_has_its_own_share(docs_of):
    """Words beyond the network's classes score by their counts."""
    top = " ".join(f"t{i:03d}" for i in range(language.VOCABULARY - language.SHAPES - 1))
    rows = [(i, f"{top} {top}") for i in range(10)] + [(20 + i, "often seldom") for i in range(9)]
    rows += [(40, "t000 often t001"), (41, "t000 rarer t001"), (42, "t000 xqzvk t001"), (43, "rarer xqzzz rarer"), (43, "rarer xqzzz rarer"), (None, None)]
    got = check_scores(docs_of(rows), rows, top.split())
    score = {r.doc_id: r.mean_ll for r in got}
    assert score[40] > score[41] > score[42]


def test_words_beside_are_counted_over_the_whole_corpus(docs_of):
    """Equal neighbours in one text, in several and in copies, at ends and beside frequent words."""
    rng = random.Random(11)
    top = [f"t{i:03d}" for i in range(language.VOCABULARY - language.SHAPES - 1)]
    some = [f"w{i}" for i in range(12)] + [f"seldom{i}" for i in range(200)]
    texts = [" ".join(rng.choice(top[:5] if rng.random() < 0.3 else some[:12] if rng.random() < 0.7 else some) for _ in range(30)) for _ in range(30)]
    rows = [(200 + i, " ".join(top * 2)) for i in range(40)] + list(enumerate(texts + texts[:6], 20)) + [(90, "w1 w2 w1 w2 w1 w2"), (91, None), (91, ""), (92, "w1")]
    check_scores(docs_of(rows).repartition(5), rows, top)


def test_documents_that_occur_twice_score_apart(docs_of):
    """Each word is masked itself, so only another place of the corpus can predict a rare one."""
    rng = random.Random(12)
    text = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) if rng.random() < 0.6 else rng.choice(["the", "of", "and"]) for _ in range(80))
    once, twice = [text() for _ in range(60)], [text() for _ in range(20)]
    got = language.score_documents(docs_of(list(enumerate(once + twice + twice)))).collect()
    score = {r.doc_id: r.mean_ll for r in got}
    assert min(score[60 + i] for i in range(40)) > max(score[i] for i in range(60))
    assert all(score[60 + i] == score[80 + i] for i in range(20))


@pytest.mark.parametrize("operator", [
    lambda d: packing.pack_documents(d, tokenizer_path()), sharding.shard_documents, secrets.scan, secrets.redact, language.score_documents,
    lambda d: chat.format_chats(d.selectExpr("doc_id AS conv_id", "doc_id AS turn", "lang AS role", "text")),
])
def test_empty_tables(docs_of, operator):
    assert operator(docs_of([])).count() == 0


def test_a_very_long_conversation(spark):
    """40,000 turns in one conversation: work that grew with the square of the turns would take minutes."""
    import time

    turns = spark.range(40_000).select(
        F.lit(5).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("é[x] <"), F.col("id").cast("string")).alias("text"),
    )
    began = time.time()
    out = chat.format_chats(turns)
    r = out.select(chat.read_back(F.col("formatted")).alias("turns"), chat.learned(F.col("formatted"), F.col("loss")).alias("learned"), "loss", "formatted").first()
    assert [(t.role, t.text) for t in r.turns] == [("assistant" if i % 3 else "user", f"é[x] <{i}") for i in range(40_000)]
    assert r.learned == "".join(f"é[x] <{i}" for i in range(40_000) if i % 3)
    assert "".join(r.formatted[s.start : s.end] for s in r.loss) == chat_escaped(r.learned)
    assert time.time() - began < 60


def chat_escaped(text):
    import re

    return re.sub(r"([\\\[<])", r"\1\\", text)
