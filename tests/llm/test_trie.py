"""Operator 13: the radix tree against a dict, the trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import radix, trie
from tidemark.llm.registry import QUERIES


@pytest.mark.parametrize("alphabet", [2, 5, 17, 60, 256])
def test_radix_tree_counts_every_prefix(alphabet):
    rng = random.Random(alphabet)
    keys = [bytes(rng.randrange(alphabet) for _ in range(rng.choice((0, 1, 2, 3, 6)))) + rng.choice((b"", b"\x00tail", b"\xffother")) for _ in range(900)]
    tree = radix.RadixTree(lambda a, b: a + b)
    for k in keys:
        tree.add(k, 1)
    want = defaultdict(int)
    for k in keys:
        for d in range(len(k) + 1):
            want[k[:d]] += 1
    got, kinds = defaultdict(list), set()
    for above, to, n in tree.walk():
        for d in range(above + 1, to + 1):
            got[d].append(n)
    for d in got:
        assert sorted(got[d]) == sorted(n for k, n in want.items() if len(k) == d)
    stack = [tree.root]
    while stack:
        node = stack.pop()
        kinds.add((type(node.branches).__name__, getattr(node.branches, "room", 0)))
        stack += [n for _, n in node.items()]
    assert {2: ("Sorted", 4), 5: ("Sorted", 16), 17: ("Indexed", 0), 60: ("Table", 0), 256: ("Table", 0)}[alphabet] in kinds


def nodes(paths):
    """The nodes of {conversation: turns}, by walking every subtree."""
    members = defaultdict(list)
    for c, turns in sorted(paths.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    out = []
    for p, own in members.items():
        saved = leaves = 0
        stack = [p]
        while stack:
            q = stack.pop()
            stack += children[q]
            leaves += not children[q]
            saved += (len(members[q]) - 1) * (len(q[-1][1]) if q else 0)
        ends = ",".join(str(c) for c in own if len(paths[c]) == len(p))
        out.append((own[0], len(p), members[p[:-1]][0] if p else None, len(own), len(children[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def ordered(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(rows):
    convs = ordered(rows)
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def table(spark, rows):
    full = [(*r, "x", 1, 2) for r in rows]
    return spark.createDataFrame(full, "conv_id bigint, turn bigint, role string, text string, depth string, slice int, chars int")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(13)
    said = ["hi", "", None, "ä 字 é", "ok then", "x" * 3000]
    out = []
    for c in [*range(0, 240), *range(901, 912), 300, 399, 1200, -5, -105, -100, 2**40, 2**40 - 2**40 % 100]:
        for turn in range(rng.choice((1, 1, 2, 3, 6, 9))):
            out.append((c, turn if rng.random() < 0.9 else None, rng.choice(("user", "assistant", None)), rng.choice(said[: rng.choice((2, 6))])))
    out += [(50, 3, "user", "tie"), (50, 3, "user", "tie"), (50, 3, "assistant", "tie"), (None, 0, "user", "hi"), (None, None, None, None)]
    long = [(k, "user", f"t{k % 7}") for k in range(700)]  # a third of all rows, twice, but for its end
    out += [(500, k, *t) for k, *t in long] + [(501, k, *t) for k, *t in long] + [(777, k, *t) for k, *t in long[:640]] + [(777, 640, "user", "else")]
    rng.shuffle(out)
    return out


def got(df):
    cols = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    return sorted(((*[r[c] for c in cols], hashlib.sha256(",".join(map(str, r.ends)).encode()).hexdigest()) for r in df.collect()), key=str)


def test_trie_equals_plain_version(spark, rows):
    assert got(trie.prefix_trie(trie.numbered(table(spark, rows)))) == nodes(ordered(rows))


def test_small_trees_and_batches_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(trie, "TREE_BYTES", 4000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert got(trie.prefix_trie(*trie.rebuilt(table(spark, rows)))) == nodes(rebuilt(rows))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_query(spark, rows, tmp_path):
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    df = QUERIES["op13_prefix_trie"](spark, str(tmp_path))
    want = nodes(rebuilt(rows))
    assert any(len(p) == 0 for p in rebuilt(rows).values())  # turnless ones end at the root
    assert sorted((tuple(r) for r in df.collect()), key=str) == want


def test_empty_table(spark):
    assert trie.prefix_trie(*trie.rebuilt(table(spark, []))).collect() == []
    assert trie.prefix_trie(trie.numbered(table(spark, [(None, 1, "user", "a")]))).collect() == []
