"""Near-duplicate documents by BagMinHash (operator 1).

Documents are multisets of five-word shingles; two are near copies if their
weighted Jaccard similarity (sum of smaller counts over sum of larger counts)
is 0.8 or more. A class is a connected component of near copies.

Method. Each shingle drives Poisson processes over (weight, time): weights
are discretised at whole numbers and grouped in dyadic blocks (0,1], (1,2],
(2,4], ...; a block's process has the block's width as its rate, and its
points are dealt down the halves of the block to one weight level and to one
of ``components`` signature parts. A document sees the points up to its own
count, and a part holds the earliest time it sees, so two parts agree with
exactly the weighted Jaccard probability. Points are made in order of time up
to the horizon at which every part is filled, about ``m ln m`` for each
document besides the first of each shingle.

Twenty bands of four parts propose candidates (0.8-similar pairs are missed
with probability ``(1 - 0.8**4)**20 = 3e-5``), and each proposed pair is
verified by multiset overlap of the whole texts.

Groups of copies. Equal texts are one node before banding. In a bucket the
members are first held against its least member only. Where a bucket still
has several components, what lies outside its largest one is joined with the
other members by an exact prefix filter on rare shingles (:func:`_rest`). So a
group of near copies costs a few comparisons a member, and no link between
components is left out.

Edge cases. Nodes are texts, whatever ids their rows have: a doc_id that names several
texts is in the class of each, and texts without an id are compared like all
others (a class without any id has a null class_id). A null text is its own class; equal texts are one class, empty
ones too. A text of one to four words is one shingle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import mapped, packed, settled, text_key
from tidemark.llm.components import components
from tidemark.llm.textscan import Words, mix, ngrams, runs, seed

SHINGLE = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 20, 4


def shingles(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text index, 64-bit shingle, count. A shorter text with words is one shingle."""
    w = Words(texts)
    hashes = w.hash()
    text, gram = [], []
    for n in range(1, k + 1):
        fits = w.count >= k if n == k else w.count == n
        grams = ngrams(hashes, n, salt=n)
        at = np.flatnonzero(fits[w.text[: len(grams)]] & (w.text[: len(grams)] == w.text[n - 1 :])) if len(grams) else []
        if len(at):
            text.append(w.text[at])
            gram.append(grams[at])
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text, gram = np.concatenate(text), np.concatenate(gram)
    order = np.argsort(mix(gram ^ mix(text.astype(np.uint64))), kind="stable")
    text, gram = text[order], gram[order]
    start, count = runs(mix(gram ^ mix(text.astype(np.uint64))))
    return text[start], gram[start], count


def bag_minhash(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n_texts: int, parts: int) -> np.ndarray:
    """Signatures (texts x parts): the earliest time of a point in each part; infinite for a text without elements."""
    out = np.full((n_texts, parts), np.inf)
    total = np.bincount(text, weights=weight, minlength=n_texts)
    # the dyadic blocks of weight that each element reaches
    t, e, low, width, top = [], [], [], [], []
    block, lower, step = 0, 0, 1
    reach = np.arange(len(text))
    while len(reach):
        t.append(text[reach])
        e.append(mix(element[reach] ^ seed(500 + block)))
        low.append(np.full(len(reach), lower))
        width.append(np.full(len(reach), step))
        top.append(weight[reach])
        block, lower = block + 1, lower + step
        step = lower
        reach = reach[weight[reach] > lower]
    if not t:
        return out
    t, e, low, width, top = (np.concatenate(x) for x in (t, e, low, width, top))
    with np.errstate(divide="ignore"):
        horizon = np.where(total > 0, parts * (np.log(parts) + 4) / np.maximum(total, 1), 0)
    todo = total > 0
    while todo.any():
        flat = np.full(n_texts * parts, np.inf)
        live = np.flatnonzero(todo[t])
        time, draw = np.zeros(len(live)), 0
        while len(live):
            r = mix(e[live] + seed(draw))
            time = time - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width[live]
            near = time <= horizon[t[live]]
            live, time, r = live[near], time[near], mix(r[near])
            part = ((r >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            level = low[live] + (((r & np.uint64(0xFFFFFFFF)) * width[live].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
            seen = level < top[live]
            np.minimum.at(flat, (t[live] * parts + part.astype(np.int64))[seen], time[seen])
            draw += 1
        found = flat.reshape(n_texts, parts)
        full = todo & np.isfinite(found).all(axis=1)
        out[full] = found[full]
        todo &= ~full
        horizon = horizon * 2
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each text and band."""
    bits = signatures.view(np.uint64).reshape(len(signatures), bands, rows)
    key = np.tile(mix(np.arange(bands, dtype=np.uint64)), (len(signatures), 1))
    for j in range(rows):
        key = mix(key ^ mix(bits[:, :, j]))
    return key


def _sign(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column(batch.schema.get_field_index("text"))
    text, element, weight = shingles(texts)
    keys = band_keys(bag_minhash(text, element, weight, len(texts), BANDS * BAND_ROWS), BANDS, BAND_ROWS).view(np.int64)
    some = Words(texts).count > 0
    flat = pa.array(keys[some].reshape(-1))
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(some * BANDS)].astype(np.int32)), flat)
    return pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in ("id", "k1", "k2")], lists], names=["id", "k1", "k2", "keys"])


def overlap(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts."""
    n = len(a)
    sides = [shingles(x) for x in (a, b)]
    pair = np.concatenate([s[0] for s in sides])
    keys = mix(np.concatenate([s[1] for s in sides]) ^ mix(pair.astype(np.uint64)))
    count = np.concatenate([s[2] for s in sides])
    order = np.argsort(keys, kind="stable")
    start, length = runs(keys[order])
    if not len(start):
        return np.zeros(n)
    both = length == 2
    small = np.minimum.reduceat(count[order], start) * both
    shared = np.bincount(pair[order][start], weights=small, minlength=n)
    total = np.bincount(pair, weights=count, minlength=n)
    return shared / np.maximum(total - shared, 1)


def _bags(batch: pa.RecordBatch) -> pa.RecordBatch:
    text, element, weight = shingles(batch.column(batch.schema.get_field_index("text")))
    node = batch.column(batch.schema.get_field_index("node")).take(pa.array(text))
    return pa.RecordBatch.from_arrays([node, pa.array(element.view(np.int64)), pa.array(weight, pa.int64())], names=["node", "shingle", "w"])


def _verify(batch: pa.RecordBatch) -> pa.RecordBatch:
    u, v, a, b = (batch.column(batch.schema.get_field_index(c)) for c in ("u", "v", "a", "b"))
    ok = pa.array(overlap(a, b) >= SIMILARITY)
    return pa.RecordBatch.from_arrays([u.filter(ok), v.filter(ok)], names=["u", "v"])


def _similar(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The pairs ``(u, v)`` whose texts are near copies. No side has a bound, so neither is broadcast."""
    one = texts.select(F.col("node").alias("u"), F.col("text").alias("a")).join(pairs.hint("merge"), "u")
    two = texts.select(F.col("node").alias("v"), F.col("text").alias("b")).join(one.hint("merge"), "v")
    return settled(mapped(two.select("u", "v", "a", "b"), _verify, "u bigint, v bigint", ("a", "b")), name)


def _pair(a: str, b: str) -> list:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def _open_buckets(buckets: DataFrame, links: DataFrame) -> DataFrame:
    """``key, node, label`` of the buckets that still hold several components."""
    labels = settled(components(links), "labels")
    labelled = buckets.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    labelled = settled(labelled, "labelled")
    several = labelled.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where(F.col("a") != F.col("b")).select("key")
    return settled(labelled.join(settled(several, "several"), "key", "left_semi"), "open")


def _rest(still: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs of different components in open buckets that can still be near copies, by their rarest shingles.

    Order the shingles of all these texts by how many texts have them, rare
    first. If the first shingle that two texts share has ``i`` and ``j``
    others before it, at most the remaining ``n - i`` and ``m - j`` can be
    shared, of which a similarity of 4/5 needs ``4/9 (n + m)``. So the shorter
    text (``n <= m``) shares ``8/9 n``, which limits ``i`` to a ninth of ``n``; the longer is at most
    ``5/4 n``, which limits ``j`` to a fifth of ``m``. The rarest ninth of each text is joined with the
    rarest fifth of longer ones, for pairs of which one lies outside its bucket's largest
    component. Texts that share a template but differ in more than a ninth of their shingles
    have none of it in their rarest ninth, so a family of them makes no pairs.
    """
    own = settled(still.groupBy("node").agg(F.first("label").alias("label")), "open-nodes")
    sizes = still.groupBy("key", "label").agg(F.count(F.lit(1)).alias("size"))
    main = settled(sizes.groupBy("key").agg(F.max_by("label", F.struct("size", "label")).alias("main")), "main")
    outside = still.join(main, "key").where(F.col("label") != F.col("main")).select("node", F.lit(True).alias("outside")).distinct()
    own = settled(own.join(outside, "node", "left"), "outside")

    bags = mapped(texts.join(own.select("node").hint("shuffle_hash"), "node", "left_semi"), _bags, "node bigint, shingle bigint, w bigint")
    often = bags.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts"))
    rare_first = Window.partitionBy("node").orderBy("texts", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    ranked = bags.join(often.hint("merge"), "shingle").withColumn("i", F.coalesce(F.sum("w").over(rare_first), F.lit(0)))
    ranked = ranked.withColumn("n", F.sum("w").over(Window.partitionBy("node")))
    prefix = ranked.where((F.col("texts") > 1) & (5 * F.col("i") <= F.col("n"))).select("shingle", "node", "i", "n")
    prefix = settled(prefix.join(own, "node"), "prefix")

    need = 4 * (F.col("n") + F.col("n2"))
    able = (F.col("label") != F.col("label2")) & (9 * (F.col("n") - F.col("i")) >= need) & (9 * (F.col("n2") - F.col("i2")) >= need)
    able = able & ((F.col("n") < F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("node") < F.col("node2")))) & (F.col("outside") | F.col("outside2"))
    prefix = prefix.withColumn("outside", F.coalesce("outside", F.lit(False)))
    short = prefix.where(9 * F.col("i") <= F.col("n"))
    long = prefix.select("shingle", *[F.col(c).alias(f"{c}2") for c in ("node", "i", "n", "label", "outside")])
    return short.join(long.hint("merge"), "shingle").where(able).select(*_pair("node", "node2")).distinct()


def _node_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id, k1, k2`` of every row with a text, and of every text ``k1, k2, least`` (its least id), ``label`` (its class)."""
    base = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))
    keyed = base.where(F.col("text").isNotNull()).select("id", "text", *text_key())
    signed = settled(mapped(keyed, _sign, "id bigint, k1 bigint, k2 bigint, keys array<bigint>"), "signed")
    nodes = signed.groupBy("k1", "k2").agg(F.min("id").alias("least"), F.first("keys").alias("keys"))
    nodes = settled(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")  # written: the numbers stay

    every = nodes.select("node", "least", F.explode("keys").alias("key"))
    order = F.struct(F.col("least").isNull(), "least", "node")  # a bucket's head is its text of least doc_id
    heads = every.groupBy("key").agg(F.min_by("node", order).alias("head"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    buckets = settled(every.drop("least").join(settled(heads.select("key", "head"), "heads"), "key"), "buckets")
    wanted = settled(nodes.select("node", "k1", "k2", "least").join(buckets.select("node").distinct(), "node"), "wanted")
    wanted = wanted.select("node", "least", F.col("k1").alias("a"), F.col("k2").alias("b")).hint("shuffle_hash")
    same = (F.col("k1") == F.col("a")) & (F.col("k2") == F.col("b"))
    named = keyed.join(wanted, (F.col("id") == F.col("least")) & same).dropDuplicates(["id", "k1", "k2"])  # by id: copies are spread
    other = keyed.where(F.col("id").isNull()).dropDuplicates(["k1", "k2"]).join(wanted.where(F.col("least").isNull()), same)
    texts = settled(named.select("node", "text").unionByName(other.select("node", "text")), "candidates")

    # against the least member of each bucket, then what the rare shingles of those still open leave
    met = buckets.where(F.col("node") != F.col("head")).select(*_pair("node", "head")).distinct()
    links = _similar(met, texts, "links")
    still = _open_buckets(buckets, links)
    links = links.unionByName(_similar(_rest(still, texts), texts, "links"))

    labels = settled(components(links), "labels")
    classes = nodes.join(labels, "node", "left").select("k1", "k2", "least", F.coalesce("label", "node").alias("label"))
    return signed.select("id", "k1", "k2"), settled(classes, "classes")


def near_classes(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``class_id`` (the least doc_id of the class) for every row of ``docs(doc_id, text)``."""
    rows, classes = _node_classes(docs)
    least = settled(classes.groupBy("label").agg(F.min("least").alias("class_id")), "least")
    classes = settled(classes.join(least, "label").select("k1", "k2", "class_id"), "class-ids")
    members = rows.join(classes, ["k1", "k2"]).select(F.col("id").alias("doc_id"), "class_id")
    alone = docs.where(F.col("text").isNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"))
    return members.unionByName(alone.withColumn("class_id", F.col("doc_id")))


def near_dedup(docs: DataFrame) -> DataFrame:
    """One document of each class, with its own columns: the one of the least doc_id, or without any id where no row
    of the class has one. Rows that repeat it count once. Of null texts, one row of each doc_id stays, and all without one."""
    _, classes = _node_classes(docs)
    order = F.struct(F.col("least").isNull().alias("no"), "least", "k1", "k2")
    first = settled(classes.groupBy("label").agg(F.min(order).alias("x")).select("x.least", F.col("x.k1").alias("a"), F.col("x.k2").alias("b")), "kept")
    rows = packed(docs).withColumn("id", F.col("row.doc_id").cast("bigint"))
    keyed = rows.where(F.col("text").isNotNull()).select("row", "id", *text_key())
    same = (F.col("k1") == F.col("a")) & (F.col("k2") == F.col("b"))
    named = keyed.join(first.hint("shuffle_hash"), (F.col("id") == F.col("least")) & same, "left_semi").dropDuplicates(["id", "k1", "k2"])
    other = keyed.where(F.col("id").isNull()).dropDuplicates(["k1", "k2"])  # combined in each task: copies meet as one row
    other = other.join(first.where(F.col("least").isNull()).hint("shuffle_hash"), same, "left_semi")
    empty = rows.where(F.col("text").isNull())
    parts = [named, other, empty.where(F.col("id").isNotNull()).dropDuplicates(["id"]), empty.where(F.col("id").isNull())]
    kept = parts[0].select("row")
    for part in parts[1:]:
        kept = kept.unionByName(part.select("row"))
    return kept.select("row.*")
