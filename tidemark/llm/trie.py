"""Prefix trie of conversations by adaptive radix trees (operator 13).

A node of depth d stands for a sequence of d turns (role, text) that some
conversation begins with; the root is the empty one.

Method. A turn's id is 128 bits of hash of its role and text, written as 16
big-endian bytes. A conversation's ids, one after the other, are its key.
Tasks put the keys of their conversations into a radix tree
(:mod:`tidemark.llm.radix`) and read from it the nodes at the byte depths that
lie between two turns, each with the number and the least of its conversations;
branches inside of a turn's bytes give none. So a task hands on each prefix that its
conversations share once. The partial nodes of all tasks are merged by an
aggregate on the node's key: the depth and the exclusive or of a 128-bit hash of each
(turn id, depth).

Sums over subtrees without visiting subtrees. A node belongs to its least
conversation, so a conversation owns its nodes from some depth on. With A(c)
the characters of the turns of c before the nodes it owns, the sum of
``(n_convs - 1) * characters`` over the subtree of v is the sum of A over the
members of v but its owner, less ``n_convs - 1`` times the characters before v. The
leaves of a subtree are its members that own a childless node. Both are sums
over members, so a second pass through the trees gives them.

Scale. No conversation is in one task whole. Turns are cut by range into
slices of the order (conversation, turn), so one of a third of all rows is
many slices; places, prefix hashes and running characters come from one row for each
(conversation, slice) and a running value inside the slice. Keys are segments of ``SEGMENT`` turns
that begin with the hash of what stands before. A first turn that a third of all conversations
share is one row of each task. Texts are shuffled once. Trees are emptied every
``TREE_BYTES`` of keys. *By its contract* the conversations that end at
one node are listed in one row, to be digested.

Edge cases. Null roles and texts are empty, a null turn comes first, equal turn
numbers are ordered by role and text; rows without a conversation id belong to no conversation and are left
out. Repeated rows are turns of their own. A conversation without turns (see
:func:`rebuilt`) ends at the root. An empty table gives no nodes. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import settled
from tidemark.llm.radix import RadixTree

#: Turns of one segment; bytes of a turn's id; bytes before the first id of a key.
SEGMENT, ID_BYTES, HEAD_BYTES = 64, 16, 24
TREE_BYTES = 32 << 20

_NODE = ["depth", "x1", "x2"]
_PARTIAL = "depth bigint, x1 bigint, x2 bigint, p1 bigint, p2 bigint, chars bigint, before bigint, n_convs bigint, conv_id bigint, skipped bigint, all_skipped bigint, n_leaves bigint"


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, slice, place, t1, t2, chars``: each turn's place (from 0), id and code points."""
    x = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    x = x.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.monotonically_increasing_id().alias("at"),  # the task's number and the row's in it
        F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit(13), "text", "role", F.octet_length("text")).alias("t2"),
        F.length("text").cast("bigint").alias("chars"),
    )
    x = settled(x.withColumn("slice", F.shiftright("at", 33)), "trie-turns")
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = x.groupBy("conv_id", "slice").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("conv_id", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy("conv_id", "slice").orderBy("at")) - 1
    return x.join(counts, ["conv_id", "slice"]).select("conv_id", "slice", (F.col("offset") + own).alias("place"), "t1", "t2", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation c begins with the first h turns of conversation ``c - c % 100`` in place of its own first h.

    h is ``crc32(decimal c) % 6``. Returns the new turns (``conv_id, slice,
    depth, t1, t2, chars``) and all conversations (``conv_id``), of which some may have no turn left.
    """
    x = settled(ordered_turns(turns), "trie-places")
    h = F.crc32(F.col("conv_id").cast("string")) % 6
    slices = x.select("conv_id", "slice").distinct()
    heads = x.where((F.col("place") < 5) & (F.col("conv_id") % 100 == 0)).groupBy(F.col("conv_id").alias("base"))
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("place", "t1", "t2", "chars"))).alias("head"))  # five turns at most
    convs = slices.select("conv_id").distinct().withColumn("base", F.col("conv_id") - F.col("conv_id") % 100).join(heads, "base", "left")
    convs = convs.select("conv_id", F.slice(F.coalesce("head", F.array()), F.lit(1), h.cast("int")).alias("head"))
    first = convs.select("conv_id", F.inline("head")).select("conv_id", F.lit(-1).cast("bigint").alias("slice"), (F.col("place") + 1).alias("depth"), "t1", "t2", "chars")
    shift = slices.join(convs.select("conv_id", (F.size("head") - h + 1).alias("shift")), "conv_id")
    rest = x.where(F.col("place") >= h).join(shift, ["conv_id", "slice"])
    rest = rest.select("conv_id", "slice", (F.col("place") + F.col("shift")).alias("depth"), "t1", "t2", "chars")
    return settled(first.unionByName(rest), "trie-rebuilt"), convs.select("conv_id")


def _terms(turns: DataFrame) -> DataFrame:
    return turns.withColumn("x1", F.xxhash64("t1", "t2", "depth")).withColumn("x2", F.xxhash64(F.lit(17), "t2", "t1", "depth"))


def _segments(turns: DataFrame) -> DataFrame:
    """``conv_id, seg, p1, p2, before, turns``: the turns of each segment, and the prefix hash and characters before it."""
    x = _terms(turns)
    sums = [F.bit_xor("x1").alias("c1"), F.bit_xor("x2").alias("c2"), F.sum("chars").alias("sum")]
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.bit_xor("c1").over(earlier).alias("c1"), F.bit_xor("c2").over(earlier).alias("c2"), F.sum("sum").over(earlier).alias("sum")]
    carry = x.groupBy("conv_id", "slice").agg(*sums).select("conv_id", "slice", *[F.coalesce(c, F.lit(0)).alias(n) for c, n in zip(carried, ("c1", "c2", "sum"), strict=True)])
    inside = Window.partitionBy("conv_id", "slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = lambda term, c: F.bit_xor(term).over(inside).bitwiseXOR(F.col(c))
    x = x.join(carry, ["conv_id", "slice"]).select(
        "conv_id", "depth", "t1", "t2", running("x1", "c1").alias("x1"), running("x2", "c2").alias("x2"), "chars",
        F.col("x1").alias("own1"), F.col("x2").alias("own2"), (F.sum("chars").over(inside) + F.col("sum") - F.col("chars")).alias("before"),
    )
    x = x.groupBy("conv_id", F.floor((F.col("depth") - 1) / SEGMENT).alias("seg")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "t1", "t2", "x1", "x2", "chars", "own1", "own2", "before"))).alias("turns")
    )
    head = F.col("turns")[0]
    return x.select("conv_id", "seg", head["x1"].bitwiseXOR(head["own1"]).alias("p1"), head["x2"].bitwiseXOR(head["own2"]).alias("p2"), head["before"].alias("before"), "turns")


class _Keys:
    """Segments of some batches: their keys, and the columns of their turns one after the other."""

    def __init__(self, batches: list[pa.RecordBatch]):
        t = pa.Table.from_batches(batches).combine_chunks()
        long = lambda c: c.to_numpy(zero_copy_only=False).astype(np.int64)
        lists = t["turns"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        self.count = long(lists.value_lengths())
        self.first = np.r_[0, np.cumsum(self.count)]
        flat = lists.flatten()
        self.turn = {n: long(flat.field(i)) for i, n in enumerate(("depth", "t1", "t2", "x1", "x2", "chars"))}
        self.row = {n: long(t[n]) for n in ("conv_id", "seg", "p1", "p2", "before", "skipped", "leaf")}
        self.ids = np.column_stack([self.turn["t1"], self.turn["t2"]]).astype(">i8").tobytes()
        self.heads = np.column_stack([self.row["seg"], self.row["p1"], self.row["p2"]]).astype(">i8").tobytes()

    def key(self, i: int) -> bytes:
        return self.heads[HEAD_BYTES * i : HEAD_BYTES * (i + 1)] + self.ids[ID_BYTES * self.first[i] : ID_BYTES * self.first[i + 1]]

    def nodes(self) -> pa.RecordBatch | None:
        """The trie's nodes that these segments show, from one radix tree."""
        tree = RadixTree(_merged)
        for i, (c, skipped, leaf) in enumerate(zip(*[self.row[n].tolist() for n in ("conv_id", "skipped", "leaf")], strict=True)):
            tree.add(self.key(i), (1, c, i, skipped, skipped, leaf))
        found = []
        for above, to, (n, c, i, skipped, total, leaves) in tree.walk():
            low = max((above - HEAD_BYTES) // ID_BYTES, 0)
            for k in range(low, (to - HEAD_BYTES) // ID_BYTES):  # a node for each turn that ends in (above, to]
                found.append((i, k, n, c, skipped, total, leaves))
        if not found:
            return None
        i, k, n, c, skipped, total, leaves = np.array(found, np.int64).T
        at = self.first[i] + k
        sums = np.r_[0, np.cumsum(self.turn["chars"])]
        p1, p2 = (np.where(k > 0, self.turn[x][at - 1], self.row[p][i]) for x, p in (("x1", "p1"), ("x2", "p2")))
        before = self.row["before"][i] + sums[at] - sums[self.first[i]]
        columns = [*[self.turn[x][at] for x in _NODE], p1, p2, self.turn["chars"][at], before, n, c, skipped, total, leaves]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=[p.split()[0] for p in _PARTIAL.split(", ")])


def _merged(a: tuple, b: tuple) -> tuple:
    """Conversations, the least one with its segment and skipped characters, all skipped characters, leaves."""
    low = a if a[1] <= b[1] else b
    return (a[0] + b[0], low[1], low[2], low[3], a[4] + b[4], a[5] + b[5])


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        for i in range(0, batch.num_rows, 2048):
            part = batch.slice(i, 2048)
            held.append(part)
            size += ID_BYTES * len(part.column(part.schema.get_field_index("turns")).flatten()) + HEAD_BYTES * part.num_rows
            if size >= TREE_BYTES:
                out = _Keys(held).nodes()
                held, size = [], 0
                if out is not None:
                    yield out
    if held:
        out = _Keys(held).nodes()
        if out is not None:
            yield out


def _partial_nodes(segments: DataFrame, skipped: Column, leaf: Column) -> DataFrame:
    x = segments.select("conv_id", "seg", "p1", "p2", "before", "turns", skipped.cast("bigint").alias("skipped"), leaf.cast("bigint").alias("leaf"))
    return x.mapInArrow(_grown, _PARTIAL)


def prefix_trie(turns: DataFrame, convs: DataFrame | None = None) -> DataFrame:
    """The nodes of ``turns(conv_id, slice, depth, t1, t2, chars)``, from :func:`rebuilt` or :func:`numbered`.

    ``convs``: all conversations, also those without turns. Returns ``conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends``
    (the sorted conversations that end at the node) ``, last_chars``.
    """
    paths = _terms(turns).groupBy("conv_id").agg(F.max("depth").alias("depth"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("chars").alias("chars"))
    if convs is not None:
        paths = convs.join(paths, "conv_id", "left").na.fill(0)
    paths = settled(paths, "trie-paths")
    segments = settled(_segments(turns), "trie-segments")

    zero, root = F.lit(0).cast("bigint"), [F.lit(0).cast("bigint").alias(c) for c in (*_NODE, "p1", "p2", "chars", "before")]
    found = _partial_nodes(segments, zero, zero).groupBy(*_NODE).agg(
        *[F.min(c).alias(c) for c in ("p1", "p2", "chars", "before")], F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id")
    )
    top = paths.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    nodes = settled(found.unionByName(top.select(*root, "n_convs", "conv_id")), "trie-nodes")

    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = settled(nodes.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", zero)), "trie-children")
    owned = nodes.groupBy("conv_id").agg(F.min_by("before", "depth").alias("skipped"), F.max((F.col("n_children") == 0).cast("bigint")).alias("leaf"))
    weights = paths.select("conv_id", "chars").join(owned, "conv_id", "left")
    weights = settled(weights.select("conv_id", F.coalesce("skipped", "chars").alias("skipped"), F.coalesce("leaf", zero).alias("leaf")), "trie-weights")

    least = F.min(F.struct("conv_id", "skipped"))["skipped"].alias("skipped")
    sums = _partial_nodes(segments.join(weights, "conv_id"), F.col("skipped"), F.col("leaf"))
    sums = sums.groupBy(*_NODE).agg(least, F.sum("all_skipped").alias("all_skipped"), F.sum("n_leaves").alias("n_leaves"))
    all_of = weights.agg(least, F.sum("skipped").alias("all_skipped"), F.sum("leaf").alias("n_leaves")).where("skipped IS NOT NULL")
    sums = sums.unionByName(all_of.select(*root[:3], "skipped", "all_skipped", "n_leaves"))
    ends = paths.groupBy(*_NODE).agg(F.sort_array(F.collect_list("conv_id")).alias("ends"))
    parents = nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, _NODE).join(ends, _NODE, "left").join(parents, ["depth", "p1", "p2"], "left")
    saved = F.col("all_skipped") - F.col("skipped") - (F.col("n_convs") - 1) * F.col("before")
    return out.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        saved.alias("saved_tokens"), F.coalesce("ends", F.array().cast("array<bigint>")).alias("ends"), F.col("chars").alias("last_chars"),
    )


def numbered(turns: DataFrame) -> DataFrame:
    """The turns of ``turns(conv_id, turn, role, text)`` as they are, for :func:`prefix_trie`."""
    x = ordered_turns(turns)
    return settled(x.select("conv_id", "slice", (F.col("place") + 1).alias("depth"), "t1", "t2", "chars"), "trie-numbered")
