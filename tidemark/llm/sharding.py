"""Assignment of whole groups to shards by best-fit decreasing (operator 6).

Documents with equal texts form a group, which no shard boundary may cut.
Groups go, largest first, to the shard whose remaining capacity they fit most
tightly; remaining capacities are held in order, so the search is a descent
of a balanced order (bisection). With a given capacity that uses few shards;
for a given number of shards the least capacity that needs no more of them is
found by bisection over it, which makes their bytes near equal.

Scale. Groups are as many as there are texts, so the driver never sees them.
Only groups of at least ``1 / ITEMS`` of all bytes are placed one by one (at
most ``ITEMS`` of them); smaller ones are dealt by hash to ``ITEMS`` parcels
of whole groups, and parcels are placed like groups. The driver thus handles
at most ``2 * ITEMS`` sizes at any input size. With a given capacity there may
be any number of shards, so groups are dealt by hash to parts of about
``PART_SHARDS`` capacities and each part is packed in a task: groups of at
least a ``PART_SHARDS``-th of the capacity one by one, smaller ones in parcels
of about that size. Of each part at most one shard is no more than half full;
these are packed once more in the same way. Texts are read once and never
shuffled: rows carry sizes and 128-bit text keys. Slots come from counts of
small sub-shards, so no task numbers a whole shard.

Edge cases. A null text has size 1 and is a group of its own. Rows that repeat
are separate documents of one group. An empty table gives an empty result. A
group larger than a shard's share makes its shard larger than the others.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import settled

SHARDS = 8
ITEMS = 4096
#: Capacities that one task packs; ITEMS parcels of a part are as many parts of a capacity.
PART_SHARDS = 64
#: Rows that one task numbers.
SLOT_ROWS = 20_000


def best_fit_decreasing(sizes: list[int], capacity: int, limit: int | None = None) -> list[int] | None:
    """The bin of each size; None if more than ``limit`` bins are needed. Sizes over the capacity get bins of their own."""
    room: list[tuple[int, int]] = []  # (remaining capacity, bin), in order
    bins, out = 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_left(room, (sizes[i], -1))
        if at < len(room):
            left, own = room.pop(at)
        else:
            left, own, bins = max(capacity, sizes[i]), bins, bins + 1
            if limit is not None and bins > limit:
                return None
        out[i] = own
        insort(room, (left - sizes[i], own))
    return out


def near_equal(sizes: list[int], shards: int) -> list[int]:
    """Bins of near equal sums: best-fit decreasing with the least capacity that needs no more bins."""
    if not sizes:
        return []
    low = max(-(-sum(sizes) // shards), max(sizes))
    high = max(2 * low, 1)
    best = best_fit_decreasing(sizes, high, shards)
    while low < high:
        middle = (low + high) // 2
        found = best_fit_decreasing(sizes, middle, shards)
        if found is None:
            low = middle + 1
        else:
            best, high = found, middle
    return best


def _bins(items: DataFrame, capacity: int) -> DataFrame:
    """``bin`` of each item within its ``part``; ``items`` has ``part, own, i1, i2, bytes``."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("own", "ascending"), ("i1", "ascending"), ("i2", "ascending")])
        return table.append_column("bin", pa.array(best_fit_decreasing(table["bytes"].to_pylist(), capacity), pa.int64()))

    items = items.select("part", "own", "i1", "i2", "bytes")
    return settled(items.groupBy("part").applyInArrow(pack, "part bigint, own boolean, i1 bigint, i2 bigint, bytes bigint, bin bigint"), "bins")


def _part(total: int, capacity: int, *key: str):
    return F.pmod(F.xxhash64(*key), F.lit(max(1, -(-total // (PART_SHARDS * capacity)))))


def _shards_of_capacity(groups: DataFrame, total: int, capacity: int) -> DataFrame:
    """``k1, k2, shard`` of each group, in shards of at most ``capacity`` bytes (a larger group has one of its own)."""
    own = F.col("bytes") * PART_SHARDS >= capacity
    parcel = F.pmod(F.xxhash64("k2", "k1"), F.lit(ITEMS))
    groups = groups.select("k1", "k2", "bytes", _part(total, capacity, "k1", "k2").alias("part"), own.alias("own"), F.when(own, F.col("k1")).otherwise(parcel).alias("i1"), F.when(own, F.col("k2")).otherwise(F.lit(0)).alias("i2"))
    keys = ["part", "own", "i1", "i2"]
    items = _bins(groups.groupBy(*keys).agg(F.sum("bytes").alias("bytes")), capacity)
    bins = settled(items.groupBy("part", "bin").agg(F.sum("bytes").alias("bytes")), "shard-bins")
    few = bins.where(2 * F.col("bytes") <= capacity)
    left = few.agg(F.sum("bytes")).first()[0] or 0
    again = _bins(few.select(_part(left, capacity, "part", "bin").alias("part"), F.lit(True).alias("own"), F.col("part").alias("i1"), F.col("bin").alias("i2"), "bytes"), capacity)
    again = again.select(F.col("i1").alias("part"), F.col("i2").alias("bin"), F.col("part").alias("part2"), F.col("bin").alias("bin2"))
    level = F.when(F.col("part2").isNull(), 0).otherwise(1)
    bins = bins.select("part", "bin").join(again, ["part", "bin"], "left")
    bins = settled(bins.select("part", "bin", level.alias("level"), F.coalesce("part2", "part").alias("in_part"), F.coalesce("bin2", "bin").alias("in_bin")), "shard-places")
    # shards numbered without gaps: within each part, after those of the parts before (a row for each part)
    counts = bins.groupBy("level", "in_part").agg(F.count_distinct("in_bin").alias("n"))
    first = counts.select("level", "in_part", F.coalesce(F.sum("n").over(Window.orderBy("level", "in_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    nth = F.dense_rank().over(Window.partitionBy("level", "in_part").orderBy("in_bin")) - 1
    shards = bins.withColumn("nth", nth).join(first, ["level", "in_part"]).select("part", "bin", (F.col("first") + F.col("nth")).cast("int").alias("shard"))
    return settled(groups.join(items.select(*keys, "bin"), keys).join(shards, ["part", "bin"]).select("k1", "k2", "shard"), "group-shards")


def _slots(rows: DataFrame) -> DataFrame:
    """``slot``: rows of each shard numbered from 0 without gaps."""
    rows = settled(rows, "shards")
    total = rows.count()
    parts = max(1, -(-total // SLOT_ROWS))
    rows = rows.withColumn("sub", F.pmod(F.xxhash64("doc_id", "k1"), F.lit(parts)))
    counts = rows.groupBy("shard", "sub").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("shard", "sub").orderBy("doc_id", "k1", "k2")
    return rows.join(first, ["shard", "sub"]).withColumn("slot", F.col("first") + F.row_number().over(own) - 1)


def _numbered(rows: DataFrame) -> DataFrame:
    return _slots(rows.select("doc_id", "size", "text_crc32", "k1", "k2", "shard")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def shard_documents(docs: DataFrame, shards: int | None = SHARDS, capacity: int | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row of ``docs(doc_id, text)``.

    ``capacity`` in bytes, in place of ``shards``, takes as few shards as
    best-fit decreasing of parts needs; only a group larger than the capacity
    has a shard that exceeds it.
    """
    text, own = F.col("text").cast("string"), F.col("doc_id").cast("bigint")
    none = text.isNull()
    rows = docs.select(
        own.alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
        F.when(none, F.xxhash64(own)).otherwise(F.xxhash64(text)).alias("k1"),
        F.when(none, F.lit(0).cast("bigint")).otherwise(F.xxhash64(F.lit(7), text, F.octet_length(text))).alias("k2"),
    )
    rows = settled(rows, "sizes").withColumn("parcel", F.pmod(F.xxhash64("k1", "k2"), F.lit(ITEMS)))
    groups = settled(rows.groupBy("k1", "k2").agg(F.sum("size").alias("bytes"), F.first("parcel").alias("parcel")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    if capacity:
        rows = rows.join(_shards_of_capacity(groups, total, capacity), ["k1", "k2"])
        return _numbered(rows)
    large = groups.where(F.col("bytes") * ITEMS >= total).select("k1", "k2", "bytes").orderBy("k1", "k2").collect()
    small = groups.where(F.col("bytes") * ITEMS < total).groupBy("parcel").agg(F.sum("bytes").alias("bytes")).orderBy("parcel").collect()
    sizes = [r.bytes for r in large] + [r.bytes for r in small]
    bins = near_equal(sizes, shards)
    spark = docs.sparkSession
    one = spark.createDataFrame([(r.k1, r.k2, b) for r, b in zip(large, bins, strict=False)], "k1 bigint, k2 bigint, large_shard int")
    two = spark.createDataFrame([(r.parcel, b) for r, b in zip(small, bins[len(large) :], strict=True)], "parcel bigint, small_shard int")
    # both have at most ITEMS rows
    rows = rows.join(F.broadcast(one), ["k1", "k2"], "left").join(F.broadcast(two), "parcel", "left")
    return _numbered(rows.withColumn("shard", F.coalesce("large_shard", "small_shard")))
