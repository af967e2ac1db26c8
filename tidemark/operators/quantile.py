"""Exact continuous percentile per group, without gathering a group in one task.

``percentile(x, p)`` buffers every distinct value of a group in one
aggregation buffer, so one very large group (a third of the data in one
session) would sit in one task's memory. This operator computes the same
value, ``quantile_cont`` / linear interpolation between the order statistics
at ``floor((n-1)p)`` and ``ceil((n-1)p)``, as a distributed rank selection:

1. count each distinct ``(group, value)`` (map-side combined aggregate);
2. range-partition those counts on ``(group, value)``: the sampled range
   bounds split a large group over many tasks;
3. per (task, group) totals give each slice its rank offset: a small table
   with at most one row per group and task;
4. inside each slice of a group, a running count over the sorted values adds to the
   offset; join and running count share one exchange on ``(task, group)``, whose task id spreads a
   large group over many reducers. The at most two rows per group that hold the two order
   statistics are kept;
5. interpolate.

All of it is built-in aggregates, windows and joins.
Every group takes this one path, whatever its size; NULL keys are groups of
their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_percentile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    p: float,
    alias: str = "percentile",
    count_alias: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """One row per group: ``keys``, the exact ``p`` percentile, optionally the group size.

    NULL values are ignored, as by ``percentile``. Groups whose values are all
    NULL are absent; a NULL key is a group.
    """
    keys = list(keys)
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_cnt"))
    )
    # Sorting each input partition first fixes the row order the range
    # partitioner samples, so the bounds (and every row's ``_part``) are the
    # same on any recomputation, whether or not the exchange is reused.
    ordered = (
        counts.sortWithinPartitions(*keys, value)
        .repartitionByRange(n_parts, *[F.col(k).asc_nulls_first() for k in keys], F.col(value).asc())
        .sortWithinPartitions(*keys, value)
        .withColumn("_part", F.spark_partition_id())
    )
    # NULL fields of a struct are equal to each other, so NULL keys meet
    ordered = ordered.withColumn("_group", F.struct(*keys))
    part_totals = ordered.groupBy("_part", "_group").agg(F.sum("_cnt").alias("_part_n"))
    across = Window.partitionBy("_group").orderBy("_part")
    offsets = part_totals.select(
        "_part", "_group",
        F.coalesce(F.sum("_part_n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.sum("_part_n").over(Window.partitionBy("_group")).alias("_n"),
    )
    running = Window.partitionBy("_part", "_group").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = ordered.join(offsets, ["_part", "_group"]).withColumn("_cum", F.sum("_cnt").over(running))
    position = (F.col("_n") - 1).cast("double") * F.lit(float(p))
    lo = F.floor(position)
    hi = F.ceil(position)
    first_rank = F.col("_offset") + F.col("_cum") - F.col("_cnt")
    last_rank = F.col("_offset") + F.col("_cum") - 1
    ranked = ranked.select(
        *keys, value, "_n", position.alias("_pos"), lo.alias("_lo"), hi.alias("_hi"),
        first_rank.alias("_r0"), last_rank.alias("_r1"),
    ).where(
        ((F.col("_r0") <= F.col("_lo")) & (F.col("_r1") >= F.col("_lo")))
        | ((F.col("_r0") <= F.col("_hi")) & (F.col("_r1") >= F.col("_hi")))
    )
    holds_lo = (F.col("_r0") <= F.col("_lo")) & (F.col("_r1") >= F.col("_lo"))
    holds_hi = (F.col("_r0") <= F.col("_hi")) & (F.col("_r1") >= F.col("_hi"))
    picked = ranked.groupBy(*keys).agg(
        F.max(F.when(holds_lo, F.col(value))).alias("_v_lo"),
        F.max(F.when(holds_hi, F.col(value))).alias("_v_hi"),
        F.max("_pos").alias("_pos"),
        F.max("_lo").alias("_lo"),
        F.max("_n").alias("_n"),
    )
    result = F.col("_v_lo") + (F.col("_v_hi") - F.col("_v_lo")) * (F.col("_pos") - F.col("_lo"))
    cols = [*keys, result.alias(alias)]
    if count_alias:
        cols.append(F.col("_n").alias(count_alias))
    return picked.select(*cols)
