"""Insert-time rollups with mergeable partial states.

Each batch of inserted version rows yields one partial per rollup; a read
merges all partials. The partials count *versions*, not events, exactly like
insert-fed materialised views: an updated event counts once per version and a
delete removes nothing (the tombstone only stops counting).

* error rollup: per ``(event_date, event_name)``: ``error_count`` = inserted
  live versions with an error, ``total_count`` = inserted live versions.
* latency rollup: per ``(conversation_id, event_name)`` over inserted live
  versions: a KLL sketch of ``latency`` (mergeable, bounded size, approximate
  p95 with no interpolation) and ``event_count``.

Both partial builds and merges are ordinary aggregates, so they combine
map-side and a hot session is reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import as_of_literal, day_text, days_before, has_error, month_key
from tidemark.operators.validate import check_days, check_event_name, check_limit
from tidemark.schema import P95

ERROR_KEYS = ("event_name", "event_date")
LATENCY_KEYS = ("conversation_id", "event_name")


def error_partial(versions: DataFrame) -> DataFrame:
    """Error-rollup partial of one batch of inserted version rows."""
    live = F.col("is_deleted") == 0
    return versions.groupBy(F.to_date("created_at").alias("event_date"), "event_name").agg(
        F.sum((has_error("error") & live).cast("bigint")).alias("error_count"),
        F.sum(live.cast("bigint")).alias("total_count"),
    )


def latency_partial(versions: DataFrame) -> DataFrame:
    """Latency-rollup partial of one batch of inserted version rows."""
    return (
        versions.where(F.col("is_deleted") == 0)
        .groupBy(*LATENCY_KEYS)
        .agg(
            F.kll_sketch_agg_double("latency").alias("latency_sketch"),
            F.sum(F.lit(1).cast("bigint")).alias("event_count"),
        )
    )


def merge_error(partials: DataFrame) -> DataFrame:
    """Merged error rollup: one row per ``(event_name, event_date)``."""
    return partials.groupBy(*ERROR_KEYS).agg(
        F.sum("error_count").alias("error_count"), F.sum("total_count").alias("total_count")
    )


def with_month(partials: DataFrame) -> DataFrame:
    """The error rollup as it is stored: with the month that its folders are named by."""
    return partials.withColumn("event_month", month_key("event_date"))


def merge_latency(partials: DataFrame) -> DataFrame:
    """Merged latency rollup: one sketch and count per ``(conversation_id, event_name)``."""
    return partials.groupBy(*LATENCY_KEYS).agg(
        F.kll_merge_agg_double("latency_sketch").alias("latency_sketch"),
        F.sum("event_count").alias("event_count"),
    )


def read_error_rollup(partials: DataFrame, event_name: str | None = None, days: int | None = None, as_of=None) -> DataFrame:
    """Daily error counts from the rollup, optionally for one type and the last ``days`` days.

    Filters are applied to the partials (before the merge), so the merge
    only touches matching keys.
    """
    p = partials
    if event_name is not None:
        p = p.where(F.col("event_name") == check_event_name(event_name))
    if days is not None:
        cutoff = days_before(as_of_literal(as_of), check_days(days))
        p = p.where(F.col("event_date") >= F.to_date(cutoff))
        if "event_month" in p.columns:  # prunes the stored partials' folders
            p = p.where(F.col("event_month") >= month_key(cutoff))
    return merge_error(p).orderBy("event_date", "event_name").select(
        day_text("event_date").alias("date"), "event_name", "error_count", "total_count"
    )


def read_latency_rollup(partials: DataFrame, limit: int | None = None) -> DataFrame:
    """Approximate p95 and count per session x event type from the rollup."""
    merged = merge_latency(partials).select(
        *LATENCY_KEYS,
        F.kll_sketch_get_quantile_double("latency_sketch", F.lit(P95)).alias("p95_latency"),
        "event_count",
    )
    if limit is None:
        return merged
    return merged.orderBy(F.col("p95_latency").desc(), *LATENCY_KEYS).limit(check_limit(limit))
