"""The named reads over the event history (the user-facing query surface).

Each function takes the version history (as read by
:func:`tidemark.sinks.table.read_history`, or any DataFrame with the event
columns) and returns a lazy DataFrame; parameters are validated before any
plan is built. All reads see the latest non-deleted version of each event.

``deduped=True`` says the input already holds one row per event (the
current state from :func:`tidemark.sinks.table.read_state`); the read then
skips the version dedup and only filters tombstones, so no shuffle of the
whole table happens before the aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import as_of_literal, day_key, day_text, days_before, has_error, month_key
from tidemark.operators.quantile import exact_percentile
from tidemark.operators.validate import check_days, check_event_id, check_event_name, check_limit
from tidemark.operators.versioning import (
    DEFAULT_KEYS,
    latest_version,
    public_view,
    restricted_latest,
    restricted_rows,
)
from tidemark.schema import DAY_COL, LINEAGE_COLS, MONTH_COL, P95


def _narrow(history: DataFrame, *cols: str) -> DataFrame:
    """Only the columns a read needs plus the dedup/order columns.

    Text and vector columns never reach the shuffle of an aggregate read.
    """
    keep = ["id", "version", "is_deleted", *[c for c in LINEAGE_COLS if c in history.columns]]
    keep += [c for c in cols if c not in keep]
    return history.select(*keep)


def _latest(history: DataFrame, deduped: bool, include_deleted: bool = False) -> DataFrame:
    if deduped:
        return history if include_deleted else history.where(F.col("is_deleted") == 0)
    return latest_version(history, DEFAULT_KEYS, include_deleted=include_deleted)


def get_event(history: DataFrame, event_id: str, include_deleted: bool = False, deduped: bool = False) -> DataFrame:
    """Q-1: one event by id (0 or 1 rows), public columns.

    The id filter sits below the dedup (``id`` is the dedup key), so it is
    pushed into the parquet scan and, with the writer's bloom filters, skips
    row groups.
    """
    check_event_id(event_id)
    one = _latest(history.where(F.col("id") == event_id), deduped, include_deleted)
    return public_view(one).limit(1)


def get_events_by_conversation(history: DataFrame, conversation_id: str, deduped: bool = False) -> DataFrame:
    """Q-2: the live events of one session, oldest first (``id`` breaks ties)."""
    if not conversation_id:
        raise ValueError("conversation id is required")
    pred = F.col("conversation_id") == conversation_id
    rows = _latest(history, True).where(pred) if deduped else restricted_rows(history, pred)
    return public_view(rows).orderBy("created_at", "id")


def get_error_counts(
    history: DataFrame, event_name: str, days: int = 7, as_of=None, deduped: bool = False
) -> DataFrame:
    """Q-3: per day, errors and events of one type created in the last ``days`` days.

    Rolling window ``created_at >= as_of - days``; days without events are
    absent. ``as_of`` defaults to now. The month partition column, when
    present, gets the implied bound too, so old months are pruned.
    """
    check_event_name(event_name)
    days = check_days(days)
    cutoff = days_before(as_of_literal(as_of), days)
    pred = (F.col("event_name") == event_name) & (F.col("created_at") >= cutoff)
    parts = [c for c in (MONTH_COL, DAY_COL) if c in history.columns]
    if MONTH_COL in parts:
        pred = pred & (F.col(MONTH_COL) >= month_key(cutoff))
    if DAY_COL in parts:
        pred = pred & (F.col(DAY_COL) >= day_key(cutoff))
    narrow = _narrow(history, "event_name", "error", "created_at", *parts)
    live = _latest(narrow, True).where(pred) if deduped else restricted_latest(narrow, pred)
    daily = live.groupBy(F.to_date("created_at").alias("event_date"), "event_name").agg(
        F.count_if(has_error("error")).alias("error_count"),
        F.count(F.lit(1)).alias("total_count"),
    )
    return daily.orderBy("event_date").select(
        day_text("event_date").alias("date"), "event_name", "error_count", "total_count"
    )


def get_latency_stats(
    history: DataFrame, limit: int = 100, method: str = "exact", deduped: bool = False
) -> DataFrame:
    """Q-4: p95 latency and event count per session x event type, highest p95 first.

    Both methods are exact (linear interpolation between order statistics).
    ``method="exact"`` ranks distributed values, so no group sits in one
    buffer; ``"percentile"`` is the plain aggregate (a buffer per group).
    """
    limit = check_limit(limit)
    live = _latest(_narrow(history, "conversation_id", "event_name", "latency"), deduped)
    keys = ["conversation_id", "event_name"]
    if method == "exact":
        stats = exact_percentile(live, keys, "latency", P95, alias="p95_latency", count_alias="event_count")
    elif method == "percentile":
        stats = live.groupBy(*keys).agg(
            F.percentile("latency", F.lit(P95)).alias("p95_latency"), F.count(F.lit(1)).alias("event_count")
        )
    else:
        raise ValueError("method must be 'exact' or 'percentile'")
    return stats.orderBy(F.col("p95_latency").desc(), "conversation_id", "event_name").limit(limit)


def get_top_error_sessions(history: DataFrame, limit: int = 100, deduped: bool = False) -> DataFrame:
    """Q-5: sessions by share of events with an error, then by size."""
    limit = check_limit(limit)
    live = _latest(_narrow(history, "conversation_id", "error"), deduped)
    per = live.groupBy("conversation_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(has_error("error")).alias("error_events"),
    )
    per = per.where(F.col("total_events") > 0).withColumn(
        "error_rate", F.col("error_events").cast("double") / F.col("total_events").cast("double")
    )
    return per.orderBy(
        F.col("error_rate").desc(), F.col("total_events").desc(), "conversation_id"
    ).limit(limit).select("conversation_id", "total_events", "error_events", "error_rate")


def page_events_by_conversation(
    history: DataFrame, conversation_id: str, limit: int = 100, after: tuple | None = None, deduped: bool = False
) -> DataFrame:
    """Keyset page of :func:`get_events_by_conversation`.

    ``after = (created_at, id)`` of the last row of the previous page; the
    next page starts strictly after it in ``(created_at, id)`` order. No
    offset scan: each page is a filter plus a top-k.
    """
    limit = check_limit(limit)
    rows = get_events_by_conversation(history, conversation_id, deduped)
    if after is not None:
        ts, last_id = after
        ts = as_of_literal(ts)
        rows = rows.where((F.col("created_at") > ts) | ((F.col("created_at") == ts) & (F.col("id") > F.lit(last_id))))
    return rows.orderBy("created_at", "id").limit(limit)
