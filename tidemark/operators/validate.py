"""Message validation, reject split and patch normalisation.

A decoded message either becomes a normalised operation row or a reject row
with a reason; nothing is dropped silently. Normalised patches use NULL for
"not provided": creates get their defaults (``''``, ``0``, ``[]``), updates
treat ``''`` as absent for the five free-text/identity fields while
``error``, ``latency`` and the vectors can be cleared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import blank_as_absent, empty_floats, known_event_name, to_millis
from tidemark.schema import (
    ARRAY_FIELDS,
    BLANK_IS_ABSENT,
    DEFAULT_DAYS,
    DEFAULT_LIMIT,
    EVENT_NAMES,
    OP_CREATE,
    OP_DELETE,
    OP_UPDATE,
    OPERATIONS,
    PATCH_SCHEMA,
    R_BAD_EVENT_NAME,
    R_MALFORMED,
    R_MISSING_CONVERSATION_ID,
    R_MISSING_EVENT_ID,
    R_MISSING_EVENT_NAME,
    R_MISSING_PAYLOAD,
    R_UNKNOWN_OPERATION,
)
from tidemark.sources.changelog import CORRUPT, SOURCE_TIME

def _blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def _time(messages: DataFrame) -> Column:
    """The message time; updates and deletes without one take the source's record time."""
    if SOURCE_TIME not in messages.columns:
        return F.col("timestamp")
    mutation = F.col("operation").isin(OP_UPDATE, OP_DELETE)
    return F.coalesce(F.col("timestamp"), F.when(mutation, F.col(SOURCE_TIME)))


def reject_reason(messages: DataFrame) -> Column:
    """The first failing check of a decoded message, NULL when it is valid."""
    op = F.col("operation")
    data = F.col("data")
    name = F.col("data.event_name")
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in messages.columns else F.lit(False)
    return (
        F.when(corrupt | _time(messages).isNull(), F.lit(R_MALFORMED))
        .when(_blank(F.col("event_id")), F.lit(R_MISSING_EVENT_ID))
        .when(op.isNull() | ~op.isin(*OPERATIONS), F.lit(R_UNKNOWN_OPERATION))
        .when(op.isin(OP_CREATE, OP_UPDATE) & data.isNull(), F.lit(R_MISSING_PAYLOAD))
        .when((op == OP_CREATE) & _blank(F.col("data.conversation_id")), F.lit(R_MISSING_CONVERSATION_ID))
        .when((op == OP_CREATE) & _blank(name), F.lit(R_MISSING_EVENT_NAME))
        .when((op == OP_CREATE) & ~known_event_name(name), F.lit(R_BAD_EVENT_NAME))
        .when((op == OP_UPDATE) & ~_blank(name) & ~known_event_name(name), F.lit(R_BAD_EVENT_NAME))
    )


def _normalised_field(name: str, dtype) -> Column:
    src = F.col(f"data.{name}")
    op = F.col("operation")
    if name in ARRAY_FIELDS:
        on_create = F.coalesce(src, empty_floats())
        on_update = src
    elif name == "latency":
        on_create = F.coalesce(src, F.lit(0.0))
        on_update = src
    elif name == "error":
        on_create = F.coalesce(src, F.lit(""))
        on_update = src
    else:  # free text and identity fields
        on_create = F.coalesce(src, F.lit(""))
        on_update = blank_as_absent(src) if name in BLANK_IS_ABSENT else src
    return (
        F.when(op == OP_CREATE, on_create)
        .when(op == OP_UPDATE, on_update)
        .otherwise(F.lit(None))
        .cast(dtype)
        .alias(name)
    )


def split_messages(messages: DataFrame, batch_id: int | Column = 0, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Decoded messages -> (normalised operations, rejects).

    Operations: ``id, seq, batch_id, op, ts`` + the patch fields. ``ts`` is
    the message time cut to milliseconds (UTC). ``keep`` columns pass through. Rejects: ``event_id,
    operation, seq, reason, raw``.
    """
    batch = batch_id if isinstance(batch_id, Column) else F.lit(int(batch_id))
    flagged = messages.withColumn("_reason", reject_reason(messages))
    ops = flagged.where(F.col("_reason").isNull()).select(
        F.col("event_id").alias("id"),
        F.col("seq").cast("bigint").alias("seq"),
        batch.cast("bigint").alias("batch_id"),
        F.col("operation").alias("op"),
        to_millis(_time(messages)).alias("ts"),
        *[_normalised_field(f.name, f.dataType) for f in PATCH_SCHEMA.fields],
        *keep,
    )
    raw = F.col("raw") if "raw" in messages.columns else F.to_json(F.struct("operation", "event_id", "data"))
    rejects = flagged.where(F.col("_reason").isNotNull()).select(
        F.col("event_id"),
        F.col("operation"),
        F.col("seq").cast("bigint").alias("seq"),
        F.col("_reason").alias("reason"),
        raw.alias("raw"),
    )
    return ops, rejects


# ---- read-parameter checks (raise before any plan is built) ----

def check_event_name(event_name: str) -> str:
    if not event_name:
        raise ValueError("event_name is required")
    if event_name not in EVENT_NAMES:
        raise ValueError(f"event_name must be one of {', '.join(EVENT_NAMES)}")
    return event_name


def check_positive(value, what: str, default: int) -> int:
    if value is None:
        return default
    if isinstance(value, bool) or not isinstance(value, int):
        try:
            value = int(str(value))
        except ValueError:
            raise ValueError(f"{what} must be a positive integer") from None
    if value <= 0:
        raise ValueError(f"{what} must be a positive integer")
    return value


def check_days(days) -> int:
    return check_positive(days, "days", DEFAULT_DAYS)


def check_limit(limit) -> int:
    return check_positive(limit, "limit", DEFAULT_LIMIT)


def check_event_id(event_id: str) -> str:
    if not event_id:
        raise ValueError("event id is required")
    return event_id


__all__ = [
    "check_days",
    "check_event_id",
    "check_event_name",
    "check_limit",
    "reject_reason",
    "split_messages",
]
