"""Client surface: bulk create/update/delete requests -> change messages, and the reads.

The reference's per-call client becomes set-based functions over request
DataFrames. Each builder validates like the request handler, returns
``(messages, rejects)`` and never drops a request silently. Messages have the
decoded envelope columns (``operation, event_id, timestamp, data, seq``);
:func:`publish_files` / :func:`publish_kafka` put them on the wire.

Wire encoding follows the reference's optional-field rules: empty strings
and empty vectors are left out of a payload (so an update cannot clear
``input`` or a vector through this path), while ``error`` and ``latency`` are
always sent on create and sent whenever given on update (so they can be
cleared).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import known_event_name
from tidemark.operators.versioning import public_view  # noqa: F401  (re-exported read helper)
from tidemark.plans.queries import (  # noqa: F401  (CL-4 / CL-5)
    get_error_counts,
    get_event,
    get_events_by_conversation,
    get_latency_stats,
    get_top_error_sessions,
)
from tidemark.schema import (
    ARRAY_FIELDS,
    OP_CREATE,
    OP_DELETE,
    OP_UPDATE,
    PATCH_SCHEMA,
    R_BAD_EVENT_NAME,
    R_EMPTY_PATCH,
    R_MISSING_CONVERSATION_ID,
    R_MISSING_EVENT_ID,
    R_MISSING_EVENT_NAME,
)
from tidemark.session import scratch_path
from tidemark.sources.changelog import encode_json

_NEW_ID, _NEW_TIME = "_new_event_id", "_new_event_time"
_UPDATABLE = tuple(f.name for f in PATCH_SCHEMA.fields if f.name != "conversation_id")


def _opt(df: DataFrame, name: str) -> Column:
    """The request column, or NULL when the request frame does not have it."""
    dtype = PATCH_SCHEMA[name].dataType
    return (F.col(name) if name in df.columns else F.lit(None)).cast(dtype)


def _omit_empty(name: str, c: Column) -> Column:
    """Leave out empty strings / empty vectors, like an omit-if-empty JSON field."""
    if name in ARRAY_FIELDS:
        return F.when(F.size(c) > 0, c)
    return F.when(c != "", c)


def _with_new_ids(requests: DataFrame) -> DataFrame:
    """The requests with a fresh random id each, written to the shared folder and read back.

    Equal requests are separate events, so an id cannot come from a request's
    content; writing it once makes every later use (messages, wire, result)
    see the same id.
    """
    path = scratch_path(requests.sparkSession, "requests")
    requests.withColumn(_NEW_ID, F.expr("uuid()")).withColumn(_NEW_TIME, F.current_timestamp()).write.parquet(path)
    return requests.sparkSession.read.parquet(path)


def _time(df: DataFrame, ts_col: str) -> Column:
    now = F.col(_NEW_TIME) if _NEW_TIME in df.columns else F.current_timestamp()
    return (F.col(ts_col) if ts_col in df.columns else now).cast("timestamp")


def _seq(df: DataFrame) -> Column:
    return (F.col("seq") if "seq" in df.columns else F.lit(None)).cast("bigint")


def _split(df: DataFrame, reason: Column, messages: list[Column], reject_id: Column, op: str, columns: list[str] | None = None):
    flagged = df.withColumn("_reason", reason)
    msgs = flagged.where(F.col("_reason").isNull()).select(*messages)
    rejects = flagged.where(F.col("_reason").isNotNull()).select(
        reject_id.alias("event_id"), F.lit(op).alias("operation"), _seq(df).alias("seq"),
        F.col("_reason").alias("reason"), F.to_json(F.struct(*[F.col(c) for c in columns or df.columns])).alias("raw"),
    )
    return msgs, rejects


def track_events(requests: DataFrame, id_col: str | None = None, ts_col: str = "timestamp"):
    """Create requests -> create messages (one new event each).

    Required: ``conversation_id``, ``event_name``. Optional: every other
    patch field, ``timestamp`` (request time, default now), ``seq`` and an
    id column. Without ``id_col`` each request gets a new random id; the
    numbered requests are then written to the shared folder at once, so the
    returned messages and what is published carry the same ids.
    """
    columns = requests.columns
    if not id_col:
        requests = _with_new_ids(requests)
    cid = _opt(requests, "conversation_id")
    name = _opt(requests, "event_name")
    reason = (
        F.when(cid.isNull() | (cid == ""), F.lit(R_MISSING_CONVERSATION_ID))
        .when(name.isNull() | (name == ""), F.lit(R_MISSING_EVENT_NAME))
        .when(~known_event_name(name), F.lit(R_BAD_EVENT_NAME))
    )
    ts = _time(requests, ts_col)
    event_id = F.col(id_col or _NEW_ID).cast("string")
    data = []
    for f in PATCH_SCHEMA.fields:
        c = _opt(requests, f.name)
        if f.name == "error":
            c = F.coalesce(c, F.lit(""))
        elif f.name == "latency":
            c = F.coalesce(c, F.lit(0.0))
        else:
            c = _omit_empty(f.name, c)
        data.append(c.cast(f.dataType).alias(f.name))
    messages = [
        F.lit(OP_CREATE).alias("operation"), event_id.alias("event_id"), ts.alias("timestamp"),
        F.struct(*data).alias("data"), _seq(requests).alias("seq"),
    ]
    return _split(requests, reason, messages, event_id, OP_CREATE, columns)


def update_events(requests: DataFrame, ts_col: str = "timestamp"):
    """Update requests (``event_id`` + any of the updatable fields) -> update messages.

    A given ``event_name`` must be an allowed name; a request with no field
    at all is rejected as ``empty_patch``.
    """
    eid = F.col("event_id").cast("string")
    name = _opt(requests, "event_name")
    given = [_opt(requests, f).isNotNull() for f in _UPDATABLE]
    any_given = given[0]
    for g in given[1:]:
        any_given = any_given | g
    reason = (
        F.when(eid.isNull() | (eid == ""), F.lit(R_MISSING_EVENT_ID))
        .when(name.isNotNull() & ~known_event_name(name), F.lit(R_BAD_EVENT_NAME))
        .when(~any_given, F.lit(R_EMPTY_PATCH))
    )
    data = []
    for f in PATCH_SCHEMA.fields:
        if f.name == "conversation_id":
            c = F.lit(None)
        elif f.name in ("error", "latency"):
            c = _opt(requests, f.name)
        else:
            c = _omit_empty(f.name, _opt(requests, f.name))
        data.append(c.cast(f.dataType).alias(f.name))
    messages = [
        F.lit(OP_UPDATE).alias("operation"), eid.alias("event_id"), _time(requests, ts_col).alias("timestamp"),
        F.struct(*data).alias("data"), _seq(requests).alias("seq"),
    ]
    return _split(requests, reason, messages, eid, OP_UPDATE)


def delete_events(requests: DataFrame, ts_col: str = "timestamp"):
    """Delete requests (``event_id``) -> delete messages without payload."""
    eid = F.col("event_id").cast("string")
    reason = F.when(eid.isNull() | (eid == ""), F.lit(R_MISSING_EVENT_ID))
    messages = [
        F.lit(OP_DELETE).alias("operation"), eid.alias("event_id"), _time(requests, ts_col).alias("timestamp"),
        F.lit(None).cast(PATCH_SCHEMA).alias("data"), _seq(requests).alias("seq"),
    ]
    return _split(requests, reason, messages, eid, OP_DELETE)


def _in_order(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key, value`` with each event's messages in one task, in ``seq`` (else input) order."""
    placed = messages.withColumn("_place", F.coalesce(F.col("seq"), F.monotonically_increasing_id()))
    return encode_json(placed.repartition("event_id").sortWithinPartitions("event_id", "_place"), keep)


def publish_files(messages: DataFrame, path: str) -> None:
    """Append messages as JSON lines to a folder read by the file change-log source.

    One event's messages stay in one file, in order; messages without ``seq``
    are ordered by the reader by file time and line, so later calls come later.
    """
    _in_order(messages).select("value").write.mode("append").text(path)


def publish_kafka(messages: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Write messages to a topic keyed by event id (needs the Kafka connector).

    One task writes all of an event's messages, in order.
    """
    (
        _in_order(messages)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .save()
    )
