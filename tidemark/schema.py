"""Fixed schemas and value sets of the versioned event model.

Every table and message in the engine has a declared schema; nothing is
inferred from data.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# --- fixed values (must equal the reference's for identical results) ---
# Allowed event names, in declaration order.
EVENT_NAMES = ("event_a", "event_b", "event_c")
# Change-message operations.
OP_CREATE = "create"
OP_UPDATE = "update"
OP_DELETE = "delete"
OPERATIONS = (OP_CREATE, OP_UPDATE, OP_DELETE)
# Quantile reported by the latency read and rollup.
P95 = 0.95
# Default read parameters: days for the error-count read, limit for the top-N reads.
DEFAULT_DAYS = 7
DEFAULT_LIMIT = 100
# --- end of fixed values ---

# Internal pseudo-operation: the stored state of an event carried into an
# incremental fold (never emitted as a history row).
OP_BASE = "base"

# Reject reasons written to the reject table.
R_MALFORMED = "malformed"
R_UNKNOWN_OPERATION = "unknown_operation"
R_MISSING_PAYLOAD = "missing_payload"
R_MISSING_EVENT_ID = "missing_event_id"
R_MISSING_CONVERSATION_ID = "missing_conversation_id"
R_MISSING_EVENT_NAME = "missing_event_name"
R_BAD_EVENT_NAME = "bad_event_name"
R_NOT_FOUND = "not_found"
R_EMPTY_PATCH = "empty_patch"

FLOAT_ARRAY = ArrayType(FloatType())

# Columns a patch may carry, in stored-column order.
PATCH_FIELDS = (
    "conversation_id",
    "conversation_metadata",
    "event_name",
    "error",
    "latency",
    "input",
    "input_embeddings",
    "output",
    "output_embeddings",
)
# String fields for which an empty string means "not provided" in an update.
BLANK_IS_ABSENT = ("conversation_id", "conversation_metadata", "event_name", "input", "output")
ARRAY_FIELDS = ("input_embeddings", "output_embeddings")

PATCH_SCHEMA = StructType(
    [
        StructField("conversation_id", StringType()),
        StructField("conversation_metadata", StringType()),
        StructField("event_name", StringType()),
        StructField("error", StringType()),
        StructField("latency", DoubleType()),
        StructField("input", StringType()),
        StructField("input_embeddings", ArrayType(FloatType())),
        StructField("output", StringType()),
        StructField("output_embeddings", ArrayType(FloatType())),
    ]
)

# Wire envelope of one change message (JSON). ``seq`` is optional on the wire;
# file sources carry it explicitly, Kafka derives it from the offset.
MESSAGE_SCHEMA = StructType(
    [
        StructField("operation", StringType()),
        StructField("event_id", StringType()),
        StructField("timestamp", TimestampType()),
        StructField("data", PATCH_SCHEMA),
        StructField("seq", LongType()),
    ]
)

# Stored event version (one row per inserted version).
EVENT_COLS = (
    "id",
    "conversation_id",
    "conversation_metadata",
    "event_name",
    "error",
    "latency",
    "input",
    "input_embeddings",
    "output",
    "output_embeddings",
    "is_deleted",
    "version",
    "created_at",
    "updated_at",
)

EVENT_SCHEMA = StructType(
    [
        StructField("id", StringType(), False),
        StructField("conversation_id", StringType()),
        StructField("conversation_metadata", StringType()),
        StructField("event_name", StringType()),
        StructField("error", StringType()),
        StructField("latency", DoubleType()),
        StructField("input", StringType()),
        StructField("input_embeddings", ArrayType(FloatType())),
        StructField("output", StringType()),
        StructField("output_embeddings", ArrayType(FloatType())),
        StructField("is_deleted", IntegerType()),
        StructField("version", LongType()),
        StructField("created_at", TimestampNTZType()),
        StructField("updated_at", TimestampNTZType()),
    ]
)

# Ordering columns added by the writer: the micro-batch that inserted the
# row and the log position of the message inside its batch. Together with
# ``version`` they make "last inserted wins" deterministic.
LINEAGE_COLS = ("batch_id", "seq")
# 1 on a create that never was the current version: it came after the event's first
# mutation. Any other row of a later batch supersedes what was stored before it.
SHADOW_COL = "shadowed"
# Derived partition column of the history table (yyyyMM of created_at).
MONTH_COL = "created_month"
# Optional finer partition below the month (yyyyMMdd of created_at).
DAY_COL = "created_day"

HISTORY_SCHEMA = StructType(
    list(EVENT_SCHEMA.fields)
    + [
        StructField("batch_id", LongType()),
        StructField("seq", LongType()),
        StructField(SHADOW_COL, IntegerType()),
        StructField(MONTH_COL, StringType()),
    ]
)

REJECT_SCHEMA = StructType(
    [
        StructField("event_id", StringType()),
        StructField("operation", StringType()),
        StructField("seq", LongType()),
        StructField("reason", StringType()),
        StructField("raw", StringType()),
    ]
)

# Rollup partials as stored, one folder per batch (the error rollup also per month).
ERROR_PARTIAL_SCHEMA = StructType(
    [
        StructField("event_date", DateType()),
        StructField("event_name", StringType()),
        StructField("error_count", LongType()),
        StructField("total_count", LongType()),
        StructField("batch_id", LongType()),
        StructField("event_month", StringType()),
    ]
)
LATENCY_PARTIAL_SCHEMA = StructType(
    [
        StructField("conversation_id", StringType()),
        StructField("event_name", StringType()),
        StructField("latency_sketch", BinaryType()),
        StructField("event_count", LongType()),
        StructField("batch_id", LongType()),
    ]
)

# History written with daily partitions (month, then day).
DAILY_HISTORY_SCHEMA = StructType(list(HISTORY_SCHEMA.fields) + [StructField(DAY_COL, StringType())])
