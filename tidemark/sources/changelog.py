"""Change-log sources: JSON lines (files, batch or stream) and Kafka.

Every source ends in the same decoded envelope: ``MESSAGE_SCHEMA`` columns,
plus ``_corrupt`` (set when the JSON did not parse or a field had the wrong
type) and ``raw`` (the message text, kept for the reject table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.schema import MESSAGE_SCHEMA

CORRUPT = "_corrupt"
# The source's record time: stands in for a missing message time.
SOURCE_TIME = "_source_time"
# Where a message stands in a folder of files.
FILE_COLS = ("_file_time", "_file_path", "_file_start")
# Messages that one task can number.
_ROW_BITS = 33
_DECODE_SCHEMA = StructType(list(MESSAGE_SCHEMA.fields) + [StructField(CORRUPT, StringType())])
_DECODE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def decode_json(
    df: DataFrame,
    value_col: str = "value",
    offset_col: str | None = None,
    time_col: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Parse JSON message text into envelope columns.

    Field names match exactly (case-sensitive); unknown keys are ignored.
    ``seq`` is the per-event log order. A log that has one of its own gives
    it: with ``offset_col`` (a Kafka offset; one event's messages share a
    partition because the key is the event id) a message's own ``seq`` is
    ignored. Otherwise the message's ``seq`` is taken, and where it has none,
    :func:`with_input_order` numbers the messages as they stand in the input.
    ``time_col`` is the source's record time, which stands in for a missing
    message time. ``keep`` columns pass through.
    """
    text = F.col(value_col).cast("string")
    extra = {"_offset": offset_col, SOURCE_TIME: time_col}
    parsed = df.select(
        F.from_json(text, _DECODE_SCHEMA, _DECODE_OPTIONS).alias("m"), text.alias("raw"),
        *[F.col(c).alias(name) for name, c in extra.items() if c], *keep,
    )
    seq = F.col("_offset") if offset_col else F.col("m.seq")
    cols = [F.col(f"m.{f.name}").alias(f.name) for f in MESSAGE_SCHEMA.fields if f.name != "seq"]
    # A NULL parse result (empty or non-object text) is corrupt as well.
    corrupt = F.when(F.col("m").isNull(), F.col("raw")).otherwise(F.col(f"m.{CORRUPT}"))
    return parsed.select(*cols, seq.cast("bigint").alias("seq"), corrupt.alias(CORRUPT), "raw", *([SOURCE_TIME] if time_col else []), *keep)


def with_input_order(messages: DataFrame, keep=lambda df: df) -> DataFrame:
    """Fill a missing ``seq`` from the input order (batch DataFrames only).

    Messages read from files (``FILE_COLS``) are ordered by file time, path
    and position; Spark packs files by size, so its own row order says
    nothing between files. The table of splits is one row for each part of a
    file that a task reads; it is broadcast, since a shuffle by file would make
    a file's messages one task's. Other inputs keep their row order.
    ``keep`` may persist the splits, for a caller that uses the result more than once.
    """
    row = F.monotonically_increasing_id()
    if not set(FILE_COLS) <= set(messages.columns):
        return messages.withColumn("seq", F.coalesce(F.col("seq"), row))
    inside = F.lit((1 << _ROW_BITS) - 1)
    messages = messages.withColumn("_row", row.bitwiseAND(inside))
    splits = messages.select(*FILE_COLS).distinct().withColumn("_split", F.row_number().over(Window.orderBy(*FILE_COLS)))
    splits = keep(splits.select(*[F.col(c).alias(f"{c}_s") for c in FILE_COLS], "_split"))
    same = [F.col(c) == F.col(f"{c}_s") for c in FILE_COLS]
    position = F.shiftleft(F.col("_split").cast("bigint"), _ROW_BITS).bitwiseOR(F.col("_row"))
    ordered = messages.join(F.broadcast(splits), same).withColumn("seq", F.coalesce(F.col("seq"), position))
    return ordered.drop("_row", "_split", *FILE_COLS, *[f"{c}_s" for c in FILE_COLS])


def encode_json(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Envelope columns to ``(key, value)`` JSON text; NULL fields are left out.

    ``to_json`` drops NULL fields, which matches omitting empty optional
    fields on the wire; a delete carries no ``data``. The key is the event id,
    so one event's messages land in one Kafka partition, in order.
    """
    envelope = F.struct(
        F.col("operation"),
        F.col("event_id"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.col("data"),
        F.col("seq"),
    )
    return messages.select(F.col("event_id").alias("key"), F.to_json(envelope).alias("value"), *keep)


def _lines(df: DataFrame) -> DataFrame:
    """Text lines with where they stand."""
    where = ("file_modification_time", "file_path", "file_block_start")
    lines = df.select("value", *[F.col(f"_metadata.{m}").alias(c) for c, m in zip(FILE_COLS, where, strict=True)])
    return decode_json(lines, time_col=FILE_COLS[0], keep=FILE_COLS)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a folder of JSON-lines change files."""
    return with_input_order(_lines(spark.read.text(path)))


def stream_json_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of JSON-lines change files as they arrive in ``path``.

    Streams cannot number rows; each micro-batch is by :func:`with_input_order`.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return _lines(reader.load(path))


def stream_kafka(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    starting_offsets: str = "earliest",
) -> DataFrame:
    """Streaming read of a change-log topic (needs the Kafka connector on the classpath).

    Consumer-group offset commits are replaced by the query checkpoint.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    return decode_json(reader.load(), value_col="value", offset_col="offset", time_col="timestamp")
