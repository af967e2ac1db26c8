"""Structured Streaming apply: change log -> history, rejects and rollup partials.

Each micro-batch is folded as a set (one shuffle on ``id``) against the
stored latest version of the events it touches. Its rows go to all tables, and one
manifest commits them together (:mod:`tidemark.sinks.store`). Spark replays an
unfinished batch under the same id after a failure, and the replay's commit replaces
what the batch had, so the tables end up as if each batch ran once.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType

from tidemark.operators.fold import SLICES, STEP, fold_rows, op_key
from tidemark.operators.validate import split_messages
from tidemark.operators.vectors import split_vectors
from tidemark.schema import EVENT_COLS, R_NOT_FOUND, REJECT_SCHEMA, SHADOW_COL
from tidemark.sinks.manifest import load
from tidemark.sinks.store import (  # noqa: F401  (the apply job's tables are read and kept through these)
    Tables,
    base_rows,
    compact_rollups,
    compact_tables,
    current_state,
    error_rollup,
    is_compacted,
    lag_ms,
    latency_rollup,
    read_metrics,
    redrive_rejects,
    store_batch,
)
from tidemark.sources.changelog import with_input_order


#: A message's ``seq`` as it came.
_SENT_SEQ = "_sent_seq"


def _sent(messages: DataFrame) -> Column:
    """The message as it came: its text, or what :func:`_text` makes its text of."""
    if "raw" in messages.columns:
        return F.col("raw")
    return F.struct("operation", "event_id", "timestamp", "data", F.col(_SENT_SEQ).alias("seq"))


def _text(df: DataFrame, column: str) -> Column:
    """The text of a message of :func:`_sent`: put back by a re-drive it keeps its ``seq``, or has none.
    Only rejects need it."""
    return F.col(column) if isinstance(df.schema[column].dataType, StringType) else F.to_json(column)


def apply_batch(spark: SparkSession, messages: DataFrame, batch_id: int, tables: Tables, slices: int = SLICES, step: int = STEP) -> None:
    """Fold one batch of decoded messages into the tables (idempotent per ``batch_id``).

    A replay replaces the batch; of a batch that a snapshot already holds, it changes
    nothing. ``slices`` / ``step`` are passed to the fold.
    """
    m = load(spark, tables.root)
    if is_compacted(m, batch_id):
        return
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return kept[-1]

    try:
        # The batch is read from the source once; everything below derives from it.
        messages = keep(messages.withColumn(_SENT_SEQ, F.col("seq")))
        messages = with_input_order(messages, keep).withColumn("_sent", _sent(messages))
        told = messages.withColumn("raw", _text(messages, "_sent"))
        bad = split_messages(told, batch_id)[1]
        sent, vectors = split_vectors(split_messages(messages, batch_id, keep=("_sent",))[0])
        ops = keep(sent.drop("_sent"))
        base = base_rows(spark, tables, ops, batch_id, m, keep)
        rows = keep(fold_rows(ops, base, slices, step))
        versions = rows.where("_ok").select(*EVENT_COLS, "batch_id", "seq", SHADOW_COL)
        rejects = bad.unionByName(_not_found(rows, sent))
        store_batch(spark, tables, batch_id, versions, vectors, rejects, _metrics(rows, bad), m)
    finally:
        for df in reversed(kept):
            df.unpersist()


def _not_found(rows: DataFrame, sent: DataFrame) -> DataFrame:
    """Operations without anything to act on, with the text of their messages."""
    keys = ["event_id", "operation", "seq", "_tie"]
    lost = rows.where(~F.col("_ok")).select(F.col("id").alias("event_id"), F.col("op").alias("operation"), "seq", "_tie")
    texts = sent.select(F.col("id").alias("event_id"), F.col("op").alias("operation"), "seq", op_key().alias("_tie"), "_sent")
    texts = texts.join(lost.distinct(), keys, "left_semi").withColumn("raw", _text(texts, "_sent")).drop("_sent").dropDuplicates(keys)
    return lost.join(texts, keys).withColumn("reason", F.lit(R_NOT_FOUND)).select(*REJECT_SCHEMA.names)


def _metrics(rows: DataFrame, bad: DataFrame) -> dict:
    """Rows applied by operation, with the newest message time and its lag, and rejects by reason."""
    folded = rows.groupBy("op", "_ok").agg(F.count(F.lit(1)).alias("n"), F.max("updated_at").alias("last")).collect()
    applied = {r.op: {"n": r.n, "last": str(r["last"]), "lag_ms": lag_ms(r["last"])} for r in folded if r._ok}
    rejected = {r.reason: {"n": r["count"]} for r in bad.groupBy("reason").count().collect()}
    lost = sum(r.n for r in folded if not r._ok)
    return {"applied": applied, "rejected": rejected | ({R_NOT_FOUND: {"n": lost}} if lost else {})}


def start_apply(
    messages: DataFrame,
    tables: Tables,
    checkpoint: str,
    processing_time: str | None = None,
    available_now: bool = False,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start the streaming apply over a decoded message stream.

    ``processing_time`` (e.g. ``"200 milliseconds"``) sets the micro-batch
    cadence; ``available_now`` drains what is there and stops. Progress
    (input rows, rates, source lag) is in ``query.recentProgress``; what was applied and
    rejected, batch by batch, in :func:`tidemark.sinks.store.read_metrics`.
    """
    spark = messages.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        apply_batch(spark, batch, int(batch_id), tables)

    writer = messages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def progress_summary(query: StreamingQuery) -> list[dict]:
    """Per-batch counters: batch id, input rows and rates, from recent progress."""
    out = []
    for p in query.recentProgress:
        out.append(
            {
                "batch_id": p.get("batchId"),
                "input_rows": p.get("numInputRows"),
                "input_rows_per_second": p.get("inputRowsPerSecond"),
                "processed_rows_per_second": p.get("processedRowsPerSecond"),
                "sources": [s.get("metrics", {}) for s in p.get("sources", [])],
            }
        )
    return out
