"""Named queries over the event store (:mod:`tidemark.sinks.store`), and their SQL.

Each applies the driver's change log in batches, keeps the store as its name
says, and reads it. The SQL computes the rows from the driver's tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.versioning import public_view
from tidemark.plans.registry import _A_BASE, _C_ROWS, _PUBLIC, _WITH_A, AS_OF, EVENT_ID, ORACLE as ENGINE, RETENTION_DAYS, SESSION, history
from tidemark.plans.queries import get_event
from tidemark.schema import EVENT_COLS, EVENT_SCHEMA
from tidemark.session import scratch_path
from tidemark.sinks import store
from tidemark.sinks.store import Tables
from tidemark.sources import adapters
from tidemark.sources.changelog import read_json_lines
from tidemark.streaming.apply import apply_batch

QUERIES, ORACLE = {}, {}
#: Rows of a batch that never commits.
GHOSTS = 50


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _tables(spark: SparkSession, name: str) -> Tables:
    return Tables(f"{scratch_path(spark, name)}/tables")


def _applied(spark: SparkSession, log: DataFrame, name: str, compacted: bool = True) -> Tables:
    """A log in two batches, creates and then the rest; compacted in between."""
    tables = _tables(spark, name)
    apply_batch(spark, log.where(F.col("operation") == "create"), 0, tables)
    if compacted:
        store.compact_tables(spark, tables, 0)
    apply_batch(spark, log.where(F.col("operation") != "create"), 1, tables)
    return tables


def _live(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("is_deleted") == 0).select(*EVENT_COLS)


def _unfinished(spark: SparkSession, tables: Tables, batch_id: int) -> None:
    """What a batch leaves behind that died before its commit: whole folders in every table."""
    ghosts = store.read_versions(spark, tables, vectors=False).limit(GHOSTS).withColumn("id", F.concat(F.lit("ghost-"), "id"))
    at = f"batch_id={batch_id}/attempt=lost"
    rows = {
        "history": ghosts.drop("batch_id"),
        "rollup_error": store.with_month(store.error_partial(ghosts)),
        "rollup_latency": store.latency_partial(ghosts),
        "rejects": ghosts.select(F.col("id").alias("event_id"), F.lit("update").alias("operation"), "seq", F.lit("not_found").alias("reason"), F.lit("{}").alias("raw")),
    }
    for table, df in rows.items():
        by = {"history": ["created_month"], "rollup_error": ["event_month"]}.get(table, [])
        df.write.partitionBy(*by).parquet(f"{tables.root}/{table}/{at}")


@query
def manifest_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the readers of every table count beside an unfinished batch in each."""
    tables = _applied(spark, adapters.changelog_a(spark, sf_dir), "manifest")
    _unfinished(spark, tables, 2)
    counts = [
        ("versions", store.read_versions(spark, tables, vectors=False).agg(F.count(F.lit(1)))),
        ("events", store.current_state(spark, tables).agg(F.count(F.lit(1)))),
        ("rejects", store.read_rejects(spark, tables).agg(F.count(F.lit(1)))),
        ("error rollup", store.error_rollup(spark, tables).agg(F.sum("total_count"))),
        ("latency rollup", store.latency_rollup(spark, tables).agg(F.sum("event_count"))),
    ]
    out = None
    for name, df in counts:
        df = df.toDF("n").select(F.lit(name).alias("what"), F.col("n").cast("bigint").alias("n"))
        out = df if out is None else out.unionByName(df)
    return out


ORACLE["manifest_reads"] = _WITH_A + """
select 'versions' as what, count(*) as n from history
union all select 'events', count(*) from latest
union all select 'rejects', 0
union all select unnest(['error rollup', 'latency rollup']), (select count(*) from history where is_deleted = 0)"""


@query
def purged_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events (tombstones too) through a snapshot older than the purge, beside an unfinished batch written after it."""
    tables = _applied(spark, adapters.changelog_a(spark, sf_dir), "purged")
    store.purge(spark, tables, RETENTION_DAYS, AS_OF)
    _unfinished(spark, tables, 2)
    return store.current_state(spark, tables, vectors=True).select(*EVENT_COLS)


ORACLE["purged_state"] = _WITH_A + (
    f"select {', '.join(EVENT_COLS)} from latest\n"
    f"where not (is_deleted = 1 and created_at < timestamp '{AS_OF}' - interval {RETENTION_DAYS} day)"
)


@query
def vector_side_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn with its vectors, which are stored by content beside rows that hold keys."""
    tables = _applied(spark, adapters.changelog_c(spark, sf_dir), "vectors")
    return store.vectors_of(spark, tables, _live(store.current_state(spark, tables)))


ORACLE["vector_side_table"] = ENGINE["conversation_turns"]


@query
def vector_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each vector's content is stored, with its size, after the same log came twice under other event ids."""
    log = adapters.changelog_c(spark, sf_dir)
    tables = _applied(spark, log, "contents")
    again = log.withColumn("event_id", F.concat(F.lit("again-"), "event_id"))
    apply_batch(spark, again, 2, tables)
    # two vectors are one content when all their numbers are the same
    stored = store.read_vectors(spark, tables).groupBy("vec").agg(F.count(F.lit(1)).alias("copies"))
    return stored.groupBy("copies", F.size("vec").cast("bigint").alias("size")).agg(F.count(F.lit(1)).alias("n"))


ORACLE["vector_contents"] = (
    f"with rows as ({_C_ROWS}), v as (select distinct input_embeddings as vec from rows where len(input_embeddings) > 0)\n"
    "select cast(1 as bigint) as copies, len(vec) as size, count(*) as n from v group by all"
)


@query
def stream_index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event after batches that found their events by the bucketed index: in later batches, then in the snapshot too."""
    log = adapters.changelog_a(spark, sf_dir)
    tables = _applied(spark, log.where(F.col("event_id").cast("bigint") % 2 == 0), "index", compacted=False)
    store.compact_tables(spark, tables, 1)
    odd = log.where(F.col("event_id").cast("bigint") % 2 == 1)
    apply_batch(spark, odd.where(F.col("operation") == "create"), 2, tables)
    apply_batch(spark, odd.where(F.col("operation") != "create"), 3, tables)
    # the same mutations once more: updates apply to what the index finds, deletes find nothing alive
    apply_batch(spark, log.where(F.col("operation") != "create"), 4, tables)
    return store.current_state(spark, tables, vectors=True).select(*EVENT_COLS)


# the repeated update sets the same error, latency and time once more: only the version grows
ORACLE["stream_index_lookup"] = _WITH_A + (
    f"select {', '.join(EVENT_COLS)} from (\n"
    "  select * replace (case when is_deleted = 0 and version = 2 then 3 else version end as version) from latest)"
)


@query
def write_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history that another writer sends in three overlapping batches, copies inside: each version is stored once."""
    versions = history(spark, sf_dir).select(*EVENT_COLS, "seq")
    tables = _tables(spark, "once")
    store.append_versions(spark, tables, 0, versions.where(F.col("version") == 1))
    store.compact_tables(spark, tables, 0)
    store.append_versions(spark, tables, 1, versions.unionByName(versions))
    store.append_versions(spark, tables, 2, versions)
    return store.read_versions(spark, tables).select(*EVENT_COLS)


ORACLE["write_once"] = ENGINE["event_history"]


@query
def redrive_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event after mutations that came before the creates were put back twice, the second time without effect."""
    log = adapters.changelog_a(spark, sf_dir)
    tables, inbox = _tables(spark, "redrive"), scratch_path(spark, "redrive-inbox")
    apply_batch(spark, log.where(F.col("operation") != "create"), 0, tables)
    apply_batch(spark, log.where(F.col("operation") == "create"), 1, tables)
    for _ in range(2):
        store.redrive_rejects(spark, tables, inbox, through=1)
    apply_batch(spark, read_json_lines(spark, inbox), 2, tables)
    return store.current_state(spark, tables, vectors=True).select(*EVENT_COLS)


ORACLE["redrive_twice"] = ENGINE["snapshot_with_deleted"]


@query
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch applied and rejected; the last batch is the log's mutations again."""
    log = adapters.changelog_a(spark, sf_dir)
    tables = _applied(spark, log, "metrics")
    apply_batch(spark, log.where(F.col("operation") != "create"), 2, tables)
    metrics = store.read_metrics(spark, tables)
    return metrics.select("batch_id", "kind", "name", "n", F.col("last_time").cast("timestamp_ntz").alias("last_time"))


ORACLE["stream_metrics"] = f"""with {_A_BASE}, x as (
  select 0 as batch_id, 'applied' as kind, 'create' as name, created_at as t from base
  union all select unnest([1, 2]), 'applied', 'update', created_at + interval 1 hour from base where k in (0, 1)
  union all select 1, 'applied', 'delete', created_at + interval 1 hour from base where k in (2, 3)
  union all select 2, 'rejected', 'not_found', null from base where k in (2, 3))
select cast(batch_id as bigint) as batch_id, kind, name, count(*) as n, cast(max(t) as timestamp) as last_time from x group by all"""


@query
def clustered_session_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session's events, from the snapshot's files that can hold it and the batch after it."""
    tables = _applied(spark, adapters.changelog_a(spark, sf_dir), "clustered")
    rows = store.session_state(spark, tables, SESSION).where(F.col("is_deleted") == 0)
    return public_view(store.vectors_of(spark, tables, rows))


ORACLE["clustered_session_lookup"] = ENGINE["conversation_events"]


@query
def vacuumed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event before and after the folders that a snapshot covers were deleted."""
    tables = _applied(spark, adapters.changelog_a(spark, sf_dir), "vacuumed", compacted=False)
    store.compact_tables(spark, tables, 1)
    store.compact_rollups(spark, tables, 1)
    path = scratch_path(spark, "before-vacuum")
    store.current_state(spark, tables, vectors=True).select(*EVENT_COLS).write.parquet(path)
    store.retire(spark, tables)
    store.vacuum(spark, tables, keep=1)
    steps = [spark.read.schema(EVENT_SCHEMA).parquet(path), store.current_state(spark, tables, vectors=True).select(*EVENT_COLS)]
    before, after = (df.withColumn("step", F.lit(i).cast("bigint")) for i, df in enumerate(steps))
    return before.unionByName(after)


ORACLE["vacuumed_state"] = _WITH_A + f"select {', '.join(EVENT_COLS)}, cast(unnest([0, 1]) as bigint) as step from latest"


@query
def keyed_event_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event by id from the state, its vectors fetched for that row alone."""
    tables = _applied(spark, adapters.changelog_a(spark, sf_dir), "keyed")
    return store.vectors_of(spark, tables, get_event(store.current_state(spark, tables), EVENT_ID, deduped=True))


ORACLE["keyed_event_by_id"] = _WITH_A + f"select {_PUBLIC} from latest where id = '{EVENT_ID}' and is_deleted = 0"
