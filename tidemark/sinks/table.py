"""History table layout, writer, reader, bootstrap and maintenance jobs.

Layout of the append-only history::

    <root>/batch_id=<N>/created_month=<yyyyMM>/part-*.parquet

* ``batch_id`` makes every write replaceable on its own: a replayed batch
  overwrites its own folder as a whole, which turns an at-least-once source
  into exactly-once table contents. The folder's ``_SUCCESS`` marks the batch
  as committed; readers leave a newest batch without it out.
* ``created_month`` gives month pruning for time-bounded reads.
* Rows are rebalanced on ``(created_month, conversation_id)`` and sorted on
  ``(conversation_id, event_name, id)`` within each file: row-group min/max
  statistics then skip on session filters. The rebalance is planned by AQE
  from measured sizes: small partitions are merged into ~advisory-size
  files and a hot session's partition is split over several writers, with
  no sampling pass over the input (a range repartition would recompute the
  fold once more to sample it).
* Parquet bloom filters on ``id`` (and optionally ``error``) back point
  lookups; min/max statistics on ``created_at`` come for free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.functions.exprs import day_key, month_key
from tidemark.operators.versioning import latest_version
from tidemark.schema import (
    DAILY_HISTORY_SCHEMA,
    DAY_COL,
    ERROR_PARTIAL_SCHEMA,
    EVENT_COLS,
    HISTORY_SCHEMA,
    LATENCY_PARTIAL_SCHEMA,
    MONTH_COL,
    REJECT_SCHEMA,
    SHADOW_COL,
)

SORT_COLS = ("conversation_id", "event_name", "id")
# Upper bound of rows per output file.
MAX_ROWS_PER_FILE = 2_000_000


# Bloom filter sizing: each column chunk gets a filter sized for this many
# distinct values (about 120 KB at fpp 0.01) unless the writer is told the
# batch size; capped at one row group's worth of ids.
DEFAULT_NDV = 100_000
MAX_NDV = 1_000_000


def _bloom_options(columns: tuple[str, ...], expected_ndv: int | None, fpp: float) -> dict[str, str]:
    """Parquet bloom filters per column, sized for ``expected_ndv`` distinct values.

    The filter is allocated at that size in every column chunk, however few
    rows the file gets, so callers that know their batch size pass it.
    """
    ndv = DEFAULT_NDV if expected_ndv is None else max(1_000, min(int(expected_ndv), MAX_NDV))
    opts = {}
    for c in columns:
        opts[f"parquet.bloom.filter.enabled#{c}"] = "true"
        opts[f"parquet.bloom.filter.expected.ndv#{c}"] = str(ndv)
        opts[f"parquet.bloom.filter.fpp#{c}"] = str(fpp)
    return opts


def layout(versions: DataFrame, partitions: int | None = None, daily: bool = False, ranged: bool = False) -> DataFrame:
    """Add the month (and, ``daily``, day) column, rebalance and sort rows for writing.

    ``ranged`` partitions by range instead (globally sorted files, so a
    session lies in one or two files of a month; one extra sampling pass);
    ``partitions`` also fixes their number.
    """
    ranged = ranged or bool(partitions)
    df = versions.withColumn(MONTH_COL, month_key("created_at"))
    if daily:
        df = df.withColumn(DAY_COL, day_key("created_at"))
    order = [MONTH_COL, *([DAY_COL] if daily else []), *SORT_COLS]
    if ranged:
        df = df.repartitionByRange(*([partitions] if partitions else []), *order)
    elif daily:
        # one writer per day folder (AQE splits a heavy day), not one file per task and day
        df = df.hint("rebalance", MONTH_COL, DAY_COL)
    else:
        df = df.hint("rebalance", MONTH_COL, "conversation_id")
    return df.sortWithinPartitions(*order)


# Bits of the clustering key: of a session's hash, and of the time inside a month.
SESSION_BITS, TIME_BITS = 16, 8


def _session_range(session: Column | str) -> Column:
    """A session's place among all sessions: the top bits of its hash."""
    return F.shiftrightunsigned(F.xxhash64(session), 64 - SESSION_BITS)


def clustered(versions: DataFrame) -> DataFrame:
    """Add the month column and order rows along a curve over (session, time) inside each month.

    The key interleaves two bits of the session's place with one of the time,
    so a file holds a small rectangle of sessions and days: a read by session opens few
    of a month's files, and one by session and time still fewer.
    :func:`file_ranges` tells which.
    """
    start = F.date_trunc("month", "created_at").cast("timestamp_ntz")
    share = F.timestamp_diff("SECOND", start, F.col("created_at")) / F.lit(31 * 86400)
    time = F.floor(share * (1 << TIME_BITS)).cast("bigint")
    session = _session_range("conversation_id")
    key = F.lit(0).cast("bigint")
    for i in range(TIME_BITS):
        key = key + F.shiftleft(F.shiftright(time, i).bitwiseAND(F.lit(1)), 3 * i)
        key = key + F.shiftleft(F.shiftright(session, 2 * i).bitwiseAND(F.lit(3)), 3 * i + 1)
    df = versions.withColumn(MONTH_COL, month_key("created_at")).withColumn("_z", key)
    return df.repartitionByRange(MONTH_COL, "_z").sortWithinPartitions(MONTH_COL, "_z", *SORT_COLS).drop("_z")


def file_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and the least and greatest session place and creation time in it, for each file of a clustered table."""
    rows = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file"), _session_range("conversation_id").alias("s"), "created_at"
    )
    return rows.groupBy("file").agg(
        F.min("s").alias("s_min"), F.max("s").alias("s_max"), F.min("created_at").alias("t_min"), F.max("created_at").alias("t_max")
    )


def session_files(spark: SparkSession, ranges_path: str, conversation_id: str, since=None) -> list[str]:
    """The files that can hold rows of a session (created at ``since`` or later), by their ranges."""
    s = _session_range(F.lit(conversation_id))
    hit = spark.read.parquet(ranges_path).where((F.col("s_min") <= s) & (F.col("s_max") >= s))
    if since is not None:
        hit = hit.where(F.col("t_max") >= F.lit(str(since)).cast("timestamp_ntz"))
    return sorted(r.file for r in hit.select("file").collect())


def write_history(
    versions: DataFrame,
    path: str,
    batch_id: int | None = None,
    bloom_columns: tuple[str, ...] = ("id",),
    expected_ndv: int | None = None,
    fpp: float = 0.01,
    partitions: int | None = None,
    daily: bool = False,
) -> None:
    """Write version rows under ``batch_id=N``; re-running the same batch replaces it.

    Without ``batch_id`` the rows, each with its own, are the whole table.
    ``daily`` adds a ``created_day`` partition level below the month, for
    tables whose reads mostly cover a few days; read such a table with
    ``read_history(..., daily=True)``.
    """
    df = versions
    if "seq" not in df.columns:
        df = df.withColumn("seq", F.lit(0).cast("bigint"))
    if SHADOW_COL not in df.columns:
        df = df.withColumn(SHADOW_COL, F.lit(0))
    df = layout(df.select(*EVENT_COLS, *(["batch_id"] if batch_id is None else []), "seq", SHADOW_COL), partitions, daily)
    _write_partitioned(
        df.write.option("maxRecordsPerFile", MAX_ROWS_PER_FILE).options(**_bloom_options(bloom_columns, expected_ndv, fpp)),
        path,
        ["batch_id", MONTH_COL, *([DAY_COL] if daily else [])],
        batch_id,
    )


def _write_partitioned(writer, path: str, partition_cols: list[str], batch_id: int | None) -> None:
    """Replace the folder of one batch, whatever it held; without a batch, the table.

    The folder is overwritten as a whole, so a replay that yields fewer rows,
    months or no rows at all leaves nothing of the first attempt. Spark puts
    ``_SUCCESS`` into the folder when the write has been committed.
    """
    writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    if batch_id is not None:
        path, partition_cols = f"{path}/batch_id={int(batch_id)}", [c for c in partition_cols if c != "batch_id"]
    (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(path)


def write_batch_table(df: DataFrame, path: str, batch_id: int, partition_cols: tuple[str, ...] = ()) -> None:
    """Write a per-batch side table (rejects, rollup partials) under ``batch_id=N``."""
    _write_partitioned(df.drop("batch_id").write, path, list(partition_cols), batch_id)


def _batches(spark: SparkSession, path: str) -> list[int]:
    """The batch folders of a table, in order (one listing of its root)."""
    if not path_exists(spark, path):
        return []
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(int(n[len("batch_id="):]) for n in names if n.startswith("batch_id="))


def last_committed(spark: SparkSession, path: str) -> int | None:
    """The newest batch whose write has been committed.

    Batches are written one after the other, so only the newest folder can be
    unfinished; its ``_SUCCESS`` is looked up, and older folders only while
    newer ones lack theirs. A table written at once, without batch folders of
    its own, has one ``_SUCCESS`` for all.
    """
    batches = _batches(spark, path)
    if batches and path_exists(spark, f"{path}/_SUCCESS"):
        return batches[-1]
    for batch in reversed(batches):
        if path_exists(spark, f"{path}/batch_id={batch}/_SUCCESS"):
            return batch
    return None


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and its path class."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path_of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path_of


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, path_of = _hadoop(spark, path)
    return bool(fs.exists(path_of(path)))


def read_history(spark: SparkSession, path: str, daily: bool = False) -> DataFrame:
    """The history table with its declared schema (nothing inferred), without an unfinished batch."""
    schema = DAILY_HISTORY_SCHEMA if daily else HISTORY_SCHEMA
    rows = spark.read.schema(schema).option("basePath", path).parquet(path)
    batches, done = _batches(spark, path), last_committed(spark, path)
    if not batches or done == batches[-1]:
        return rows
    return rows.where(F.col("batch_id") <= done) if done is not None else rows.limit(0)


def _typed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark, path, StructType(list(REJECT_SCHEMA.fields) + [StructField("batch_id", LongType())]))


def read_error_partials(spark: SparkSession, path: str) -> DataFrame:
    """The error rollup's partials; a filter on ``event_month`` (yyyyMM) prunes folders."""
    return _typed(spark, path, ERROR_PARTIAL_SCHEMA)


def read_latency_partials(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark, path, LATENCY_PARTIAL_SCHEMA)


def ensure_tables(spark: SparkSession, database: str, root: str) -> None:
    """Idempotent bootstrap: database plus catalog tables over the table folders.

    Safe to run at every start; existing tables are left as they are.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in HISTORY_SCHEMA.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.event_history ({cols}) USING parquet "
        f"PARTITIONED BY (batch_id, {MONTH_COL}) LOCATION '{root}/history'"
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.error_rollup (event_date date, event_name string, "
        f"error_count bigint, total_count bigint, batch_id bigint, event_month string) USING parquet "
        f"PARTITIONED BY (batch_id, event_month) LOCATION '{root}/rollup_error'"
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.latency_rollup (conversation_id string, event_name string, "
        f"latency_sketch binary, event_count bigint, batch_id bigint) USING parquet "
        f"PARTITIONED BY (batch_id) LOCATION '{root}/rollup_latency'"
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.event_rejects (event_id string, operation string, seq bigint, "
        f"reason string, raw string, batch_id bigint) USING parquet PARTITIONED BY (batch_id) "
        f"LOCATION '{root}/rejects'"
    )


def refresh_tables(spark: SparkSession, database: str, root: str) -> None:
    """Register partitions written by the path-based writers with the catalog.

    Tables whose folder has not been written yet are left alone.
    """
    folders = {"event_history": "history", "error_rollup": "rollup_error",
               "latency_rollup": "rollup_latency", "event_rejects": "rejects"}
    for table, folder in folders.items():
        if path_exists(spark, f"{root}/{folder}"):
            spark.sql(f"ALTER TABLE {database}.{table} RECOVER PARTITIONS")


def compact(history: DataFrame) -> DataFrame:
    """One row per event: its latest version, tombstones kept.

    Written as a new history, it answers every read and every later fold the
    same way as the full history, with one version per event to scan.
    """
    keep = [*EVENT_COLS, "batch_id", "seq", *[c for c in (SHADOW_COL,) if c in history.columns]]
    return latest_version(history, ("id",), include_deleted=True).select(*keep)


def purge_deleted(history: DataFrame, retention_days: int, as_of=None) -> DataFrame:
    """History without the events deleted and created more than ``retention_days`` ago.

    All versions of such an event are removed; other events are untouched.
    """
    from tidemark.functions.exprs import as_of_literal, days_before

    cutoff = days_before(as_of_literal(as_of), int(retention_days))
    latest = latest_version(history.select("id", "version", "batch_id", "seq", "is_deleted", "created_at"))
    expired = latest.where((F.col("is_deleted") == 1) & (F.col("created_at") < cutoff)).select("id")
    return history.join(expired, "id", "left_anti")


def drop_replayed(history: DataFrame) -> DataFrame:
    """One row per ``(id, version)``, the first written: removes copies left by a replayed write.

    The batch-overwrite writers never leave such copies; this is for
    histories appended by other writers, whose replays may carry another
    batch id. Not for histories with a shadowed create, whose version 1
    occurs twice.
    """
    w = Window.partitionBy("id", "version").orderBy("batch_id", "seq")
    return history.withColumn("_copy", F.row_number().over(w)).where(F.col("_copy") == 1).drop("_copy")


SNAPSHOT_PREFIX = "through="


def write_snapshot(spark: SparkSession, history_path: str, snapshot_root: str, through: int) -> str:
    """Compact every version written by batches ``<= through`` into one row per event.

    ``through`` must be a committed batch: a later write of an older batch
    would stay hidden. Merges the newest older snapshot with the batches after
    it, so old batches are not read again. Written next to earlier snapshots as
    ``<snapshot_root>/through=<K>``, partitioned by ``created_month`` like the
    history and sorted by session over the whole month, so month and session
    predicates skip folders and files; readers pick the newest. Tombstones
    are kept, so the snapshot answers later folds and reads exactly like the
    versions it replaces.
    """
    done = last_committed(spark, history_path)
    if done is None or int(through) > done:
        raise ValueError(f"batch {through} has not been committed (last: {done})")
    out = f"{snapshot_root.rstrip('/')}/{SNAPSHOT_PREFIX}{int(through)}"
    rows = read_state(spark, history_path, snapshot_root, through=int(through), before=int(through))
    (
        layout(rows.select(*EVENT_COLS, "batch_id", "seq", SHADOW_COL), ranged=True)
        .write.mode("overwrite")
        .options(**_bloom_options(("id",), None, 0.01))
        .partitionBy(MONTH_COL)
        .parquet(out)
    )
    return out


def merge_partials(
    spark: SparkSession, path: str, out_root: str, through: int, schema: StructType, merge, partition_cols: tuple[str, ...] = ()
) -> str:
    """Merge a rollup's partials of the batches ``<= through`` (and the last merge) into one per key.

    Written as ``<out_root>/through=<K>`` like snapshots; :func:`merged_partials`
    reads the newest with the later batches, so reads stay bounded by the keys.
    """
    done = last_committed(spark, path)
    if done is None or int(through) > done:
        raise ValueError(f"batch {through} has not been committed (last: {done})")
    out = f"{out_root.rstrip('/')}/{SNAPSHOT_PREFIX}{int(through)}"
    merged = merge(merged_partials(spark, path, out_root, schema, through))
    writer = merged.write.mode("overwrite")
    (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(out)
    return out


def merged_partials(spark: SparkSession, path: str, out_root: str, schema: StructType, through: int | None = None) -> DataFrame:
    """The newest merge older than ``through`` and the partials of later batches, without ``batch_id``."""
    names = [f.name for f in schema.fields if f.name != "batch_id"]
    rows = _typed(spark, path, schema)
    if through is not None:
        rows = rows.where(F.col("batch_id") <= int(through))
    k = latest_snapshot(spark, out_root)
    if k is None or (through is not None and k > through):
        return rows.select(*names)
    own = StructType([f for f in schema.fields if f.name != "batch_id"])
    old = _typed(spark, f"{out_root.rstrip('/')}/{SNAPSHOT_PREFIX}{k}", own)
    return old.select(*names).unionByName(rows.where(F.col("batch_id") > k).select(*names))


def latest_snapshot(spark: SparkSession, snapshot_root: str, before: int | None = None) -> int | None:
    """The highest ``through`` batch among the written snapshots (older than ``before``), if any."""
    if not path_exists(spark, snapshot_root):
        return None
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(snapshot_root)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    best = None
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(SNAPSHOT_PREFIX) and path_exists(
            spark, f"{status.getPath().toString()}/_SUCCESS"
        ):
            k = int(name[len(SNAPSHOT_PREFIX):])
            if (best is None or k > best) and (before is None or k < before):
                best = k
    return best


def read_state(
    spark: SparkSession, history_path: str, snapshot_root: str | None = None, through: int | None = None, before: int | None = None
) -> DataFrame:
    """Current state: the latest version of every event (tombstones kept), one row each.

    With a snapshot through batch K, a row of a later batch supersedes the
    event's snapshot row unless it is a shadowed create, which is never
    visible. So the state is the snapshot without the events that later
    batches touched (an anti join on ids; AQE broadcasts them when they
    measure small) and the latest of those batches' rows: the snapshot is
    neither sorted nor shuffled by the dedup, and filters on month or session
    reach its scan. Without a snapshot this is the dedup of the whole
    history. ``through`` limits the batches, ``before`` the snapshots.
    """
    history = read_history(spark, history_path)
    if through is not None:
        history = history.where(F.col("batch_id") <= int(through))
    k = latest_snapshot(spark, snapshot_root, before) if snapshot_root else None
    cols = [*EVENT_COLS, "batch_id", "seq", SHADOW_COL, MONTH_COL]
    if k is None:
        return latest_version(history.select(*cols), ("id",), include_deleted=True)
    snap = read_snapshot(spark, snapshot_root, k).select(*cols)
    visible = F.coalesce(F.col(SHADOW_COL), F.lit(0)) == 0
    delta = history.where((F.col("batch_id") > k) & visible).select(*cols)
    untouched = snap.join(delta.select("id").distinct(), "id", "left_anti")
    return untouched.unionByName(latest_version(delta, ("id",), include_deleted=True))


def read_snapshot(spark: SparkSession, snapshot_root: str, through: int) -> DataFrame:
    """One row per event of the batches ``<= through``."""
    path = f"{snapshot_root.rstrip('/')}/{SNAPSHOT_PREFIX}{int(through)}"
    return spark.read.schema(HISTORY_SCHEMA).option("basePath", path).parquet(path)


def write_purged(spark: SparkSession, history_path: str, out_path: str, retention_days: int, as_of=None) -> None:
    """The stored history without expired events (:func:`purge_deleted`), written as a new table.

    Batches keep their folders' ids and each has its own commit mark, so a
    later batch that is unfinished stays hidden. For the tables of an apply job, see
    :func:`tidemark.sinks.store.purge`.
    """
    done = last_committed(spark, history_path)
    kept = purge_deleted(read_history(spark, history_path), retention_days, as_of)
    write_history(kept.drop(MONTH_COL), out_path)
    fs, path = _hadoop(spark, out_path)
    for batch in _batches(spark, history_path):
        if batch <= done:
            fs.create(path(f"{out_path}/batch_id={batch}/_SUCCESS"), True).close()
    fs.delete(path(f"{out_path}/_SUCCESS"), False)
