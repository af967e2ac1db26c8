"""The event store of an apply job: all its tables behind one manifest.

Folders under the root (the manifest says which of them count)::

    history/batch_id=N/attempt=<a>/created_month=<yyyyMM>/   version rows, vectors by key
    vectors/batch_id=N/attempt=<a>/                          vec_key, vec: each content once
    index/batch_id=N/attempt=<a>/                            one narrow row for each version row
    rejects/..., rollup_error/..., rollup_latency/...        per batch
    snapshots/through=K/attempt=<a>/created_month=<yyyyMM>/  one row per event
    index_base/through=K/attempt=<a>/id_bucket=<b>/          the index rows of the batches up to K
    vector_keys/through=K/attempt=<a>/key_bucket=<b>/        the stored vector keys up to K
    redriven/run=<r>/                                        keys of rejects that were put back

* A batch is written to folders of a new attempt and committed by one manifest
  for all tables, so no reader sees half of it, whatever fails, and a replay
  replaces it at once.
* The lookup of a micro-batch reads the buckets of the index that its ids fall into, and
  then the folders (batch or snapshot month) that hold the winners.
* :func:`purge` moves all tables to a new generation by one manifest;
  :func:`retire` stops naming versions that a snapshot covers; :func:`vacuum`
  deletes what only forgotten manifests name.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType
from pyspark.util import inheritable_thread_target

from tidemark.functions.exprs import as_of_literal, days_before, month_key
from tidemark.operators.fold import as_base
from tidemark.operators.rollups import error_partial, latency_partial, merge_error, merge_latency, with_month
from tidemark.operators.vectors import VECTOR_SCHEMA, keyed_schema, split_vectors, with_vectors
from tidemark.operators.versioning import latest_version, place_in
from tidemark.schema import (
    ARRAY_FIELDS,
    ERROR_PARTIAL_SCHEMA,
    EVENT_COLS,
    HISTORY_SCHEMA,
    LATENCY_PARTIAL_SCHEMA,
    MONTH_COL,
    R_NOT_FOUND,
    REJECT_SCHEMA,
    SHADOW_COL,
)
from tidemark.session import scratch_path
from tidemark.sinks import manifest as M
from tidemark.sinks.manifest import Files, Manifest, commit, load
from tidemark.sinks.table import MAX_ROWS_PER_FILE, _bloom_options, clustered, file_ranges, layout, session_files

#: A key's slot, by its hash. The buckets of a compacted index are equal ranges of slots; there
#: are as many (a power of two) as its rows need.
SLOTS, BUCKET_ROWS, LEAST_BUCKETS = 4096, 500_000, 4
ATTEMPT, SLOT, ID_BUCKET, KEY_BUCKET = "attempt", "slot", "id_bucket", "key_bucket"
KEYED_HISTORY = keyed_schema(HISTORY_SCHEMA)
_ROW = [*EVENT_COLS, "batch_id", "seq", SHADOW_COL]
_ROLLUPS = {
    "rollup_error": (ERROR_PARTIAL_SCHEMA, ("event_month",), lambda p: with_month(merge_error(p))),
    "rollup_latency": (LATENCY_PARTIAL_SCHEMA, (), merge_latency),
}


def _fields(*pairs) -> StructType:
    return StructType([StructField(n, t) for n, t in pairs])


_LONG, _TEXT, _INT = LongType(), StringType(), IntegerType()
INDEX_SCHEMA = _fields(("id", _TEXT), ("version", _LONG), ("is_deleted", _INT), ("seq", _LONG), (SHADOW_COL, _INT), ("month", _TEXT), (SLOT, _INT), ("batch_id", _LONG))
KEYS_SCHEMA = _fields(("vec_key", _TEXT), (SLOT, _INT))
_SCHEMAS = {
    "history": KEYED_HISTORY,
    "index": INDEX_SCHEMA,
    "vectors": StructType([*VECTOR_SCHEMA.fields, StructField("batch_id", _LONG)]),
    "rejects": StructType([*REJECT_SCHEMA.fields, StructField("batch_id", _LONG)]),
    **{name: schema for name, (schema, _, _) in _ROLLUPS.items()},
}


@dataclass(frozen=True)
class Tables:
    """The tables of one apply job, under one root on shared storage."""

    root: str


def slot(key: Column | str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")


def _touched(keys: DataFrame, key: str) -> list[int]:
    """The slots that keys fall into: at most ``SLOTS`` numbers."""
    return sorted(r[0] for r in keys.select(slot(key)).distinct().collect())


# ---------------------------------------------------------------- folders

def _none(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows; the limit lets the optimizer drop joins with them."""
    return spark.createDataFrame([], schema).limit(0)


def _read(spark: SparkSession, tables: Tables, table: str, paths: list[str], schema: StructType, *more: StructField) -> DataFrame:
    """The rows of the named folders; nothing else of the table is listed."""
    full = StructType([*schema.fields, *more, StructField(ATTEMPT, _TEXT)])
    if not paths:
        return _none(spark, full).drop(ATTEMPT)
    reader = spark.read.schema(full).option("basePath", f"{tables.root}/{table}")
    return reader.parquet(*[f"{tables.root}/{p}" for p in paths]).drop(ATTEMPT)


def _batches(spark: SparkSession, tables: Tables, m: Manifest, table: str, after: int | None = None, before: int | None = None) -> DataFrame:
    return _read(spark, tables, table, m.paths(table, after, before), _SCHEMAS[table])


def _compacted(spark: SparkSession, tables: Tables, path: str | None, schema: StructType) -> DataFrame:
    """The rows of a ``through=K`` folder."""
    paths = [path] if path else []
    return _read(spark, tables, path.split("/")[0] if path else "", paths, schema, StructField("through", _LONG)).drop("through")


def _write(df: DataFrame, tables: Tables, path: str, partition_cols: tuple[str, ...] = (), **options: str) -> str:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**options)
    (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(f"{tables.root}/{path}")
    return path


def _bucketed(df: DataFrame, tables: Tables, path: str, by: str, key: str, rows: int) -> dict:
    """Rows in one folder for each bucket of slots, sorted by key; AQE splits a large bucket over several writers."""
    buckets = LEAST_BUCKETS
    while buckets < SLOTS and buckets * BUCKET_ROWS < rows:
        buckets *= 2
    df = df.withColumn(by, F.shiftright(SLOT, (SLOTS // buckets).bit_length() - 1))
    _write(df.hint("rebalance", by).sortWithinPartitions(by, key), tables, path, (by,))
    names = set(Files(df.sparkSession, tables.root).names(path))
    full = [b for b in range(buckets) if f"{by}={b}" in names]
    return {"path": path, "by": by, "buckets": buckets, "full": full, "rows": rows}


def _buckets(spark: SparkSession, tables: Tables, part: dict | None, schema: StructType, slots: list[int] | None = None) -> DataFrame:
    """The rows of a bucketed folder, of the buckets that hold the given slots: other folders are not even listed."""
    if part is None:
        return _none(spark, schema)
    touched = part["full"] if slots is None else sorted({s * part["buckets"] // SLOTS for s in slots} & set(part["full"]))
    paths = [f"{part['path']}/{part['by']}={b}" for b in touched]
    extra = [StructField("through", _LONG), StructField(part["by"], _INT)]
    return _read(spark, tables, part["path"].split("/")[0], paths, schema, *extra).drop("through", part["by"])


def _together(spark: SparkSession, *jobs):
    """Run independent writes side by side; the results in order."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def _new() -> str:
    return uuid.uuid4().hex[:12]


# ---------------------------------------------------------------- reads

def read_versions(spark: SparkSession, tables: Tables, vectors: bool = True, m: Manifest | None = None) -> DataFrame:
    """All committed version rows that have not been retired; without ``vectors`` their columns hold keys."""
    m = m or load(spark, tables.root)
    rows = _batches(spark, tables, m, "history")
    return with_vectors(rows, read_vectors(spark, tables, m)) if vectors else rows


def read_vectors(spark: SparkSession, tables: Tables, m: Manifest | None = None) -> DataFrame:
    """``vec_key, vec``."""
    return _batches(spark, tables, m or load(spark, tables.root), "vectors").select("vec_key", "vec")


def read_rejects(spark: SparkSession, tables: Tables, m: Manifest | None = None) -> DataFrame:
    return _batches(spark, tables, m or load(spark, tables.root), "rejects")


def read_index(spark: SparkSession, tables: Tables, m: Manifest, before: int | None = None, slots: list[int] | None = None) -> DataFrame:
    """Index rows of the batches before ``before``, the snapshot's from the buckets of the given slots; ``compacted``: the row is in the snapshot."""
    k = m.through()
    if k is not None and before is not None and k >= before:
        k = None
    base = _buckets(spark, tables, m.snapshot["index"] if k is not None else None, INDEX_SCHEMA, slots).withColumn("compacted", F.lit(True))
    return base.unionByName(_batches(spark, tables, m, "index", k, before).withColumn("compacted", F.lit(False)))


def _state(spark: SparkSession, tables: Tables, m: Manifest, columns: list[str], through: int | None = None) -> DataFrame:
    """One row per event (tombstones kept): the snapshot without the events that later batches touch, and those."""
    k = m.through()
    delta = _batches(spark, tables, m, "history", k, None if through is None else through + 1).where(F.coalesce(SHADOW_COL, F.lit(0)) == 0)
    latest = latest_version(delta.select(*columns))
    if k is None:
        return latest
    snap = _compacted(spark, tables, m.snapshot["state"], KEYED_HISTORY).select(*columns)
    return snap.join(delta.select("id").distinct(), "id", "left_anti").unionByName(latest)


def current_state(spark: SparkSession, tables: Tables, vectors: bool = False, m: Manifest | None = None) -> DataFrame:
    """One row per event (tombstones kept), for the reads with ``deduped=True``.

    No vector passes a shuffle or a sort here. Their columns hold keys, for
    :func:`vectors_of` on the final rows; ``vectors`` does that for all rows.
    """
    m = m or load(spark, tables.root)
    rows = _state(spark, tables, m, [*_ROW, MONTH_COL])
    return with_vectors(rows, read_vectors(spark, tables, m)) if vectors else rows


def vectors_of(spark: SparkSession, tables: Tables, rows: DataFrame) -> DataFrame:
    """Rows of :func:`current_state` or a read over it, keys replaced by vectors (those columns that are left)."""
    return with_vectors(rows, read_vectors(spark, tables), tuple(c for c in ARRAY_FIELDS if c in rows.columns))


def session_state(spark: SparkSession, tables: Tables, conversation_id: str, since=None) -> DataFrame:
    """The events of one session (tombstones kept), read from the files that can hold it.

    The snapshot's files are chosen by their ranges (:func:`tidemark.sinks.table.file_ranges`)
    before the scan is planned; later batches are few and read by filter.
    An event that changed its session belongs to where its latest row is.
    """
    m = load(spark, tables.root)
    k, cols = m.through(), [*_ROW, MONTH_COL]
    delta = _batches(spark, tables, m, "history", k).where(F.coalesce(SHADOW_COL, F.lit(0)) == 0)
    here = F.col("conversation_id") == conversation_id
    if since is not None:
        here = here & (F.col("created_at") >= as_of_literal(since))
    touched = delta.where(here).select("id").distinct()
    rows = latest_version(delta.select(*cols).join(touched, "id", "left_semi")).where(here)
    if k is None:
        return rows
    files = session_files(spark, f"{tables.root}/{m.snapshot['files']}", conversation_id, since)
    snap = _read(spark, tables, "snapshots", [f[f.index("snapshots/through="):] for f in files], KEYED_HISTORY, StructField("through", _LONG)).where(here)
    return snap.select(*cols).join(delta.select("id").distinct(), "id", "left_anti").unionByName(rows)


def _rollup(spark: SparkSession, tables: Tables, m: Manifest, name: str, through: int | None = None) -> DataFrame:
    schema = StructType([f for f in _ROLLUPS[name][0].fields if f.name != "batch_id"])
    old = m.merged.get(name)
    rows = _batches(spark, tables, m, name, old and old["through"], None if through is None else through + 1).select(*schema.names)
    return rows.unionByName(_compacted(spark, tables, old["path"], schema)) if old else rows


def error_rollup(spark: SparkSession, tables: Tables) -> DataFrame:
    """The error rollup's committed partials, old ones merged; for ``read_error_rollup``."""
    return _rollup(spark, tables, load(spark, tables.root), "rollup_error")


def latency_rollup(spark: SparkSession, tables: Tables) -> DataFrame:
    """The latency rollup's committed partials, old ones merged; for ``read_latency_rollup``."""
    return _rollup(spark, tables, load(spark, tables.root), "rollup_latency")


_METRICS = _fields(("batch_id", _LONG), ("kind", _TEXT), ("name", _TEXT), ("n", _LONG), ("last_time", _TEXT), ("lag_ms", _LONG))


def read_metrics(spark: SparkSession, tables: Tables) -> DataFrame:
    """``batch_id, kind, name, n, last_time, lag_ms`` of every batch that the manifest lists.

    ``kind`` is ``applied`` (``name``: the operation) or ``rejected`` (the
    reason). ``last_time``: the newest message time; ``lag_ms``: from it to the commit.
    """
    rows = [
        (b, kind, name, x["n"], x.get("last"), x.get("lag_ms"))
        for b, tables_of in sorted(load(spark, tables.root).batches.items())
        for kind in ("applied", "rejected")
        for name, x in sorted(tables_of["metrics"][kind].items())
    ]
    return spark.createDataFrame(rows, _METRICS)


# ---------------------------------------------------------------- writes

def base_rows(spark: SparkSession, tables: Tables, ids: DataFrame, batch_id: int, m: Manifest, keep=lambda df: df) -> DataFrame | None:
    """The stored current row of each of ``ids`` before a batch, as base operations of the fold.

    The ids' buckets of the index give the winners on narrow columns; the winners name the
    folders to read: months of the snapshot, and (batch, month) of later batches.
    ``keep`` may persist the ids and the winners, which are used more than once.
    """
    if not any(b < batch_id for b in m.batches):
        return None
    ids = keep(ids.select("id").distinct())
    index = read_index(spark, tables, m, batch_id, _touched(ids, "id") if m.snapshot else None)
    keys = ["id", "version", "batch_id", "seq"]
    winners = keep(latest_version(index.join(ids, "id", "left_semi").select(*keys, "month", "compacted")))
    places = winners.select("compacted", "batch_id", "month").distinct().collect()  # folders: at most months x batches
    part = lambda path, month: path if month is None else f"{path}/{MONTH_COL}={month}"
    months = {r.month for r in places if r.compacted}
    snap = [part(m.snapshot["state"], x) for x in sorted(months, key=str)] if months else []
    later = sorted({part(p, r.month) for r in places if not r.compacted for p in m.batches[r.batch_id]["history"]["paths"]})
    rows = _read(spark, tables, "snapshots", snap, KEYED_HISTORY, StructField("through", _LONG)).drop("through")
    rows = rows.unionByName(_read(spark, tables, "history", later, KEYED_HISTORY))
    same = [F.col(f"h.{k}").eqNullSafe(F.col(f"w.{k}")) if k == "seq" else F.col(f"h.{k}") == F.col(f"w.{k}") for k in keys]
    return as_base(rows.alias("h").join(winners.alias("w"), same, "left_semi"))


def _new_vectors(spark: SparkSession, tables: Tables, vectors: DataFrame, m: Manifest) -> DataFrame:
    """The vectors whose content is not stored yet, each once."""
    stored = _batches(spark, tables, m, "vectors", m.through()).select("vec_key")
    if m.snapshot:
        stored = stored.unionByName(_buckets(spark, tables, m.snapshot["vector_keys"], KEYS_SCHEMA, _touched(vectors, "vec_key")).select("vec_key"))
    return vectors.dropDuplicates(["vec_key"]).join(stored, "vec_key", "left_anti")  # copies end before the shuffle


def store_batch(
    spark: SparkSession, tables: Tables, batch_id: int, versions: DataFrame, vectors: DataFrame, rejects: DataFrame, metrics: dict, m: Manifest
) -> Manifest:
    """Write one batch to all tables and commit it; ``versions`` and ``vectors`` from ``split_vectors``.

    ``metrics``: ``applied`` and ``rejected``, each name -> ``{"n": rows, ...}``.
    """
    attempt = _new()
    path = lambda table: f"{table}/batch_id={int(batch_id)}/{ATTEMPT}={attempt}"
    applied, rejected = (sum(x["n"] for x in metrics[kind].values()) for kind in ("applied", "rejected"))

    def write(table: str, rows: int, df: DataFrame, *partition_cols: str, **options: str) -> tuple[str, dict]:
        return table, {"rows": rows, "paths": [_write(df, tables, path(table), partition_cols, **options)] if rows else []}

    def write_vectors() -> tuple[str, dict]:
        at = _write(_new_vectors(spark, tables, vectors, m), tables, path("vectors"))
        rows = spark.read.schema(VECTOR_SCHEMA).parquet(f"{tables.root}/{at}").count()
        kept = m.batches.get(batch_id, {}).get("vectors", {"rows": 0, "paths": []})  # a replay's: later batches may name them
        return "vectors", {"rows": rows + kept["rows"], "paths": kept["paths"] + ([at] if rows else [])}

    narrow = versions.select("id", "version", "is_deleted", "seq", SHADOW_COL, month_key("created_at").alias("month"), slot("id").alias(SLOT))
    narrow = narrow.hint("rebalance").sortWithinPartitions(SLOT, "id")
    wide = layout(versions.select(*EVENT_COLS, "seq", SHADOW_COL))
    options = _bloom_options(("id",), applied, 0.01) | {"maxRecordsPerFile": str(MAX_ROWS_PER_FILE)}
    entry = dict(_together(
        spark, write_vectors,
        lambda: write("rejects", rejected, rejects.select(*REJECT_SCHEMA.names)),
        lambda: write("rollup_error", applied, with_month(error_partial(versions)), "event_month"),
        lambda: write("rollup_latency", applied, latency_partial(versions)),
        lambda: write("index", applied, narrow),
        lambda: write("history", applied, wide, MONTH_COL, **options),
    ))
    entry["metrics"] = metrics

    def change(new: Manifest) -> Manifest:
        new.batches[int(batch_id)] = entry
        return new

    return commit(spark, tables.root, change)


def is_compacted(m: Manifest, batch_id: int) -> bool:
    """A committed batch that the snapshot holds: a replay has nothing to add."""
    return batch_id in m.batches and m.through() is not None and batch_id <= m.through()


def lag_ms(last) -> int | None:
    """Milliseconds from a message time (UTC) to now."""
    import datetime as dt

    return None if last is None else int(1000 * (time.time() - last.replace(tzinfo=dt.timezone.utc).timestamp()))


def append_versions(spark: SparkSession, tables: Tables, batch_id: int, versions: DataFrame) -> int:
    """Store version rows made by another writer, each ``(id, version)`` once whatever batch brings it again.

    Rows that the index knows, and all but the first of equal ones in the batch, are left
    out; a replay of ``batch_id`` replaces it. Returns the rows stored.
    ``versions``: ``EVENT_COLS`` and ``seq``.
    """
    m = load(spark, tables.root)
    if is_compacted(m, batch_id):
        return 0
    versions = versions.persist()  # read once; the keyed rows and the vectors derive from it
    known = Manifest(**{**m.__dict__, "batches": {b: t for b, t in m.batches.items() if b != batch_id}})
    rows = versions.select(*EVENT_COLS, F.col("seq").cast("bigint").alias("seq"), F.lit(int(batch_id)).cast("bigint").alias("batch_id"), F.lit(0).alias(SHADOW_COL))
    rows, vectors = split_vectors(rows)
    first = Window.partitionBy("id", "version").orderBy("seq", "updated_at", F.xxhash64(*EVENT_COLS))
    stored = read_index(spark, tables, known, slots=_touched(versions, "id") if known.snapshot else None).select("id", "version")
    rows = rows.join(stored, ["id", "version"], "left_anti")  # before the sort: most of a replay ends here
    rows = rows.withColumn("_n", place_in(first)).where("_n = 1").drop("_n").persist()
    try:
        told = rows.agg(F.count(F.lit(1)).alias("n"), F.max("updated_at").alias("last")).first()
        wanted = rows.select(F.explode(F.array(*ARRAY_FIELDS)).alias("vec_key")).distinct()
        metrics = {"applied": {"append": {"n": told.n, "last": told.last and str(told.last), "lag_ms": lag_ms(told.last)}}, "rejected": {}}
        none = spark.createDataFrame([], REJECT_SCHEMA)
        store_batch(spark, tables, batch_id, rows, vectors.join(wanted, "vec_key", "left_semi"), none, metrics, m)
        return told.n
    finally:
        rows.unpersist()
        versions.unpersist()


# ---------------------------------------------------------------- maintenance

def _rows(m: Manifest, table: str, part: str) -> int:
    """Rows of a table's batches after the snapshot, and of the snapshot's part."""
    k = m.through()
    later = sum(t[table]["rows"] for b, t in m.batches.items() if table in t and (k is None or b > k))
    return later + (m.snapshot[part]["rows"] if m.snapshot else 0)


def _index_of(spark: SparkSession, tables: Tables, m: Manifest, index: DataFrame, path: str) -> dict:
    return _bucketed(index, tables, path, ID_BUCKET, "id", _rows(m, "index", "index"))


def _keys_of(spark: SparkSession, tables: Tables, m: Manifest, path: str) -> dict:
    """All stored vector keys of the manifest's batches and its snapshot, by bucket."""
    keys = _batches(spark, tables, m, "vectors", m.through()).select("vec_key", slot("vec_key").alias(SLOT))
    keys = keys.unionByName(_buckets(spark, tables, m.snapshot and m.snapshot["vector_keys"], KEYS_SCHEMA))
    return _bucketed(keys, tables, path, KEY_BUCKET, "vec_key", _rows(m, "vectors", "vector_keys"))


def compact_tables(spark: SparkSession, tables: Tables, through: int) -> Manifest:
    """One row per event of the batches ``<= through``, and their index and vector keys by bucket.

    Merges the last snapshot with the batches after it. Safe beside the apply and
    readers: they go on with what their manifest names. Vectors stay where they are.
    """
    m = load(spark, tables.root)
    if not m.batches or int(through) > max(m.batches):
        raise ValueError(f"batch {through} has not been committed (last: {max(m.batches, default=None)})")
    k, attempt = m.through(), _new()
    if k is not None and k >= int(through):
        return m
    at = lambda table: f"{table}/through={int(through)}/{ATTEMPT}={attempt}"
    upto = Manifest(**{**m.__dict__, "batches": {b: t for b, t in m.batches.items() if b <= int(through)}})

    def write_state() -> tuple[str, str]:
        rows = clustered(_state(spark, tables, m, _ROW, int(through)))
        state = _write(rows, tables, at("snapshots"), (MONTH_COL,), **_bloom_options(("id",), None, 0.01))
        return state, _write(file_ranges(spark, f"{tables.root}/{state}"), tables, at("snapshot_files"))

    (state, files), index, keys = _together(
        spark, write_state,
        lambda: _index_of(spark, tables, upto, read_index(spark, tables, upto).drop("compacted"), at("index_base")),
        lambda: _keys_of(spark, tables, upto, at("vector_keys")),
    )
    seen = {b: m.batches[b]["history"]["paths"] for b in upto.batches if "history" in m.batches[b]}

    def change(new: Manifest) -> Manifest:
        if new.generation != m.generation or any(new.batches[b].get("history", {}).get("paths") != p for b, p in seen.items()):
            raise RuntimeError("the batches were rewritten during the compaction: run it again")
        if new.snapshot is None or new.snapshot["through"] < int(through):
            new.snapshot = {"through": int(through), "state": state, "files": files, "index": index, "vector_keys": keys}
        return new

    return commit(spark, tables.root, change)


def compact_rollups(spark: SparkSession, tables: Tables, through: int) -> Manifest:
    """Merge both rollups' partials of the batches ``<= through`` (and the last merge) into one per key."""
    m = load(spark, tables.root)
    if not m.batches or int(through) > max(m.batches):
        raise ValueError(f"batch {through} has not been committed (last: {max(m.batches, default=None)})")
    merged, attempt = {}, _new()
    for name, (_, partition_cols, merge) in _ROLLUPS.items():
        if m.merged.get(name, {"through": -1})["through"] < int(through):
            path = f"{name}_merged/through={int(through)}/{ATTEMPT}={attempt}"
            merged[name] = {"through": int(through), "path": _write(merge(_rollup(spark, tables, m, name, int(through))), tables, path, partition_cols)}

    def change(new: Manifest) -> Manifest | None:
        fresh = {n: x for n, x in merged.items() if new.merged.get(n, {"through": -1})["through"] < x["through"]}
        new.merged |= fresh
        return new if fresh else None

    return commit(spark, tables.root, change)


def _expired(state: DataFrame, retention_days: int, as_of) -> DataFrame:
    cutoff = days_before(as_of_literal(as_of), int(retention_days))
    return state.where((F.col("is_deleted") == 1) & (F.col("created_at") < cutoff)).select("id")


def purge(spark: SparkSession, tables: Tables, retention_days: int, as_of=None) -> Manifest:
    """Remove the events deleted and created more than ``retention_days`` ago, from every table.

    History, index, rejects, vectors and snapshot without them are written as
    a new generation, and one manifest names it: until then readers see the old one, after it
    no read finds a purged event. Rollups hold sums of insertions and stay. The old files go with
    :func:`vacuum`. Batches that are committed meanwhile stay as they are.
    """
    m = load(spark, tables.root)
    path = scratch_path(spark, "expired")
    _expired(_state(spark, tables, m, ["id", "version", "batch_id", "seq", "is_deleted", "created_at"]), retention_days, as_of).write.parquet(path)
    gone = spark.read.parquet(path)
    attempt = f"g{m.generation + 1}-{_new()}"
    k = m.through()

    def rewritten(table: str, rows: DataFrame, *partition_cols: str) -> dict[int, dict]:
        """All batches of a table in one job; the new entries by batch."""
        rows = rows.withColumn(ATTEMPT, F.lit(attempt))
        writer = rows.write.mode("append").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        writer.partitionBy("batch_id", ATTEMPT, *partition_cols).parquet(f"{tables.root}/{table}")
        counts = {r.batch_id: r["count"] for r in _read(spark, tables, table, [f"{table}/batch_id={b}/{ATTEMPT}={attempt}" for b in _left(table)], _SCHEMAS[table]).groupBy("batch_id").count().collect()}
        return {b: {"rows": counts.get(b, 0), "paths": [f"{table}/batch_id={b}/{ATTEMPT}={attempt}"] if counts.get(b) else []} for b in m.batches if table in m.batches[b]}

    files = Files(spark, tables.root)

    def _left(table: str) -> list[int]:
        return [b for b in m.batches if files.exists(f"{table}/batch_id={b}/{ATTEMPT}={attempt}")]

    at = lambda table: f"{table}/through={k}/{ATTEMPT}={attempt}"

    def write_state() -> tuple[str, str] | None:
        if k is None:
            return None
        old = _compacted(spark, tables, m.snapshot["state"], KEYED_HISTORY).join(gone, "id", "left_anti")
        state = _write(clustered(old.select(*_ROW)), tables, at("snapshots"), (MONTH_COL,), **_bloom_options(("id",), None, 0.01))
        return state, _write(file_ranges(spark, f"{tables.root}/{state}"), tables, at("snapshot_files"))

    def write_index() -> dict | None:
        if k is None:
            return None
        index = _buckets(spark, tables, m.snapshot["index"], INDEX_SCHEMA).join(gone, "id", "left_anti")
        return _bucketed(index, tables, at("index_base"), ID_BUCKET, "id", m.snapshot["index"]["rows"])

    kept = _batches(spark, tables, m, "history").join(gone, "id", "left_anti")
    rejects = _batches(spark, tables, m, "rejects")
    *rewrites, of_state, of_index = _together(
        spark,
        lambda: rewritten("history", layout(kept.select(*_ROW)), MONTH_COL),
        lambda: rewritten("index", _batches(spark, tables, m, "index").join(gone, "id", "left_anti")),
        lambda: rewritten("rejects", rejects.join(gone, rejects["event_id"] == gone["id"], "left_anti")),
        write_state, write_index,
    )
    new = dict(zip(("history", "index", "rejects"), rewrites, strict=True))
    done = Manifest(**{**m.__dict__, "batches": {b: {**t, **{n: e[b] for n, e in new.items() if b in e}} for b, t in m.batches.items()}})
    snapshot = None
    named = _batches(spark, tables, done, "history").select(*ARRAY_FIELDS)
    if k is not None:
        state, ranges = of_state
        snapshot = {"through": k, "state": state, "files": ranges, "index": of_index}
        named = named.unionByName(_compacted(spark, tables, state, KEYED_HISTORY).select(*ARRAY_FIELDS))
    wanted = named.select(F.explode(F.array(*ARRAY_FIELDS)).alias("vec_key")).distinct()
    new["vectors"] = rewritten("vectors", _batches(spark, tables, m, "vectors").join(wanted, "vec_key", "left_semi"))
    done.batches = {b: {**t, **({"vectors": new["vectors"][b]} if b in new["vectors"] else {})} for b, t in done.batches.items()}
    if snapshot:
        upto = Manifest(batches={b: t for b, t in done.batches.items() if b <= k})
        snapshot["vector_keys"] = _keys_of(spark, tables, upto, at("vector_keys"))

    def change(now: Manifest) -> Manifest:
        if now.generation != m.generation or now.snapshot != m.snapshot or any(now.batches.get(b) != t for b, t in m.batches.items()):
            raise RuntimeError("the store was rewritten during the purge: run it again")
        now.generation += 1
        now.batches |= done.batches
        now.snapshot = snapshot
        return now

    return commit(spark, tables.root, change)


def retire(spark: SparkSession, tables: Tables, keep_batches: int = 0) -> Manifest:
    """Stop naming the version rows and index rows that the snapshot covers (but of the newest
    ``keep_batches`` batches), and rollup partials that a merge covers. The state and all reads over it stay the same."""

    def change(new: Manifest) -> Manifest | None:
        k, before = new.through(), new.text()
        newest = sorted(new.batches)[max(len(new.batches) - keep_batches, 0):]
        for b in [b for b in new.batches if b not in newest]:
            for table in ("history", "index") if k is not None and b <= k else ():
                new.batches[b].pop(table, None)
            for name in _ROLLUPS:
                if b <= new.merged.get(name, {"through": -1})["through"]:
                    new.batches[b].pop(name, None)
        return new if new.text() != before else None

    return commit(spark, tables.root, change)


def vacuum(spark: SparkSession, tables: Tables, keep: int = 2) -> list[str]:
    """Delete the folders that only manifests older than the newest ``keep`` name, then those manifests.

    A reader that began with a kept manifest is safe, and so is a batch that is being
    written: only what a forgotten manifest names is touched. Returns the folders.
    """
    known = M.versions(spark, tables.root)
    old, kept = known[: -int(keep)], known[-int(keep):]
    files = Files(spark, tables.root)
    live = set().union(*[load(spark, tables.root, v).named() for v in kept])
    dead = sorted(set().union(*[load(spark, tables.root, v).named() for v in old]) - live)
    for path in dead:
        files.remove(path)
    for v in old:
        files.remove(M._name(v))
    return dead


# ---------------------------------------------------------------- re-drive

_LEDGER = _fields(("batch_id", _LONG), ("k1", _LONG), ("k2", _LONG), ("n", _LONG))


def redrive_rejects(spark: SparkSession, tables: Tables, inbox: str, through: int, reasons: tuple[str, ...] = (R_NOT_FOUND,)) -> int:
    """Put the messages rejected by batches ``<= through`` for ``reasons`` back on the file log, each once.

    Meant for rejects whose cause has gone, such as an update that came before
    its create. They go through the apply like new messages, in their old
    order; those that fail again are rejected again (as rejects of a new batch, which can be put back in turn).

    A run writes its messages aside and its keys to the ledger, commits that, then
    moves the files into the inbox under names of their own. A run that died in between
    is finished by the next call, and a reject in the ledger is not taken
    again. Returns the messages that this call put back.
    """
    _publish_staged(spark, tables)
    m = load(spark, tables.root)
    rejects = _batches(spark, tables, m, "rejects", None, int(through) + 1)
    rejects = rejects.where(F.col("reason").isin(*reasons) & F.col("raw").isNotNull())
    content = [F.coalesce("event_id", F.lit("")), F.coalesce("seq", F.lit(-1).cast("bigint")), F.col("raw")]
    keyed = rejects.withColumns({"k1": F.xxhash64("batch_id", *content), "k2": F.xxhash64(F.lit(3), *content, "batch_id")})
    for run in m.ledger:
        known = spark.read.schema(_LEDGER).parquet(f"{tables.root}/{run['path']}/keys")
        keyed = keyed.join(known, ["batch_id", "k1", "k2"], "left_anti")
    run = _new()
    path = f"redriven/run={run}"
    again = keyed.persist()
    try:
        n = again.count()
        if not n:
            return 0
        _write(again.groupBy("batch_id", "k1", "k2").agg(F.count(F.lit(1)).alias("n")), tables, f"{path}/keys")
        lines = again.repartition("event_id").sortWithinPartitions("event_id", "batch_id", "seq").select(F.col("raw").alias("value"))
        lines.write.mode("overwrite").text(f"{tables.root}/{path}/messages")
    finally:
        again.unpersist()

    def change(new: Manifest) -> Manifest:
        if len(new.ledger) != len(m.ledger):
            raise RuntimeError("another re-drive ran meanwhile: run it again")
        new.ledger.append({"path": path, "inbox": inbox, "staged": True, "rows": n})
        return new

    commit(spark, tables.root, change)
    _publish_staged(spark, tables)
    return n


def _publish_staged(spark: SparkSession, tables: Tables) -> None:
    """Move the message files of committed runs into their inboxes; a file that is there is not moved again."""
    runs = [r for r in load(spark, tables.root).ledger if r["staged"]]
    if not runs:
        return
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for run in runs:
        source, target = Files(spark, f"{tables.root}/{run['path']}/messages"), Files(spark, run["inbox"])
        name = run["path"].split("=")[1]
        for part in sorted(n for n in source.names("") if n.startswith("part-")):
            to = f"redrive-{name}-{part}"
            if not target.exists(to):
                jvm.org.apache.hadoop.fs.FileUtil.copy(source._fs, source._path(part), target._fs, target._path(f"_{to}"), False, True, conf)
                target.rename(f"_{to}", to)

    paths = {r["path"] for r in runs}

    def change(new: Manifest) -> Manifest:
        new.ledger = [{**r, "staged": r["staged"] and r["path"] not in paths} for r in new.ledger]
        return new

    commit(spark, tables.root, change)
    for run in runs:  # the ledger keeps keys, not messages
        Files(spark, tables.root).remove(f"{run['path']}/messages")
