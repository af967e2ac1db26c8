"""Named queries over the driver tables, each with an equivalent DuckDB SQL.

Every Spark query reads the driver's parquet tables through the adapters in
:mod:`tidemark.sources.adapters`, runs the engine path (change log ->
validation -> fold -> reads), and returns a lazy DataFrame. The SQL next to
it computes the expected result independently, straight from the same
tables (the version rows are written out by hand there, not folded).

Fixed parameters: ``as_of = 2024-01-31 00:00:00``, ``days = 7``,
``limit = 100``; p95 and error rates are rounded to 6 decimals on both
sides (engines differ in the last bits of interpolation).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.fold import fold_operations
from tidemark.operators.quantile import exact_percentile
from tidemark.operators.rollups import (
    error_partial,
    latency_partial,
    merge_latency,
    read_error_rollup,
    read_latency_rollup,
)
from tidemark.operators.validate import split_messages
from tidemark.operators.versioning import SORT_KEY, latest_max_by, latest_version, live_snapshot
from tidemark.plans.queries import (
    get_error_counts,
    get_event,
    get_events_by_conversation,
    get_latency_stats,
    get_top_error_sessions,
)
from tidemark.schema import EVENT_COLS, MONTH_COL
from tidemark.sources import adapters
from tidemark.sources.changelog import decode_json, encode_json, with_input_order

AS_OF = "2024-01-31 00:00:00"
DAYS = 7
LIMIT = 100
EVENT_ID = "5"
SESSION = "conv_5"
MONTH = "199703"
ORDER_ID = "1"
CUSTOMER = "cust_605"
RETENTION_DAYS = 20
PAGE = 10
CURSOR = ("2024-01-15 00:00:00", "")
DAILY_AS_OF = "1997-03-20 00:00:00"
ROLLUP_DAYS, ROLLUP_AS_OF = 1500, "2001-08-02 00:00:00"
REPLAY_CUT = "1996-02-10 00:00:00"
# Largest rank error of the latency sketch that its reads may show.
RANK_ERROR = 0.02

Query = Callable[[SparkSession, str], DataFrame]


def fold_log(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded messages -> (version rows, all rejects)."""
    ops, bad = split_messages(with_input_order(messages))
    versions, not_found = fold_operations(ops)
    return versions, bad.unionByName(not_found)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter A's change log folded into version rows (with ``batch_id, seq``)."""
    return fold_log(adapters.changelog_a(spark, sf_dir))[0]


# ---------------------------------------------------------------- Spark side

def q_event_history(spark, d):
    return history(spark, d).select(*EVENT_COLS)


def q_live_snapshot(spark, d):
    return live_snapshot(history(spark, d)).select(*EVENT_COLS)


def q_snapshot_with_deleted(spark, d):
    return latest_version(history(spark, d), include_deleted=True).select(*EVENT_COLS)


def q_latest_by_sort_key(spark, d):
    versions = fold_log(adapters.changelog_a(spark, d, rename=True))[0]
    return latest_version(versions, keys=SORT_KEY, include_deleted=True).select(*EVENT_COLS)


def q_latest_max_by(spark, d):
    return latest_max_by(history(spark, d)).select(*EVENT_COLS)


def q_event_by_id(spark, d):
    return get_event(history(spark, d), EVENT_ID)


def q_conversation_events(spark, d):
    return get_events_by_conversation(history(spark, d), SESSION)


def q_error_counts_daily(spark, d):
    return get_error_counts(history(spark, d), "event_a", DAYS, AS_OF)


def q_p95_latency(spark, d):
    return get_latency_stats(history(spark, d), LIMIT).withColumn("p95_latency", F.round("p95_latency", 6))


def q_top_error_sessions(spark, d):
    return get_top_error_sessions(history(spark, d), LIMIT).withColumn("error_rate", F.round("error_rate", 6))


def q_client_roundtrip(spark, d):
    from tidemark import api

    b = adapters.events_requests(spark, d)
    creates, bad_c = api.track_events(b["create"], id_col="id")
    updates, bad_u = api.update_events(b["update"])
    deletes, bad_d = api.delete_events(b["delete"])
    empty, bad_e = api.update_events(b["empty"])
    versions = fold_log(creates.unionByName(updates).unionByName(deletes).unionByName(empty))[0]
    return live_snapshot(versions).select(*EVENT_COLS)


def q_client_rejects(spark, d):
    from tidemark import api

    b = adapters.events_requests(spark, d)
    _, bad_e = api.update_events(b["empty"])
    _, bad_n = api.track_events(b["bad_name"], id_col="id")
    return bad_e.unionByName(bad_n).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def q_compacted_snapshot(spark, d):
    from tidemark.session import scratch_path
    from tidemark.sinks.table import compact, read_history, write_history

    path = scratch_path(spark, "compacted")
    write_history(compact(history(spark, d)), path)
    return live_snapshot(read_history(spark, path)).select(*EVENT_COLS)


def q_purged_history(spark, d):
    from tidemark.sinks.table import purge_deleted

    return purge_deleted(history(spark, d), RETENTION_DAYS, AS_OF).select(*EVENT_COLS)


def q_conversation_page(spark, d):
    from tidemark.plans.queries import page_events_by_conversation

    return page_events_by_conversation(history(spark, d), SESSION, PAGE, after=CURSOR)


def _state(spark: SparkSession, d: str) -> DataFrame:
    """Adapter A stored as two batches (creates, then mutations), compacted through
    the first; returns the merged current state (one row per event)."""
    from tidemark.session import scratch_path
    from tidemark.sinks.table import read_state, write_history, write_snapshot

    root = scratch_path(spark, "state")
    versions = history(spark, d).persist()  # one fold for both batches
    first, second = _two_batches(versions)
    write_history(first, f"{root}/history", batch_id=0)
    write_history(second, f"{root}/history", batch_id=1)
    versions.unpersist()
    write_snapshot(spark, f"{root}/history", f"{root}/snapshots", through=0)
    return read_state(spark, f"{root}/history", f"{root}/snapshots")


def q_state_live_snapshot(spark, d):
    return _state(spark, d).where(F.col("is_deleted") == 0).select(*EVENT_COLS)


def q_state_error_counts(spark, d):
    return get_error_counts(_state(spark, d), "event_a", DAYS, AS_OF, deduped=True)


def q_state_p95_latency(spark, d):
    out = get_latency_stats(_state(spark, d), LIMIT, deduped=True)
    return out.withColumn("p95_latency", F.round("p95_latency", 6))


def q_state_top_error_sessions(spark, d):
    out = get_top_error_sessions(_state(spark, d), LIMIT, deduped=True)
    return out.withColumn("error_rate", F.round("error_rate", 6))


def q_state_conversation_events(spark, d):
    return get_events_by_conversation(_state(spark, d), SESSION, deduped=True)


def _two_batches(versions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The version rows as two insert batches: creates, then mutations."""
    return versions.where(F.col("version") == 1), versions.where(F.col("version") > 1)


def q_rollup_error_counts(spark, d):
    first, second = _two_batches(history(spark, d))
    return read_error_rollup(error_partial(first).unionByName(error_partial(second)))


def q_rollup_event_counts(spark, d):
    first, second = _two_batches(history(spark, d))
    merged = merge_latency(latency_partial(first).unionByName(latency_partial(second)))
    return merged.select("conversation_id", "event_name", "event_count")


def q_rollup_p95(spark, d):
    first, second = _two_batches(history(spark, d))
    out = read_latency_rollup(latency_partial(first).unionByName(latency_partial(second)))
    return out.withColumn("p95_latency", F.round("p95_latency", 6))


def q_changelog_roundtrip(spark, d):
    wire = encode_json(adapters.changelog_a(spark, d))
    back = decode_json(wire)
    return back.select(
        "operation",
        "event_id",
        F.col("timestamp").cast("timestamp_ntz").alias("msg_time"),
        "seq",
        F.col("data.conversation_id").alias("d_conversation_id"),
        F.col("data.conversation_metadata").alias("d_conversation_metadata"),
        F.col("data.event_name").alias("d_event_name"),
        F.col("data.error").alias("d_error"),
        F.col("data.latency").alias("d_latency"),
    )


def q_changelog_rejects(spark, d):
    msgs = decode_json(adapters.faulty_changelog_a(spark, d))
    _, rejects = fold_log(msgs)
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def q_patch_update(spark, d):
    versions = fold_log(adapters.patch_changelog_a(spark, d))[0]
    return live_snapshot(versions).select(
        "id",
        "conversation_id",
        "conversation_metadata",
        "event_name",
        "error",
        "latency",
        "input",
        F.size("input_embeddings").cast("bigint").alias("n_input_embeddings"),
        "output",
        F.size("output_embeddings").cast("bigint").alias("n_output_embeddings"),
        "version",
    )


def q_conversation_turns(spark, d):
    versions = fold_log(adapters.changelog_c(spark, d))[0]
    return live_snapshot(versions).select(*EVENT_COLS)


def _table_b(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.session import scratch_path
    from tidemark.sinks.table import read_history, write_history

    path = scratch_path(spark, "orders-history")
    write_history(adapters.history_b(spark, d), path, batch_id=0)
    return read_history(spark, path)


def q_table_daily_error_counts(spark, d):
    """Q-3 over adapter B stored with daily partitions (OPT-4): 7 days before 1997-03-20."""
    from tidemark.session import scratch_path
    from tidemark.sinks.table import read_history, write_history

    path = scratch_path(spark, "orders-daily")
    # ~2,400 day folders holding a few rows each: spread the files over all cores
    parts = spark.sparkContext.defaultParallelism
    write_history(adapters.history_b(spark, d), path, batch_id=0, daily=True, partitions=parts)
    return get_error_counts(read_history(spark, path, daily=True), "event_b", DAYS, DAILY_AS_OF)


def q_table_month_scan(spark, d):
    return _table_b(spark, d).where(F.col(MONTH_COL) == MONTH).select(*EVENT_COLS)


def q_table_id_lookup(spark, d):
    return get_event(_table_b(spark, d), ORDER_ID)


def q_table_session_lookup(spark, d):
    return get_events_by_conversation(_table_b(spark, d), CUSTOMER)


def _streamed(spark: SparkSession, d: str) -> str:
    """Write adapter A's log as JSON files and run the streaming apply over them.

    Creates are written first, then updates and deletes, and a micro-batch
    takes two files, so folds meet their base rows across batches.
    """
    from tidemark.session import scratch_path
    from tidemark.streaming.apply import Tables, start_apply
    from tidemark.sources.changelog import stream_json_lines

    root = scratch_path(spark, "stream")
    inbox = f"{root}/inbox"
    log = adapters.changelog_a(spark, d)
    for part in (log.where(F.col("operation") == "create"), log.where(F.col("operation") != "create")):
        encode_json(part).select("value").write.mode("append").text(inbox)
    tables = Tables(f"{root}/tables")
    q = start_apply(
        stream_json_lines(spark, inbox, max_files_per_trigger=2),
        tables,
        checkpoint=f"{root}/checkpoint",
        available_now=True,
    )
    q.awaitTermination()
    return tables.root


def q_stream_apply(spark, d):
    from tidemark.sinks.store import Tables, read_versions

    return live_snapshot(read_versions(spark, Tables(_streamed(spark, d)))).select(*EVENT_COLS)


def q_stream_rollup(spark, d):
    from tidemark.streaming.apply import Tables, compact_rollups, error_rollup

    tables = Tables(_streamed(spark, d))
    compact_rollups(spark, tables, through=0)
    return read_error_rollup(error_rollup(spark, tables))


def q_rollup_error_window(spark, d):
    """One event type's last days from the stored, month-partitioned error rollup (adapter B)."""
    from tidemark.operators.rollups import with_month
    from tidemark.session import scratch_path
    from tidemark.sinks.table import read_error_partials, write_batch_table

    path = scratch_path(spark, "rollup-window")
    write_batch_table(with_month(error_partial(adapters.history_b(spark, d))), path, 0, ("event_month",))
    return read_error_rollup(read_error_partials(spark, path), "event_b", ROLLUP_DAYS, ROLLUP_AS_OF)


def q_rollup_p95_rank_error(spark, d):
    """For each event type: is the sketch's p95 within ``RANK_ERROR`` of rank 0.95 among its live versions?"""
    live = history(spark, d).where(F.col("is_deleted") == 0).withColumn("conversation_id", F.lit("all"))
    first, second = _two_batches(live)
    read = read_latency_rollup(latency_partial(first).unionByName(latency_partial(second)))
    read = read.select(F.col("event_name").alias("name"), F.col("p95_latency").alias("p95"))
    both = live.join(read, F.col("event_name") == F.col("name"))
    rank = F.avg((F.col("latency") <= F.col("p95")).cast("double"))
    low = F.avg((F.col("latency") < F.col("p95")).cast("double"))
    ok = (rank >= 0.95 - RANK_ERROR) & (low <= 0.95 + RANK_ERROR)
    return both.groupBy("event_name").agg(F.count(F.lit(1)).alias("n"), ok.alias("within_bound"))


def _inbox(spark: SparkSession, d: str):
    """Adapter A's log without any ``seq``, in files of very different sizes: creates, then the rest."""
    from tidemark import api
    from tidemark.session import scratch_path

    inbox = f"{scratch_path(spark, 'no-seq')}/inbox"
    log = adapters.changelog_a(spark, d).withColumn("seq", F.lit(None).cast("bigint"))
    api.publish_files(log.where(F.col("operation") == "create"), inbox)
    pad = F.col("data").withField("conversation_metadata", F.when(F.col("operation") == "update", F.rpad(F.lit("m"), 2000, "m")))
    api.publish_files(log.where(F.col("operation") != "create").withColumn("data", F.when(F.col("data").isNotNull(), pad)), inbox)
    return inbox


def q_stream_no_seq(spark, d):
    """A log without positions, drained in one micro-batch: files order it."""
    from tidemark.sinks.store import read_versions
    from tidemark.sources.changelog import stream_json_lines
    from tidemark.streaming.apply import Tables, start_apply

    inbox = _inbox(spark, d)
    tables = Tables(inbox.replace("/inbox", "/tables"))
    start_apply(stream_json_lines(spark, inbox), tables, inbox.replace("/inbox", "/checkpoint"), available_now=True).awaitTermination()
    return live_snapshot(read_versions(spark, tables)).select(*[c for c in EVENT_COLS if c != "conversation_metadata"])


def q_offset_order(spark, d):
    """The log's offset decides, whatever ``seq`` the messages carry."""
    log = adapters.changelog_a(spark, d)
    # the message's seq runs against the offset
    wire = encode_json(log.withColumn("offset", F.col("seq")).withColumn("seq", 10 - F.col("seq")), keep=("offset",))
    versions = fold_log(decode_json(wire, offset_col="offset"))[0]
    return live_snapshot(versions).select(*EVENT_COLS)


def q_hot_event_history(spark, d):
    """One event with the whole log, folded in slices."""
    ops, _ = split_messages(adapters.hot_changelog_a(spark, d))
    versions, _ = fold_operations(ops)
    return versions.select("id", "conversation_id", "event_name", "error", "latency", "version", "seq")


def q_percentile_null_group(spark, d):
    """Exact p95 with a null group that holds a third of all rows."""
    events = spark.read.parquet(f"{d}/events.parquet")
    keyed = events.select(F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("kind"), "value")
    out = exact_percentile(keyed, ["kind"], "value", 0.95, "p95", "n")
    return out.withColumn("p95", F.round("p95", 6))


def q_client_derived_ids(spark, d):
    """Every create request twice, without ids: as many events as requests, and the ids on the wire are the returned ones."""
    from tidemark import api
    from tidemark.session import scratch_path
    from tidemark.sources.changelog import read_json_lines

    requests = adapters.events_requests(spark, d)["create"].drop("id", "seq")
    messages, _ = api.track_events(requests.unionByName(requests))
    inbox = scratch_path(spark, "derived-ids")
    api.publish_files(messages, inbox)
    wire = read_json_lines(spark, inbox)
    events = live_snapshot(fold_log(wire)[0])
    ids = messages.select("event_id").distinct()
    same = ids.join(wire.select("event_id").distinct(), "event_id", "left_semi")
    counts = [x.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n") for name, x in (("requests", messages), ("events", events), ("ids on the wire", same))]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def q_replay_shrinks(spark, d):
    """A batch replayed with fewer months, then with nothing, beside an untouched batch."""
    from tidemark.session import scratch_path
    from tidemark.sinks.table import read_history, write_history

    path = scratch_path(spark, "replay")
    orders = adapters.history_b(spark, d)
    kept = orders.where(F.col("created_at") < F.lit(REPLAY_CUT).cast("timestamp_ntz"))
    steps = []
    write_history(orders.where(F.col("event_name") == "event_a"), path, batch_id=0)
    for step, rows in enumerate((orders, kept, orders.limit(0))):
        write_history(rows, path, batch_id=1)
        per = read_history(spark, path).groupBy("batch_id", MONTH_COL).agg(F.count(F.lit(1)).alias("n"))
        out = f"{path}-step{step}"
        per.withColumn("step", F.lit(step).cast("bigint")).write.parquet(out)
        steps.append(spark.read.parquet(out))
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


def q_event_not_found(spark, d):
    """A read by an id that does not exist: no row."""
    return get_event(history(spark, d), "no-such-event")


def q_replay_copies(spark, d):
    """A history in which a writer left copies, some under another batch id: one row per event and version."""
    from tidemark.sinks.table import drop_replayed

    versions = history(spark, d)
    copies = versions.withColumn("batch_id", F.col("batch_id") + F.pmod(F.col("id").cast("bigint"), F.lit(2)))
    return drop_replayed(versions.unionByName(copies)).select(*EVENT_COLS)


def q_table_error_lookup(spark, d):
    """Rows with one error text, from a table with a bloom filter on it."""
    from tidemark.session import scratch_path
    from tidemark.sinks.table import read_history, write_history

    path = scratch_path(spark, "orders-error")
    write_history(adapters.history_b(spark, d), path, batch_id=0, bloom_columns=("id", "error"))
    return read_history(spark, path).where(F.col("error") == "pending").select(*EVENT_COLS)


def q_catalog_month_counts(spark, d):
    """The history through the catalog table, registered by the bootstrap."""
    from tidemark.session import scratch_path
    from tidemark.sinks.table import ensure_tables, refresh_tables, write_history

    root = scratch_path(spark, "catalog")
    database = "tidemark_" + root.rsplit("-", 1)[1]
    ensure_tables(spark, database, root)
    write_history(adapters.history_b(spark, d), f"{root}/history", batch_id=0)
    refresh_tables(spark, database, root)
    return spark.table(f"{database}.event_history").groupBy(MONTH_COL).agg(F.count(F.lit(1)).alias("n"))


def _numbered(df: DataFrame) -> DataFrame:
    """The rows of an ordered read with the position at which it returns them."""
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    position = F.row_number().over(Window.orderBy("_place")).cast("bigint") - 1
    return placed.withColumn("position", position).drop("_place")


def q_conversation_order(spark, d):
    return _numbered(get_events_by_conversation(history(spark, d), SESSION).select("id", "created_at"))


def q_error_counts_order(spark, d):
    return _numbered(get_error_counts(history(spark, d), "event_a", DAYS, AS_OF).select("date", "error_count"))


QUERIES: dict[str, Query] = {
    "event_history": q_event_history,
    "live_snapshot": q_live_snapshot,
    "snapshot_with_deleted": q_snapshot_with_deleted,
    "latest_by_sort_key": q_latest_by_sort_key,
    "latest_max_by": q_latest_max_by,
    "event_by_id": q_event_by_id,
    "conversation_events": q_conversation_events,
    "error_counts_daily": q_error_counts_daily,
    "p95_latency": q_p95_latency,
    "top_error_sessions": q_top_error_sessions,
    "rollup_error_counts": q_rollup_error_counts,
    "rollup_event_counts": q_rollup_event_counts,
    "rollup_p95": q_rollup_p95,
    "changelog_roundtrip": q_changelog_roundtrip,
    "changelog_rejects": q_changelog_rejects,
    "patch_update": q_patch_update,
    "conversation_turns": q_conversation_turns,
    "table_month_scan": q_table_month_scan,
    "table_daily_error_counts": q_table_daily_error_counts,
    "table_id_lookup": q_table_id_lookup,
    "table_session_lookup": q_table_session_lookup,
    "stream_apply": q_stream_apply,
    "stream_rollup": q_stream_rollup,
    "client_roundtrip": q_client_roundtrip,
    "client_rejects": q_client_rejects,
    "compacted_snapshot": q_compacted_snapshot,
    "purged_history": q_purged_history,
    "conversation_page": q_conversation_page,
    "state_live_snapshot": q_state_live_snapshot,
    "state_error_counts": q_state_error_counts,
    "state_p95_latency": q_state_p95_latency,
    "state_top_error_sessions": q_state_top_error_sessions,
    "state_conversation_events": q_state_conversation_events,
    "rollup_error_window": q_rollup_error_window,
    "rollup_p95_rank_error": q_rollup_p95_rank_error,
    "stream_no_seq": q_stream_no_seq,
    "offset_order": q_offset_order,
    "hot_event_history": q_hot_event_history,
    "percentile_null_group": q_percentile_null_group,
    "client_derived_ids": q_client_derived_ids,
    "replay_shrinks": q_replay_shrinks,
    "event_not_found": q_event_not_found,
    "replay_copies": q_replay_copies,
    "table_error_lookup": q_table_error_lookup,
    "catalog_month_counts": q_catalog_month_counts,
    "conversation_order": q_conversation_order,
    "error_counts_order": q_error_counts_order,
}


# --------------------------------------------------------------- oracle side

def _name_sql(n: str) -> str:
    return f"case ({n}) % 3 when 0 then 'event_a' when 1 then 'event_b' else 'event_c' end"


_EMPTY = "cast([] as float[])"

_A_BASE = f"""base as (
  select cast(event_id as varchar) as id,
         'conv_' || cast(user_id as varchar) as conversation_id,
         coalesce(props, '') as conversation_metadata,
         {_name_sql('event_id')} as event_name,
         case when event_type = 'error' then 'internal_error' else '' end as error,
         coalesce(value, 0.0) as latency,
         event_id % 5 as k,
         event_id,
         date_trunc('millisecond', ts) as created_at
  from events)"""


def _a_history(rename: bool = False) -> str:
    v2_name = f"case when k = 0 then {_name_sql('event_id + 1')} else event_name end" if rename else "event_name"
    tail = f"'' as input, {_EMPTY} as input_embeddings, '' as output, {_EMPTY} as output_embeddings"
    return f"""history as (
  select id, conversation_id, conversation_metadata, event_name, error, latency, {tail},
         0 as is_deleted, cast(1 as bigint) as version, created_at, created_at as updated_at
  from base
  union all
  select id, conversation_id, conversation_metadata, {v2_name} as event_name,
         case when error = '' then 'timeout' else '' end as error, latency * 2 as latency, {tail},
         0 as is_deleted, cast(2 as bigint) as version, created_at, created_at + interval 1 hour as updated_at
  from base where k in (0, 1)
  union all
  select id, conversation_id, conversation_metadata, event_name, error, latency, {tail},
         1 as is_deleted, cast(2 as bigint) as version, created_at, created_at + interval 1 hour as updated_at
  from base where k in (2, 3))"""


_COLS = ", ".join(EVENT_COLS)
_PUBLIC = ", ".join(c for c in EVENT_COLS if c not in ("is_deleted", "version"))
_LATEST = """latest as (
  select * exclude (rn) from (
    select *, row_number() over (partition by id order by version desc) as rn from history) where rn = 1)"""
_WITH_A = f"with {_A_BASE},\n{_a_history()},\n{_LATEST}\n"

_ERROR_ROLLUP_SQL = (
    f"with {_A_BASE},\n{_a_history()}\n"
    "select strftime(cast(created_at as date), '%Y-%m-%d') as date, event_name,\n"
    "       cast(sum(case when error <> '' and is_deleted = 0 then 1 else 0 end) as bigint) as error_count,\n"
    "       cast(sum(case when is_deleted = 0 then 1 else 0 end) as bigint) as total_count\n"
    "from history group by 1, 2"
)

_B_ROWS = f"""select cast(o_orderkey as varchar) as id,
       'cust_' || cast(o_custkey as varchar) as conversation_id,
       o_orderpriority as conversation_metadata,
       {_name_sql('o_orderkey')} as event_name,
       case when o_orderstatus = 'P' then 'pending' else '' end as error,
       o_totalprice as latency,
       '' as input, {_EMPTY} as input_embeddings, '' as output, {_EMPTY} as output_embeddings,
       0 as is_deleted, cast(1 as bigint) as version,
       date_trunc('millisecond', o_orderdate) as created_at,
       date_trunc('millisecond', o_orderdate) as updated_at
from orders"""

_C_ROWS = f"""with u as (select conv_id, turn, text from conversations where role <> 'assistant'),
a as (select conv_id, turn - 1 as turn, text as reply from conversations where role = 'assistant'),
t as (
  select u.conv_id, u.turn, u.text, a.reply, e.embedding
  from u left join a on a.conv_id = u.conv_id and a.turn = u.turn
         left join embeddings e on e.vec_id = (u.conv_id * 8 + u.turn) % 500),
r as (
  select cast(conv_id as varchar) || '-' || cast(turn as varchar) as id,
         'conv_' || cast(conv_id as varchar) as conversation_id,
         '' as conversation_metadata,
         {_name_sql('turn')} as event_name,
         '' as error,
         cast(length(text) as double) as latency,
         text as input,
         coalesce(cast(embedding as float[]), {_EMPTY}) as input_embeddings,
         coalesce(reply, '') as output,
         {_EMPTY} as output_embeddings,
         0 as is_deleted,
         cast(case when reply is null then 1 else 2 end as bigint) as version,
         timestamp '2024-02-01 00:00:00' + to_minutes(cast(turn as bigint)) as created_at,
         timestamp '2024-02-01 00:00:00' + to_minutes(cast(turn as bigint))
           + case when reply is null then interval 0 second else interval 30 second end as updated_at
  from t)
select {_COLS} from r"""

ORACLE: dict[str, str] = {
    "event_history": f"with {_A_BASE},\n{_a_history()}\nselect {_COLS} from history",
    "live_snapshot": _WITH_A + f"select {_COLS} from latest where is_deleted = 0",
    "snapshot_with_deleted": _WITH_A + f"select {_COLS} from latest",
    "latest_by_sort_key": (
        f"with {_A_BASE},\n{_a_history(rename=True)}\n"
        f"select {_COLS} from (select *, row_number() over (partition by conversation_id, event_name, id "
        "order by version desc) as rn from history) where rn = 1"
    ),
    "latest_max_by": _WITH_A + f"select {_COLS} from latest",
    "event_by_id": _WITH_A + f"select {_PUBLIC} from latest where id = '{EVENT_ID}' and is_deleted = 0",
    "conversation_events": _WITH_A
    + f"select {_PUBLIC} from latest where conversation_id = '{SESSION}' and is_deleted = 0",
    "error_counts_daily": _WITH_A
    + "select strftime(cast(created_at as date), '%Y-%m-%d') as date, event_name,\n"
    "       count(*) filter (where error <> '') as error_count, count(*) as total_count\n"
    "from latest\n"
    f"where is_deleted = 0 and event_name = 'event_a'\n"
    f"  and created_at >= timestamp '{AS_OF}' - interval {DAYS} day\n"
    "group by 1, 2 order by 1",
    "p95_latency": _WITH_A
    + "select conversation_id, event_name, round(quantile_cont(latency, 0.95), 6) as p95_latency,\n"
    "       count(*) as event_count\n"
    "from latest where is_deleted = 0 group by 1, 2\n"
    f"order by quantile_cont(latency, 0.95) desc, conversation_id, event_name limit {LIMIT}",
    "top_error_sessions": _WITH_A
    + "select conversation_id, total_events, error_events,\n"
    "       round(cast(error_events as double) / cast(total_events as double), 6) as error_rate\n"
    "from (select conversation_id, count(*) as total_events,\n"
    "             count(*) filter (where error <> '') as error_events\n"
    "      from latest where is_deleted = 0 group by 1)\n"
    "where total_events > 0\n"
    "order by cast(error_events as double) / cast(total_events as double) desc, total_events desc,\n"
    f"         conversation_id limit {LIMIT}",
    "rollup_error_counts": _ERROR_ROLLUP_SQL,
    "rollup_event_counts": f"with {_A_BASE},\n{_a_history()}\n"
    "select conversation_id, event_name, count(*) as event_count from history where is_deleted = 0 group by 1, 2",
    "changelog_roundtrip": f"with {_A_BASE}\n"
    "select 'create' as operation, id as event_id, created_at as msg_time, cast(0 as bigint) as seq,\n"
    "       conversation_id as d_conversation_id, conversation_metadata as d_conversation_metadata,\n"
    "       event_name as d_event_name, error as d_error, latency as d_latency from base\n"
    "union all\n"
    "select 'update', id, created_at + interval 1 hour, cast(1 as bigint), null, null, null,\n"
    "       case when error = '' then 'timeout' else '' end, latency * 2 from base where k in (0, 1)\n"
    "union all\n"
    "select 'delete', id, created_at + interval 1 hour, cast(1 as bigint), null, null, null, null, null\n"
    "from base where k in (2, 3)",
    "changelog_rejects": "with e as (select event_id % 10 as r from events),\n"
    "t as (select case when r in (1, 9) then 'malformed' when r = 2 then 'unknown_operation'\n"
    "                  when r = 3 then 'missing_payload' when r in (4, 8) then 'bad_event_name'\n"
    "                  when r = 5 then 'missing_conversation_id' when r in (6, 7) then 'not_found' end as reason\n"
    "      from e)\n"
    "select reason, count(*) as n from t where reason is not null group by reason",
    "patch_update": f"with {_A_BASE}, p as (select *, event_id % 8 as r from base)\n"
    "select id,\n"
    "       case when r = 7 then conversation_id || '_moved' else conversation_id end as conversation_id,\n"
    "       conversation_metadata,\n"
    f"       case when r = 6 then {_name_sql('event_id + 1')} else event_name end as event_name,\n"
    "       case when r = 0 then '' else 'boom' end as error,\n"
    "       case when r = 2 then 0.0 else latency end as latency,\n"
    "       case when r = 5 then 'in2' else 'in' end as input,\n"
    "       cast(case when r = 4 then 0 else 2 end as bigint) as n_input_embeddings,\n"
    "       'out' as output,\n"
    "       cast(2 as bigint) as n_output_embeddings,\n"
    "       cast(2 as bigint) as version\n"
    "from p",
    "conversation_turns": _C_ROWS,
    "table_month_scan": f"select * from ({_B_ROWS}) where strftime(created_at, '%Y%m') = '{MONTH}'",
    "table_daily_error_counts": "select strftime(cast(created_at as date), '%Y-%m-%d') as date, event_name,\n"
    "       count(*) filter (where error <> '') as error_count, count(*) as total_count\n"
    f"from ({_B_ROWS}) b\n"
    f"where event_name = 'event_b' and created_at >= timestamp '{DAILY_AS_OF}' - interval {DAYS} day\n"
    "group by 1, 2 order by 1",
    "table_id_lookup": f"select {_PUBLIC} from ({_B_ROWS}) where id = '{ORDER_ID}'",
    "table_session_lookup": f"select {_PUBLIC} from ({_B_ROWS}) where conversation_id = '{CUSTOMER}'",
    "stream_apply": _WITH_A + f"select {_COLS} from latest where is_deleted = 0",
    "stream_rollup": _ERROR_ROLLUP_SQL,
    "client_roundtrip": _WITH_A + f"select {_COLS} from latest where is_deleted = 0",
    "compacted_snapshot": _WITH_A + f"select {_COLS} from latest where is_deleted = 0",
    "purged_history": _WITH_A
    + f"select {_COLS} from history where id not in (select id from latest where is_deleted = 1\n"
    f"  and created_at < timestamp '{AS_OF}' - interval {RETENTION_DAYS} day)",
    "conversation_page": _WITH_A
    + f"select {_PUBLIC} from latest where conversation_id = '{SESSION}' and is_deleted = 0\n"
    f"  and (created_at > timestamp '{CURSOR[0]}' or (created_at = timestamp '{CURSOR[0]}' and id > '{CURSOR[1]}'))\n"
    f"order by created_at, id limit {PAGE}",
    "client_rejects": "select 'empty_patch' as reason, count(*) as n from events\n"
    "union all\n"
    "select 'bad_event_name', count(*) from events",
    "rollup_p95": f"with {_A_BASE},\n{_a_history()}\n"
    "select conversation_id, event_name, round(quantile_disc(latency, 0.95), 6) as p95_latency,\n"
    "       count(*) as event_count from history where is_deleted = 0 group by 1, 2",
    "rollup_p95_rank_error": f"with {_A_BASE},\n{_a_history()}\n"
    "select event_name, count(*) as n, true as within_bound from history where is_deleted = 0 group by 1",
    "rollup_error_window": "select strftime(cast(created_at as date), '%Y-%m-%d') as date, event_name,\n"
    "       cast(sum(case when error <> '' then 1 else 0 end) as bigint) as error_count, count(*) as total_count\n"
    f"from ({_B_ROWS}) b where event_name = 'event_b'\n"
    f"  and cast(created_at as date) >= cast(timestamp '{ROLLUP_AS_OF}' - interval {ROLLUP_DAYS} day as date) group by 1, 2",
    "stream_no_seq": _WITH_A + f"select {_COLS.replace('conversation_metadata, ', '')} from latest where is_deleted = 0",
    "offset_order": _WITH_A + f"select {_COLS} from latest where is_deleted = 0",
    "hot_event_history": "with b as (\n"
    "  select event_id, event_id * 1000 as seq, case when event_id % 3 = 0 then coalesce(value, 0.0) end as latency,\n"
    "         case when event_id % 7 = 0 then case when event_type = 'error' then 'internal_error' else '' end end as error\n"
    "  from events union all select null, cast(1e15 as bigint), -1.0, null)\n"
    "select 'hot' as id, 'conv_hot' as conversation_id, 'event_a' as event_name,\n"
    "       last_value(error ignore nulls) over w as error, last_value(latency ignore nulls) over w as latency,\n"
    "       row_number() over w as version, seq\n"
    "from b window w as (order by seq rows between unbounded preceding and current row)",
    "percentile_null_group": "select case when event_id % 3 <> 0 then event_type end as kind,\n"
    "       round(quantile_cont(value, 0.95), 6) as p95, count(value) as n\n"
    "from events where value is not null group by 1",
    "client_derived_ids": "select unnest(['requests', 'events', 'ids on the wire']) as what, (select 2 * count(*) from events) as n",
    "replay_shrinks": f"with b as ({_B_ROWS}), s as (\n"
    "  select 0 as step, 1 as batch_id, * from b union all\n"
    f"  select 1, 1, * from b where created_at < timestamp '{REPLAY_CUT}' union all\n"
    "  select unnest([0, 1, 2]), 0, * from b where event_name = 'event_a')\n"
    "select cast(step as bigint) as step, cast(batch_id as bigint) as batch_id, strftime(created_at, '%Y%m') as created_month,\n"
    "       count(*) as n from s group by all",
    "event_not_found": _WITH_A + f"select {_PUBLIC} from latest where id = 'no-such-event'",
    "replay_copies": f"with {_A_BASE},\n{_a_history()}\nselect {_COLS} from history",
    "table_error_lookup": f"select * from ({_B_ROWS}) where error = 'pending'",
    "catalog_month_counts": f"select strftime(created_at, '%Y%m') as created_month, count(*) as n from ({_B_ROWS}) group by 1",
    "conversation_order": _WITH_A
    + f"select id, created_at, row_number() over (order by created_at, id) - 1 as position from latest\n"
    f"where conversation_id = '{SESSION}' and is_deleted = 0",
    "error_counts_order": _WITH_A
    + "select strftime(cast(created_at as date), '%Y-%m-%d') as date, count(*) filter (where error <> '') as error_count,\n"
    "       row_number() over (order by cast(created_at as date)) - 1 as position from latest\n"
    f"where is_deleted = 0 and event_name = 'event_a' and created_at >= timestamp '{AS_OF}' - interval {DAYS} day\n"
    "group by cast(created_at as date)",
}
# The state-path reads must give the same answers as the full-history reads.
_SAME_AS = {
    "state_live_snapshot": "live_snapshot",
    "state_error_counts": "error_counts_daily",
    "state_p95_latency": "p95_latency",
    "state_top_error_sessions": "top_error_sessions",
    "state_conversation_events": "conversation_events",
}
ORACLE.update({name: ORACLE[same] for name, same in _SAME_AS.items()})
