"""Physical-plan properties that matter at scale."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.versioning import live_snapshot
from tidemark.plans import queries as Q
from tidemark.plans.registry import history
from tidemark.session import scratch_path
from tidemark.sinks.table import read_history, write_history
from tidemark.sources import adapters

from conftest import SF_SMALL


@pytest.fixture(autouse=True)
def whole_plans(spark):
    """Plans show whole paths and filters."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch_path(spark, "plans")
    write_history(history(spark, SF_SMALL), path, batch_id=0)
    write_history(adapters.history_b(spark, SF_SMALL), path, batch_id=1)
    return read_history(spark, path)


def test_dedup_limits_map_side(stored):
    p = plan(live_snapshot(stored))
    assert "WindowGroupLimit" in p


def test_aggregate_reads_skip_wide_columns(stored):
    for df in (Q.get_error_counts(stored, "event_a", 7, "2024-01-31 00:00:00"), Q.get_top_error_sessions(stored, 10),
               Q.get_latency_stats(stored, 10)):
        p = plan(df)
        for wide in ("input_embeddings", "output_embeddings", "conversation_metadata", "input#", "output#"):
            assert wide not in p.split("ReadSchema")[1] if "ReadSchema" in p else True
        scans = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
        assert scans and all("embeddings" not in s for s in scans)


def test_topk_is_take_ordered(stored):
    for df in (Q.get_top_error_sessions(stored, 10), Q.get_latency_stats(stored, 10, method="percentile")):
        assert "TakeOrderedAndProject" in plan(df)


def test_id_lookup_is_pushed_to_scan(stored):
    p = plan(Q.get_event(stored, "5"))
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,5)]" in p


def test_error_counts_prune_months(stored):
    p = plan(Q.get_error_counts(stored, "event_a", 7, "2024-01-31 00:00:00"))
    assert "PartitionFilters: [isnotnull(created_month" in p


def test_session_lookup_filters_scan(stored):
    p = plan(Q.get_events_by_conversation(stored, "conv_5"))
    assert "EqualTo(conversation_id,conv_5)" in p


def test_fold_has_one_exchange(spark):
    from tidemark.operators.fold import fold_operations
    from tidemark.operators.validate import split_messages

    ops, _ = split_messages(adapters.changelog_a(spark, SF_SMALL))
    versions, _ = fold_operations(ops)
    p = versions._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange hashpartitioning(id") == 1
    assert "Exchange" not in p.replace("Exchange hashpartitioning(id", "")
    assert p.count("Sort [") == 1


def test_state_reads_pass_snapshot_rows_map_side(spark):
    from tidemark.sinks.table import read_state, write_snapshot

    root = scratch_path(spark, "state-plan")
    v = history(spark, SF_SMALL)
    write_history(v.where("version = 1"), f"{root}/h", batch_id=0)
    write_history(v.where("version > 1"), f"{root}/h", batch_id=1)
    write_snapshot(spark, f"{root}/h", f"{root}/s", through=0)
    df = Q.get_top_error_sessions(read_state(spark, f"{root}/h", f"{root}/s"), 10, deduped=True)
    df.collect()
    p = plan(df)
    assert "LeftAnti" in p and "BroadcastHashJoin" in p


def test_lookup_searches_on_narrow_columns(spark, stored):
    from tidemark.operators.fold import base_from_history

    ids = spark.createDataFrame([("5",), ("7",)], "id string")
    base = base_from_history(stored, ids)
    assert sorted(r.id for r in base.collect()) == ["5", "7"]
    scans = [x for x in plan(base).splitlines() if "FileScan" in x]
    wide = [x for x in scans if "input_embeddings" in x]
    assert 0 < len(wide) <= len(scans) / 2  # the winners' search reads narrow columns only


def test_state_reads_filter_the_snapshot_with_newer_batches(spark):
    """Month and session filters are on every snapshot scan, and no dedup lies above one."""
    from tidemark.sinks.table import read_state, write_snapshot

    root = scratch_path(spark, "state-months")
    write_history(history(spark, SF_SMALL), f"{root}/h", batch_id=0)
    write_history(adapters.history_b(spark, SF_SMALL), f"{root}/h", batch_id=1)
    write_snapshot(spark, f"{root}/h", f"{root}/s", through=1)
    update = history(spark, SF_SMALL).where("id in ('3', '4')").withColumn("version", F.lit(9).cast("bigint"))
    write_history(update, f"{root}/h", batch_id=2)
    state = read_state(spark, f"{root}/h", f"{root}/s")
    df = Q.get_error_counts(state, "event_a", 7, "2024-01-31 00:00:00", deduped=True)
    assert df.count() == 7
    scans = [x for x in plan(df).splitlines() if "FileScan" in x and "/s/through=1" in x]
    assert scans and all("created_month" in x.split("PartitionFilters: [")[1].split("]")[0] for x in scans)
    df = Q.get_events_by_conversation(state, "conv_5", deduped=True)
    df.collect()
    scans = [x for x in plan(df).splitlines() if "FileScan" in x and "/s/through=1" in x]
    assert scans and all("EqualTo(conversation_id,conv_5)" in x for x in scans)


def test_incremental_snapshot_equals_one_from_scratch(spark):
    from tidemark.sinks.table import read_snapshot, write_snapshot

    root = scratch_path(spark, "snapshots")
    versions = history(spark, SF_SMALL)
    write_history(versions.where("version = 1"), f"{root}/h", batch_id=0)
    write_history(versions.where("version > 1"), f"{root}/h", batch_id=1)
    write_snapshot(spark, f"{root}/h", f"{root}/a", through=0)
    for s in ("a", "b"):
        write_snapshot(spark, f"{root}/h", f"{root}/{s}", through=1)
    rows = [sorted(map(str, read_snapshot(spark, f"{root}/{s}", 1).drop("batch_id").collect())) for s in ("a", "b")]
    assert rows[0] == rows[1] and len(rows[0]) > 0


def test_session_lookup_reads_wide_rows_of_the_session_only(stored):
    p = plan(Q.get_events_by_conversation(stored, "conv_5"))
    wide = [x for x in p.splitlines() if "FileScan" in x and "input_embeddings" in x]
    assert wide and all("EqualTo(conversation_id,conv_5)" in x for x in wide)
