"""Sources, sinks, client builders, bootstrap and streaming restart."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tidemark import api
from tidemark.operators.versioning import live_snapshot
from tidemark.schema import EVENT_COLS
from tidemark.session import scratch_path
from tidemark.sinks.table import ensure_tables, read_history, refresh_tables, write_history
from tidemark.sources.changelog import decode_json, encode_json, stream_json_lines
from tidemark.sinks.store import read_rejects, read_versions
from tidemark.streaming.apply import Tables, progress_summary, start_apply

T = dt.datetime(2024, 3, 1, 12, 0, tzinfo=dt.timezone.utc)


def test_client_builders_and_wire_format(spark):
    creates = spark.createDataFrame(
        [("c1", "event_a", "", None, "", [], T), ("", "event_a", None, None, None, None, T),
         ("c2", "event_x", None, None, None, None, T)],
        "conversation_id string, event_name string, error string, latency double, input string, "
        "input_embeddings array<float>, timestamp timestamp",
    )
    msgs, rejects = api.track_events(creates)
    assert sorted(r.reason for r in rejects.collect()) == ["bad_event_name", "missing_conversation_id"]
    wire = [json.loads(r.value) for r in encode_json(msgs).collect()]
    assert len(wire) == 1
    data = wire[0]["data"]
    # error and latency always sent on create; empty strings and vectors left out
    assert data == {"conversation_id": "c1", "event_name": "event_a", "error": "", "latency": 0.0}
    assert wire[0]["operation"] == "create" and len(wire[0]["event_id"]) == 36
    # an id is given once, so recomputation gives the same one, and an equal request gets another
    assert msgs.collect()[0].event_id == wire[0]["event_id"] != api.track_events(creates)[0].collect()[0].event_id

    upd = spark.createDataFrame(
        [("e1", "", 0.0, "", None), ("e2", None, None, None, None), ("e3", None, None, None, "event_q")],
        "event_id string, error string, latency double, output string, event_name string",
    )
    umsgs, urej = api.update_events(upd)
    assert sorted(r.reason for r in urej.collect()) == ["bad_event_name", "empty_patch"]
    (u,) = [json.loads(r.value) for r in encode_json(umsgs).collect()]
    assert u["data"] == {"error": "", "latency": 0.0}

    dmsgs, _ = api.delete_events(spark.createDataFrame([("e1",)], "event_id string"))
    (d,) = [json.loads(r.value) for r in encode_json(dmsgs).collect()]
    assert "data" not in d and d["operation"] == "delete"


def test_publish_files_roundtrip(spark):
    path = scratch_path(spark, "inbox")
    reqs = spark.createDataFrame([("c1", "event_b", 5.0, T, "x1")],
                                 "conversation_id string, event_name string, latency double, timestamp timestamp, id string")
    msgs, _ = api.track_events(reqs, id_col="id")
    api.publish_files(msgs, path)
    back = decode_json(spark.read.text(path)).collect()
    assert [(r.operation, r.event_id, r.data.latency) for r in back] == [("create", "x1", 5.0)]


def test_bootstrap_is_idempotent(spark):
    root = scratch_path(spark, "catalog")
    ensure_tables(spark, "tidemark_test", root)
    ensure_tables(spark, "tidemark_test", root)
    hist = spark.createDataFrame(
        [("1", "c", "", "event_a", "", 1.0, "", [], "", [], 0, 1, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2))],
        "id string, conversation_id string, conversation_metadata string, event_name string, error string, "
        "latency double, input string, input_embeddings array<float>, output string, output_embeddings array<float>, "
        "is_deleted int, version bigint, created_at timestamp_ntz, updated_at timestamp_ntz",
    )
    write_history(hist, f"{root}/history", batch_id=0)
    refresh_tables(spark, "tidemark_test", root)
    assert spark.table("tidemark_test.event_history").where("created_month = '202401'").count() == 1


def test_stream_restart_continues_from_checkpoint(spark):
    root = scratch_path(spark, "restart")
    inbox, ckpt = f"{root}/inbox", f"{root}/ckpt"
    tables = Tables(f"{root}/tables")

    def drop(rows):
        df = spark.createDataFrame(rows, "value string")
        df.coalesce(1).write.mode("append").text(inbox)

    def line(op, eid, seq, **data):
        m = {"operation": op, "event_id": eid, "timestamp": "2024-01-05T00:00:00Z", "seq": seq}
        if data:
            m["data"] = data
        return (json.dumps(m),)

    drop([line("create", "a", 0, conversation_id="c", event_name="event_a", latency=1.0),
          line("create", "b", 1, conversation_id="c", event_name="event_b")])
    q = start_apply(stream_json_lines(spark, inbox), tables, ckpt, available_now=True)
    q.awaitTermination()
    assert progress_summary(q)[0]["input_rows"] == 2
    drop([line("update", "a", 2, latency=7.0), line("delete", "b", 3), line("update", "b", 4, error="x")])
    q = start_apply(stream_json_lines(spark, inbox), tables, ckpt, available_now=True)
    q.awaitTermination()
    live = {r.id: r for r in live_snapshot(read_versions(spark, tables)).collect()}
    assert set(live) == {"a"} and live["a"].latency == 7.0 and live["a"].version == 2
    rej = read_rejects(spark, tables).collect()
    assert [(r.event_id, r.reason) for r in rej] == [("b", "not_found")]
    assert read_versions(spark, tables).select(*EVENT_COLS).count() == 4
    assert sorted(r.batch_id for r in read_versions(spark, tables).select("batch_id").distinct().collect()) == [0, 1]
    assert F is not None


def test_processing_time_stream_stops_gracefully(spark):
    root = scratch_path(spark, "ptime")
    inbox, ckpt = f"{root}/inbox", f"{root}/ckpt"
    tables = Tables(f"{root}/tables")

    def drop(lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(inbox)

    msg = '{"operation":"create","event_id":"%s","timestamp":"2024-01-06T00:00:00Z","seq":0,' \
          '"data":{"conversation_id":"c","event_name":"event_c","latency":%d}}'
    drop([msg % ("x%d" % i, i) for i in range(5)])
    q = start_apply(stream_json_lines(spark, inbox, max_files_per_trigger=1), tables, ckpt,
                    processing_time="500 milliseconds", query_name="tidemark_ptime")
    try:
        q.processAllAvailable()
        drop([msg % ("y%d" % i, i) for i in range(3)])
        q.processAllAvailable()
    finally:
        q.stop()
    assert not q.isActive
    live = live_snapshot(read_versions(spark, tables))
    assert live.count() == 8
    assert sum(p["input_rows"] for p in progress_summary(q)) >= 8


def test_messages_without_seq_follow_file_order(spark):
    path = scratch_path(spark, "noseq")
    lines = [
        '{"operation":"create","event_id":"a","timestamp":"2024-01-05T00:00:00Z","data":{"conversation_id":"c","event_name":"event_a"}}',
        '{"operation":"update","event_id":"a","timestamp":"2024-01-05T00:00:01Z","data":{"latency":3.5}}',
        '{"operation":"update","event_id":"a","timestamp":"2024-01-05T00:00:02Z","data":{"latency":4.5}}',
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    from tidemark.plans.registry import fold_log

    versions, rejects = fold_log(decode_json(spark.read.text(path)))
    assert rejects.count() == 0
    (r,) = live_snapshot(versions).collect()
    assert (r.version, r.latency) == (3, 4.5)


def test_files_order_a_log_without_seq(spark):
    """Creates in a small file, then a larger file of updates: Spark packs the larger first."""
    from tidemark.plans.registry import fold_log
    from tidemark.sources.changelog import read_json_lines

    path = scratch_path(spark, "two-files")
    reqs = spark.createDataFrame([(f"e{i}", f"c{i}", "event_a", T) for i in range(200)], "id string, conversation_id string, event_name string, timestamp timestamp")
    api.publish_files(api.track_events(reqs, id_col="id")[0].coalesce(1), path)
    upd = reqs.select(F.col("id").alias("event_id"), F.rpad(F.lit("x"), 3000, "x").alias("output"), "timestamp")
    api.publish_files(api.update_events(upd)[0].coalesce(1), path)
    api.publish_files(api.delete_events(reqs.where("id = 'e7'").select(F.col("id").alias("event_id")))[0], path)
    versions, rejects = fold_log(read_json_lines(spark, path))
    assert rejects.count() == 0
    assert live_snapshot(versions).where("version = 2").count() == 199


def test_mutations_without_time_take_the_source_time(spark):
    from tidemark.plans.registry import fold_log
    from tidemark.sources.changelog import read_json_lines

    path = scratch_path(spark, "no-time")
    lines = [
        '{"operation":"create","event_id":"a","timestamp":"2024-01-05T00:00:00Z","data":{"conversation_id":"c","event_name":"event_a"}}',
        '{"operation":"delete","event_id":"a"}',
        '{"operation":"create","event_id":"b","data":{"conversation_id":"c","event_name":"event_a"}}',
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    versions, rejects = fold_log(read_json_lines(spark, path))
    assert [r.reason for r in rejects.collect()] == ["malformed"]
    assert live_snapshot(versions).count() == 0 and versions.where("is_deleted = 1 and updated_at is not null").count() == 1


def test_shared_folder_is_required_off_local(spark, monkeypatch):
    import pytest

    from tidemark import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())
