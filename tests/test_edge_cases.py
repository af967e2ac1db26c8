"""Hand-built edge cases of the change semantics (one per rule)."""

import datetime as dt

import pytest
from helpers import UTC, messages_df, msg

from tidemark.operators.fold import fold_operations
from tidemark.operators.validate import split_messages
from tidemark.operators.versioning import SORT_KEY, latest_version, live_snapshot
from tidemark.sources.changelog import decode_json


def fold(spark, rows):
    ops, bad = split_messages(messages_df(spark, rows))
    versions, nf = fold_operations(ops)
    return versions, bad.unionByName(nf)


def create(eid="e1", seq=0, **kw):
    base = dict(conversation_id="c1", event_name="event_a")
    base.update(kw)
    return msg("create", eid, seq, **base)


def live_one(spark, rows):
    v, _ = fold(spark, rows)
    out = live_snapshot(v).collect()
    return out[0] if out else None


def test_e1_empty_error_clears(spark):
    r = live_one(spark, [create(error="timeout"), msg("update", "e1", 1, error="")])
    assert r.error == "" and r.version == 2


def test_e2_empty_output_is_ignored(spark):
    r = live_one(spark, [create(output="keep"), msg("update", "e1", 1, output="")])
    assert r.output == "keep" and r.version == 2


def test_e3_zero_latency_applies(spark):
    r = live_one(spark, [create(latency=12.5), msg("update", "e1", 1, latency=0.0)])
    assert r.latency == 0.0


def test_e4_empty_patch_bumps_version(spark):
    r = live_one(spark, [create(latency=3.0), msg("update", "e1", 1)])
    assert r.version == 2 and r.latency == 3.0


def test_e5_empty_array_clears_raw_message(spark):
    r = live_one(spark, [create(input_embeddings=[1.0, 2.0]), msg("update", "e1", 1, input_embeddings=[])])
    assert list(r.input_embeddings) == []
    r = live_one(spark, [create(input_embeddings=[1.0, 2.0]), msg("update", "e1", 1)])
    assert list(r.input_embeddings) == [1.0, 2.0]


def test_e6_e7_not_found(spark):
    v, rej = fold(spark, [msg("update", "nope", 0, error="x"), msg("delete", "nope2", 1, data=None),
                          create("e1", 2), msg("delete", "e1", 3, data=None),
                          msg("update", "e1", 4, error="x"), msg("delete", "e1", 5, data=None)])
    reasons = sorted((r.event_id, r.reason) for r in rej.collect())
    assert reasons == [("e1", "not_found"), ("e1", "not_found"), ("nope", "not_found"), ("nope2", "not_found")]
    assert v.count() == 2


def test_e8_create_after_delete_stays_deleted(spark):
    v, _ = fold(spark, [create(), msg("delete", "e1", 1, data=None), create(seq=2, error="new")])
    assert live_snapshot(v).count() == 0
    assert latest_version(v).collect()[0].is_deleted == 1


def test_e9_replayed_create_no_visible_change(spark):
    rows = [create(latency=1.0), msg("update", "e1", 1, latency=2.0), create(seq=2, latency=1.0)]
    r = live_one(spark, rows)
    assert r.latency == 2.0 and r.version == 2


def test_e10_second_create_before_update_wins(spark):
    r = live_one(spark, [create(latency=1.0), create(seq=1, latency=9.0, conversation_id="c2")])
    assert r.latency == 9.0 and r.conversation_id == "c2" and r.version == 1


def test_e11_missing_payload(spark):
    _, rej = fold(spark, [msg("create", "e1", 0, data=None), create("e2"), msg("update", "e2", 1, data=None)])
    assert sorted(r.reason for r in rej.collect()) == ["missing_payload", "missing_payload"]


def test_e12_malformed_json_and_wrong_type(spark):
    lines = [
        '{"operation":"create","event_id":"a","timestamp":"2024-01-01T00:00:00Z","data":{"conversation_id":"c","event_name":"event_a"',
        '{"operation":"create","event_id":"b","timestamp":"2024-01-01T00:00:00Z","data":{"conversation_id":"c","event_name":"event_a","latency":"slow"}}',
        '{"operation":"create","event_id":"c","timestamp":"2024-01-01T00:00:00Z","data":{"conversation_id":"c","event_name":"event_a"}}',
    ]
    df = decode_json(spark.createDataFrame([(x,) for x in lines], "value string"))
    ops, bad = split_messages(df)
    assert sorted(r.reason for r in bad.collect()) == ["malformed", "malformed"]
    assert [r.id for r in ops.collect()] == ["c"]


def test_e13_unknown_operation_is_case_sensitive(spark):
    _, rej = fold(spark, [msg("Create", "e1", 0, conversation_id="c", event_name="event_a"), msg("upsert", "e2", 1)])
    assert sorted(r.reason for r in rej.collect()) == ["unknown_operation", "unknown_operation"]


def test_e14_bad_event_name_does_not_bump(spark):
    v, rej = fold(spark, [create(event_name="event_x"), create("e2"), msg("update", "e2", 1, event_name="event_q")])
    assert sorted(r.reason for r in rej.collect()) == ["bad_event_name", "bad_event_name"]
    assert latest_version(v).collect()[0].version == 1


def test_e15_empty_conversation_id(spark):
    _, rej = fold(spark, [create(conversation_id="")])
    assert [r.reason for r in rej.collect()] == ["missing_conversation_id"]


def test_e16_rename_key_choice(spark):
    rows = [create(), msg("update", "e1", 1, event_name="event_b")]
    v, _ = fold(spark, rows)
    assert live_snapshot(v).count() == 1
    assert live_snapshot(v, keys=SORT_KEY).count() == 2


def test_e17_create_defaults(spark):
    r = live_one(spark, [create()])
    assert (r.error, r.latency, r.input, r.output, r.conversation_metadata) == ("", 0.0, "", "", "")
    assert list(r.input_embeddings) == [] and list(r.output_embeddings) == []


def test_e18_timestamps_to_utc_millis(spark):
    lines = [
        '{"operation":"create","event_id":"a","timestamp":"2024-01-01T10:00:00.123456789Z","data":{"conversation_id":"c","event_name":"event_a"}}',
        '{"operation":"create","event_id":"b","timestamp":"2024-01-01T10:00:00.987+05:30","data":{"conversation_id":"c","event_name":"event_a"}}',
    ]
    df = decode_json(spark.createDataFrame([(x,) for x in lines], "value string"))
    ops, _ = split_messages(df)
    got = {r.id: r.ts for r in ops.collect()}
    assert got["a"] == dt.datetime(2024, 1, 1, 10, 0, 0, 123000)
    assert got["b"] == dt.datetime(2024, 1, 1, 4, 30, 0, 987000)


def test_e22_repeated_fold_is_deterministic(spark):
    rows = [create(), msg("update", "e1", 1, latency=4.0), create("e2", 2), msg("delete", "e2", 3, data=None)]
    a, _ = fold(spark, rows)
    b, _ = fold(spark, rows)
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_base_tombstone_rejects_later_mutations(spark):
    from tidemark.operators.fold import base_from_history

    v0, _ = fold(spark, [create(), msg("delete", "e1", 1, data=None)])
    ops, _ = split_messages(messages_df(spark, [msg("update", "e1", 0, error="x"), create(seq=1)]), batch_id=1)
    base = base_from_history(v0, ops.select("id"))
    v1, nf = fold_operations(ops, base)
    assert [r.reason for r in nf.collect()] == ["not_found"]
    both = v0.unionByName(v1)
    assert live_snapshot(both).count() == 0


def test_base_live_v1_is_replaced_by_new_create(spark):
    from tidemark.operators.fold import base_from_history

    v0, _ = fold(spark, [create(latency=1.0)])
    ops, _ = split_messages(messages_df(spark, [create(seq=0, latency=5.0), msg("update", "e1", 1, error="e")]), batch_id=1)
    v1, _ = fold_operations(ops, base_from_history(v0, ops.select("id")))
    r = live_snapshot(v0.unionByName(v1)).collect()[0]
    assert (r.latency, r.error, r.version) == (5.0, "e", 2)


def test_base_updated_then_update_continues_versions(spark):
    from tidemark.operators.fold import base_from_history

    v0, _ = fold(spark, [create(latency=1.0), msg("update", "e1", 1, latency=2.0)])
    ops, _ = split_messages(messages_df(spark, [msg("update", "e1", 0, error="z"), create(seq=1, latency=9.0)]), batch_id=1)
    v1, _ = fold_operations(ops, base_from_history(v0, ops.select("id")))
    r = live_snapshot(v0.unionByName(v1)).collect()[0]
    assert (r.latency, r.error, r.version) == (2.0, "z", 3)
    created = {x.version: x.created_at for x in v0.unionByName(v1).collect()}
    assert created[3] == created[2]


@pytest.mark.parametrize("bad", [{"days": 0}, {"days": -1}, {"limit": 0}, {"event_name": "event_x"}, {"event_name": ""}])
def test_e19_parameters_rejected_before_planning(spark, bad):
    from tidemark.plans import queries as Q

    hist = spark.createDataFrame([], "id string")  # never executed
    with pytest.raises(ValueError):
        if "limit" in bad:
            Q.get_top_error_sessions(hist, bad["limit"])
        else:
            Q.get_error_counts(hist, bad.get("event_name", "event_a"), bad.get("days", 7), "2024-01-31 00:00:00")


def test_e20_cutoff_is_inclusive_and_e21_empty(spark):
    from tidemark.plans import queries as Q

    at = dt.datetime(2024, 1, 24, tzinfo=UTC)
    v, _ = fold(spark, [msg("create", "e1", 0, ts=at, conversation_id="c", event_name="event_a", error="x")])
    out = Q.get_error_counts(v, "event_a", 7, "2024-01-31 00:00:00").collect()
    assert [(r.date, r.error_count, r.total_count) for r in out] == [("2024-01-24", 1, 1)]
    empty = v.where("false")
    for df in (
        Q.get_error_counts(empty, "event_a", 7, "2024-01-31 00:00:00"),
        Q.get_latency_stats(empty, 10),
        Q.get_top_error_sessions(empty, 10),
        Q.get_events_by_conversation(empty, "c"),
        Q.get_event(empty, "e1"),
    ):
        assert df.count() == 0


def test_e23_ties_are_ordered(spark):
    from tidemark.plans import queries as Q

    rows = []
    for i, cid in enumerate(["c3", "c1", "c2"]):
        rows.append(msg("create", f"e{i}", i, conversation_id=cid, event_name="event_a", error="x", latency=5.0))
    v, _ = fold(spark, rows)
    assert [r.conversation_id for r in Q.get_top_error_sessions(v, 10).collect()] == ["c1", "c2", "c3"]
    assert [r.conversation_id for r in Q.get_latency_stats(v, 10).collect()] == ["c1", "c2", "c3"]
