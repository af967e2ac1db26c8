"""Fold properties: set-based fold == sequential model; k batches == one batch."""

from collections import Counter

from pyspark.sql import functions as F

from helpers import messages_df, model, random_log, row_key, spark_rows

from tidemark.operators.fold import fold_operations
from tidemark.operators.validate import split_messages
from tidemark.operators.versioning import latest_version, live_snapshot
from tidemark.schema import EVENT_COLS
from tidemark.session import scratch_path
from tidemark.sinks.store import read_rejects, read_versions
from tidemark.streaming.apply import Tables, apply_batch, error_rollup


def _fold(spark, rows):
    ops, bad = split_messages(messages_df(spark, rows))
    versions, not_found = fold_operations(ops)
    return versions, bad, not_found


def test_fold_matches_sequential_model(spark):
    rows = random_log(n_ids=300, n_ops=2500, seed=11)
    expected_hist, expected_rej = model(rows)
    versions, bad, not_found = _fold(spark, rows)
    assert bad.count() == 0
    got = Counter(row_key(r) for r in spark_rows(versions.select(*EVENT_COLS)))
    want = Counter(row_key(r) for r in expected_hist)
    assert got == want
    got_rej = sorted((r.event_id, r.operation, r.seq) for r in not_found.collect())
    assert got_rej == sorted((e, o, s) for e, o, s, _ in expected_rej)


def test_snapshot_matches_model_visibility(spark):
    rows = random_log(n_ids=200, n_ops=1500, seed=5)
    expected_hist, _ = model(rows)
    # model visibility: highest version, last inserted on ties
    best = {}
    for i, r in enumerate(expected_hist):
        cur = best.get(r["id"])
        if cur is None or (r["version"], i) >= (cur[0]["version"], cur[1]):
            best[r["id"]] = (r, i)
    want_live = Counter(row_key(r) for r, _ in best.values() if r["is_deleted"] == 0)
    versions, _, _ = _fold(spark, rows)
    got_live = Counter(row_key(r) for r in spark_rows(live_snapshot(versions).select(*EVENT_COLS)))
    assert got_live == want_live
    got_all = latest_version(versions).count()
    assert got_all == len(best)


def test_batch_split_equals_one_shot(spark):
    rows = random_log(n_ids=250, n_ops=1800, seed=23)
    expected_hist, expected_rej = model(rows)
    tables = Tables(scratch_path(spark, "split"))
    cuts = [0, 500, 1100, len(rows)]
    for b in range(3):
        apply_batch(spark, messages_df(spark, rows[cuts[b]:cuts[b + 1]]), b, tables)
    hist = read_versions(spark, tables)
    got = Counter(row_key(r) for r in spark_rows(hist.select(*EVENT_COLS)))
    assert got == Counter(row_key(r) for r in expected_hist)
    rej = read_rejects(spark, tables)
    assert rej.where("reason = 'not_found'").count() == len(expected_rej)


def test_replayed_batch_is_idempotent(spark):
    rows = random_log(n_ids=100, n_ops=600, seed=3)
    tables = Tables(scratch_path(spark, "replay"))
    apply_batch(spark, messages_df(spark, rows[:300]), 0, tables)
    apply_batch(spark, messages_df(spark, rows[300:]), 1, tables)
    first = sorted(map(tuple, read_versions(spark, tables).select(*EVENT_COLS, "batch_id", "seq").collect()), key=repr)
    # batch 1 runs again (e.g. failed after writing, before the checkpoint commit)
    apply_batch(spark, messages_df(spark, rows[300:]), 1, tables)
    second = sorted(map(tuple, read_versions(spark, tables).select(*EVENT_COLS, "batch_id", "seq").collect()), key=repr)
    assert first == second
    p1 = error_rollup(spark, tables).count()
    apply_batch(spark, messages_df(spark, rows[300:]), 1, tables)
    assert error_rollup(spark, tables).count() == p1


def test_sliced_path_matches_model_with_one_hot_event(spark):
    import datetime as dt
    import random

    from helpers import T0, msg

    rnd = random.Random(99)
    rows = random_log(n_ids=60, n_ops=600, seed=41)
    # one event holding about a third of all operations, incl. a delete near the end
    seq0 = len(rows)
    hot = [msg("create", "hot", seq0, T0 + dt.timedelta(seconds=seq0), conversation_id="c0", event_name="event_b")]
    for i in range(1, 320):
        s = seq0 + i
        hot.append(msg("update", "hot", s, T0 + dt.timedelta(seconds=s),
                       latency=rnd.choice([None, float(i)]), error=rnd.choice([None, "", f"e{i}"]),
                       output=rnd.choice([None, "", f"o{i}"]), input_embeddings=rnd.choice([None, [float(i)]])))
        if i == 150:
            hot.append(msg("create", "hot", s + 10_000, T0, conversation_id="c9", event_name="event_a"))
    hot.append(msg("delete", "hot", seq0 + 400, T0 + dt.timedelta(seconds=seq0 + 400), data=None))
    hot.append(msg("update", "hot", seq0 + 401, T0 + dt.timedelta(seconds=seq0 + 401), latency=1.0))
    rows = sorted(rows + hot, key=lambda r: r[4])
    expected_hist, expected_rej = model(rows)
    ops, bad = split_messages(messages_df(spark, rows))
    versions, not_found = fold_operations(ops, slices=40, step=10)
    got = Counter(row_key(r) for r in spark_rows(versions.select(*EVENT_COLS)))
    assert got == Counter(row_key(r) for r in expected_hist)
    assert sorted((r.event_id, r.seq) for r in not_found.collect()) == sorted((e, s) for e, _, s, _ in expected_rej)


def test_sliced_path_with_base_matches_one_shot(spark):
    rows = random_log(n_ids=8, n_ops=900, seed=77)  # ~110 operations per event: all hot below
    expected_hist, _ = model(rows)
    tables = Tables(scratch_path(spark, "hot-split"))
    for b, (lo, hi) in enumerate([(0, 300), (300, 650), (650, len(rows))]):
        apply_batch(spark, messages_df(spark, rows[lo:hi]), b, tables, slices=100, step=4)
    hist = read_versions(spark, tables)
    got = Counter(row_key(r) for r in spark_rows(hist.select(*EVENT_COLS)))
    assert got == Counter(row_key(r) for r in expected_hist)


def test_compacted_state_equals_history_snapshot(spark):
    from tidemark.plans import queries as Q
    from tidemark.streaming.apply import compact_tables, current_state

    rows = random_log(n_ids=120, n_ops=700, seed=5)
    tables = Tables(scratch_path(spark, "compact-state"))
    for b, (lo, hi) in enumerate([(0, 300), (300, 500), (500, len(rows))]):
        apply_batch(spark, messages_df(spark, rows[lo:hi]), b, tables)
        if b == 1:
            compact_tables(spark, tables, through=1)
    hist = read_versions(spark, tables)
    state = current_state(spark, tables, vectors=True)
    assert state.count() == latest_version(hist).count()
    want = sorted(map(tuple, live_snapshot(hist).select(*EVENT_COLS).collect()), key=repr)
    got = sorted(map(tuple, state.where("is_deleted = 0").select(*EVENT_COLS).collect()), key=repr)
    assert got == want
    a = sorted(map(tuple, Q.get_top_error_sessions(hist, 50).collect()))
    b = sorted(map(tuple, Q.get_top_error_sessions(state, 50, deduped=True).collect()))
    assert a == b


def test_slices_follow_ranks_not_values(spark):
    """One far outlier in seq must not put all other rows into one slice."""
    import datetime as dt

    from helpers import T0, msg

    rows = [msg("create", "hot", 0, T0, conversation_id="c0", event_name="event_b")]
    rows += [msg("update", "hot", 1000 * i if i < 299 else 10**12, T0 + dt.timedelta(seconds=i), latency=float(i) if i % 3 else None) for i in range(1, 300)]
    expected_hist, _ = model(rows)
    ops, _ = split_messages(messages_df(spark, rows))
    versions, _ = fold_operations(ops, slices=60, step=5)
    got = Counter(row_key(r) for r in spark_rows(versions.select(*EVENT_COLS)))
    assert got == Counter(row_key(r) for r in expected_hist)


def test_many_events_are_cut(spark):
    rows = random_log(n_ids=40, n_ops=600, seed=13)
    expected_hist, _ = model(rows)
    ops, _ = split_messages(messages_df(spark, rows))
    versions, _ = fold_operations(ops, slices=400, step=2)
    assert Counter(row_key(r) for r in spark_rows(versions.select(*EVENT_COLS))) == Counter(row_key(r) for r in expected_hist)


def test_slices_agree_on_equal_seq(spark):
    """Operations of one event that share a seq, and exact copies, are ordered alike at every size."""
    import datetime as dt
    import random

    from helpers import T0, msg

    rows = [
        msg("create", "again", 0, T0, conversation_id="c0", event_name="event_a"),
        msg("delete", "again", 1, T0 + dt.timedelta(seconds=1), data=None),
        msg("update", "again", 1, T0 + dt.timedelta(seconds=2), latency=1.0),
        msg("update", "early", 5, T0, latency=1.0),
        msg("create", "early", 5, T0 + dt.timedelta(seconds=1), conversation_id="c0", event_name="event_a"),
    ]
    rnd = random.Random(41)
    for i in range(900):
        ts = T0 + dt.timedelta(seconds=rnd.randrange(4))
        eid, seq = f"e{rnd.randrange(60)}", rnd.randrange(6)
        kind = rnd.choice(("create", "update", "update", "delete"))
        if kind == "create":
            rows.append(msg(kind, eid, seq, ts, conversation_id=f"c{i % 3}", event_name="event_b", latency=float(i)))
        elif kind == "update":
            rows.append(msg(kind, eid, seq, ts, latency=rnd.choice([None, float(i)]), output=rnd.choice([None, f"o{i}"])))
        else:
            rows += [msg(kind, eid, seq, ts, data=None)] * rnd.choice((1, 2))
    rows += [msg("update", "one", 7, T0 + dt.timedelta(seconds=i), latency=float(i)) for i in range(1, 60)]
    rows.append(msg("create", "one", 7, T0, conversation_id="c0", event_name="event_a"))
    ops, _ = split_messages(messages_df(spark, rows))
    ops = ops.repartition(5)

    def folded(step):
        versions, not_found = fold_operations(ops, slices=2000 // step, step=step)
        got = Counter((*row_key(r), r["seq"], r["shadowed"]) for r in spark_rows(versions))
        return got, Counter((r.event_id, r.operation, r.seq, r.raw) for r in not_found.collect())

    assert folded(1) == folded(3) == folded(1000)
    versions, not_found = fold_operations(ops, slices=1000, step=2)
    assert {r.id for r in live_snapshot(versions).collect()}.isdisjoint({"again"})
    assert {(r.event_id, r.seq) for r in not_found.collect()} >= {("again", 1), ("early", 5)}


def test_shrinking_replay_leaves_nothing_behind(spark):
    from tidemark.operators.rollups import error_partial

    rows = random_log(n_ids=60, n_ops=400, seed=31)
    tables = Tables(scratch_path(spark, "shrink"))
    apply_batch(spark, messages_df(spark, rows[:200]), 0, tables)
    apply_batch(spark, messages_df(spark, rows[200:]), 1, tables)
    apply_batch(spark, messages_df(spark, rows[200:210]), 1, tables)
    want, _ = model(rows[:210])
    hist = read_versions(spark, tables)
    assert Counter(row_key(r) for r in spark_rows(hist.select(*EVENT_COLS))) == Counter(row_key(r) for r in want)
    apply_batch(spark, messages_df(spark, rows[:1]).limit(0), 1, tables)
    hist = read_versions(spark, tables)
    assert hist.where("batch_id = 1").count() == 0 and hist.count() == len(model(rows[:200])[0])
    assert error_partial(hist).count() >= 1


def test_uncommitted_batches_are_not_seen(spark):
    """Of a plain history table (an apply job's tables: test_store)."""
    from tidemark.sinks.table import last_committed, read_history, write_history, write_purged, write_snapshot

    rows = random_log(n_ids=30, n_ops=120, seed=8)
    path, purged = scratch_path(spark, "commit"), scratch_path(spark, "commit-purged")
    versions = _fold(spark, rows)[0]
    write_history(versions, path, 0)
    n = read_history(spark, path).count()
    write_purged(spark, path, purged, 10_000)
    jvm = spark.sparkContext._jvm
    for table in (path, purged):
        write_history(versions, table, 1)
        marker = jvm.org.apache.hadoop.fs.Path(f"{table}/batch_id=1/_SUCCESS")
        marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(marker, False)
        assert last_committed(spark, table) == 0
        assert read_history(spark, table).count() == n
        try:
            write_snapshot(spark, table, f"{table}-snapshots", through=1)
            raise AssertionError("an uncommitted batch was compacted")
        except ValueError:
            pass


def test_lookup_after_compaction_and_merged_rollups(spark):
    from tidemark.operators.rollups import read_error_rollup, read_latency_rollup
    from tidemark.streaming.apply import compact_rollups, compact_tables, latency_rollup

    rows = random_log(n_ids=90, n_ops=700, seed=19)
    expected_hist, _ = model(rows)
    tables, plain = Tables(scratch_path(spark, "compacted")), Tables(scratch_path(spark, "plain"))
    for b, (lo, hi) in enumerate([(0, 250), (250, 500), (500, len(rows))]):
        for t in (tables, plain):
            apply_batch(spark, messages_df(spark, rows[lo:hi]), b, t)
        if b < 2:  # the next batch looks its events up in the snapshot
            compact_tables(spark, tables, through=b)
            compact_rollups(spark, tables, through=b)
    hist = read_versions(spark, tables)
    assert Counter(row_key(r) for r in spark_rows(hist.select(*EVENT_COLS))) == Counter(row_key(r) for r in expected_hist)
    for read, rollup in ((read_error_rollup, error_rollup), (read_latency_rollup, latency_rollup)):
        got, want = (sorted(map(tuple, read(rollup(spark, t)).collect())) for t in (tables, plain))
        assert got == want


def test_rejects_are_driven_again(spark):
    from tidemark.schema import R_NOT_FOUND
    from tidemark.sources.changelog import read_json_lines
    from tidemark.streaming.apply import redrive_rejects

    rows = random_log(n_ids=20, n_ops=200, seed=2)
    updates = [r for r in rows if r[0] == "update"][:15]
    tables = Tables(scratch_path(spark, "redrive"))
    inbox = scratch_path(spark, "redrive-inbox")
    apply_batch(spark, messages_df(spark, updates), 0, tables)
    rej = read_rejects(spark, tables)
    n = rej.where(F.col("reason") == R_NOT_FOUND).count()
    assert n > 0
    redrive_rejects(spark, tables, inbox, through=0)
    creates = [r for r in rows if r[0] == "create"]
    apply_batch(spark, messages_df(spark, creates), 1, tables)
    known = read_versions(spark, tables).select("id").distinct()
    apply_batch(spark, read_json_lines(spark, inbox), 2, tables)
    again = read_json_lines(spark, inbox)
    assert again.count() == n
    assert sorted(r.seq for r in again.collect()) == sorted(r.seq for r in rej.where(F.col("reason") == R_NOT_FOUND).collect())
    assert redrive_rejects(spark, tables, inbox, through=0) == 0 and read_json_lines(spark, inbox).count() == n
    applied = read_versions(spark, tables).where("batch_id = 2").count()
    assert applied == again.join(known, again["event_id"] == known["id"], "left_semi").count()
