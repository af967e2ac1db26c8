"""The event store: one manifest, the id index, vectors by content, purge, retirement, re-drive."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import T0, messages_df, model, msg, random_log, row_key, spark_rows

from tidemark.operators.vectors import split_vectors, vector_key, with_vectors
from tidemark.operators.versioning import latest_version, live_snapshot
from tidemark.schema import ARRAY_FIELDS, EVENT_COLS, R_NOT_FOUND
from tidemark.session import scratch_path
from tidemark.sinks import manifest, store
from tidemark.sinks.store import Tables
from tidemark.streaming import apply as A
from tidemark.streaming.apply import apply_batch


def state_of(rows):
    """id -> the model's current row, tombstones too."""
    out = {}
    for r in model(rows)[0]:
        if r["id"] not in out or r["version"] >= out[r["id"]]["version"]:
            out[r["id"]] = r
    return Counter(row_key(r) for r in out.values())


def keys_of(df):
    return Counter(row_key(r) for r in spark_rows(df.select(*EVENT_COLS)))


@pytest.fixture(scope="module")
def stored(spark):
    """A log in four batches, the first two compacted; with the log."""
    rows = random_log(n_ids=80, n_ops=600, seed=71)
    tables = Tables(f"{scratch_path(spark, 'stored')}/t")
    cuts = [0, 200, 380, 500, len(rows)]
    for b in range(4):
        apply_batch(spark, messages_df(spark, rows[cuts[b] : cuts[b + 1]]), b, tables)
        if b == 1:
            store.compact_tables(spark, tables, 1)
    return rows, tables


def copy_of(spark, tables):
    """The store in a root of its own."""
    import shutil

    out = f"{scratch_path(spark, 'copy')}/t"
    shutil.copytree(tables.root.removeprefix("file:"), out.removeprefix("file:"))
    return Tables(out)


def test_batches_and_state_equal_the_model(spark, stored):
    rows, tables = stored
    assert keys_of(store.read_versions(spark, tables)) == Counter(row_key(r) for r in model(rows)[0])
    assert keys_of(store.current_state(spark, tables, vectors=True)) == state_of(rows)
    rejected = [(r.event_id, r.operation, r.seq, r.reason) for r in store.read_rejects(spark, tables).collect()]
    assert Counter(rejected) == Counter(tuple(x) for x in model(rows)[1])


def test_the_loser_of_a_commit_takes_up_the_winners_manifest(spark):
    root, calls = scratch_path(spark, "race"), []

    def slow(m):
        calls.append(m.version)
        if len(calls) == 1:
            manifest.commit(spark, root, lambda other: manifest.Manifest(**{**other.__dict__, "generation": 7}))
        m.ledger.append({"path": "x", "staged": False})
        return m

    done = manifest.commit(spark, root, slow)
    assert calls == [0, 1] and (done.version, done.generation, len(done.ledger)) == (2, 7, 1)
    assert manifest.versions(spark, root) == [1, 2]
    assert manifest.commit(spark, root, lambda m: None).version == 2
    assert manifest.load(spark, root, 1).ledger == []


def test_a_batch_that_dies_at_any_write_is_not_seen(spark, stored, monkeypatch):
    rows, tables = stored
    tables = copy_of(spark, tables)
    more = [msg("create", f"new{i}", 10_000 + i, T0, conversation_id="c", event_name="event_a") for i in range(20)]
    want = {name: sorted(map(repr, read(spark, tables).collect())) for name, read in READS.items()}
    write = store._write
    for table in ("history", "index", "vectors", "rollup_error", "rollup_latency", "commit"):
        def fail(df, at, path, *args, _table=table, **options):
            if path.startswith(_table):
                raise OSError("lost")
            return write(df, at, path, *args, **options)

        def lost(*_):
            raise OSError("lost")

        with monkeypatch.context() as m:
            m.setattr(store, "commit" if table == "commit" else "_write", lost if table == "commit" else fail)
            with pytest.raises(OSError):
                apply_batch(spark, messages_df(spark, more), 4, tables)
        if table in ("history", "commit"):
            assert {name: sorted(map(repr, read(spark, tables).collect())) for name, read in READS.items()} == want
    apply_batch(spark, messages_df(spark, more), 4, tables)
    assert keys_of(store.current_state(spark, tables, vectors=True)) == state_of(rows + more)


READS = {
    "versions": lambda spark, t: store.read_versions(spark, t, vectors=False),
    "state": store.current_state,
    "rejects": store.read_rejects,
    "errors": store.error_rollup,
    "latencies": lambda spark, t: store.latency_rollup(spark, t).drop("latency_sketch"),
    "vectors": store.read_vectors,
    "metrics": lambda spark, t: store.read_metrics(spark, t).drop("lag_ms"),
}


def test_readers_open_only_what_the_manifest_names(spark, stored):
    _, tables = stored
    m = manifest.load(spark, tables.root)
    for read in (store.read_versions, store.current_state, store.error_rollup, store.read_rejects):
        for path in read(spark, tables).inputFiles():
            assert any(f"/{named}/" in path for named in m.named()), path


def test_lookup_reads_touched_buckets_and_folders_only(spark, stored):
    rows, tables = stored
    m = manifest.load(spark, tables.root)
    one = spark.createDataFrame([(rows[0][1],)], "id string")
    slots = store._touched(one, "id")
    files = store.read_index(spark, tables, m, 99, slots).inputFiles()
    buckets = {f.split("id_bucket=")[1].split("/")[0] for f in files if "id_bucket=" in f}
    assert buckets <= {str(slots[0] * m.snapshot["index"]["buckets"] // store.SLOTS)}
    (r,) = store.read_index(spark, tables, m, 99).where(F.col("id") == rows[0][1]).groupBy("id").agg(F.max(F.struct("version", "batch_id", "compacted")).alias("w")).collect()
    base = store.base_rows(spark, tables, one, 99, m)
    opened = base.inputFiles()
    assert opened and base.count() == 1
    rows_in = [f for f in opened if "/history/" in f or "/snapshots/" in f]
    want = "/snapshots/" if r.w.compacted else f"/history/batch_id={r.w.batch_id}/"
    assert rows_in and all(want in f and "created_month=" in f for f in rows_in)


def test_replays_replace_a_batch_but_not_a_compacted_one(spark, stored):
    rows, tables = stored
    tables = copy_of(spark, tables)
    before = keys_of(store.read_versions(spark, tables))
    apply_batch(spark, messages_df(spark, rows[500:]), 3, tables)
    apply_batch(spark, messages_df(spark, rows[:3]), 0, tables)
    assert keys_of(store.read_versions(spark, tables)) == before
    apply_batch(spark, messages_df(spark, rows[500:540]), 3, tables)
    assert keys_of(store.current_state(spark, tables, vectors=True)) == state_of(rows[:540])


def test_each_content_is_stored_once(spark, stored):
    _, tables = stored
    vectors = store.read_vectors(spark, tables)
    assert vectors.count() == vectors.select("vec_key").distinct().count() == vectors.select("vec").distinct().count() > 0
    tables = copy_of(spark, tables)
    n = vectors.count()
    again = [msg("create", f"copy{i}", i, T0, conversation_id="c", event_name="event_a", input_embeddings=v, output_embeddings=v) for i, v in enumerate([list(r.vec) for r in vectors.collect()] + [[], None, [0.25, -1.5]])]
    apply_batch(spark, messages_df(spark, again), 4, tables)
    assert store.read_vectors(spark, tables).count() == n + 1
    back = store.read_versions(spark, tables).where("batch_id = 4").select("id", *ARRAY_FIELDS).collect()
    assert {r.id: (list(r[1]), list(r[2])) for r in back} == {x[1]: (list(x[3].input_embeddings or []),) * 2 for x in again}


def test_vector_keys(spark):
    rows = [("a", [1.0, 2.0], []), ("b", None, [1.0, 2.0]), ("c", [2.0, 1.0], [float("nan")]), ("d", [0.0], [-0.0])]
    df = spark.createDataFrame(rows, "id string, input_embeddings array<float>, output_embeddings array<float>")
    keyed, vectors = split_vectors(df)
    got = {r.id: r[1:] for r in keyed.collect()}
    assert got["a"][0] == got["b"][1] and got["a"][1] == "" and got["b"][0] is None
    assert got["c"][0] != got["a"][0] and got["d"][0] == got["d"][1] and len(got["a"][0]) == 32
    back = {r.id: r[1:] for r in with_vectors(keyed, vectors.dropDuplicates(["vec_key"])).collect()}
    assert back["a"] == ([1.0, 2.0], []) and back["b"] == (None, [1.0, 2.0]) and back["c"][0] == [2.0, 1.0]
    assert df.select(vector_key("input_embeddings")).distinct().count() == 4


def wide(df):
    """Exchanges and sorts of a plan whose rows hold an array of floats."""
    found, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.initialPlan())
        if "Exchange" in node.nodeName() or node.nodeName() == "Sort":
            if "array<float>" in node.schema().catalogString():
                found.append(node.nodeName())
    return found


def test_no_vector_passes_a_shuffle_or_a_sort(spark, stored):
    from tidemark.operators.fold import fold_operations
    from tidemark.operators.validate import split_messages
    from tidemark.sinks.table import clustered, compact

    rows, tables = stored
    history = store.read_versions(spark, tables, vectors=False)
    ops, _ = split_vectors(split_messages(messages_df(spark, rows))[0])
    plans = [latest_version(history), live_snapshot(history), compact(history), clustered(compact(history)), fold_operations(ops)[0], store.current_state(spark, tables)]
    for df in plans:
        assert wide(df) == []
    assert wide(latest_version(store.read_versions(spark, tables)))  # the same dedup of rows that hold the vectors


def test_purge_removes_events_from_every_table(spark, stored):
    rows, tables = stored
    tables = copy_of(spark, tables)
    old = manifest.load(spark, tables.root)
    expired = {r[0] for r in store.current_state(spark, tables).where("is_deleted = 1").select("id").collect()}
    assert len(expired) > 3
    store.purge(spark, tables, 1, dt.datetime(2030, 1, 1))
    m = manifest.load(spark, tables.root)
    assert m.generation == old.generation + 1 and m.through() == old.through()
    want = Counter(row_key(r) for r in model(rows)[0] if r["id"] not in expired)
    assert keys_of(store.read_versions(spark, tables)) == want
    assert {r.id for r in store.current_state(spark, tables).collect()}.isdisjoint(expired)
    assert {r.event_id for r in store.read_rejects(spark, tables).collect()}.isdisjoint(expired)
    assert {r.id for r in store.read_index(spark, tables, m).collect()}.isdisjoint(expired)
    named = store.read_versions(spark, tables, vectors=False).select(F.explode(F.array(*ARRAY_FIELDS)).alias("k")).where("k != ''").distinct()
    named = named.union(store._compacted(spark, tables, m.snapshot["state"], store.KEYED_HISTORY).select(F.explode(F.array(*ARRAY_FIELDS))).where("col != ''")).distinct()
    assert store.read_vectors(spark, tables).count() == named.count()
    # a reader of the old manifest still has all rows; after a vacuum no file of them is left
    assert keys_of(store.read_versions(spark, tables, m=old)) == Counter(row_key(r) for r in model(rows)[0])
    store.vacuum(spark, tables, keep=1)
    files = manifest.Files(spark, tables.root)
    assert not any(files.exists(p) for p in old.named() - m.named())
    # an update of a purged event finds nothing, later batches go on
    gone = sorted(expired)[0]
    apply_batch(spark, messages_df(spark, [msg("update", gone, 99_999, T0, latency=1.0), msg("create", "later", 99_999, T0, conversation_id="c", event_name="event_a")]), 4, tables)
    assert [(r.event_id, r.reason) for r in store.read_rejects(spark, tables).where("batch_id = 4").collect()] == [(gone, R_NOT_FOUND)]
    assert store.current_state(spark, tables).where("id = 'later'").count() == 1


def test_retired_and_vacuumed_stores_answer_alike(spark, stored):
    rows, tables = stored
    tables = copy_of(spark, tables)
    store.compact_rollups(spark, tables, 2)
    errors = sorted(map(repr, store.error_rollup(spark, tables).groupBy("event_date", "event_name").agg(F.sum("total_count")).collect()))
    reader = manifest.load(spark, tables.root)
    store.retire(spark, tables)
    gone = store.vacuum(spark, tables, keep=2)
    assert keys_of(store.read_versions(spark, tables, m=reader)) == Counter(row_key(r) for r in model(rows)[0])
    assert not any("history/batch_id=0" in p for p in gone)  # the reader's manifest is still kept
    gone = store.vacuum(spark, tables, keep=1)
    assert any("history/batch_id=0" in p for p in gone) and any("rollup_error/batch_id=2" in p for p in gone)
    assert keys_of(store.current_state(spark, tables, vectors=True)) == state_of(rows)
    assert sorted(map(repr, store.error_rollup(spark, tables).groupBy("event_date", "event_name").agg(F.sum("total_count")).collect())) == errors
    more = random_log(n_ids=80, n_ops=150, seed=72)
    more = [(op, eid, ts, d, 100_000 + seq) for op, eid, ts, d, seq in more]
    apply_batch(spark, messages_df(spark, more), 4, tables)
    store.compact_tables(spark, tables, 4)
    assert keys_of(store.current_state(spark, tables, vectors=True)) == state_of(rows + more)


def test_redrive_survives_a_crash_between_its_steps(spark, tmp_path, monkeypatch):
    tables, inbox = Tables(f"{scratch_path(spark, 'redrive')}/t"), f"{tmp_path}/inbox"
    ups = [msg("update", f"e{i % 7}", i, T0, latency=float(i)) for i in range(30)]
    apply_batch(spark, messages_df(spark, ups), 0, tables)
    lines = lambda: sorted(r.value for r in spark.read.text(inbox).collect())
    with monkeypatch.context() as m:
        m.setattr(store, "_publish_staged", lambda *_: None)
        assert store.redrive_rejects(spark, tables, inbox, 0) == 30
    assert store.redrive_rejects(spark, tables, inbox, 0) == 0  # finishes the first run, takes nothing again
    first = lines()
    assert len(first) == 30
    assert store.redrive_rejects(spark, tables, inbox, 0) == 0 and lines() == first
    assert store.redrive_rejects(spark, tables, inbox, 0, reasons=("malformed",)) == 0
    apply_batch(spark, messages_df(spark, ups[:4]), 1, tables)
    assert store.redrive_rejects(spark, tables, inbox, 1) == 4 and len(lines()) == 34


def test_append_versions_stores_each_version_once(spark, stored):
    rows, tables = stored
    versions = store.read_versions(spark, tables).where("shadowed = 0").select(*EVENT_COLS, "seq")
    other = Tables(f"{scratch_path(spark, 'once')}/t")
    n = versions.select("id", "version").distinct().count()
    even = F.col("version") % 2 == 0
    assert store.append_versions(spark, other, 0, versions.where(even).unionByName(versions.where(even))) == versions.where(even).select("id", "version").distinct().count()
    store.compact_tables(spark, other, 0)
    store.append_versions(spark, other, 1, versions)
    assert store.append_versions(spark, other, 2, versions) == 0
    assert store.append_versions(spark, other, 1, versions) == versions.where(~even).select("id", "version").distinct().count()  # a replay
    got = store.read_versions(spark, other)
    assert got.count() == got.select("id", "version").distinct().count() == n


def test_a_session_opens_few_files_of_a_clustered_snapshot(spark, monkeypatch):
    rows = [msg("create", f"e{i}", i, T0 + dt.timedelta(hours=i % 700), conversation_id=f"s{i % 200}", event_name="event_b", latency=float(i)) for i in range(4000)]
    tables = Tables(f"{scratch_path(spark, 'clustered')}/t")
    apply_batch(spark, messages_df(spark, rows), 0, tables)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        store.compact_tables(spark, tables, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    m = manifest.load(spark, tables.root)
    ranges = f"{tables.root}/{m.snapshot['files']}"
    total = spark.read.parquet(ranges).count()
    apply_batch(spark, messages_df(spark, [msg("update", "e7", 9000, T0, latency=-1.0)]), 1, tables)
    want = {f"e{i}" for i in range(7, 4000, 200)}
    since = "2024-01-20 00:00:00"
    late = {f"e{i}" for i in range(7, 4000, 200) if T0 + dt.timedelta(hours=i % 700) >= dt.datetime(2024, 1, 20, tzinfo=dt.timezone.utc)}
    whole, part = store.session_state(spark, tables, "s7"), store.session_state(spark, tables, "s7", since)
    assert {r.id for r in whole.collect()} == want and {r.id for r in part.collect()} == late
    assert whole.where("id = 'e7'").first().latency == -1.0
    from tidemark.sinks.table import session_files

    few, fewer = session_files(spark, ranges, "s7"), session_files(spark, ranges, "s7", since)
    assert total >= 32 and len(few) <= 3 * total**0.5 and len(fewer) <= len(few)
    opened = [f for f in whole.inputFiles() if "/snapshots/" in f]
    assert {f.rsplit("/", 1)[1] for f in opened} == {f.rsplit("/", 1)[1] for f in few}


def test_metrics_count_every_message(spark, stored):
    rows, tables = stored
    got = store.read_metrics(spark, tables)
    told = {(r.kind, r.name): r.n for r in got.groupBy("kind", "name").agg(F.sum("n").alias("n")).collect()}
    hist, rejected = model(rows)
    assert sum(n for (kind, _), n in told.items() if kind == "applied") == len(hist)
    assert {k: n for (kind, k), n in told.items() if kind == "rejected"} == Counter(r[3] for r in rejected)
    assert got.where("kind = 'applied' and (last_time is null or lag_ms is null)").count() == 0
    assert A.read_metrics is store.read_metrics
