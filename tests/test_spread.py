"""No step gives one task all rows, sorts rows that it need not, or computes its input again."""

import pytest
from pyspark.sql import functions as F

from helpers import messages_df, msg

from tidemark.operators.fold import fold_operations
from tidemark.operators.validate import split_messages
from tidemark.operators.vectors import VECTOR_SCHEMA, with_vectors
from tidemark.plans import registry
from tidemark.schema import EVENT_COLS
from tidemark.session import scratch_path
from tidemark.sinks import store
from tidemark.sinks.store import Tables
from tidemark.sources.changelog import read_json_lines


@pytest.fixture
def shuffled(spark):
    """Joins are shuffled and partitions stay as they are."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in kept.items():
        spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def versions_of(spark, n):
    rows = [msg("create", f"e{i}", 0, conversation_id="s", event_name="event_a", latency=float(i)) for i in range(n)]
    rows += [msg("update", f"e{i}", 1, latency=-1.0) for i in range(0, n, 2)]
    return fold_operations(split_messages(messages_df(spark, rows))[0])[0]


def counted(spark, df):
    """The rows, and how many of them have been computed so far."""
    seen = spark.sparkContext.accumulator(0)

    def passed(parts):
        for part in parts:
            seen.add(part.num_rows)
            yield part

    return df.mapInArrow(passed, df.schema), seen


def test_rows_without_vectors_are_no_single_task(shuffled):
    rows = shuffled.range(2000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") == 7, F.lit("k")).when(F.col("id") % 2 == 0, F.lit("")).alias("input_embeddings"), F.lit("").alias("output_embeddings"),
    )
    out = with_vectors(rows, shuffled.createDataFrame([("k", [1.0, 2.0])], VECTOR_SCHEMA))
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 1000
    got = {r.id: (r.input_embeddings, r.output_embeddings) for r in out.collect()}
    assert all(v == ([1.0, 2.0] if i == "7" else None if int(i) % 2 else [], []) for i, v in got.items())


def test_no_stored_vectors_no_join(shuffled):
    tables = Tables(f"{scratch_path(shuffled, 'plain')}/t")
    versions = versions_of(shuffled, 20)
    assert store.append_versions(shuffled, tables, 0, versions) == 30
    assert "Join" not in plan_of(store.read_versions(shuffled, tables))
    assert sorted(r.id for r in store.read_versions(shuffled, tables).collect()) == sorted(r.id for r in versions.collect())


def test_a_files_messages_are_not_shuffled_for_their_order(shuffled):
    path = scratch_path(shuffled, "one-file")
    lines = [f'{{"operation":"update","event_id":"e","timestamp":"2024-01-01T00:00:00Z","data":{{"latency":{i}}}}}' for i in range(50)]
    shuffled.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    got = read_json_lines(shuffled, path)
    assert "SortMergeJoin" not in plan_of(got)
    assert [r.v for r in got.orderBy("seq").select(F.col("data.latency").alias("v")).collect()] == [float(i) for i in range(50)]


def test_appended_versions_are_computed_once(spark):
    versions, seen = counted(spark, versions_of(spark, 40).select(*EVENT_COLS, "seq"))
    tables = Tables(f"{scratch_path(spark, 'counted')}/t")
    assert store.append_versions(spark, tables, 0, versions) == 60
    assert seen.value == 60


def test_two_stored_batches_are_one_fold(spark, monkeypatch):
    versions, seen = counted(spark, versions_of(spark, 40))
    monkeypatch.setattr(registry, "history", lambda spark, d: versions)
    assert registry._state(spark, "").count() == 40
    assert seen.value == 60


def test_copies_of_a_vector_end_before_the_shuffle(shuffled):
    vectors = shuffled.createDataFrame([("k", [1.0])] * 500 + [("l", [2.0])], VECTOR_SCHEMA)
    tables = Tables(f"{scratch_path(shuffled, 'vectors')}/t")
    shuffled.createDataFrame([("l", [2.0])], VECTOR_SCHEMA).write.parquet(f"{tables.root}/vectors/batch_id=0/attempt=a")
    m = store.Manifest(batches={0: {"vectors": {"rows": 1, "paths": ["vectors/batch_id=0/attempt=a"]}}})
    fresh = store._new_vectors(shuffled, tables, vectors, m)
    assert [tuple(r) for r in fresh.collect()] == [("k", [1.0])]
    before_join = plan_of(fresh).split("LeftAnti")[1]
    assert "Aggregate(key=[vec_key" in before_join
