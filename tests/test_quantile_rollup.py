"""Exact distributed percentile and the KLL rollup."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.operators.quantile import exact_percentile
from tidemark.operators.rollups import error_partial, latency_partial, merge_error, read_latency_rollup


def _data(spark, seed=1):
    rnd = random.Random(seed)
    rows = []
    # one hot group holding about a third of all rows, many small ones, ties and repeats
    for i in range(6000):
        rows.append(("hot", "event_a", float(rnd.randrange(0, 3000))))
    for g in range(300):
        for _ in range(rnd.randrange(1, 40)):
            rows.append((f"g{g}", rnd.choice(["event_a", "event_b"]), round(rnd.uniform(0, 5000), 2)))
    rows.append(("single", "event_c", 7.0))
    rows += [("same", "event_a", 3.0)] * 50
    return rows


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_exact_percentile_matches_duckdb(spark, parts):
    rows = _data(spark)
    df = spark.createDataFrame(rows, "conversation_id string, event_name string, latency double")
    got = {
        (r.conversation_id, r.event_name): (round(r.p, 6), r.n)
        for r in exact_percentile(df, ["conversation_id", "event_name"], "latency", 0.95, "p", "n", parts).collect()
    }
    con = duckdb.connect()
    con.execute("create table t (conversation_id varchar, event_name varchar, latency double)")
    con.executemany("insert into t values (?, ?, ?)", rows)
    want = {
        (a, b): (round(q, 6), n)
        for a, b, q, n in con.execute(
            "select conversation_id, event_name, quantile_cont(latency, 0.95), count(*) from t group by 1, 2"
        ).fetchall()
    }
    assert got == want


def test_exact_percentile_keeps_null_groups(spark):
    """NULL keys, alone and beside others, over several batches of a task."""
    rows = [(None if i % 3 else "a", None if i % 2 else "x", float(i)) for i in range(30_000)] + [("b", None, None)]
    df = spark.createDataFrame(rows, "k string, l string, v double")
    con = duckdb.connect()
    con.register("t", df.toPandas())
    want = {(k, m): (round(q, 6), n) for k, m, q, n in con.execute(
        "select k, l, quantile_cont(v, 0.95), count(v) from t where v is not null group by 1, 2").fetchall()}
    for parts in (1, 7):
        got = {(r.k, r.l): (round(r.p, 6), r.n) for r in exact_percentile(df, ["k", "l"], "v", 0.95, "p", "n", parts).collect()}
        assert got == want and len(got) == 4


def test_exact_percentile_spreads_hot_group(spark):
    """The operator's own plan ranges by key and value, so the hot group's values lie in several tasks."""
    df = spark.createDataFrame(_data(spark), "conversation_id string, event_name string, latency double")
    out = exact_percentile(df, ["conversation_id", "event_name"], "latency", 0.95, "p", "n", 8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(conversation_id" in plan and "latency" in plan.split("rangepartitioning(")[1].split(")")[0]
    assert "BroadcastNestedLoopJoin" not in plan


def test_rollup_partials_merge_like_one_shot(spark):
    rows = []
    for i in range(400):
        rows.append((f"e{i}", f"c{i % 9}", ["event_a", "event_b"][i % 2], "x" if i % 3 == 0 else "",
                     float(i % 97), i % 5 == 0, f"2024-01-{1 + i % 20:02d} 00:00:00"))
    df = spark.createDataFrame(rows, "id string, conversation_id string, event_name string, error string, "
                                     "latency double, dead boolean, ts string")
    df = df.select("*", F.col("dead").cast("int").alias("is_deleted"), F.col("ts").cast("timestamp_ntz").alias("created_at"))
    parts = [df.where(f"cast(substr(id, 2) as int) % 3 = {k}") for k in range(3)]
    merged = merge_error(error_partial(parts[0]).unionByName(error_partial(parts[1])).unionByName(error_partial(parts[2])))
    one = merge_error(error_partial(df))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, one.collect()))
    sk = read_latency_rollup(latency_partial(parts[0]).unionByName(latency_partial(parts[1])).unionByName(latency_partial(parts[2])))
    exact = df.where("is_deleted = 0").groupBy("conversation_id", "event_name").agg(
        F.sort_array(F.collect_list("latency")).alias("vals"), F.count(F.lit(1)).alias("n"))
    joined = sk.join(exact, ["conversation_id", "event_name"]).collect()
    assert len(joined) == exact.count()
    for r in joined:
        assert r.event_count == r.n
        # KLL answers with an actual element whose rank is near 0.95 (no interpolation)
        assert r.p95_latency in r.vals
        below = sum(1 for v in r.vals if v < r.p95_latency) / r.n
        upto = sum(1 for v in r.vals if v <= r.p95_latency) / r.n
        assert below <= 0.95 + 0.02 and upto >= 0.95 - 0.02 - 1.0 / r.n
