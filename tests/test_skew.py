"""History by ranges, joins that split heavy keys alone, mergeable metrics."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridlake.operators.history import scd2, scd2_ranges
from gridlake.operators.joins import heavy_hitters, skew_join
from gridlake.operators.sketches import add_delivery, merged_metrics, read_state, returning_keys


def _history(n, keys, states, seed):
    r = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = [(r.choice(keys), start + dt.timedelta(minutes=r.randrange(500)), r.choice(states), i) for i in range(n)]
    return rows


@pytest.mark.parametrize("collapse", [True, False])
@pytest.mark.parametrize("states", [["a"], ["a", "b", None], list("abcdefgh")])
def test_ranges_equal_the_window_form(spark, collapse, states):
    rows = _history(600, ["hot"] * 5 + ["x", "y", None], states, 3)
    df = spark.createDataFrame(rows, "k string, at timestamp_ntz, s string, i long").repartition(3)
    args = (["k"], "at", ["s"] if collapse else ["s", "i"], ["i"])
    want = scd2(df, *args, collapse=collapse, slice_unit=None)
    got = scd2_ranges(df, *args, collapse=collapse)
    assert got.columns == want.columns
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_ranges_of_nothing(spark):
    df = spark.createDataFrame([], "k string, at timestamp_ntz, s string")
    assert scd2_ranges(df, ["k"], "at").count() == 0


def test_one_hot_key_fills_many_tasks(spark):
    rows = spark.range(8000).selectExpr("if(id % 3 = 0, 0, id) as k", "timestamp_ntz'2024-06-01' + make_dt_interval(0, 0, cast(id % 40000 as int), 0) as at", "id as s")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = scd2_ranges(rows, ["k"], "at", collapse=False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [r["count"] for r in out.groupBy(F.input_file_name()).count().collect()]
    assert len(files) == 4 and max(files) < 2 * sorted(files)[len(files) // 2]


def test_heavy_hitters_are_exact(spark):
    df = spark.range(9000).selectExpr("case when id % 3 = 0 then 'hot' when id % 10 = 1 then null else concat('k', id) end as k")
    got = {(r.k, r.n) for r in heavy_hitters(df, ["k"], 0.05).collect()}
    assert got == {("hot", 3000), (None, df.filter("k is null").count())}
    assert heavy_hitters(df.limit(0), ["k"], 0.05).count() == 0
    with pytest.raises(ValueError):
        heavy_hitters(df, ["k"], 0.0001)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_plain_join(spark, how):
    fact = spark.range(6000).selectExpr("case when id % 3 = 0 then 1 when id % 7 = 0 then null else id % 500 end as k", "1 as v")
    dim = spark.range(400).selectExpr("id as k", "concat('d', id) as d").unionByName(spark.createDataFrame([(1, "second"), (None, "n")], "k long, d string"))
    want = fact.join(dim, ["k"], how)
    got = skew_join(fact, dim, ["k"], how, share=0.05, rows_per_task=100)
    assert got.columns == want.columns and got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_identical_rows_are_dealt_evenly_and_others_are_not_replicated(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(4000).selectExpr("case when id % 2 = 0 then 1 else id end as k", "7 as v")
        joined = skew_join(fact, spark.range(4000).selectExpr("id as k", "id as d"), ["k"], share=0.05, rows_per_task=100)
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert "_salt" in plan
        hot = fact.withColumn("at", F.monotonically_increasing_id()).filter("k = 1").groupBy(F.pmod(F.xxhash64("at"), F.lit(20))).count()
        sizes = [r["count"] for r in hot.collect()]
        assert max(sizes) <= 2 * min(sizes)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_metrics_merge_and_replace(spark, tmp_root):
    a = spark.range(1000).selectExpr("'2024-W01' as wk", "id % 800 as k", "id % 10 = 0 as bad")
    b = spark.range(500).selectExpr("'2024-W02' as wk", "id + 400 as k", "false as bad")
    path = f"{tmp_root}/state"
    for df in (a, b, b):  # the second delivery comes twice
        add_delivery(df, path, "wk", "k", {"n_bad": F.col("bad")})
    state = read_state(spark, path, "wk")
    assert state.count() == 2
    total = merged_metrics(state).first()
    assert total.rows == 1500 and total.n_bad == 100 and abs(total.distinct_keys - 900) <= 900 * 0.04
    again = returning_keys(state, "wk").first()
    assert again.wk == "2024-W02" and abs(again.returning - 400) <= 400 * 0.1
