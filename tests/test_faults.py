"""Faults found outside the proofs: NULL keys and arrays, changed columns, string clustering, unset shared folder."""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from gridlake.functions.expressions import full_match
from gridlake.operators.aggregates import reconcile
from gridlake.operators.flatten import flatten_parallel_arrays
from gridlake.operators.history import scd2
from gridlake.operators.layout import cluster_by
from gridlake.session import checkpoint_root
from gridlake.streaming.latest import upsert_latest


def test_null_array_keeps_its_sibling(spark):
    df = spark.sql("SELECT 1 AS k, array(1, 2) AS a, CAST(NULL AS array<int>) AS b UNION ALL SELECT 2, NULL, NULL")
    assert [tuple(r) for r in flatten_parallel_arrays(df, ["a", "b"], ["k"]).collect()] == [(1, 1, None), (1, 2, None)]
    assert flatten_parallel_arrays(df, ["a", "b"], ["k"], outer=True).filter("k = 2").collect()[0][1:] == (None, None)


@pytest.mark.parametrize("collapse", [True, False])
def test_history_of_a_null_key(spark, collapse):
    day = lambda m, d: dt.datetime(2024, m, d)
    rows = [(None, day(1, 1), "a"), (None, day(2, 1), "b"), ("k", day(1, 5), "a"), ("k", day(1, 5), "b")]
    out = scd2(spark.createDataFrame(rows, "k string, ts timestamp_ntz, s string"), ["k"], "ts", collapse=collapse)
    current = out.filter("is_current").collect()
    assert sorted((str(r.k), r.s) for r in current) == [("None", "b"), ("k", "b")]


def test_reconcile_null_key(spark):
    bronze = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    r = reconcile(bronze, spark.createDataFrame([(None, 2), (1, 3)], "k int, v int"), bronze.limit(0), ["k"]).first()
    assert r["superseded"] == 1 and r["balanced"]


def test_zorder_over_string_and_date(spark):
    df = spark.range(2000).select(F.concat(F.lit("n"), F.lpad(F.col("id") % 100, 3, "0")).alias("s"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 50).cast("int")).alias("d"))
    out = cluster_by(df, ["s", "d"], 8, bits=3)
    per = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("s").alias("n")).collect()
    assert out.count() == 2000 and max(r["n"] for r in per) < 100


def test_frequent_value_fills_several_files(spark):
    df = spark.range(3000).select(F.lit("hot").alias("s"), "id")
    assert cluster_by(df, ["s"], 6).groupBy(F.spark_partition_id()).count().count() > 1


def test_upsert_keeps_columns_of_both_sides(spark, tmp_root):
    target = f"{tmp_root}/t"
    first = spark.createDataFrame([(1, "d1", 1, "x"), (2, "d2", 1, "y")], "k int, day string, ts int, old string")
    second = spark.createDataFrame([(3, "d1", 1, 7.0)], "k int, day string, ts int, new double")
    for batch in (first, second, second):
        upsert_latest(batch, target, ["k"], ["ts"], None, "day")
    got = {r.k: (r.old, r.new) for r in spark.read.option("mergeSchema", True).parquet(target).collect()}
    assert got == {1: ("x", None), 2: ("y", None), 3: (None, 7.0)}


def test_pattern_is_anchored_at_both_ends(spark):
    df = spark.createDataFrame([("12345",), ("123456",)], "c string")
    for p in ("^[0-9]{5}", "[0-9]{5}$", "^[0-9]{5}$", "[0-9]{5}"):
        assert [r[0] for r in df.select(full_match("c", p)).collect()] == [True, False]


def test_no_machine_local_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda k, d=None: d)
    context = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(conf=conf, sparkContext=context))
