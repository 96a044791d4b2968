"""Layout jobs: file counts, content preservation, version swap."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators.layout import compact, cluster_by, optimize, table_location, table_stats
from gridlake.sinks import publish
from gridlake.plans.tables import table
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_compact_reaches_target_file_count(spark, tmp_root):
    li = table(spark, SF_SMALL, "lineitem")
    li.repartition(24).write.parquet(f"{tmp_root}/small")
    size = table_stats(spark, {"t": f"{tmp_root}/small"}).first()["size_bytes"]
    n = compact(spark, f"{tmp_root}/small", f"{tmp_root}/big", target_bytes=size // 3 + 1)
    assert n == 3
    assert table_stats(spark, {"t": f"{tmp_root}/big"}).first()["num_files"] <= 3
    assert rows(spark.read.parquet(f"{tmp_root}/big")) == rows(li)


def test_range_cluster_gives_disjoint_files(spark, tmp_root):
    li = table(spark, SF_SMALL, "lineitem")
    cluster_by(li, ["l_partkey"], num_files=4).write.parquet(f"{tmp_root}/c")
    ranges = (
        spark.read.parquet(f"{tmp_root}/c")
        .groupBy(F.col("_metadata.file_path").alias("f"))
        .agg(F.min("l_partkey").alias("lo"), F.max("l_partkey").alias("hi"))
        .orderBy("lo")
        .collect()
    )
    assert all(a["hi"] <= b["lo"] for a, b in zip(ranges, ranges[1:]))


def test_optimize_swaps_version_and_keeps_content(spark, tmp_root):
    name = "gridlake_test.lineitem_opt"
    li = table(spark, SF_SMALL, "lineitem")
    first = publish(li.repartition(12), name, f"{tmp_root}/wh")
    second = optimize(spark, name, f"{tmp_root}/wh", ["l_suppkey"], target_bytes=1 << 30)
    assert table_location(spark, name).rstrip("/").endswith(second.rstrip("/").split("/")[-1])
    assert first != second
    assert rows(spark.table(name)) == rows(li)
    assert table_stats(spark, {"v": second}).first()["num_files"] == 1


def test_republish_partitioned_table_reads_only_new_version(spark, tmp_root):
    name = "gridlake_test.partitioned_pub"
    df = spark.range(100).selectExpr("id", "id % 4 AS p")
    publish(df, name, f"{tmp_root}/wh", partition_by=["p"])
    assert spark.table(name).count() == 100
    publish(spark.table(name).filter("id < 10"), name, f"{tmp_root}/wh", partition_by=["p"])
    assert sorted(r["id"] for r in spark.table(name).collect()) == list(range(10))


def test_formats_present_reads_orders(spark, tmp_root):
    from gridlake.plans.proofs_layout import q_formats_present

    spark.range(1, 7).selectExpr("3 * id o_orderkey", "'x' o_comment").write.parquet(f"{tmp_root}/orders.parquet")
    spark.range(25).selectExpr("cast(id as int) n_nationkey").write.parquet(f"{tmp_root}/nation.parquet")
    assert {r.format for r in q_formats_present(spark, tmp_root).collect()} == {"json", "parquet", "orc"}


def test_too_many_sources_are_an_error(spark, tmp_root):
    import pytest

    from gridlake.plans.proofs_layout import q_missing_sources

    spark.range(1001).selectExpr("id event_id", "concat('type', id) event_type").write.parquet(f"{tmp_root}/events.parquet")
    with pytest.raises(ValueError):
        q_missing_sources(spark, tmp_root)
