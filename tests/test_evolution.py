"""Typed drift, evolving JSON, rescue in plain streams, header probes, zone maps and Bloom filters, clustering by text."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridlake import contracts as C
from gridlake.operators.layout import cluster_by, sampled_bounds
from gridlake.operators.pruning import bloom_report, bloom_size, scan_report, zone_map, zone_report
from gridlake.sources.drift import HEADER_BYTES, first_line, probe_headers
from gridlake.sources.typing import TypeLog, join_types, narrowest_types
from gridlake.streaming.evolving import ingest_evolving_csv, ingest_evolving_json, read_evolved
from gridlake.streaming.ingest import ingest_stream, run_until_drained
from tests.conftest import write_text

CONTRACT = C.schema(("id", C.L), ("name", C.S))


def test_type_lattice(spark):
    assert join_types("bigint", "double") == "double" and join_types("date", "timestamp_ntz") == "timestamp_ntz"
    assert join_types(None, "date") == "date" and join_types("boolean", "bigint") == "string" and join_types("double", "date") == "string"
    cols = {
        "whole": ["1", "-20", None], "part": ["1", "2.5", "3e4"], "code": ["01", "2", "3"], "day": ["2024-01-31", None, "2023-12-01"],
        "time": ["2024-01-31", "2024-01-31 10:00:00", None], "flag": ["true", "false", None], "none": [None, None, None], "text": ["1", "x", "2"],
        "big": ["99999999999999999999", "1", "2"],
    }
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} string" for c in cols))
    assert narrowest_types(df, list(cols)) == {
        "whole": "bigint", "part": "double", "code": "string", "day": "date", "time": "timestamp_ntz", "flag": "boolean", "none": None, "text": "string",
        "big": "double",
    }


def test_type_log_is_idempotent(spark, tmp_root):
    log = TypeLog(spark, f"{tmp_root}/log")
    assert log.current() == {}
    assert log.record(0, {"a": "bigint"}) == {"a": "bigint"} and log.record(0, {"a": "bigint"}) == {}
    assert log.record(1, {"a": "double", "b": None}) == {"a": "double", "b": None}
    assert log.record(2, {"a": "bigint", "b": "date"}) == {"b": "date"} and log.current() == {"a": "double", "b": "date"}


@pytest.mark.parametrize("files", [1, 100])
def test_csv_types_widen_for_old_rows(spark, tmp_root, files):
    landing = tmp_root.removeprefix("file:")
    write_text(f"{landing}/in/a.csv", "id,name\n1,x\n")
    write_text(f"{landing}/in/b.csv", "qty,id,name\n5,2,y\nbad,three,z\n")
    write_text(f"{landing}/in/c.csv", "id,qty,name,zip\n4,6.5,w,01234\n")
    args = (spark, f"{tmp_root}/in", f"{tmp_root}/out", f"{tmp_root}/ck", CONTRACT, f"{tmp_root}/types")
    log = ingest_evolving_csv(*args, max_files_per_trigger=files)
    assert log.current() == {"qty": "string", "zip": "string"}
    rows = {(r.id, r.name, r.qty, r.zip, r._rescued_data) for r in read_evolved(spark, f"{tmp_root}/out", CONTRACT, log).collect()}
    assert rows == {(1, "x", None, None, None), (2, "y", "5", None, None), (None, "z", "bad", None, '{"id":"three"}'), (4, "w", "6.5", "01234", None)}
    ingest_evolving_csv(*args)
    assert read_evolved(spark, f"{tmp_root}/out", CONTRACT, log).count() == 4


def test_json_keeps_everything(spark, tmp_root):
    landing = tmp_root.removeprefix("file:")
    contract = C.schema(("id", C.L), ("at", C.NTZ), ("v", C.D))
    write_text(f"{landing}/in/a.json", '{"id": 1, "at": "2024-01-01T10:00:00", "v": 2.5}\n\n{"id": 2, "v": null}\n')
    args = (spark, f"{tmp_root}/in", f"{tmp_root}/out", f"{tmp_root}/ck", contract, f"{tmp_root}/types")
    ingest_evolving_json(*args)
    write_text(f"{landing}/in/b.json", '{"id": "x", "n": 3, "deep": {"k": [1]}, "odd name": true}\n[1, 2]\nnot json\n{"id": 4, "n": 3.5}\n')
    log = ingest_evolving_json(*args)
    assert log.current() == {"deep": "string", "n": "double", "odd name": "boolean"}
    rows = read_evolved(spark, f"{tmp_root}/out", contract, log).collect()
    assert len(rows) == 6
    by_id = {r.id: r for r in rows if r.id}
    assert by_id[1].at == dt.datetime(2024, 1, 1, 10) and by_id[1].n is None and by_id[4].n == 3.5 and by_id[2]._rescued_data is None
    bad = [r for r in rows if r.id is None]
    assert {r._rescued_data for r in bad} == {'{"id":"x"}', '{"_line":"[1, 2]"}', '{"_line":"not json"}'}
    assert [(r.n, r.deep, r["odd name"]) for r in bad if r.n] == [(3.0, '{"k":[1]}', True)]


def test_one_envelope_per_file(spark, tmp_root):
    landing = tmp_root.removeprefix("file:")
    write_text(f"{landing}/in/a.json", '{\n "id": 1,\n "name": "x"\n}\n')
    log = ingest_evolving_json(spark, f"{tmp_root}/in", f"{tmp_root}/out", f"{tmp_root}/ck", CONTRACT, f"{tmp_root}/types", whole_files=True)
    assert [(r.id, r.name) for r in read_evolved(spark, f"{tmp_root}/out", CONTRACT, log).collect()] == [(1, "x")]


def test_json_stream_rescue(spark, tmp_root):
    landing = tmp_root.removeprefix("file:")
    write_text(f"{landing}/in/a.json", '{"id": 1, "name": "x"}\n{"id": "one", "name": "y"}\n{"id": 3,\n')
    ingest_stream(spark, f"{tmp_root}/in", f"{tmp_root}/out", f"{tmp_root}/ck", "json", CONTRACT, rescue=True)
    rows = {(r.id, r.name, r._rescued_data) for r in spark.read.parquet(f"{tmp_root}/out").collect()}
    assert rows == {(1, "x", None), (None, "y", '{"id":"one"}'), (None, None, '{"_line":"{\\"id\\": 3,"}')}


def test_only_listed_errors_restart():
    starts = []

    class Query:
        def awaitTermination(self):
            starts.append(1)
            raise RuntimeError("other")

    with pytest.raises(RuntimeError):
        run_until_drained(Query, retries=3, retry_on=lambda e: "planned" in str(e))
    assert len(starts) == 1


def test_header_is_read_by_range(spark, tmp_root):
    landing = tmp_root.removeprefix("file:")
    long_header = ",".join(f"column{i}" for i in range(HEADER_BYTES // 4))
    paths = [write_text(f"{landing}/{n}.csv", t) for n, t in (("a", "x;y\n1;2\n"), ("b", long_header + "\n1\n"), ("c", ""), ("d", "only;header"))]
    assert first_line(paths[1]) == long_header and first_line("file://" + paths[0]) == "x;y"
    got = probe_headers(spark, paths, ";")
    assert got[paths[0]] == ["x", "y"] and got[paths[2]] == [] and got[paths[3]] == ["only", "header"]


def test_zone_map_equals_scan(spark, tmp_root):
    df = spark.range(1000).selectExpr("id", "cast(id as string) s", "date_add(date'2024-01-01', cast(id as int)) d", "if(id < 500, null, id) n")
    df.repartitionByRange(5, "id").write.parquet(f"{tmp_root}/t")
    rows = zone_map(spark, f"{tmp_root}/t", ["id", "s", "d", "n"]).collect()
    assert len(rows) == 20 and all(r.known for r in rows) and sum(r.rows for r in rows if r.column == "id") == 1000
    assert min(r.min_number for r in rows if r.column == "id") == 0 and max(r.max_text for r in rows if r.column == "d") == "2026-09-26"
    for col, values, least in (("id", [3, 999], 2), ("d", [dt.date(2024, 1, 5)], 1), ("n", [7], 0), ("s", ["42"], 1)):
        zone = zone_report(spark, {"t": f"{tmp_root}/t"}, col, values).first()
        held = scan_report(spark, {"t": f"{tmp_root}/t"}, col, values).first()
        assert zone.files_total == 5 and zone.rows_total == 1000 and zone.files_touched >= held.files_touched and zone.files_touched >= least
    assert zone_report(spark, {"t": f"{tmp_root}/t"}, "n", [7]).first().files_touched == 0


def test_bloom_false_positives(spark, tmp_root):
    # 64 files, values spread over all of them: min and max rule nothing out
    df = spark.range(6400).selectExpr("id * 7919 % 6400 as k", "id % 64 as b")
    df.repartition(8, "b").write.partitionBy("b").parquet(f"{tmp_root}/t")
    tables = {"t": f"{tmp_root}/t"}
    values = list(range(0, 40, 2))
    zone, bloom, held = (f(spark, tables, "k", values).first() for f in (zone_report, bloom_report, scan_report))
    assert zone.files_touched >= 30 and held.files_touched <= bloom.files_touched
    # twenty values, a share of 0.01 each: far less than half of the other files
    assert bloom.files_touched - held.files_touched <= 0.5 * (64 - held.files_touched)
    absent = bloom_report(spark, tables, "k", [10_000_000 + i for i in range(5)]).first()
    assert absent.files_touched <= 12
    assert bloom_size(100, 0.01)[0] >= 959


def test_text_and_decimals_cluster(spark, tmp_root):
    df = spark.range(4000).selectExpr(
        "concat('https://example.org/a/long/prefix/item-', lpad(cast(id * 7919 % 4000 as string), 6, '0')) as url",
        "cast(id * 104729 % 4000 as decimal(20, 4)) / 3 as price",
    )
    bounds = sampled_bounds(df, ["url", "price"], 8)
    assert [len(b) for b in bounds] == [7, 7] and all(b == sorted(b) for b in bounds) and isinstance(bounds[1][0], Decimal)
    df.repartition(16).write.parquet(f"{tmp_root}/plain")
    cluster_by(df, ["url", "price"], num_files=16, bits=4).write.parquet(f"{tmp_root}/clustered")
    one = "https://example.org/a/long/prefix/item-000777"
    touched = {r.table: r.files_touched for r in zone_report(spark, {x: f"{tmp_root}/{x}" for x in ("plain", "clustered")}, "url", [one]).collect()}
    assert touched["plain"] == 16 and touched["clustered"] <= 8
    assert spark.read.parquet(f"{tmp_root}/clustered").exceptAll(df).isEmpty()


def test_hot_text_value_fills_several_files(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("s"), "id")
    sizes = [r["count"] for r in cluster_by(df, ["s", "id"], num_files=10, bits=4).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1000
