"""Physical-plan properties the operators promise (read from ``explain``)."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from gridlake.plans.registry import load_all
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF", "MapInArrow", "FlatMapGroupsInArrow")
RELATIONAL = sorted(n for n, p in load_all().items() if p.fn.__module__.endswith(("proofs_relational", "proofs_serving", "proofs_skew")))


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_python_and_no_cartesian(spark, name):
    text = plan(E.queries()[name](spark, SF_SMALL))
    assert not any(n in text for n in PYTHON_NODES), name
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_latest_per_key_limits_before_shuffle(spark):
    text = plan(E.queries()["latest_per_key"](spark, SF_SMALL))
    tree = text.split("\n\n")[0]
    # Partial WindowGroupLimit sits below (after, in the tree text) the Exchange.
    assert re.search(r"Exchange[\s\S]*WindowGroupLimit", tree)
    assert tree.count("WindowGroupLimit") == 2


def test_scan_pushdown_and_pruning(spark):
    text = plan(E.queries()["scan_parquet"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(l_shipdate" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(f.split(":")[0] for f in schema.split(",")) == ["l_extendedprice", "l_orderkey", "l_shipdate"]


def test_dimension_is_broadcast(spark):
    text = plan(E.queries()["gold_priority"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_salted_join_shuffles_on_key_and_salt(spark):
    text = plan(E.queries()["salted_join"](spark, SF_SMALL))
    assert "SortMergeJoin" in text and "_salt" in text


def test_scd2_has_no_sort_aggregate(spark):
    text = plan(E.queries()["scd2_collapsed"](spark, SF_SMALL))
    assert "SortAggregate" not in text


def test_top_k_is_take_ordered(spark):
    text = plan(E.queries()["rows_of_top_keys"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text and "LeftSemi" in text


def test_dq_metrics_has_no_expand(spark):
    text = plan(E.queries()["dq_metrics"](spark, SF_SMALL))
    assert "Expand" not in text


def test_time_bucket_join_keys_are_timestamps(spark):
    text = plan(E.queries()["hour_bucket_join"](spark, SF_SMALL))
    assert "date_format" not in text
    assert re.search(r"Left keys \[\d+\]: \[[^\]]*_bucket", text)
