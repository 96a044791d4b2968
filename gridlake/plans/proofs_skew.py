"""Proofs of skew and incremental mechanisms (X-01, X-05, DQ-01, A-03): a third of all rows on one key in one month, identical
rows, state kept per delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.expressions import iso_week
from gridlake.operators.history import scd2_ranges
from gridlake.operators.joins import heavy_hitters, skew_join
from gridlake.operators.sketches import add_delivery, merged_metrics, read_state, returning_keys
from gridlake.plans.registry import proof
from gridlake.plans.tables import table
from gridlake.session import scratch_path

#: A third of the orders on customer 1, all within June 1996 (query and oracle alike).
_HOT_SQL = """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '1996-06-01 00:00:00' + to_minutes(CAST(o_orderkey % 40000 AS INTEGER)) ELSE o_orderdate END AS seen
FROM orders"""


def _hot_orders(spark: SparkSession, d: str) -> DataFrame:
    hot = F.col("o_orderkey") % 3 == 0
    june = F.expr("timestamp_ntz'1996-06-01 00:00:00' + make_dt_interval(0, 0, o_orderkey % 40000, 0)")
    return table(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(hot, F.lit(1)).otherwise(F.col("o_custkey")).cast("long").alias("o_custkey"), F.when(hot, june).otherwise(F.col("o_orderdate")).alias("seen")
    )


@proof(
    "scd2_hot_slice",
    f"""WITH o AS ({_HOT_SQL})
       SELECT o_custkey, o_orderkey, o_orderstatus, seen AS valid_from, lead(seen) OVER w AS valid_to, lead(seen) OVER w IS NULL AS is_current
       FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY seen, o_orderkey)""",
    ("X-01",),
)
def q_scd2_hot_slice(spark: SparkSession, d: str) -> DataFrame:
    """One key with a third of the rows in one month: versions by ranges of (key, instant)."""
    return scd2_ranges(_hot_orders(spark, d), ["o_custkey"], "seen", ["o_orderkey", "o_orderstatus"], ["o_orderkey"], collapse=False)


@proof(
    "scd2_hot_collapsed",
    f"""WITH o AS ({_HOT_SQL}),
       p AS (SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY seen, o_orderkey) AS prev FROM o),
       c AS (SELECT * FROM p WHERE prev IS NULL OR prev <> o_orderstatus)
       SELECT o_custkey, o_orderstatus, seen AS valid_from, lead(seen) OVER w AS valid_to, lead(seen) OVER w IS NULL AS is_current
       FROM c WINDOW w AS (PARTITION BY o_custkey ORDER BY seen, o_orderkey)""",
    ("X-01",),
)
def q_scd2_hot_collapsed(spark: SparkSession, d: str) -> DataFrame:
    """The same with runs of equal state as one version, also across ranges."""
    return scd2_ranges(_hot_orders(spark, d), ["o_custkey"], "seen", ["o_orderstatus"], ["o_orderkey"]).drop("o_orderkey")


#: A third of the lines on supplier 1, all columns equal.
_SAME_SQL = "SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS s_suppkey, CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_linenumber END AS line FROM lineitem"


def _same_lines(spark: SparkSession, d: str) -> DataFrame:
    hot = F.col("l_orderkey") % 3 == 0
    return table(spark, d, "lineitem").select(
        F.when(hot, F.lit(1)).otherwise(F.col("l_suppkey")).cast("long").alias("s_suppkey"), F.when(hot, F.lit(7)).otherwise(F.col("l_linenumber")).cast("long").alias("line")
    )


@proof(
    "skew_join_identical_rows",
    f"SELECT s_suppkey, line, s_name, count(*) AS n FROM ({_SAME_SQL}) JOIN supplier USING (s_suppkey) GROUP BY ALL",
    ("X-05",),
)
def q_skew_join(spark: SparkSession, d: str) -> DataFrame:
    """Identical hot rows: dealt over salts by position; other keys are neither salted nor replicated."""
    joined = skew_join(_same_lines(spark, d), table(spark, d, "supplier").select("s_suppkey", "s_name"), ["s_suppkey"], share=0.05, rows_per_task=500)
    return joined.groupBy("s_suppkey", "line", "s_name").agg(F.count(F.lit(1)).alias("n"))


@proof(
    "heavy_hitters",
    f"""WITH f AS ({_SAME_SQL}) SELECT s_suppkey, count(*) AS n FROM f GROUP BY 1 HAVING count(*) >= ceil(0.05 * (SELECT count(*) FROM f))""",
    ("X-05", "M-06"),
)
def q_heavy_hitters(spark: SparkSession, d: str) -> DataFrame:
    return heavy_hitters(_same_lines(spark, d), ["s_suppkey"], share=0.05)


_DQ_SQL = "strftime(o_orderdate, '%G-W%V')"


@proof(
    "delivery_metrics",
    f"""SELECT {_DQ_SQL} AS week, count(*) AS rows, count(*) FILTER (o_totalprice > 300000) AS large, true AS distinct_close
        FROM orders GROUP BY 1""",
    ("DQ-01", "A-03"),
)
def q_delivery_metrics(spark: SparkSession, d: str) -> DataFrame:
    """State of two runs over the deliveries, the second of which repeats one week: exact counts per week, and distinct customers within five
    standard errors of the exact count."""
    path = scratch_path(spark, "dq-state")
    o = table(spark, d, "orders").withColumn("week", iso_week("o_orderdate"))
    counts = {"large": F.col("o_totalprice") > 300000}
    first = o.agg(F.min("week")).first()[0]
    add_delivery(o.filter(F.col("week") <= "1995-W01"), path, "week", "o_custkey", counts)
    add_delivery(o.filter((F.col("week") > "1995-W01") | (F.col("week") == F.lit(first))), path, "week", "o_custkey", counts)
    merged = merged_metrics(read_state(spark, path, "week"), ["week"])
    exact = o.groupBy("week").agg(F.count_distinct("o_custkey").alias("exact"))
    close = F.abs(F.col("distinct_keys") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.04)
    return merged.join(exact, "week").select("week", "rows", "large", close.alias("distinct_close"))


@proof(
    "delivery_returning_keys",
    f"""WITH k AS (SELECT DISTINCT year(o_orderdate)::VARCHAR AS year, o_custkey FROM orders),
        y AS (SELECT year, lag(year) OVER (ORDER BY year) AS before FROM (SELECT DISTINCT year FROM k))
        SELECT y.year, y.before, true AS close FROM y WHERE before IS NOT NULL""",
    ("DQ-01", "A-03"),
)
def q_returning_keys(spark: SparkSession, d: str) -> DataFrame:
    """Customers of a year who also ordered in the year before, from sketches alone, against the exact count."""
    path = scratch_path(spark, "dq-years")
    o = table(spark, d, "orders").withColumn("year", F.year("o_orderdate").cast("string"))
    add_delivery(o, path, "year", "o_custkey", {})
    found = returning_keys(read_state(spark, path, "year"), "year")
    keys = o.select("year", "o_custkey").distinct()
    earlier = keys.select((F.col("year").cast("int") + 1).cast("string").alias("year"), "o_custkey")
    exact = keys.join(earlier, ["year", "o_custkey"]).groupBy("year").agg(F.count(F.lit(1)).alias("exact"))
    # the error is relative to the keys of both years together
    close = F.abs(F.col("returning") - F.col("exact")) <= F.greatest(F.lit(2.0), F.col("exact") * 0.2)
    return found.join(exact, "year").select("year", "before", close.alias("close"))
