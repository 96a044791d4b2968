"""Proofs of delivery checks and serving marts (E-03, X-08, X-04, G-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.expressions import iso_week
from gridlake.operators import expectations as ex
from gridlake.operators.aggregates import binned_average, reconcile_manifest
from gridlake.operators.joins import dim_join
from gridlake.operators.layout import list_files
from gridlake.plans import defects
from gridlake.plans.marts import consumption_mart
from gridlake.plans.proofs_ingest import WEEK_SQL
from gridlake.plans.proofs_relational import customer_region, raw_orders
from gridlake.plans.registry import proof
from gridlake.plans.tables import table
from gridlake.session import scratch_path
from gridlake.sources.batch import read_manifest


@proof(
    "deliveries_per_period",
    f"""WITH w AS (SELECT DISTINCT {WEEK_SQL} AS period FROM orders)
        SELECT period, CAST(2 AS BIGINT) AS deliveries FROM w WHERE period LIKE '%7'""",
    ("E-03",),
)
def q_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """One file a week, a second one for weeks that end in 7: the weeks with another number of files than one."""
    root = scratch_path(spark, "deliveries")
    weeks = table(spark, d, "orders").select(iso_week("o_orderdate").alias("wk"), "o_orderkey").groupBy("wk").agg(F.count(F.lit(1)).alias("n"))
    weeks.repartition("wk").write.partitionBy("wk").option("header", True).csv(root)
    weeks.filter("wk like '%7'").repartition("wk").write.mode("append").partitionBy("wk").option("header", True).csv(root)
    return ex.deliveries_per_period(list_files(spark, root, "*.csv"), "path")


@proof(
    "manifest_file",
    f"""WITH d AS (SELECT {defects.RAW_ORDERS_SELECT} FROM orders)
        SELECT metric, n AS injected, n AS observed, true AS matches FROM (
          SELECT 'bad_price' AS metric, count(*) FILTER (NOT price > 0) AS n FROM d
          UNION ALL SELECT 'bad_code', count(*) FILTER (code = '99ZZZ') FROM d)""",
    ("X-08", "DQ-01"),
)
def q_manifest(spark: SparkSession, d: str) -> DataFrame:
    """The producer writes what it injected beside its data, as JSON; the check reads that file and the data."""
    root = scratch_path(spark, "with-manifest")
    raw = raw_orders(spark, d)
    raw.select("o_orderkey", "code", "price").write.option("header", True).csv(f"{root}/data")
    key = F.col("o_orderkey")
    injected = F.struct(F.count_if(key % 70 <= 1).alias("bad_price"), F.count_if(key % 50 == 1).alias("bad_code"))
    made = table(spark, d, "orders").agg(injected.alias("injected"))  # from the rule by which defects are dealt, not from the data
    made.select(F.to_json(F.struct("injected")).alias("value")).write.text(f"{root}/manifest")
    rows = spark.read.schema("o_orderkey long, code string, price double").option("header", True).csv(f"{root}/data")
    metrics = rows.agg(F.count_if(~(F.col("price") > 0)).alias("bad_price"), F.count_if(F.col("code") == "99ZZZ").alias("bad_code"))
    names = ["bad_price", "bad_code"]
    return reconcile_manifest(metrics, read_manifest(spark, f"{root}/manifest", names), names)


#: Inhabitants of a nation (fixed rule, query and oracle alike).
_POPULATION = "(n_nationkey + 1) * 1000"


@proof(
    "consumption_per_inhabitant",
    f"""SELECT n_nationkey, n_name, o_orderpriority AS sector, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total,
               round(sum(o_totalprice) / max({_POPULATION}), 4) AS per_capita
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3""",
    ("X-04", "J-01"),
)
def q_per_inhabitant(spark: SparkSession, d: str) -> DataFrame:
    """Total per place and sector, and per inhabitant of the place."""
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    use = dim_join(table(spark, d, "orders"), customer, [("o_custkey", "c_custkey")]).withColumnRenamed("o_orderpriority", "sector")
    nation = table(spark, d, "nation").select("n_nationkey", "n_name", F.expr(_POPULATION).alias("population"))
    return consumption_mart(use, nation, [("c_nationkey", "n_nationkey")], ["n_nationkey", "n_name", "sector"], "o_totalprice", "population")


@proof(
    "serve_one_region_curve",
    """SELECT r_name, round(o_totalprice / 25000) AS bin, count(*) AS n
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       WHERE r_name = 'EUROPE' GROUP BY 1, 2 ORDER BY 2""",
    ("G-10", "A-11", "O-01"),
)
def q_one_region(spark: SparkSession, d: str) -> DataFrame:
    """The curve of one region, in order of its bins; the filter reaches the dimension before the join."""
    orders = table(spark, d, "orders").select("o_custkey", "o_totalprice")
    one = customer_region(spark, d).filter(F.col("r_name") == "EUROPE").select("c_custkey", "r_name")
    placed = dim_join(orders, one, [("o_custkey", "c_custkey")])
    curve = binned_average(placed, ["r_name"], F.round(F.col("o_totalprice") / 25000), "o_totalprice")
    return curve.select("r_name", "bin", "n").orderBy("bin")
