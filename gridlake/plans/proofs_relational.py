"""Proofs for the relational operators (§2.3–2.7, 2.9, 2.10, 2.12, 2.13).

Every proof reads the driver's tables at ``sf_dir`` in full; its oracle is
ANSI SQL over the same tables in DuckDB. Computed columns carry the same alias
on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.expressions import trunc_wall

from gridlake.functions.expressions import full_match, iso_week, normalise_enum_col, pct_of
from gridlake.operators import aggregates as agg
from gridlake.operators import expectations as ex
from gridlake.operators.dedup import latest_per_key, repeated_keys
from gridlake.operators.flatten import flatten_envelope, flatten_parallel_arrays
from gridlake.operators.history import scd2
from gridlake.operators.joins import dim_join, join_on_time_bucket, ref_violations, salted_join
from gridlake.operators.quarantine import Rule, flag
from gridlake.plans import defects
from gridlake.plans.marts import SilverSpec, binned_join_mart, consumption_mart, priority_mart, ranked, silver_flagged
from gridlake.plans.registry import proof
from gridlake.plans.tables import table

HIGH = ("1-URGENT", "2-HIGH")


def raw_orders(spark: SparkSession, d: str) -> DataFrame:
    """Bronze-like extract: ``orders`` with injected defects (see :mod:`defects`)."""
    return table(spark, d, "orders").selectExpr(*defects.RAW_ORDERS_COLUMNS)


def code_valid():
    """NULL when the code is missing/blank (reported as ``code_missing``), else the format test."""
    c = F.col("code")
    return F.when(F.trim(c) != "", full_match(c, "[0-9]{5}"))


ORDER_RULES = [
    Rule("code_format", code_valid, when_null="code_missing"),
    Rule("price", "price > 0"),
]


def customer_nation(spark: SparkSession, d: str) -> DataFrame:
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    return dim_join(customer, nation, [("c_nationkey", "n_nationkey")])


# --------------------------------------------------------------------------- gold (G-08)

GOLD_PRIORITY_SQL = """
WITH l AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders)
SELECT n_nationkey, n_name,
       count(o_orderkey) AS n_customers,
       round(avg(o_totalprice), 2) AS mean_price,
       round(100.0 * sum(CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 1 ELSE 0 END) / count(*), 1) AS pct_high
FROM l JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE rn = 1
GROUP BY n_nationkey, n_name
HAVING count(o_orderkey) >= 20
"""


def gold_priority_df(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    latest = latest_per_key(orders, ["o_custkey"], ["o_orderdate"], ["o_orderkey"])
    return priority_mart(
        latest,
        customer_nation(spark, d),
        [("o_custkey", "c_custkey")],
        ["n_nationkey", "n_name"],
        id_col="o_orderkey",
        measure="o_totalprice",
        class_predicate=F.col("o_orderpriority").isin(*HIGH),
        min_support=20,
        measure_digits=2,
        names=("n_customers", "mean_price", "pct_high"),
    )


def customer_region(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, d, "region").select("r_regionkey", "r_name")
    geo = dim_join(nation, region, [("n_regionkey", "r_regionkey")]).select("n_nationkey", "r_regionkey", "r_name")
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return dim_join(customer, geo, [("c_nationkey", "n_nationkey")])


def gold_priority_region_df(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: latest order per customer → customer/nation/region dimension → mart per region."""
    orders = table(spark, d, "orders")
    latest = latest_per_key(orders, ["o_custkey"], ["o_orderdate"], ["o_orderkey"])
    return priority_mart(
        latest,
        customer_region(spark, d),
        [("o_custkey", "c_custkey")],
        ["r_regionkey", "r_name"],
        id_col="o_orderkey",
        measure="o_totalprice",
        class_predicate=F.col("o_orderpriority").isin(*HIGH),
        min_support=20,
        measure_digits=2,
        names=("n_customers", "mean_price", "pct_high"),
    )


@proof(
    "gold_priority_region",
    """WITH l AS (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
         FROM orders)
       SELECT r_regionkey, r_name,
              count(o_orderkey) AS n_customers,
              round(avg(o_totalprice), 2) AS mean_price,
              round(100.0 * sum(CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 1 ELSE 0 END) / count(*), 1) AS pct_high
       FROM l JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey
       WHERE rn = 1
       GROUP BY r_regionkey, r_name
       HAVING count(o_orderkey) >= 20""",
    ("G-08", "J-01", "L-01"),
)
def gold_priority_region(spark: SparkSession, d: str) -> DataFrame:
    return gold_priority_region_df(spark, d)


@proof("gold_priority", GOLD_PRIORITY_SQL, ("G-08", "J-01", "A-02", "A-06", "A-07", "A-09", "L-01"))
def gold_priority(spark: SparkSession, d: str) -> DataFrame:
    return gold_priority_df(spark, d)


@proof(
    "serve_top_priority",
    f"SELECT * FROM ({GOLD_PRIORITY_SQL}) ORDER BY pct_high DESC, n_nationkey LIMIT 10",
    ("G-10", "O-01", "O-02"),
)
def serve_top_priority(spark: SparkSession, d: str) -> DataFrame:
    return ranked(gold_priority_df(spark, d), "pct_high", ["n_nationkey"], k=10)


# --------------------------------------------------------------------------- silver (L-01, L-03, C-01)


@proof(
    "latest_per_key",
    """SELECT event_id, ts, user_id, event_type, value, props FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
         FROM events) WHERE rn = 1""",
    ("L-01", "W-01", "P-06"),
)
def q_latest_per_key(spark, d):
    return latest_per_key(table(spark, d, "events"), ["user_id", "event_type"], ["ts"], ["event_id"])


@proof(
    "latest_composite_key",
    """SELECT conv_id, turn, role, text FROM (
         SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) AS rn
         FROM conversations) WHERE rn = 1""",
    ("L-01",),
)
def q_latest_composite(spark, d):
    return latest_per_key(table(spark, d, "conversations"), ["conv_id", "role"], ["turn"])


@proof(
    "repeated_keys",
    """SELECT user_id, event_type, count(*) AS n_versions FROM events
       GROUP BY user_id, event_type HAVING count(*) > 1
       ORDER BY n_versions DESC, user_id, event_type LIMIT 10""",
    ("L-02", "A-09", "O-02"),
)
def q_repeated_keys(spark, d):
    return repeated_keys(table(spark, d, "events"), ["user_id", "event_type"], min_count=2, k=10)


QUARANTINE_SQL = f"""
WITH d AS (SELECT {defects.RAW_ORDERS_SELECT} FROM orders)
SELECT o_orderkey, code, price,
       concat_ws(',', {defects.CODE_REASON_SQL}, {defects.PRICE_REASON_SQL}) <> '' AS _quarantined
FROM d
"""


@proof("quarantine_split", QUARANTINE_SQL, ("L-03", "F-02", "F-03", "K-08"))
def q_quarantine_split(spark, d):
    return flag(raw_orders(spark, d), ORDER_RULES).select("o_orderkey", "code", "price", "_quarantined")


@proof(
    "quarantine_reasons",
    f"""WITH d AS (SELECT {defects.RAW_ORDERS_SELECT} FROM orders),
         r AS (SELECT o_orderkey, concat_ws(',', {defects.CODE_REASON_SQL}, {defects.PRICE_REASON_SQL}) AS reasons FROM d)
        SELECT o_orderkey, reasons FROM r WHERE reasons <> ''""",
    ("L-03",),
)
def q_quarantine_reasons(spark, d):
    f = flag(raw_orders(spark, d), ORDER_RULES)
    return f.filter("_quarantined").select("o_orderkey", F.concat_ws(",", "_dq_reasons").alias("reasons"))


SILVER_SPEC = SilverSpec(keys=["o_custkey"], order_by=["o_orderdate"], tie_breakers=["o_orderkey"], enums=["priority"], rules=ORDER_RULES)

SILVER_SQL = f"""
WITH d AS (SELECT {defects.RAW_ORDERS_SELECT} FROM orders),
     l AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM d),
     s AS (SELECT o_orderkey, o_custkey, code, price,
                  CASE WHEN trim(priority) = '' THEN NULL ELSE upper(trim(priority)) END AS priority,
                  concat_ws(',', {defects.CODE_REASON_SQL}, {defects.PRICE_REASON_SQL}) AS reasons
           FROM l WHERE rn = 1)
"""


@proof(
    "silver_good",
    SILVER_SQL + "SELECT o_orderkey, o_custkey, code, price, priority FROM s WHERE reasons = ''",
    ("G-07", "C-01", "L-01", "L-03"),
)
def q_silver_good(spark, d):
    f = silver_flagged(raw_orders(spark, d), SILVER_SPEC)
    return f.filter(~F.col("_quarantined")).select("o_orderkey", "o_custkey", "code", "price", "priority")


@proof(
    "silver_quarantine",
    SILVER_SQL + "SELECT o_orderkey, o_custkey, code, price, priority, reasons FROM s WHERE reasons <> ''",
    ("G-07", "L-03"),
)
def q_silver_quarantine(spark, d):
    f = silver_flagged(raw_orders(spark, d), SILVER_SPEC)
    return f.filter("_quarantined").select(
        "o_orderkey", "o_custkey", "code", "price", "priority", F.concat_ws(",", "_dq_reasons").alias("reasons")
    )


@proof(
    "layer_reconcile",
    SILVER_SQL
    + """SELECT CAST((SELECT count(*) FROM d) AS BIGINT) AS bronze,
               CAST((SELECT count(*) FROM s WHERE reasons = '') AS BIGINT) AS good,
               CAST((SELECT count(*) FROM s WHERE reasons <> '') AS BIGINT) AS bad,
               CAST((SELECT count(*) FROM d) - (SELECT count(DISTINCT o_custkey) FROM d) AS BIGINT) AS superseded,
               true AS balanced""",
    ("L-06", "A-01"),
)
def q_layer_reconcile(spark, d):
    bronze = raw_orders(spark, d)
    f = silver_flagged(bronze, SILVER_SPEC)
    good, bad = f.filter(~F.col("_quarantined")), f.filter("_quarantined")
    return agg.reconcile(bronze, good, bad, ["o_custkey"])


@proof(
    "normalise_enum",
    """SELECT o_orderkey,
              CASE WHEN trim(p) = '' THEN NULL ELSE upper(trim(p)) END AS priority
       FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 30 = 0 THEN lower(o_orderpriority) || ' ' ELSE o_orderpriority END AS p FROM orders)""",
    ("C-01",),
)
def q_normalise_enum(spark, d):
    raw = raw_orders(spark, d)
    return raw.select("o_orderkey", normalise_enum_col("priority").alias("priority"))


# --------------------------------------------------------------------------- DQ (DQ-01, A-03, A-04)

DQ_SQL = f"""
WITH d AS (SELECT {defects.RAW_ORDERS_SELECT} FROM orders)
SELECT strftime(o_orderdate, '%G-W%V') AS week,
       count(*) AS n_rows,
       count(*) - count(DISTINCT o_custkey) AS dup_or_rediag,
       count(*) FILTER (WHERE NOT coalesce(price > 0, false)) AS price,
       count(*) FILTER (WHERE NOT coalesce(trim(code) <> '' AND regexp_full_match(code, '[0-9]{{5}}'), false)) AS code_format
FROM d GROUP BY 1
"""


@proof("dq_metrics", DQ_SQL, ("DQ-01", "A-03", "A-04", "A-08", "C-06"))
def q_dq_metrics(spark, d):
    rules = [Rule("price", "price > 0"), Rule("code_format", code_valid)]
    return agg.dq_metrics(raw_orders(spark, d), [iso_week("o_orderdate").alias("week")], key="o_custkey", rules=rules)


@proof(
    "duplicate_excess",
    """SELECT o_orderstatus, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_distinct,
              count(*) - count(DISTINCT o_custkey) AS dup_excess
       FROM orders GROUP BY 1""",
    ("A-03",),
)
def q_duplicate_excess(spark, d):
    return agg.duplicate_excess(table(spark, d, "orders"), "o_custkey", ["o_orderstatus"])


@proof(
    "row_counts",
    """SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2""",
    ("A-01", "A-08"),
)
def q_row_counts(spark, d):
    return agg.row_counts(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"])


@proof(
    "time_coverage",
    """SELECT event_type, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1""",
    ("A-05",),
)
def q_time_coverage(spark, d):
    return agg.time_coverage(table(spark, d, "events"), "ts", ["event_type"])


@proof(
    "union_sources",
    """SELECT 'orders' AS src, count(*) AS n, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts FROM orders
       UNION ALL
       SELECT 'lineitem', count(*), min(l_shipdate), max(l_shipdate) FROM lineitem
       UNION ALL
       SELECT 'events', count(*), min(ts), max(ts) FROM events""",
    ("G-11", "U-01", "P-08", "A-05"),
)
def q_union_sources(spark, d):
    return agg.coverage_report(
        {
            "orders": table(spark, d, "orders").select(F.col("o_orderdate").alias("ts")),
            "lineitem": table(spark, d, "lineitem").select(F.col("l_shipdate").alias("ts")),
            "events": table(spark, d, "events").select("ts"),
        },
        "ts",
    )


@proof(
    "pct_in_class",
    """SELECT lang, count(*) AS n,
              round(100.0 * sum(CASE WHEN l.quality = 1 THEN 1 ELSE 0 END) / count(*), 1) AS pct_quality
       FROM documents JOIN labels l USING (doc_id) GROUP BY lang""",
    ("A-07", "C-09"),
)
def q_pct_in_class(spark, d):
    j = dim_join(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), ["doc_id"])
    return agg.pct_in_class(j, ["lang"], F.col("quality") == 1, 1, pct_name="pct_quality")


@proof(
    "binned_average",
    """SELECT l_returnflag, CAST(round(l_discount * 100) AS INTEGER) AS bin, count(*) AS n,
              round(avg(l_quantity), 4) AS mean_value
       FROM lineitem GROUP BY 1, 2""",
    ("A-11", "A-06", "C-05"),
)
def q_binned_average(spark, d):
    li = table(spark, d, "lineitem")
    return agg.binned_average(li, ["l_returnflag"], F.round(F.col("l_discount") * 100).cast("int"), "l_quantity", digits=4)


@proof(
    "key_skew",
    """SELECT min(n) AS min_rows, max(n) AS max_rows, round(avg(n), 4) AS avg_rows,
              round(max(n) / avg(n), 4) AS skew_ratio, count(*) AS n_keys
       FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1)""",
    ("M-06", "A-10"),
)
def q_key_skew(spark, d):
    return agg.key_skew(table(spark, d, "events"), ["user_id"], digits=4)


@proof(
    "hot_keys",
    """SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 3""",
    ("M-07", "O-02"),
)
def q_hot_keys(spark, d):
    return agg.hot_keys(table(spark, d, "lineitem"), ["l_partkey"], 3)


@proof(
    "top_k_keys",
    """SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 10""",
    ("O-02",),
)
def q_top_k_keys(spark, d):
    return agg.hot_keys(table(spark, d, "lineitem"), ["l_suppkey"], 10)


@proof(
    "rows_of_top_keys",
    """WITH top AS (SELECT l_partkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_partkey LIMIT 3)
       SELECT * FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM top)""",
    ("F-06", "F-04"),
)
def q_rows_of_top_keys(spark, d):
    return agg.rows_of_top_keys(table(spark, d, "lineitem"), ["l_partkey"], 3)


@proof(
    "corr_by_group",
    """SELECT l_returnflag, count(*) AS n, round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem GROUP BY 1""",
    ("X-07",),
)
def q_corr(spark, d):
    return agg.corr_by_group(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice", 6)


@proof(
    "weighted_mean",
    """SELECT l_returnflag, sum(l_quantity) AS weight,
              round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS weighted_mean
       FROM lineitem GROUP BY 1""",
    ("X-10",),
)
def q_weighted_mean(spark, d):
    return agg.weighted_mean(table(spark, d, "lineitem"), ["l_returnflag"], "l_discount", "l_quantity", 6)


# --------------------------------------------------------------------------- filters (F-01 … F-05)


@proof(
    "filter_compare",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem WHERE l_quantity > 25 AND l_discount <= 0.05""",
    ("F-01", "E-06", "P-03"),
)
def q_filter_compare(spark, d):
    li = table(spark, d, "lineitem")
    return li.filter((F.col("l_quantity") > 25) & (F.col("l_discount") <= 0.05)).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount"
    )


@proof(
    "filter_regex",
    f"""WITH d AS (SELECT {defects.RAW_ORDERS_SELECT} FROM orders)
        SELECT o_orderkey, code FROM d WHERE NOT coalesce(regexp_full_match(code, '[0-9]{{5}}'), false)""",
    ("F-02", "E-05"),
)
def q_filter_regex(spark, d):
    return ex.format_violations(raw_orders(spark, d), "code", "[0-9]{5}").select("o_orderkey", "code")


@proof(
    "filter_in",
    """SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('R', 'A')""",
    ("F-04",),
)
def q_filter_in(spark, d):
    return table(spark, d, "lineitem").filter(F.col("l_returnflag").isin("R", "A")).select(
        "l_orderkey", "l_linenumber", "l_returnflag"
    )


@proof(
    "range_violations",
    f"""WITH d AS (SELECT {defects.RAW_ORDERS_SELECT} FROM orders)
        SELECT o_orderkey, price FROM d WHERE NOT coalesce(price > 0, false)""",
    ("E-06", "F-01", "F-05"),
)
def q_range_violations(spark, d):
    return ex.range_violations(raw_orders(spark, d), "price", lo=0, inclusive=False).select("o_orderkey", "price")


# --------------------------------------------------------------------------- joins (J-01, J-02, X-02, X-05)


@proof(
    "dim_join",
    """SELECT l_orderkey, l_linenumber, l_suppkey, s_name, s_nationkey
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    ("J-01",),
)
def q_dim_join(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    sup = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return dim_join(li, sup, [("l_suppkey", "s_suppkey")]).select("l_orderkey", "l_linenumber", "l_suppkey", "s_name", "s_nationkey")


@proof(
    "salted_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey""",
    ("X-05",),
)
def q_salted_join(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey"))
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    # max_broadcast_rows=0 takes the salted shuffle path even though `part` would fit a broadcast.
    return salted_join(li, part, ["l_partkey"], salt_buckets=8, salt_cols=["l_orderkey", "l_linenumber"], max_broadcast_rows=0).select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_brand"
    )


@proof(
    "ref_violations",
    """SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL""",
    ("X-02",),
)
def q_ref_violations(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return ref_violations(docs, table(spark, d, "labels"), ["doc_id"])


def hourly_series(spark: SparkSession, d: str) -> DataFrame:
    """Coarse series derived from ``events``: per event type and hour, the mean value in
    integer 10-unit bins computed from exact cents (no float ties)."""
    ev = table(spark, d, "events")
    cents = F.round(F.col("value") * 100).cast("long")
    return (
        ev.groupBy("event_type", trunc_wall("ts", "hour").alias("hour"))
        .agg(F.sum(cents).alias("_c"), F.count(F.lit(1)).alias("_n"))
        .select(
            F.col("event_type").alias("h_event_type"),
            "hour",
            F.floor(F.col("_c") / (F.col("_n") * 1000)).cast("long").alias("mean_bin"),
        )
    )


HOUR_JOIN_SQL = """
WITH h AS (
  SELECT event_type AS h_event_type, date_trunc('hour', ts) AS hour,
         CAST(floor(sum(CAST(round(value * 100) AS BIGINT)) / (count(*) * 1000)) AS BIGINT) AS mean_bin
  FROM events GROUP BY 1, 2)
SELECT e.event_type, h.mean_bin AS bin, count(*) AS n_matches,
       CAST(sum(CAST(round(e.value * 100) AS BIGINT)) AS BIGINT) AS sum_cents
FROM events e JOIN h ON e.event_type = h.h_event_type AND date_trunc('hour', e.ts) = h.hour
GROUP BY 1, 2
"""


@proof("hour_bucket_join", HOUR_JOIN_SQL, ("J-02", "C-04", "A-11"))
def q_hour_bucket_join(spark, d):
    ev = table(spark, d, "events").select("event_type", "ts", "value")
    j = join_on_time_bucket(ev, hourly_series(spark, d), ["event_type"], ["h_event_type"], "ts", "hour", unit="hour")
    return j.groupBy("event_type", F.col("mean_bin").alias("bin")).agg(
        F.count(F.lit(1)).alias("n_matches"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("sum_cents")
    )


@proof(
    "gold_binned_join",
    """WITH h AS (
         SELECT event_type AS h_event_type, date_trunc('hour', ts) AS hour,
                CAST(floor(sum(CAST(round(value * 100) AS BIGINT)) / (count(*) * 1000)) AS BIGINT) AS mean_bin
         FROM events GROUP BY 1, 2)
       SELECT e.event_type, h.mean_bin AS bin, count(*) AS n_matches,
              avg(CAST(round(e.value * 100) AS BIGINT)) AS mean_measure
       FROM events e JOIN h ON e.event_type = h.h_event_type AND date_trunc('hour', e.ts) = h.hour
       GROUP BY 1, 2""",
    ("G-09", "J-02", "A-06", "A-11"),
)
def q_gold_binned_join(spark, d):
    # The measure is averaged in integer cents: an exact sum, so the mean does not depend on the
    # order in which partial sums are combined (float sums of decimals do).
    ev = table(spark, d, "events").select("event_type", "ts", F.round(F.col("value") * 100).cast("long").alias("value_cents"))
    return binned_join_mart(
        ev, hourly_series(spark, d), ["event_type"], ["h_event_type"], "ts", "hour", F.col("mean_bin"), "value_cents", digits=None
    )


@proof(
    "gold_consumption",
    """SELECT n_nationkey, n_name, count(*) AS n_rows, round(sum(l_extendedprice), 2) AS total
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       GROUP BY 1, 2""",
    ("X-04", "J-01"),
)
def q_gold_consumption(spark, d):
    sup = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    dim = dim_join(sup, nation, [("s_nationkey", "n_nationkey")]).select(F.col("s_suppkey").alias("l_suppkey"), "n_nationkey", "n_name")
    li = table(spark, d, "lineitem").select("l_suppkey", "l_extendedprice")
    return consumption_mart(li, dim, ["l_suppkey"], ["n_nationkey", "n_name"], "l_extendedprice")


# --------------------------------------------------------------------------- nested (L-04, L-05, C-07, C-08)


@proof(
    "zip_explode",
    """SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, embedding[i] AS v
       FROM embeddings, unnest(generate_series(1, len(embedding))) AS t(i)""",
    ("L-04", "C-08", "P-05"),
)
def q_zip_explode(spark, d):
    emb = table(spark, d, "embeddings")
    with_idx = emb.withColumn("idx", F.sequence(F.lit(0), F.size("embedding") - 1))
    return flatten_parallel_arrays(with_idx, ["idx", "embedding"], keep=["vec_id"], names=["pos", "v"])


def event_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """API-pull-like envelopes from ``events``: per day and block of 16 consecutive ids, an
    array of record structs and a ``pull_ts`` (latest instant in the envelope). Blocks
    bound every envelope to 16 records whatever the data size."""
    ev = table(spark, d, "events")
    return ev.groupBy(F.to_date("ts").alias("day"), F.expr("event_id div 16").alias("block")).agg(
        F.max("ts").alias("pull_ts"),
        F.collect_list(F.struct("event_id", "ts", "user_id", "event_type", "value")).alias("records"),
    )


@proof(
    "explode_records",
    """SELECT max(ts) OVER (PARTITION BY CAST(ts AS DATE), event_id // 16) AS pull_ts,
              event_id, ts, user_id, event_type, value
       FROM events""",
    ("L-05", "C-07", "P-04"),
)
def q_explode_records(spark, d):
    return flatten_envelope(event_envelopes(spark, d), "records", keep=["pull_ts"])


@proof(
    "lateness_report",
    """WITH env AS (SELECT ts, max(ts) OVER (PARTITION BY CAST(ts AS DATE), event_id // 16) AS pull_ts FROM events)
       SELECT date_trunc('hour', ts) AS hour, count(*) AS n,
              count(*) FILTER (WHERE date_diff('microsecond', ts, pull_ts) > 1800000000) AS n_late,
              max(date_diff('microsecond', ts, pull_ts)) AS max_lateness_us
       FROM env GROUP BY 1""",
    ("T-03",),
)
def q_lateness_report(spark, d):
    from gridlake.streaming.latest import lateness_report

    flat = flatten_envelope(event_envelopes(spark, d), "records", keep=["pull_ts"])
    return lateness_report(flat, "ts", "pull_ts", late_after_us=1_800_000_000)


# --------------------------------------------------------------------------- expectations (E-*)


@proof(
    "expect_unique",
    """SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1""",
    ("E-07", "A-09"),
)
def q_expect_unique(spark, d):
    return ex.unique_violations(table(spark, d, "events"), ["user_id", "event_type"])


@proof(
    "array_length",
    """SELECT vec_id, label FROM embeddings WHERE NOT coalesce(len(embedding) = 64, false)
       UNION ALL
       SELECT vec_id, label FROM embeddings WHERE NOT coalesce(len(embedding) = 32, false)""",
    ("E-09",),
)
def q_array_length(spark, d):
    emb = table(spark, d, "embeddings")
    ok64 = ex.array_length_violations(emb, ["embedding"], 64).select("vec_id", "label")
    ok32 = ex.array_length_violations(emb, ["embedding"], 32).select("vec_id", "label")
    return ok64.unionByName(ok32)


@proof(
    "closed_enum",
    """SELECT value, 'unexpected' AS issue FROM (SELECT DISTINCT role AS value FROM conversations)
         WHERE value NOT IN ('user', 'assistant', 'tool')
       UNION ALL
       SELECT value, 'missing' AS issue FROM (VALUES ('user'), ('assistant'), ('tool')) t(value)
         WHERE value NOT IN (SELECT DISTINCT role FROM conversations)""",
    ("E-10",),
)
def q_closed_enum(spark, d):
    return ex.closed_enum(table(spark, d, "conversations"), "role", ["user", "assistant", "tool"])


@proof(
    "missing_periods",
    """WITH p AS (SELECT DISTINCT date_trunc('day', o_orderdate) AS p FROM orders)
       SELECT CAST(g AS TIMESTAMP) AS period
       FROM generate_series((SELECT min(p) FROM p), (SELECT max(p) FROM p), INTERVAL 1 DAY) AS t(g)
       WHERE g NOT IN (SELECT p FROM p)""",
    ("E-03",),
)
def q_missing_periods(spark, d):
    return ex.missing_periods(table(spark, d, "orders"), "o_orderdate", unit="day")


@proof(
    "delivery_overlap",
    """WITH k AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
            n AS (SELECT day, dense_rank() OVER (ORDER BY day) AS r FROM (SELECT DISTINCT day FROM k)),
            kn AS (SELECT user_id, r FROM k JOIN n USING (day)),
            s AS (SELECT a.r, count(*) AS shared FROM kn a JOIN kn b ON a.user_id = b.user_id AND b.r = a.r + 1 GROUP BY a.r)
       SELECT a.day AS delivery, b.day AS next_delivery, CAST(coalesce(s.shared, 0) AS BIGINT) AS shared_keys
       FROM n a JOIN n b ON b.r = a.r + 1 LEFT JOIN s ON s.r = a.r""",
    ("E-11",),
)
def q_delivery_overlap(spark, d):
    ev = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"))
    return ex.delivery_overlap(ev, ["user_id"], "day")


@proof(
    "scd2",
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate AS valid_from,
              lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to,
              lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) IS NULL AS is_current
       FROM orders""",
    ("X-01",),
)
def q_scd2(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return scd2(o, ["o_custkey"], "o_orderdate", ["o_orderkey", "o_orderstatus"], tie_breakers=["o_orderkey"], collapse=False, slice_unit="year")


@proof(
    "scd2_collapsed",
    """WITH o AS (SELECT o_custkey, o_orderstatus, o_orderdate, o_orderkey,
                        lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev
                 FROM orders),
            c AS (SELECT * FROM o WHERE prev IS NULL OR prev <> o_orderstatus)
       SELECT o_custkey, o_orderstatus, o_orderdate AS valid_from,
              lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to,
              lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) IS NULL AS is_current
       FROM c""",
    ("X-01",),
)
def q_scd2_collapsed(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    out = scd2(o, ["o_custkey"], "o_orderdate", ["o_orderstatus"], tie_breakers=["o_orderkey"], collapse=True, slice_unit="year")
    return out.drop("o_orderkey")


@proof(
    "pct_high_share",
    """SELECT o_orderstatus, count(*) AS n,
              round(100.0 * sum(CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 1 ELSE 0 END) / count(*), 1) AS pct_high
       FROM orders GROUP BY 1""",
    ("A-07", "F-04"),
)
def q_pct_high_share(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), pct_of(F.col("o_orderpriority").isin(*HIGH), 1).alias("pct_high"))


@proof(
    "sql_form_report",
    """SELECT o_orderpriority, count(*) AS n, CAST(sum(CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END) AS BIGINT) AS n_large,
              min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
       FROM orders GROUP BY 1 HAVING count(*) > 1""",
    ("P-07", "S-08", "A-04", "A-08", "A-09"),
)
def q_sql_form_report(spark, d):
    """The SQL form: catalog views + ``spark.sql`` (same Catalyst plan as the DataFrame API)."""
    from gridlake.plans.tables import register_views

    register_views(spark, d)
    return spark.sql(
        """SELECT o_orderpriority, count(*) AS n, CAST(sum(CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END) AS BIGINT) AS n_large,
                  min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
           FROM orders GROUP BY 1 HAVING count(*) > 1"""
    )


@proof(
    "manifest_reconcile",
    f"""WITH d AS (SELECT {defects.RAW_ORDERS_SELECT} FROM orders)
        SELECT 'bad_code' AS metric,
               CAST(count(*) FILTER (WHERE o_orderkey % 50 IN (0, 1, 2)) AS BIGINT) AS injected,
               CAST(count(*) FILTER (WHERE NOT coalesce(trim(code) <> '' AND regexp_full_match(code, '[0-9]{{5}}'), false)) AS BIGINT) AS observed,
               true AS matches
        FROM d
        UNION ALL
        SELECT 'price', CAST(count(*) FILTER (WHERE o_orderkey % 70 IN (0, 1)) AS BIGINT),
               CAST(count(*) FILTER (WHERE NOT coalesce(price > 0, false)) AS BIGINT), true
        FROM d""",
    ("X-08", "DQ-01"),
)
def q_manifest_reconcile(spark, d):
    """Injected-vs-observed: a manifest (what the producer says it injected) against DQ totals."""
    from gridlake.operators.aggregates import reconcile_manifest

    raw = raw_orders(spark, d)
    manifest = raw.agg(
        F.count_if(F.col("o_orderkey") % 50 < 3).alias("bad_code"),
        F.count_if(F.col("o_orderkey") % 70 < 2).alias("price"),
    )
    metrics = agg.dq_metrics(raw, [F.lit(1).alias("all")], rules=[Rule("bad_code", code_valid), Rule("price", "price > 0")])
    return reconcile_manifest(metrics, manifest, ["bad_code", "price"])


@proof(
    "freshness",
    """SELECT 'events' AS source, max(ts) AS last_event, true AS ingested, false AS within_sla FROM events
       UNION ALL SELECT 'orders', max(o_orderdate), true, false FROM orders""",
    ("X-09", "P-01", "C-03"),
)
def q_freshness(spark, d):
    """Lag between the newest event and the ingestion instant, per source, against an SLA."""
    from gridlake.operators.aggregates import freshness
    from gridlake.sources.batch import with_audit

    ev = table(spark, d, "events").select(F.lit("events").alias("source"), "ts")
    od = table(spark, d, "orders").select(F.lit("orders").alias("source"), F.col("o_orderdate").alias("ts"))
    bronze = with_audit(ev.unionByName(od), source_col=None)
    report = freshness(bronze, "source", "ts", "_ingested_at", sla_seconds=30 * 60)
    return report.select("source", "last_event", F.col("last_ingested").isNotNull().alias("ingested"), "within_sla")


# --------------------------------------------------------------------------- hot keys (a third of all rows on one key)

HOT_KEY_SQL = "CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_partkey END"


def skewed_lineitem(spark: SparkSession, d: str) -> DataFrame:
    """``lineitem`` with every third order's key moved to one hot key (no row dropped)."""
    return table(spark, d, "lineitem").withColumn("k", F.expr(HOT_KEY_SQL))


@proof(
    "skew_latest_per_key",
    f"""SELECT k, l_orderkey, l_linenumber, l_shipdate FROM (
          SELECT *, {HOT_KEY_SQL} AS k,
                 row_number() OVER (PARTITION BY {HOT_KEY_SQL}
                                    ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
          FROM lineitem) WHERE rn = 1""",
    ("L-01", "W-01", "X-05"),
)
def q_skew_latest(spark, d):
    """Latest row per key when one key holds a third of the table: the partial window limit
    keeps one row per map task for it before the shuffle."""
    li = skewed_lineitem(spark, d)
    return latest_per_key(li, ["k"], ["l_shipdate"], ["l_orderkey", "l_linenumber"]).select("k", "l_orderkey", "l_linenumber", "l_shipdate")


@proof(
    "skew_salted_join",
    f"""SELECT p_brand, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty
        FROM (SELECT {HOT_KEY_SQL} AS k, l_quantity FROM lineitem) li JOIN part ON li.k = part.p_partkey
        GROUP BY p_brand""",
    ("X-05", "J-01"),
)
def q_skew_salted_join(spark, d):
    """Shuffle join whose hot key is split over 16 salts (forced: ``part`` would fit a broadcast)."""
    li = skewed_lineitem(spark, d).select("k", "l_quantity", "l_orderkey", "l_linenumber")
    part = table(spark, d, "part").select(F.col("p_partkey").alias("k"), "p_brand")
    j = salted_join(li, part, ["k"], salt_buckets=16, salt_cols=["l_orderkey", "l_linenumber"], max_broadcast_rows=0)
    return j.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("qty"))
