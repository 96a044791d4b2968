"""Aggregate operators: DQ metrics (DQ-01), coverage, skew and hot keys, binned means,
class shares, correlation and weighted means.

All are single ``groupBy().agg()`` passes: partial aggregation runs map-side,
so a hot group costs one partial row per map task on the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.expressions import as_column, pct_of, total
from gridlake.operators.quarantine import Rule, _as_rules


def _nz(c: Column, null_when_zero: bool) -> Column:
    return F.when(c > 0, c) if null_when_zero else c


def dq_metrics(
    df: DataFrame,
    by: Sequence[str | Column],
    key: str | None = None,
    rules: Sequence[Rule] | Mapping[str, Column | str] = (),
    rescued_col: str | None = None,
    null_when_zero: bool = False,
    approx_distinct: bool = False,
    rows_col: str = "n_rows",
    dup_col: str = "dup_or_rediag",
) -> DataFrame:
    """Per-group row count, duplicate excess on ``key``, violations per rule, rescued rows.

    A violation is a row where the validity predicate is false *or NULL*
    (``count_if(NOT coalesce(p, false))``), so blanks are counted too.
    ``null_when_zero`` reproduces the parity form ``SUM(CASE … THEN 1 END)``
    that reports NULL instead of 0 for a clean group.
    """
    rules = _as_rules(rules)
    by_cols = [as_column(b) for b in by]
    viol = [(r.name, ~total(r.predicate())) for r in rules]
    if rescued_col is not None:
        viol.append(("rescued", F.col(rescued_col).isNotNull()))
    if key is None or approx_distinct:
        aggs: list[Column] = [F.count(F.lit(1)).alias(rows_col)]
        if key is not None:
            aggs.append((F.count(F.lit(1)) - F.approx_count_distinct(key)).alias(dup_col))
        aggs += [_nz(F.count_if(v), null_when_zero).alias(n) for n, v in viol]
        return df.groupBy(*by_cols).agg(*aggs)
    # Exact distinct without Spark's Expand rewrite (which copies every row once per
    # aggregate group): first aggregate per (group, key) — map-side partial aggregation
    # folds a hot key to one row per task — then per group. Keys with a NULL value are
    # not counted as distinct, as in COUNT(DISTINCT key).
    per_key = df.groupBy(*by_cols, F.col(key).alias("_k")).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(v).alias(f"_v{i}") for i, (_, v) in enumerate(viol)]
    )
    group_names = per_key.columns[: len(by_cols)]
    rows = F.sum("_rows")
    aggs = [rows.alias(rows_col), (rows - F.count("_k")).alias(dup_col)]
    aggs += [_nz(F.sum(f"_v{i}"), null_when_zero).alias(n) for i, (n, _) in enumerate(viol)]
    return per_key.groupBy(*group_names).agg(*aggs)


def row_counts(df: DataFrame, by: Sequence[str] = (), count_col: str = "n") -> DataFrame:
    """``COUNT(*)`` globally or per group (A-01)."""
    if not by:
        return df.agg(F.count(F.lit(1)).alias(count_col))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(count_col))


def time_coverage(df: DataFrame, ts: str, by: Sequence[str] = (), label: str | None = None) -> DataFrame:
    """Rows, first and last instant (A-05), optionally tagged with a literal source label (P-08)."""
    aggs = [F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")]
    out = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    if label is not None:
        out = out.select(F.lit(label).alias("src"), *out.columns)
    return out


def coverage_report(sources: Mapping[str, DataFrame], ts: str) -> DataFrame:
    """UNION ALL of per-source coverage rows (G-11). Timestamps are cast explicitly so a
    string source cannot silently change the column type of the union."""
    parts = []
    for label, df in sources.items():
        d = df.select(F.col(ts).cast("timestamp_ntz").alias(ts))
        parts.append(time_coverage(d, ts, label=label))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def key_skew(df: DataFrame, keys: Sequence[str], digits: int | None = None) -> DataFrame:
    """min / max / mean rows per key and max ÷ mean (M-06): a two-level aggregate."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    mean = F.avg("_n")
    ratio = F.max("_n") / mean
    if digits is not None:
        mean, ratio = F.round(mean, digits), F.round(ratio, digits)
    return per_key.agg(
        F.min("_n").alias("min_rows"),
        F.max("_n").alias("max_rows"),
        mean.alias("avg_rows"),
        ratio.alias("skew_ratio"),
        F.count(F.lit(1)).alias("n_keys"),
    )


def hot_keys(df: DataFrame, keys: Sequence[str], k: int = 3, count_col: str = "n") -> DataFrame:
    """Top-k keys by row count (M-07); ties broken by key so the answer is stable."""
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    return agg.orderBy(F.col(count_col).desc(), *[F.col(c).asc() for c in keys]).limit(k)


def rows_of_top_keys(df: DataFrame, keys: Sequence[str], k: int = 3) -> DataFrame:
    """All rows whose key is among the top-k most frequent (F-06).

    The top-k list is at most ``k`` rows, so broadcasting it is size-proven;
    a left-semi join replaces "collect the codes, paste them into an IN list".
    """
    top = hot_keys(df, keys, k).select(*keys)
    return df.join(F.broadcast(top), list(keys), "left_semi")


def binned_average(
    df: DataFrame,
    by: Sequence[str],
    bin_expr: Column,
    value: str,
    bin_name: str = "bin",
    count_name: str = "n",
    mean_name: str = "mean_value",
    digits: int | None = None,
) -> DataFrame:
    """Count and mean of ``value`` per group and bin (A-11, e.g. ``round(temperature)``)."""
    mean = F.avg(value)
    if digits is not None:
        mean = F.round(mean, digits)
    return df.groupBy(*by, bin_expr.alias(bin_name)).agg(F.count(F.lit(1)).alias(count_name), mean.alias(mean_name))


def pct_in_class(
    df: DataFrame,
    by: Sequence[str],
    predicate: Column,
    digits: int = 1,
    pct_name: str = "pct",
    count_name: str = "n",
) -> DataFrame:
    """Share (%) of rows per group for which ``predicate`` holds (A-07), as DOUBLE."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(count_name), pct_of(predicate, digits).alias(pct_name))


def duplicate_excess(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """``COUNT(*) - COUNT(DISTINCT key)`` globally or per group (A-03)."""
    exprs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.col(key)).alias("n_distinct"),
        (F.count(F.lit(1)) - F.count_distinct(F.col(key))).alias("dup_excess"),
    ]
    return df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)


def corr_by_group(df: DataFrame, by: Sequence[str], x: str, y: str, digits: int | None = None) -> DataFrame:
    """Pearson correlation of two measures per group (X-07)."""
    c = F.corr(x, y)
    if digits is not None:
        c = F.round(c, digits)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), c.alias("corr"))


def weighted_mean(df: DataFrame, by: Sequence[str], value: str, weight: str, digits: int | None = None) -> DataFrame:
    """Non-additive ratio rollup ``sum(x*w)/sum(w)`` (X-10): rolls up correctly, unlike avg(x)."""
    m = F.sum(F.col(value) * F.col(weight)) / F.sum(weight)
    if digits is not None:
        m = F.round(m, digits)
    return df.groupBy(*by).agg(F.sum(weight).alias("weight"), m.alias("weighted_mean"))


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named layer with its row count — a single UNION ALL job (L-06)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n") for name, df in layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reconcile(
    bronze: DataFrame,
    good: DataFrame,
    bad: DataFrame,
    keys: Sequence[str],
) -> DataFrame:
    """Layer reconciliation: bronze = good + bad + superseded, with a boolean ``balanced``.

    ``superseded`` is bronze minus one row per distinct key — the versions the
    latest-wins dedup removed. One row, one job (three aggregates unioned).
    """
    counts = (
        bronze.agg(F.count(F.lit(1)).alias("v"), F.count_distinct(F.struct(*[F.col(k) for k in keys])).alias("d"))
        .select(F.lit("bronze").alias("layer"), "v", "d")
        .unionByName(good.agg(F.count(F.lit(1)).alias("v")).select(F.lit("good").alias("layer"), "v", F.lit(0).cast("long").alias("d")))
        .unionByName(bad.agg(F.count(F.lit(1)).alias("v")).select(F.lit("bad").alias("layer"), "v", F.lit(0).cast("long").alias("d")))
    )
    piv = counts.agg(
        F.max(F.when(F.col("layer") == "bronze", F.col("v"))).alias("bronze"),
        F.max(F.when(F.col("layer") == "bronze", F.col("d"))).alias("bronze_keys"),
        F.max(F.when(F.col("layer") == "good", F.col("v"))).alias("good"),
        F.max(F.when(F.col("layer") == "bad", F.col("v"))).alias("bad"),
    )
    return piv.select(
        "bronze",
        "good",
        "bad",
        (F.col("bronze") - F.col("bronze_keys")).alias("superseded"),
        (F.col("good") + F.col("bad") == F.col("bronze_keys")).alias("balanced"),
    )


def reconcile_manifest(metrics: DataFrame, manifest: DataFrame, names: Sequence[str]) -> DataFrame:
    """X-08: per metric, injected (from a producer manifest, one row) vs observed (summed DQ
    metrics) and whether they agree. Both inputs are single-row aggregates; they are
    unpivoted and joined on the metric name."""

    def unpivot(df: DataFrame, value: str) -> DataFrame:
        pairs = ", ".join(f"'{n}', CAST(`{n}` AS BIGINT)" for n in names)
        return df.selectExpr(f"stack({len(names)}, {pairs}) AS (metric, {value})")

    observed = unpivot(metrics.agg(*[F.sum(n).alias(n) for n in names]), "observed")
    injected = unpivot(manifest, "injected")
    return injected.join(observed, "metric", "full_outer").select(
        "metric", "injected", "observed", F.coalesce(F.col("injected") == F.col("observed"), F.lit(False)).alias("matches")
    )


def freshness(df: DataFrame, source_col: str, event_ts: str, ingested_col: str, sla_seconds: int) -> DataFrame:
    """X-09: per source, newest event, newest ingestion, their lag (s) and whether it meets the SLA."""
    lag = F.timestamp_diff("SECOND", F.col("last_event").cast("timestamp"), F.col("last_ingested").cast("timestamp"))
    return (
        df.groupBy(source_col)
        .agg(F.max(event_ts).alias("last_event"), F.max(ingested_col).alias("last_ingested"))
        .withColumn("lag_seconds", lag)
        .withColumn("within_sla", F.col("lag_seconds") <= sla_seconds)
    )
