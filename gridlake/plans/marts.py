"""Gold marts as functions of DataFrames (G-08, G-09, X-04) and the silver step (G-07).

Each mart is parameterised by column names; the energy pipeline is one
configuration, the driver's TPC-H-like tables another.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.expressions import normalise_enum_col, pct_of
from gridlake.operators.dedup import latest_per_key
from gridlake.operators.joins import dim_join, join_on_time_bucket
from gridlake.operators.quarantine import Rule, flag, split


@dataclass
class SilverSpec:
    """How a bronze table becomes silver: latest-wins key, enum clean-up, validity rules."""

    keys: Sequence[str]
    order_by: Sequence[str | Column]
    tie_breakers: Sequence[str | Column] | None = None
    enums: Sequence[str] = ()
    rules: Sequence[Rule] = field(default_factory=list)


def silver_flagged(bronze: DataFrame, spec: SilverSpec) -> DataFrame:
    """Dedup **before** the rule split (a newest-but-bad version hides older good ones),
    then normalise enums, then flag. One evaluation feeds both outputs."""
    latest = latest_per_key(bronze, spec.keys, spec.order_by, spec.tie_breakers)
    for c in spec.enums:
        latest = latest.withColumn(c, normalise_enum_col(c))
    return flag(latest, spec.rules)


def silver(bronze: DataFrame, spec: SilverSpec) -> tuple[DataFrame, DataFrame]:
    return split(silver_flagged(bronze, spec))


def priority_mart(
    fact: DataFrame,
    dim: DataFrame,
    join_keys: Sequence[str] | Sequence[tuple[str, str]],
    group_cols: Sequence[str],
    id_col: str,
    measure: str,
    class_predicate: Column,
    min_support: int = 20,
    measure_digits: int = 1,
    pct_digits: int = 1,
    names: tuple[str, str, str] = ("n_items", "mean_measure", "pct_in_class"),
    allow_fanout: bool = False,
) -> DataFrame:
    """Per dimension group: items, rounded mean measure, % in a class, HAVING ≥ ``min_support``.

    (G-08 "renovation priority": dwellings per commune, mean kWh/m², % F/G.)
    The dimension join is checked for key uniqueness and broadcast only when
    small; the aggregate is partial + final, so only one row per group and map
    task is shuffled. The result is unordered: rank it with :func:`ranked`
    (a top-k, not a global sort) where a serving read needs an order.
    """
    n_name, mean_name, pct_name = names
    joined = dim_join(fact, dim, join_keys, "inner", allow_fanout=allow_fanout)
    agg = joined.groupBy(*group_cols).agg(
        F.count(F.col(id_col)).alias(n_name),
        F.round(F.avg(measure), measure_digits).alias(mean_name),
        pct_of(class_predicate, pct_digits).alias(pct_name),
    )
    return agg.filter(F.col(n_name) >= min_support)


def ranked(df: DataFrame, by: str, keys: Sequence[str], k: int | None = None) -> DataFrame:
    """Explicit ordering (and optional top-k) for serving reads (O-01/O-02/G-10)."""
    out = df.orderBy(F.col(by).desc(), *[F.col(c).asc() for c in keys])
    return out.limit(k) if k is not None else out


def binned_join_mart(
    fine: DataFrame,
    coarse: DataFrame,
    fine_keys: Sequence[str],
    coarse_keys: Sequence[str],
    fine_ts: str,
    coarse_ts: str,
    bin_expr: Column,
    measure: str,
    unit: str = "hour",
    fine_tz: str | None = None,
    coarse_tz: str | None = None,
    group_cols: Sequence[str] | None = None,
    names: tuple[str, str, str] = ("bin", "n_matches", "mean_measure"),
    digits: int | None = 0,
) -> DataFrame:
    """G-09 "use vs temperature": join a fine series to a coarse one on entity + time
    bucket, then count and average the fine measure per entity and binned coarse value.

    ``nb_heures`` in the reference counts *fine* rows (quarter-hours), kept here
    as ``n_matches``.
    """
    bin_name, n_name, mean_name = names
    j = join_on_time_bucket(fine, coarse, fine_keys, coarse_keys, fine_ts, coarse_ts, unit, fine_tz, coarse_tz)
    mean = F.avg(measure)
    if digits is not None:
        mean = F.round(mean, digits)
    gcols = list(group_cols) if group_cols is not None else list(fine_keys)
    return j.groupBy(*gcols, bin_expr.alias(bin_name)).agg(F.count(F.lit(1)).alias(n_name), mean.alias(mean_name))


def consumption_mart(
    fact: DataFrame,
    dim: DataFrame,
    join_keys: Sequence[str],
    group_cols: Sequence[str],
    measure: str,
    per_capita_col: str | None = None,
    digits: int = 2,
) -> DataFrame:
    """X-04: total measure per dimension group, with an optional per-capita ratio
    (``per_capita_col`` is a dimension attribute, constant within a group)."""
    j = dim_join(fact, dim, join_keys, "inner")
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(measure), digits).alias("total")]
    if per_capita_col:
        aggs.append(F.round(F.sum(measure) / F.max(per_capita_col), digits + 2).alias("per_capita"))
    return j.groupBy(*group_cols).agg(*aggs)
