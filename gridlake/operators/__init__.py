"""DataFrame operators, all parameterised by column names."""

from gridlake.operators.aggregates import (
    binned_average,
    corr_by_group,
    coverage_report,
    dq_metrics,
    duplicate_excess,
    hot_keys,
    key_skew,
    layer_counts,
    pct_in_class,
    reconcile,
    row_counts,
    rows_of_top_keys,
    time_coverage,
    weighted_mean,
)
from gridlake.operators.dedup import latest_per_key, repeated_keys
from gridlake.operators.flatten import flatten_envelope, flatten_parallel_arrays
from gridlake.operators.history import scd2, scd2_ranges
from gridlake.operators.joins import (
    broadcast_if_small,
    dim_join,
    duplicate_keys,
    expect_unique,
    heavy_hitters,
    join_on_time_bucket,
    probe_size,
    ref_violations,
    salted_join,
    skew_join,
    with_time_bucket,
)
from gridlake.operators.quarantine import Rule, flag, quarantine, reasons_column, split

__all__ = [
    "Rule",
    "binned_average",
    "broadcast_if_small",
    "corr_by_group",
    "coverage_report",
    "dim_join",
    "dq_metrics",
    "duplicate_excess",
    "duplicate_keys",
    "expect_unique",
    "heavy_hitters",
    "flag",
    "flatten_envelope",
    "flatten_parallel_arrays",
    "hot_keys",
    "join_on_time_bucket",
    "key_skew",
    "latest_per_key",
    "layer_counts",
    "pct_in_class",
    "probe_size",
    "quarantine",
    "reasons_column",
    "reconcile",
    "ref_violations",
    "repeated_keys",
    "row_counts",
    "rows_of_top_keys",
    "salted_join",
    "skew_join",
    "scd2",
    "scd2_ranges",
    "split",
    "time_coverage",
    "weighted_mean",
    "with_time_bucket",
]
