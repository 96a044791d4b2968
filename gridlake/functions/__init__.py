"""Column-level building blocks (all built-in Spark expressions, codegen-friendly)."""

from gridlake.functions.expressions import (
    as_column,
    fingerprint,
    full_match,
    hour_bucket,
    iso_week,
    morton_key,
    normalise_enum_col,
    path_period,
    pct_of,
    time_bucket,
    total,
    trunc_wall,
)

__all__ = [
    "as_column",
    "fingerprint",
    "full_match",
    "hour_bucket",
    "iso_week",
    "morton_key",
    "normalise_enum_col",
    "path_period",
    "pct_of",
    "time_bucket",
    "total",
    "trunc_wall",
]
