"""Latest-version-per-key deduplication (L-01) and most-resent keys (L-02)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.functions.expressions import as_column


def _desc(c: str | Column) -> Column:
    # A bare name means "newest first"; a Column is taken as the caller wrote it.
    return F.col(c).desc_nulls_last() if isinstance(c, str) else c


def orderable(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Columns usable as a last-resort tie-break (maps are not orderable)."""

    def ok(t: T.DataType) -> bool:
        if isinstance(t, (T.MapType, T.VariantType)):
            return False
        if isinstance(t, T.ArrayType):
            return ok(t.elementType)
        if isinstance(t, T.StructType):
            return all(ok(f.dataType) for f in t.fields)
        return True

    skip = set(exclude)
    return [f.name for f in df.schema.fields if f.name not in skip and ok(f.dataType)]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    tie_breakers: Sequence[str | Column] | None = None,
    rank_col: str = "_rn",
) -> DataFrame:
    """One full row per key: the newest by ``order_by`` (descending for names).

    Ties are resolved by ``tie_breakers``; when none are given, all remaining
    orderable columns are used, so the result is the same on every run (exact
    duplicates tie only with themselves, where either copy is the same row).

    Plan: ``row_number() = 1`` becomes ``WindowGroupLimit`` *before* the
    shuffle, so each map task sends at most one row per key — a key holding a
    third of all rows costs one row per map partition on the wire, not a third
    of the table in one reducer.
    """
    if tie_breakers is None:
        used = set(keys) | {c for c in order_by if isinstance(c, str)}
        tie_breakers = orderable(df, sorted(used))
    order = [_desc(c) for c in order_by] + [_desc(c) for c in tie_breakers]
    w = Window.partitionBy(*[as_column(k) for k in keys]).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)


def repeated_keys(
    df: DataFrame,
    keys: Sequence[str],
    min_count: int = 2,
    k: int | None = 10,
    count_col: str = "n_versions",
) -> DataFrame:
    """Keys seen at least ``min_count`` times, most repeated first (top ``k``; ``None`` = all).

    Partial aggregation runs map-side, so only one row per key and map task is
    shuffled; the top-k is a ``TakeOrderedAndProject`` (no global sort).
    """
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) >= min_count)
    ordered = agg.orderBy(F.col(count_col).desc(), *[F.col(c).asc() for c in keys])
    return ordered.limit(k) if k is not None else ordered
