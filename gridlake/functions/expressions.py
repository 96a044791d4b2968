"""Scalar expressions used by the operators.

Everything here returns a ``Column`` made of built-in functions, so it stays
inside whole-stage codegen and is pushed/pruned by Catalyst like any other
expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: str | Column) -> Column:
    """A column name or a ``Column``, as a ``Column``."""
    return F.col(c) if isinstance(c, str) else c


def total(predicate: str | Column) -> Column:
    """Two-valued form of a predicate: NULL counts as false.

    SQL's three-valued logic makes ``p`` and ``NOT p`` both drop rows where
    ``p`` is NULL; splitting on ``total(p)`` / ``~total(p)`` keeps every row
    in exactly one side.
    """
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return F.coalesce(p, F.lit(False))


def full_match(c: str | Column, pattern: str) -> Column:
    """Whole-string regex match (both ends are anchored); NULL stays NULL."""
    return as_column(c).rlike("^(?:" + pattern.removeprefix("^").removesuffix("$") + ")$")


def normalise_enum_col(c: str | Column, case: str = "upper") -> Column:
    """``upper(trim(x))`` normalisation of a categorical code; blank becomes NULL."""
    trimmed = F.trim(as_column(c))
    cased = F.upper(trimmed) if case == "upper" else F.lower(trimmed)
    return F.when(trimmed == "", F.lit(None).cast("string")).otherwise(cased)


def path_period(path_col: str | Column, pattern: str = r"(\d{4}-W\d{2})", group: int = 1) -> Column:
    """Extract a period label (default ISO week ``YYYY-Www``) from a file path; '' when absent."""
    return F.regexp_extract(as_column(path_col), pattern, group)


def iso_week(c: str | Column) -> Column:
    """ISO-8601 week label ``YYYY-Www`` of a date/timestamp (2023-01-01 → 2022-W52)."""
    d = as_column(c)
    year = F.extract(F.lit("YEAROFWEEK"), d)
    return F.format_string("%04d-W%02d", year, F.weekofyear(d))


def trunc_wall(c: str | Column, unit: str) -> Column:
    """Truncate a zone-free wall clock (``timestamp_ntz``) without any time-zone round trip.

    ``date_trunc`` accepts ``timestamp_ntz`` only by casting it to a session-zone
    ``timestamp`` — the result then depends on the session zone (half-hour
    offsets, DST gaps). This builds the truncated value from its fields.
    """
    t = as_column(c).cast("timestamp_ntz")
    u = unit.lower()
    zero = F.lit(0)
    if u == "year":
        return F.make_timestamp_ntz(F.year(t), F.lit(1), F.lit(1), zero, zero, zero)
    if u == "quarter":
        return F.make_timestamp_ntz(F.year(t), (F.quarter(t) - 1) * 3 + 1, F.lit(1), zero, zero, zero)
    if u == "month":
        return F.make_timestamp_ntz(F.year(t), F.month(t), F.lit(1), zero, zero, zero)
    if u == "week":  # ISO week: Monday
        d = F.to_date(t)
        return F.date_sub(d, F.pmod(F.dayofweek(d) + 5, F.lit(7))).cast("timestamp_ntz")
    if u == "day":
        return F.to_date(t).cast("timestamp_ntz")
    if u == "hour":
        return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), zero, zero)
    if u == "minute":
        return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), zero)
    if u == "second":
        return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.second(t))
    raise ValueError(f"unsupported unit {unit}")


def time_bucket(
    ts: str | Column,
    unit: str = "hour",
    source_tz: str | None = None,
    target_tz: str = "UTC",
    is_local: bool = False,
) -> Column:
    """Wall-clock bucket of an instant, as ``timestamp_ntz`` in ``target_tz``.

    * ``is_local=False`` (an absolute ``timestamp``, or a string carrying its
      offset): converted to the wall clock of ``target_tz``.
    * ``is_local=True`` (``timestamp_ntz`` or a naive string) with a declared
      ``source_tz``: converted from that zone to ``target_tz``.
    * ``is_local=True`` without ``source_tz``: taken as a wall clock already in
      ``target_tz`` (no conversion).

    Truncation happens on the zone-free value (:func:`trunc_wall`), so the
    bucket never depends on the session time zone — the trap of formatting
    both sides with ``date_format`` in whatever zone the session uses.
    """
    c = as_column(ts)
    if is_local:
        ntz = c.cast("timestamp_ntz")
        wall = F.convert_timezone(F.lit(source_tz), F.lit(target_tz), ntz) if source_tz else ntz
    else:
        wall = F.convert_timezone(None, F.lit(target_tz), c.cast("timestamp"))
    return trunc_wall(wall, unit)


def hour_bucket(ts: str | Column, source_tz: str | None = None, target_tz: str = "UTC", is_local: bool = False) -> Column:
    """:func:`time_bucket` at hour grain (the reference's hour join key)."""
    return time_bucket(ts, "hour", source_tz, target_tz, is_local)


def pct_of(predicate: str | Column, digits: int = 1) -> Column:
    """Share of rows (in %) for which ``predicate`` holds, as DOUBLE (NULL counts as not)."""
    hit = total(predicate).cast("int")
    return F.round(F.lit(100.0) * F.sum(hit).cast("double") / F.count(F.lit(1)), digits)


def fingerprint(cols: Sequence[str]) -> Column:
    """Per-row 64-bit hash of the given columns (order-insensitive table fingerprints sum it)."""
    return F.xxhash64(*[F.col(c) for c in cols])


def morton_key(bucket_cols: Sequence[str | Column], bits: int) -> Column:
    """Interleave the low ``bits`` bits of integer bucket columns (Z-order key).

    Built from ``shiftleft``/``bitwise_or`` only, so it is a plain codegen
    expression. Bit ``b`` of column ``i`` lands at position ``b*n + i``.
    """
    cols = [as_column(c).cast("long") for c in bucket_cols]
    n = len(cols)
    key = F.lit(0).cast("long")
    for b in range(bits):
        for i, c in enumerate(cols):
            bit = F.shiftright(c, b).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(bit, b * n + i))
    return key
