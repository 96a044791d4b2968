"""Joins: checked dimension join (J-01), time-bucket join (J-02), skew salting (X-05),
referential violations (X-02).

Broadcast policy:
* a **stored** side (a dimension table) is broadcast only after a probe
  proves it small — a distributed row count, then (only within the row
  bound) a distributed byte estimate;
* a **derived** side (an aggregate, a distinct list) is not probed — that
  would compute it twice — and is left to adaptive execution, which switches
  a shuffle join to a broadcast at runtime from the side's *measured* shuffle
  size (``spark.sql.adaptive.autoBroadcastJoinThreshold``).
Beyond the bounds the join stays a shuffle join (sort-merge, with AQE's
skew-join split enabled).
"""

from __future__ import annotations

import math

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.functions.expressions import time_bucket

DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class SideSize:
    rows: int
    approx_bytes: int
    bounded: bool  # True when the side is within the probe bound


def _row_width(schema: T.StructType) -> Column:
    """Rough in-memory width of a row: fixed sizes + actual string/binary lengths."""
    parts: list[Column] = []
    for f in schema.fields:
        t = f.dataType
        if isinstance(t, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 8)
        elif isinstance(t, (T.ArrayType, T.MapType)):
            parts.append(F.coalesce(F.size(F.col(f.name)), F.lit(0)) * 8 + 16)
        elif isinstance(t, T.StructType):
            parts.append(F.lit(8 * max(len(t.fields), 1)))
        else:
            parts.append(F.lit(8))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total.cast("long")


def probe_size(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> SideSize:
    """Rows and approximate bytes of a *stored* side, both as distributed aggregates.

    The row count comes first (for Parquet it needs no column data); bytes are
    summed only when the count is within ``max_rows``, so an oversized side is
    rejected without scanning its values, and no step funnels rows through a
    single task.
    """
    n = df.count()
    if n > max_rows:
        return SideSize(rows=n, approx_bytes=-1, bounded=False)
    b = df.agg(F.sum(_row_width(df.schema)).alias("b")).first()["b"]
    return SideSize(rows=n, approx_bytes=int(b or 0), bounded=True)


def broadcast_if_small(
    df: DataFrame,
    max_rows: int = DEFAULT_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when the probe proves it small, else ``(df, False)``."""
    s = probe_size(df, max_rows)
    if s.bounded and s.approx_bytes <= max_bytes:
        return F.broadcast(df), True
    return df, False


class DuplicateKeyError(ValueError):
    pass


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Keys that occur more than once (E-07)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > 1)


def expect_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when ``keys`` is not unique in ``df`` (stops at the first offending key)."""
    bad = duplicate_keys(df, keys).limit(5).collect()
    if bad:
        raise DuplicateKeyError(f"key {list(keys)} not unique, e.g. {[r.asDict() for r in bad]}")


def _checked_dimension(dim: DataFrame, keys: Sequence[str], max_rows: int, max_bytes: int) -> DataFrame:
    """Uniqueness check and broadcast size probe in **one** job over the dimension.

    The per-key counts give the duplicate test; their sums give rows and
    approximate bytes. Raises :class:`DuplicateKeyError` on a repeated key.
    """
    per_key = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(_row_width(dim.schema)).alias("_b"))
    r = per_key.agg(F.max("_n").alias("mx"), F.sum("_n").alias("rows"), F.sum("_b").alias("bytes")).first()
    if r["mx"] is not None and r["mx"] > 1:
        raise DuplicateKeyError(f"key {list(keys)} not unique ({r['mx']} rows for one key)")
    rows, size = int(r["rows"] or 0), int(r["bytes"] or 0)
    return F.broadcast(dim) if rows <= max_rows and size <= max_bytes else dim


def dim_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str] | Sequence[tuple[str, str]],
    how: str = "inner",
    allow_fanout: bool = False,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Fact ⋈ conformed dimension.

    * The dimension key must be unique (else the join silently multiplies fact
      rows) unless ``allow_fanout``.
    * The dimension is broadcast only when the bounded probe proves it small;
      otherwise both sides shuffle on the key (AQE may still switch to a
      broadcast at runtime from real shuffle statistics).
    """
    pairs = [(k, k) if isinstance(k, str) else k for k in keys]
    dim_keys = [r for _, r in pairs]
    if allow_fanout:
        side, _ = broadcast_if_small(dim, max_broadcast_rows, max_broadcast_bytes)
    else:
        side = _checked_dimension(dim, dim_keys, max_broadcast_rows, max_broadcast_bytes)
    if all(l == r for l, r in pairs):
        return fact.join(side, [l for l, _ in pairs], how)
    cond = None
    for l, r in pairs:
        c = fact[l] == side[r]
        cond = c if cond is None else cond & c
    return fact.join(side, cond, how)


def _is_local(dtype: T.DataType, tz: str | None) -> bool:
    if isinstance(dtype, T.TimestampNTZType):
        return True
    if isinstance(dtype, T.StringType):
        return tz is not None  # naive string in a declared zone; else offset-aware parse
    return False


def with_time_bucket(
    df: DataFrame,
    ts: str,
    unit: str = "hour",
    source_tz: str | None = None,
    target_tz: str = "UTC",
    out: str = "_bucket",
) -> DataFrame:
    """Materialise the wall-clock bucket of ``ts`` as a real column (a plain equi-join key)."""
    local = _is_local(df.schema[ts].dataType, source_tz)
    return df.withColumn(out, time_bucket(ts, unit, source_tz, target_tz, is_local=local))


def join_on_time_bucket(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    unit: str = "hour",
    left_tz: str | None = None,
    right_tz: str | None = None,
    target_tz: str = "UTC",
    how: str = "inner",
    bucket_col: str = "_bucket",
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """Join two series of different granularity on entity keys + time bucket.

    Each side's instant is brought to a wall clock in ``target_tz`` with its own
    declared source zone, truncated to ``unit`` and joined as an ordinary
    equi-join key — the optimizer sees a timestamp column (statistics, hashing)
    instead of a formatted string. Hashing on (entity, bucket) spreads one hot
    entity over all its buckets.
    The right side's key/bucket columns are dropped from the output; the bucket
    is kept once as ``bucket_col``. ``max_broadcast_rows`` probes a *stored*
    right side for an explicit broadcast; by default (a derived series, e.g.
    an hourly aggregate) adaptive execution decides from measured sizes.
    """
    lb = with_time_bucket(left, left_ts, unit, left_tz, target_tz, bucket_col)
    rb = with_time_bucket(right, right_ts, unit, right_tz, target_tz, "_rbucket")
    rside = broadcast_if_small(rb, max_broadcast_rows)[0] if max_broadcast_rows else rb
    cond = lb[bucket_col] == rside["_rbucket"]
    for lk, rk in zip(left_keys, right_keys, strict=True):
        cond = cond & (lb[lk] == rside[rk])
    out = lb.join(rside, cond, how).drop(rside["_rbucket"])
    for rk in right_keys:
        out = out.drop(rside[rk])
    return out


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    salt_buckets: int = 16,
    how: str = "inner",
    salt_cols: Sequence[str] | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Equi-join whose hot keys are spread over ``salt_buckets`` reducers.

    A dimension the bounded probe proves small is simply broadcast (no
    shuffle, so no skew). Otherwise the fact side gets a *deterministic* salt
    (hash of its own columns, so a retried task recomputes the same salt) and
    the dimension is replicated once per salt value; the shuffle join then
    splits every key — the hot one included — over ``salt_buckets`` tasks.
    Same rows as the plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    if max_broadcast_rows > 0:
        side, small = broadcast_if_small(dim, max_broadcast_rows)
        if small:
            return fact.join(side, list(keys), how)
    cols = list(salt_cols) if salt_cols else [c for c in fact.columns]
    f = fact.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salt_buckets)).cast("int"))
    d = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    return f.join(d.hint("shuffle_merge"), list(keys) + ["_salt"], how).drop("_salt")


#: Keys that a heavy-hitter list holds at most, and the items that its summary tracks.
MAX_HEAVY, TRACKED = 100, 1000


def heavy_hitters(df: DataFrame, keys: Sequence[str], share: float = 0.01) -> DataFrame:
    """``keys, n`` of the keys with at least ``share`` of all rows (at most ``MAX_HEAVY`` of them).

    A frequent-items sketch of bounded size per task, merged, names the candidates; a second pass counts only them,
    exactly. With ``TRACKED`` items no key of more than 1 / TRACKED of the rows is missed.
    """
    if share < 1 / MAX_HEAVY:
        raise ValueError(f"a share below {1 / MAX_HEAVY} may have more than {MAX_HEAVY} keys")
    code = F.xxhash64(*[F.col(k) for k in keys])
    row = df.select(code.alias("c")).agg(F.expr(f"approx_top_k(c, {MAX_HEAVY}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    candidates = [x["item"] for x in row["top"] or []]
    counted = df.filter(code.isin(candidates) if candidates else F.lit(False)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= F.lit(max(1, math.ceil(share * row["n"]))))


def skew_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    share: float = 0.01,
    rows_per_task: int = 1_000_000,
    max_salts: int = 1024,
) -> DataFrame:
    """Equi-join that splits heavy keys alone.

    Only rows of :func:`heavy_hitters` are dealt over salts, by a hash of their *position*, so that identical rows are dealt
    evenly too; only their dimension rows are replicated, each for the salts that its own count needs. All other keys
    are joined as they are, and nothing is replicated for them. Same rows as the plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join supports inner and left joins")
    keys = list(keys)
    salts = F.least(F.lit(max_salts), F.greatest(F.lit(2), F.ceil(F.col("n") / rows_per_task))).cast("int")
    hot = [(*[r[k] for k in keys], r["_salts"]) for r in heavy_hitters(fact, keys, share).select(*keys, salts.alias("_salts")).collect()]
    schema = T.StructType([*[T.StructField(k, fact.schema[k].dataType) for k in keys], T.StructField("_salts", T.IntegerType())])
    table = F.broadcast(fact.sparkSession.createDataFrame([h for h in hot if None not in h], schema))  # at most MAX_HEAVY rows
    salted = F.coalesce("_salts", F.lit(1))
    f = fact.withColumn("_at", F.monotonically_increasing_id()).join(table, keys, "left")
    f = f.withColumn("_salt", F.pmod(F.xxhash64("_at"), salted).cast("int")).drop("_at", "_salts")
    d = dim.join(table, keys, "left")
    d = d.withColumn("_salt", F.explode(F.sequence(F.lit(0), salted - 1))).drop("_salts")
    return f.join(d, [*keys, "_salt"], how).drop("_salt")


def ref_violations(
    df: DataFrame,
    ref: DataFrame,
    keys: Sequence[str] | Sequence[tuple[str, str]],
) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``ref`` (left anti join; X-02).

    The distinct reference keys are a derived side: adaptive execution
    broadcasts them when their measured size is small, else shuffles.
    """
    pairs = [(k, k) if isinstance(k, str) else k for k in keys]
    side = ref.select(*[F.col(rk).alias(f"_ref_{i}") for i, (_, rk) in enumerate(pairs)]).distinct()
    cond = None
    for i, (lk, _) in enumerate(pairs):
        c = df[lk] == side[f"_ref_{i}"]
        cond = c if cond is None else cond & c
    return df.join(side, cond, "left_anti")
