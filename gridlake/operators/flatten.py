"""Nested flattening: envelope of array<struct> (L-05) and parallel arrays (L-04)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_envelope(
    df: DataFrame,
    array_col: str,
    keep: Sequence[str] = (),
    outer: bool = False,
    position_col: str | None = None,
) -> DataFrame:
    """One row per element of ``array_col`` (array<struct>), its fields expanded, plus ``keep`` columns.

    ``explode`` drops envelopes whose array is empty or NULL (the reference's
    behaviour); ``outer=True`` keeps them with NULL fields. A narrow,
    partition-local operator: no shuffle.
    """
    keep = list(keep)
    gen = F.posexplode_outer if (outer and position_col) else F.posexplode if position_col else F.explode_outer if outer else F.explode
    if position_col:
        exploded = df.select(*keep, gen(array_col).alias(position_col, "_r"))
        return exploded.select(*keep, position_col, "_r.*")
    return df.select(*keep, gen(array_col).alias("_r")).select(*keep, "_r.*")


def flatten_parallel_arrays(
    df: DataFrame,
    arrays: Sequence[str],
    keep: Sequence[str] = (),
    names: Sequence[str] | None = None,
    position_col: str | None = None,
    outer: bool = False,
) -> DataFrame:
    """Zip equally-indexed arrays and emit one row per index (``explode(arrays_zip(...))``).

    Arrays of unequal length are padded with NULL up to the longest one, as
    ``arrays_zip`` does, a NULL array with them; a row whose arrays are all empty or
    NULL gives no row, or one of NULLs with ``outer``. ``names`` renames the zipped fields (default: the leaf
    name of each array path, e.g. ``hourly.time`` → ``time``).
    """
    keep = list(keep)
    leaf = [a.split(".")[-1] for a in arrays]
    out_names = list(names) if names else leaf
    # A NULL array counts as empty: it must not take its siblings' values with it.
    zipped = F.arrays_zip(*[F.coalesce(F.col(a), F.array()).alias(l) for a, l in zip(arrays, leaf)])
    if position_col:
        gen = F.posexplode_outer if outer else F.posexplode
        x = df.select(*keep, gen(zipped).alias(position_col, "_z"))
        fixed = [position_col]
    else:
        gen = F.explode_outer if outer else F.explode
        x = df.select(*keep, gen(zipped).alias("_z"))
        fixed = []
    return x.select(*keep, *fixed, *[F.col(f"_z.{l}").alias(n) for l, n in zip(leaf, out_names)])
