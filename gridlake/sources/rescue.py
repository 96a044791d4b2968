"""Typed projection with rescue (S-11): values that do not fit the contract type are
kept, as JSON, in ``_rescued_data`` instead of being lost or failing the job.

Input columns are strings (as read from text); each contract column is
``try_cast`` to its type. A value that was non-NULL before and NULL after the
cast is rescued under its column name. A genuine NULL is not rescued.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"


def _typed(c: Column, t: T.DataType) -> Column:
    if isinstance(t, T.StringType):
        return c
    return c.try_cast(t)


def cast_with_rescue(
    df: DataFrame,
    schema: T.StructType,
    rescued_col: str = RESCUED,
    rescue_unknown: bool = False,
    keep: tuple[str, ...] = (),
    corrupt_col: str = "_corrupt_record",
) -> DataFrame:
    """Contract columns typed, missing ones NULL, bad values in ``rescued_col``.

    * Columns of ``df`` not in the contract are kept as they are (schema
      evolution: new columns are added), or folded into the rescue JSON with
      ``rescue_unknown=True``.
    * ``keep`` columns (audit/provenance) pass through untouched.
    * A ``corrupt_col`` (Spark's corrupt-record column) is folded into the
      rescue JSON as ``{"_line": <raw line>}``.
    """
    have = set(df.columns)
    contract = [f.name for f in schema.fields]
    typed_cols, entries = [], []
    for f in schema.fields:
        if f.name in have:
            raw = F.col(f.name)
            t = _typed(raw, f.dataType)
            typed_cols.append(t.alias(f.name))
            if not isinstance(f.dataType, T.StringType):
                entries += [F.lit(f.name), F.when(raw.isNotNull() & t.isNull(), raw)]
        else:
            typed_cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if corrupt_col in have:
        # A malformed line (wrong number of fields) is rescued whole.
        entries += [F.lit("_line"), F.col(corrupt_col)]
    extra = [c for c in df.columns if c not in set(contract) and c not in set(keep) and c not in (rescued_col, corrupt_col)]
    if rescue_unknown:
        for c in extra:
            entries += [F.lit(c), F.col(c).cast("string")]
        extra_cols: list[Column] = []
    else:
        extra_cols = [F.col(c) for c in extra]
    if entries:
        m = F.map_filter(F.create_map(*entries), lambda k, v: v.isNotNull())
        rescued = F.when(F.size(m) > 0, F.to_json(m))
    else:
        rescued = F.lit(None).cast("string")
    return df.select(*typed_cols, *extra_cols, *[F.col(k) for k in keep], rescued.alias(rescued_col))
