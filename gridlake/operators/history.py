"""Type-2 history (X-01): validity intervals per key, hot keys split by time slice.

``valid_to`` of a version is the ``valid_from`` of the next version of the same
key. A plain ``lead() OVER (PARTITION BY key …)`` sends every version of a key
to one task; when one key holds a large share of the table that task becomes
the whole job. Here the window is partitioned by *(key, slice)* — ``slice`` a
coarse time bucket such as the month — and the gap at each slice edge is
filled from a small per-(key, slice) summary (first instant / last state),
itself a tiny window per key. Rows never leave their slice.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import gridlake
from gridlake.functions.expressions import trunc_wall
from gridlake.operators.dedup import orderable
from gridlake.session import cut_lineage, scratch_path

# Task functions travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(gridlake)


def _ordered(ts: str, tie_breakers: Sequence[str]) -> list[Column]:
    return [F.col(ts).asc()] + [F.col(c).asc() for c in tie_breakers]


def _left_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on columns that may be NULL on both sides."""
    other = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(other, cond, "left").drop(*[f"_r_{c}" for c in on])


def scd2(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    state_cols: Sequence[str] | None = None,
    tie_breakers: Sequence[str] = (),
    collapse: bool = True,
    slice_unit: str | None = "month",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    current_col: str = "is_current",
    materialize: bool = False,
) -> DataFrame:
    """One row per version with ``valid_from``/``valid_to``/``is_current``.

    * ``collapse=True`` keeps only versions whose ``state_cols`` differ from
      the previous version of the key (runs of equal state become one row).
    * ``slice_unit=None`` uses the plain per-key window (fine for keys of
      bounded size); a unit (``'month'``, ``'day'``…) bounds the rows per task
      by (key, slice).
    * ``materialize`` (with ``collapse``): the collapsed versions are written
      once as a reliable checkpoint under ``spark.checkpoint.dir`` (eagerly),
      so the ``valid_to`` phase reads them instead of re-deriving the collapse
      (which otherwise costs a second scan + full shuffle + window). The files
      stay in the checkpoint folder unless the cluster cleans checkpoints, so
      it is opt-in.
    """
    keys = list(keys)
    state_cols = list(state_cols) if state_cols is not None else [c for c in df.columns if c not in set(keys) | {ts}]
    if not tie_breakers:  # a total order, so that ties give the same versions on every run
        tie_breakers = orderable(df, [*keys, ts])
    order = _ordered(ts, tie_breakers)
    state = F.struct(*[F.col(c) for c in state_cols])
    if slice_unit is None:
        slice_col = F.lit(None).cast("timestamp_ntz")
    elif isinstance(df.schema[ts].dataType, (T.TimestampNTZType, T.DateType)):
        slice_col = trunc_wall(ts, slice_unit)
    else:
        slice_col = F.date_trunc(slice_unit, F.col(ts))
    base = df.withColumn("_slice", slice_col)
    part = keys + ["_slice"]
    w = Window.partitionBy(*part).orderBy(*order)

    if collapse:
        # Previous state inside the slice from the window; at a slice edge, the
        # last state of the key's previous slice. "Last state of a slice" is
        # read off the same (key, slice) partitioning by a descending rank — no
        # extra shuffle, no aggregate over struct buffers.
        w_desc = Window.partitionBy(*part).orderBy(*[c.desc() for c in [F.col(ts)] + [F.col(t) for t in tie_breakers]])
        base = (
            base.withColumn("_state", state)
            .withColumn("_prev", F.lag("_state").over(w))
            .withColumn("_pos", F.row_number().over(w))
            .withColumn("_rpos", F.row_number().over(w_desc))
        )
        wk = Window.partitionBy(*keys).orderBy("_slice")
        edges = base.filter(F.col("_rpos") == 1).select(*part, F.lag("_state").over(wk).alias("_edge_prev"))
        base = (
            _left_null_safe(base, edges, part)
            .withColumn("_prev", F.when(F.col("_pos") == 1, F.col("_edge_prev")).otherwise(F.col("_prev")))
            .filter(~F.col("_prev").eqNullSafe(F.col("_state")))
            .drop("_prev", "_pos", "_rpos", "_edge_prev", "_state")
        )
        if materialize:
            base = cut_lineage(base)

    base = base.withColumn(valid_to, F.lead(ts).over(w))
    # Gap at the slice edge: first instant of the next non-empty slice of the key.
    firsts = base.groupBy(*part).agg(F.min(ts).alias("_first"))
    wk = Window.partitionBy(*keys).orderBy("_slice")
    nxt = firsts.select(*part, F.lead("_first").over(wk).alias("_next_first"))
    out = (
        _left_null_safe(base, nxt, part)
        .withColumn(valid_to, F.coalesce(F.col(valid_to), F.col("_next_first")))
        .drop("_next_first", "_slice")
        .withColumnRenamed(ts, valid_from)
        .withColumn(current_col, F.col(valid_to).isNull())
    )
    return out


def _same(a: pa.Table, b: pa.Table, cols: Sequence[str]) -> pa.ChunkedArray | pa.Array:
    """Row by row: whether the columns are equal, NULL being equal to NULL."""
    out = pa.array([True] * a.num_rows)
    for c in cols:
        x, y = a.column(c), b.column(c)
        both = pc.and_(pc.is_null(x), pc.is_null(y))
        out = pc.and_(out, pc.or_(both, pc.fill_null(pc.equal(x, y), False)))
    return out


def _version_batches(keys: list[str], ts: str, state: list[str], collapse: bool):
    """Versions of one sorted range. ``_open`` marks its last version, whose end lies in a later range; ``_first`` its first row,
    which may repeat the state that an earlier range ends with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held = TaskContext.get().partitionId(), None, None

        def rows(table: pa.Table, ends, open_: bool) -> list[pa.RecordBatch]:
            n = table.num_rows
            table = table.append_column("_to", ends).append_column("_part", pa.array([part] * n, pa.int32()))
            return table.append_column("_open", pa.array([open_] * n)).combine_chunks().to_batches()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if table.num_rows == 0:
                continue
            before = table.slice(0, table.num_rows - 1) if last is None else pa.concat_tables([last, table.slice(0, table.num_rows - 1)])
            rest = table.slice(1) if last is None else table
            kept = pc.invert(_same(rest, before, [*keys, *state])) if collapse else pa.array([True] * rest.num_rows)
            first = last is None
            if first:
                kept = pa.concat_arrays([pa.array([True]), kept.combine_chunks() if isinstance(kept, pa.ChunkedArray) else kept])
            last = table.slice(table.num_rows - 1)
            marks = pa.array([first and i == 0 for i in range(table.num_rows)])
            table = table.append_column("_first", marks).filter(kept)
            table = table if held is None else pa.concat_tables([held, table])
            if table.num_rows > 1:
                head, after = table.slice(0, table.num_rows - 1), table.slice(1)
                ends = pc.if_else(_same(head, after, keys), after.column(ts), pa.scalar(None, after.schema.field(ts).type))
                yield from rows(head, ends, False)
            held = table.slice(table.num_rows - 1)
        if held is not None:
            yield from rows(held, pa.nulls(1, held.schema.field(ts).type), True)

    return run


def _boundary_fixes(edges: list, keys: Sequence[str], ts: str, state: Sequence[str], collapse: bool) -> list[tuple]:
    """From the first and the last version of each range, in order: (range, whether its first version goes, end of its last version)."""
    ends: dict[int, object] = {}
    gone: set[int] = set()
    cur = None
    for part in sorted({e["_part"] for e in edges}):
        own = [e for e in edges if e["_part"] == part]
        first, last = next(e for e in own if e["_first"]), next(e for e in own if e["_open"])
        if cur is not None and all(cur[k] == first[k] for k in keys):
            if collapse and all(cur[c] == first[c] for c in state):
                gone.add(part)
                if first["_open"]:  # the whole range goes on with the earlier state
                    continue
                ends[cur["_part"]] = first["_to"]
            else:
                ends[cur["_part"]] = first[ts]
        cur = last
    return [(p, p in gone, ends.get(p)) for p in sorted({*ends, *gone})]


def scd2_ranges(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    state_cols: Sequence[str] | None = None,
    tie_breakers: Sequence[str] = (),
    collapse: bool = True,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    current_col: str = "is_current",
) -> DataFrame:
    """The versions of :func:`scd2` where a key may hold any share of the rows, in any span of time.

    Rows are dealt by *ranges* of (key, instant, ties), so one key fills as many tasks as it needs; that is the only
    shuffle of the rows. Each range is written with its versions; what a range lacks, the state before its first row and the end of
    its last version, comes from the neighbouring ranges' edges: two rows a range, settled on the driver and joined
    back by a broadcast of at most one row a range.
    """
    spark = df.sparkSession
    keys = list(keys)
    state_cols = list(state_cols) if state_cols is not None else [c for c in df.columns if c not in set(keys) | {ts}]
    if not tie_breakers:
        tie_breakers = orderable(df, [*keys, ts])
    order = [*keys, ts, *[t for t in tie_breakers if t not in (*keys, ts)]]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType(
        [
            *df.schema.fields, T.StructField("_first", T.BooleanType()), T.StructField("_to", df.schema[ts].dataType),
            T.StructField("_part", T.IntegerType()), T.StructField("_open", T.BooleanType()),
        ]
    )
    path = scratch_path(spark, "versions")
    ranged.mapInArrow(_version_batches(keys, ts, state_cols, collapse), schema).write.parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    edges = stored.filter("_first or _open").collect()  # two rows a range
    fixes = _boundary_fixes(edges, keys, ts, state_cols, collapse)
    fix = spark.createDataFrame(fixes, T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_gone", T.BooleanType()), T.StructField("_end", df.schema[ts].dataType)]))
    out = stored.join(F.broadcast(fix), "_part", "left").filter(~(F.col("_first") & F.coalesce("_gone", F.lit(False))))
    end = F.when(F.col("_open"), F.col("_end")).otherwise(F.col("_to"))
    cols = [F.col(ts).alias(valid_from) if c == ts else F.col(c) for c in df.columns]
    return out.select(*cols, end.alias(valid_to), end.isNull().alias(current_col))
