"""Types of columns that no contract names (S-09): found from the values, remembered, and only ever widened.

Drifted columns are stored as text; the type log says as what they are read. So a column whose type widens in a
later delivery reads alike for old and new files, and the result doesn't depend on how deliveries fall into
micro-batches (a join of types is associative). Reading needs no file footers: the log gives the schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.session import path_exists

#: Narrow to wide; a type is joined with one outside its chain as text.
_CHAINS = (("boolean",), ("bigint", "double"), ("date", "timestamp_ntz"))
_NUMBER = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
_FORMS = {"boolean": "(?i)^(true|false)$", "date": r"^\d{4}-\d{2}-\d{2}$", "timestamp_ntz": r"^\d{4}-\d{2}-\d{2}"}
_LEADING_ZERO = r"[+-]?0\d.*"


def join_types(a: str | None, b: str | None) -> str | None:
    """The narrowest type that holds values of both (``None``: no value seen yet)."""
    if a is None or b is None or a == b:
        return a or b
    for chain in _CHAINS:
        if a in chain and b in chain:
            return max(a, b, key=chain.index)
    return "string"


def narrowest_types(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Per text column the narrowest type that every value casts to, in one aggregation (partial per task).

    Numbers with leading zeros are codes, so text; a column without values has no type yet.
    """
    if not columns:
        return {}
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`")
        number = v.rlike(f"^({_NUMBER})$") & ~v.rlike(f"^({_LEADING_ZERO})$")
        aggs.append(F.count(v).alias(f"n{i}"))
        for t in (t for chain in _CHAINS for t in chain):
            fits = v.try_cast(t).isNotNull() & (number if t in ("bigint", "double") else ~number)
            if t == "bigint":
                fits = fits & ~v.rlike(r"[.eE]")
            if t in _FORMS:  # casts take more than deliveries mean
                fits = fits & v.rlike(_FORMS[t])
            aggs.append(F.count_if(v.isNotNull() & ~F.coalesce(fits, F.lit(False))).alias(f"{t}{i}"))
    row = df.agg(*aggs).first()
    out: dict[str, str | None] = {}
    for i, c in enumerate(columns):
        fits = [t for chain in _CHAINS for t in chain if row[f"{t}{i}"] == 0]
        out[c] = None if row[f"n{i}"] == 0 else fits[0] if fits else "string"
    return out


class TypeLog:
    """The drifted columns of a stream and their types, one JSON row per change: a retried micro-batch may repeat its
    row, which the join of all rows absorbs."""

    SCHEMA = "batch_id long, name string, type string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).json(self.path)

    def current(self) -> dict[str, str | None]:
        """Names in the order in which they were met (within one batch by name), with their joined types."""
        out: dict[str, str | None] = {}
        for r in sorted(self.rows().collect(), key=lambda r: (r["batch_id"], r["name"])):  # one row per column and change of type
            out[r["name"]] = join_types(out.get(r["name"]), r["type"])
        return out

    def record(self, batch_id: int, found: dict[str, str | None]) -> dict[str, str | None]:
        """Joins the types of a batch into the log; returns the changed ones."""
        known = self.current()
        changed = {c: t for c, t in found.items() if c not in known or join_types(known[c], t) != known[c]}
        if changed:
            rows = [(int(batch_id), c, t) for c, t in sorted(changed.items())]
            self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").json(self.path)
        return changed


def stored_schema(contract: T.StructType, log: TypeLog, others: T.StructType) -> T.StructType:
    """The columns of a target folder: the contract's, the drifted ones as text, then ``others``."""
    drifted = [T.StructField(c, T.StringType()) for c in log.current()]
    return T.StructType([*contract.fields, *drifted, *others.fields])


def typed_view(df: DataFrame, log: TypeLog) -> DataFrame:
    """The stored rows with drifted columns in their current types."""
    types = log.current()
    return df.select(*[F.col(f"`{c}`").try_cast(types[c]).alias(c) if types.get(c) else F.col(f"`{c}`") for c in df.columns])
