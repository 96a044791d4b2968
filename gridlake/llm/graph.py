"""Connected components of a link table by minimum labels and pointer jumping, one written table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release


def components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """``(id, comp)`` for every id of ``edges``: ``comp`` is the smallest id reachable from it.

    Each round takes the smallest label among the neighbours, then the label of that label. Labels and links stay
    distributed; only the number of changed labels reaches the driver. Null ends and repeated links are ignored.
    The result is a written table (``release`` it after use).
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).dropna()
    sym = materialize(e.union(e.select("v", "u")).filter("u <> v").distinct(), "links")
    # A node starts with the smallest id of its neighbourhood, itself included.
    lab = materialize(sym.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("m")).select("id", F.least("id", "m").alias("comp")), "labels")
    while True:
        near = sym.join(lab.select(F.col("id").alias("v"), F.col("comp").alias("c")), "v").groupBy(F.col("u").alias("id")).agg(F.min("c").alias("c"))
        step = lab.join(near, "id").select("id", F.col("comp").alias("old"), F.least("comp", "c").alias("comp"))
        up = step.select(F.col("id").alias("comp"), F.col("comp").alias("up"))
        new = materialize(step.join(up, "comp").select("id", "old", F.least("comp", "up").alias("comp")), "labels")
        release(lab)
        lab = new.select("id", "comp")
        lab.scratch = new.scratch
        if new.filter("old <> comp").isEmpty():
            release(sym)
            return lab
