"""K-d tree sharding: nodes are split at distributed weighted medians along their widest metadata dimension.

A node of k shards becomes two of k // 2 and k - k // 2; the split point leaves bytes in that proportion. Dimensions are properties of
the text: its bytes, its lines and its mean line length (in 1/16 bytes), so equal texts have equal coordinates. Rows are ordered by
(coordinate, 64-bit hash of the text, id), and the weighted median is found in that order by histograms: every round counts the bytes
of the buckets of all open nodes at once and goes on inside the bucket that holds the split point. A round's table has at most
nodes x ``BUCKETS`` rows; only the chosen bucket of each node reaches the driver. The split point is moved to the nearer end of its group of
equal texts, so equal texts share a shard; a group of more bytes than a shard is divided. What a cut shifts, the cuts below it share.

Only DataFrame functions run. Slots count the rows of a shard from 0: rows are dealt by a hash of the id into cells of about ``CELL_ROWS`` rows,
numbered within their cell, and offset by the cells before.

Cases: a null text has no bytes (size 1, hash of the empty text); repeated rows are separate rows; null ids are placed like others; an empty table
gives an empty result; extra columns but
the text are kept, and clashing names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SHARDS = 8
BUCKETS = 1024
CELL_ROWS = 50_000
_DIMS = ("__size", "__lines", "__mean")


def kd_shards(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """The rows with ``size, text_crc32, shard, slot``; sizes of shards are near equal."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    lines = (F.length(text) - F.length(F.translate(text, "\n", "")) + 1).cast("long")
    own = {"size", "text_crc32", "shard", "slot"}
    carry = [F.col(f"`{c}`") for c in df.columns if c.lower() not in own and c.lower() != text_col.lower()]
    rows = materialize(
        df.select(
            *carry,
            size.alias("__size"),
            F.crc32(text.cast("binary")).alias("__crc"),
            lines.alias("__lines"),
            (size * 16 / lines).cast("long").alias("__mean"),
            F.xxhash64(text).alias("__h"),
        ).withColumn("__i", F.xxhash64(F.col(f"`{id_col}`").cast("string"))),
        "shard-rows",
    )
    ranges = rows.agg(*[F.min(d).alias(f"lo{d}") for d in _DIMS], *[F.max(d).alias(f"hi{d}") for d in _DIMS], F.count(F.lit(1)).alias("n"), F.sum("__size").alias("bytes")).first()
    tree = {0: (0, shards)}  # node: its first shard and its number of shards; node i has the children 2 i + 1 and 2 i + 2
    share = (ranges["bytes"] or 0) / shards
    spread = {d: max((ranges[f"hi{d}"] or 0) - (ranges[f"lo{d}"] or 0), 1) for d in _DIMS}
    rows = rows.withColumn("__node", F.lit(0))
    while open_ := {i: v for i, v in tree.items() if v[1] > 1}:
        cuts = _cuts(rows.filter(F.col("__node").isin(list(open_))), open_, spread, share)
        step = F.col("__node")
        for i, (s, k) in open_.items():
            del tree[i]
            tree |= {2 * i + 1: (s, k // 2), 2 * i + 2: (s + k // 2, k - k // 2)}
            side = F.when(_before(cuts[i]), F.lit(2 * i + 1)).otherwise(F.lit(2 * i + 2)) if i in cuts else F.lit(2 * i + 1)
            step = F.when(F.col("__node") == i, side).otherwise(step)
        rows = materialize(rows.withColumn("__node", step), "shard-nodes")
    node = F.col("__node")
    pairs = [F.lit(x) for i, (s, _) in tree.items() for x in (i, s)]
    rows = rows.withColumn("shard", F.create_map(*pairs)[node].cast("int"))
    out = _slots(rows, ranges["n"])
    keep = [c for c in out.columns if not c.startswith("__")]
    return out.select(*[f"`{c}`" for c in keep], F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"))


def _before(cut: tuple) -> Column:
    """Rows up to a cut (dimension, coordinate, text hash, id hash), in that order; a missing last key takes all."""
    dim, *keys = cut
    out = F.lit(True)
    for name, x in reversed(list(zip((dim, "__h", "__i"), keys))):
        if x is not None:
            out = (F.col(name) < F.lit(x)) | ((F.col(name) == F.lit(x)) & out)
    return out


def _cuts(rows: DataFrame, open_: dict, spread: dict, share: float) -> dict[int, tuple]:
    """For each open node with rows: its split point in the order of (coordinate, text hash, id hash). ``share``: bytes of a shard."""
    stats = rows.groupBy("__node").agg(
        F.sum("__size").alias("bytes"), *[F.min(d).alias(f"lo{d}") for d in _DIMS], *[F.max(d).alias(f"hi{d}") for d in _DIMS]
    ).collect()
    work = {}
    for r in stats:
        first, k = open_[r["__node"]]
        dim = max(_DIMS, key=lambda d: (r[f"hi{d}"] - r[f"lo{d}"]) / spread[d])
        work[r["__node"]] = {"dim": dim, "total": r["bytes"], "goal": r["bytes"] * (k // 2) / k, "eq": [], "lo": r[f"lo{dim}"], "hi": r[f"hi{dim}"], "before": 0}
    cuts: dict[int, tuple] = {}
    for level, name in enumerate(("coordinate", "__h", "__i")):
        todo = {i: w for i, w in work.items() if i not in cuts}
        if level and todo:  # the range of this key among the rows that are equal so far
            for r in _within(rows, todo).groupBy("__node").agg(F.min(name).alias("lo"), F.max(name).alias("hi")).collect():
                todo[r["__node"]] |= {"lo": r["lo"], "hi": r["hi"]}
        while active := {i: w for i, w in todo.items() if w["lo"] < w["hi"]}:
            _narrow(rows, active, name)
        for i, w in todo.items():
            w["eq"].append(w["lo"])
        # what the rows that are equal so far weigh decides whether the next key is needed
        for r in _within(rows, todo).groupBy("__node").agg(F.sum("__size").alias("bytes")).collect():
            w = work[r["__node"]]
            under, over = w["goal"] - w["before"], w["before"] + r["bytes"] - w["goal"]
            exact = level == 2 or min(under, over) == 0 or (level == 1 and r["bytes"] <= share)
            if exact:  # the nearer end of the group of equal keys
                eq = w["eq"] + [None] * (3 - len(w["eq"]))
                cuts[r["__node"]] = (w["dim"], *(eq if over <= under else _lower(eq)))
    return cuts


def _lower(eq: list) -> list:
    """The cut just before a group of equal keys: its last key less one."""
    last = max(i for i, x in enumerate(eq) if x is not None)
    return [x - 1 if i == last else x for i, x in enumerate(eq)]


def _key(w: dict, level: int) -> Column:
    return F.col(w["dim"] if level == 0 else ("__h", "__i")[level - 1])


def _within(rows: DataFrame, work: dict) -> DataFrame:
    """Rows of each node whose keys equal those that are settled so far."""
    cond = F.lit(False)
    for i, w in work.items():
        own = F.col("__node") == i
        for level, x in enumerate(w["eq"]):
            own = own & (_key(w, level) == F.lit(x))
        cond = cond | own
    return rows.filter(cond)


def _narrow(rows: DataFrame, work: dict, name: str) -> None:
    """One histogram round: each node's [lo, hi] shrinks to the bucket that holds its split point."""
    bucket = F.lit(None).cast("int")
    value = F.lit(None).cast("long")
    for i, w in work.items():
        key = _key(w, len(w["eq"]))
        width = -(-(w["hi"] - w["lo"] + 1) // BUCKETS)
        inside = (F.col("__node") == i) & (key >= F.lit(w["lo"])) & (key <= F.lit(w["hi"]))
        # decimals hold the whole span of 64-bit hashes
        b = F.floor((key.cast("decimal(20,0)") - F.lit(w["lo"]).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)")).cast("int")
        bucket = F.when(inside, b).otherwise(bucket)
        value = F.when(inside, key).otherwise(value)
    hist = _within(rows, work).select("__node", bucket.alias("b"), value.alias("v"), "__size").filter("b is not null")
    hist = hist.groupBy("__node", "b").agg(F.sum("__size").alias("bytes"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    goals = F.create_map(*[F.lit(x) for i, w in work.items() for x in (i, float(w["goal"] - w["before"]))])
    order = Window.partitionBy("__node").orderBy("b")
    upto = hist.withColumn("upto", F.sum("bytes").over(order)).withColumn("goal", goals[F.col("__node")])
    pick = upto.filter("upto >= goal").withColumn("k", F.row_number().over(order)).filter("k = 1")
    for r in pick.collect():
        w = work[r["__node"]]
        w["before"] += r["upto"] - r["bytes"]
        w["lo"], w["hi"] = r["lo"], r["hi"]


def _slots(rows: DataFrame, n: int) -> DataFrame:
    """``slot``: a row's number in its shard, gapless from 0."""
    cells = max(1, n // CELL_ROWS)
    rows = rows.withColumn("__cell", F.pmod(F.xxhash64("__i", "__h"), F.lit(cells)).cast("int"))
    counts = rows.groupBy("shard", "__cell").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("shard", "__cell").orderBy("__i", "__h")
    ranked = rows.withColumn("__k", F.row_number().over(inside) - 1)
    return ranked.join(base, ["shard", "__cell"]).withColumn("slot", (F.col("__base") + F.col("__k")).cast("long"))
