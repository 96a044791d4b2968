"""Quotation linking: quoted passages lead each message to the one it answers, and conversations come out without quotes.

A line's quote level is the number of its leading ``>``. Paragraphs of one level, and their longer lines, are normalised (lower case,
letters and digits only) and hashed. Unquoted passages are a message's own. A passage's context is the last passage before it, one level
deeper, in the same message: what it answers. The passages of a message's shallowest quote level (k) vote, by their length, each for the
latest earlier message of the scope that has it at level k - 1 in the same context, else for the latest that has it at level k - 1, else for the
latest that has it as its own. So turns that repeat are told apart by what they answer. The most votes
make the parent (ties: the smallest id), which is an earlier message, so the links form trees. The latest earlier message is found in a range-sorted
table whose partitions hand their last one on: equal passages neither multiply nor meet in one task. Roots and depths follow by pointer jumping, positions (by depth, then id) by a range-sorted table
whose partitions are numbered and offset, so no conversation meets in one task.

Cases: messages without a scope form a scope of their own, and scopes keep their type; an attribution line above a quote ("On Monday Ann wrote:")
is the message's own text, and only ``>`` marks a quote; a null or empty text has no passages and no parent, its own text is null or empty; a passage without letters or digits is not
hashed; repeated rows of one id in one scope are one message (the first by text); rows without an id are left out; an empty table gives an
empty result; extra columns are dropped, names can't clash.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

MIN_LINE_WORDS = 4
_QUOTE = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
_NOT_WORD = re.compile(r"[\W_]+")


def quote_level(line: str) -> tuple[int, str]:
    """(number of leading quote marks, the line without them)."""
    m = _QUOTE.match(line)
    return (m[1].count(">"), line[m.end() :]) if m else (0, line)


def passages(text: str) -> list[tuple[int, str]]:
    """(level, normalised passage): paragraphs of one level, and their lines of some words."""
    out, level, para = [], 0, []
    for line in [*text.split("\n"), ""]:
        lv, body = quote_level(line)
        words = _NOT_WORD.sub(" ", body.lower()).strip()
        if para and (lv != level or not words):
            whole = " ".join(para)
            out.append((level, whole))
            out += [(level, x) for x in para if x != whole and x.count(" ") + 1 >= MIN_LINE_WORDS]
            para = []
        if words:
            level = lv
            para.append(words)
    return out


def own_text(text: str) -> str:
    """The text without quoted lines and without the blank lines that they leave at its ends."""
    return "\n".join(x for x in text.split("\n") if quote_level(x)[0] == 0).strip("\n")


def _passage_batches(batches):
    for batch in batches:
        rows = []
        for scope, key, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            last, seen = {}, set()
            for level, words in passages(text or ""):
                digest = hashlib.blake2b(words.encode(), digest_size=16).hexdigest()
                last[level] = digest
                if (level, digest) not in seen:
                    seen.add((level, digest))
                    rows.append((scope, key, level, digest, len(words), last.get(level + 1, "")))
        types = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["scope", "id", "level", "hash", "weight", "context"])


def _own_batches(batches):
    for batch in batches:
        own = [None if t is None else own_text(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.string())], names=["scope", "id", "text"])


def _latest(writers: DataFrame, readers: DataFrame, keys: list[str]) -> DataFrame:
    """``readers`` with ``parent``: the largest smaller id among the writers of the same keys, or null."""
    cols = [*readers.columns, "parent"]
    known = writers.select(*keys, "id").distinct().withColumn("parent", F.col("id"))
    both = readers.withColumn("parent", F.lit(None).cast("long")).unionByName(known, allowMissingColumns=True)
    both = both.withColumn("writes", F.col("parent").isNotNull())
    order = [*keys, "id", "writes"]
    both = both.repartitionByRange(*order).sortWithinPartitions(*order)
    both = materialize(both.withColumn("part", F.spark_partition_id()), "as-of")
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.groupBy(*keys, "part").agg(F.max("parent").alias("m")).select(*keys, "part", F.max("m").over(before).alias("carried")).filter("carried is not null")
    inside = Window.partitionBy(*keys, "part").orderBy("id", "writes").rowsBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("near", F.max("parent").over(inside)).filter("not writes").drop("parent")
    return near.join(carried, [*keys, "part"], "left").withColumn("parent", F.coalesce("near", "carried")).select(*cols)


def threads(df: DataFrame, id_col: str, text_col: str, scope_col: str | None = None) -> DataFrame:
    """``scope, id, parent, root, depth, position, text`` per message; links stay within a scope (none: one for all)."""
    # a null scope is one of its own, apart from the empty one
    own = F.lit("") if scope_col is None else F.col(f"`{scope_col}`")
    scope = F.coalesce(F.concat(F.lit("="), own.cast("string")), F.lit(""))
    src = df.select(scope.alias("scope"), F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    src = materialize(src.filter("id is not null").groupBy("scope", "id").agg(F.min("text").alias("text")), "messages")
    found = materialize(src.mapInArrow(_passage_batches, "scope string, id long, level int, hash string, weight long, context string"), "passages")
    # readers: the passages of each message's shallowest quote level, sought one level higher
    quoted = found.filter("level > 0")
    shallow = quoted.groupBy("scope", "id").agg(F.min("level").alias("level"))
    left = quoted.join(shallow, ["scope", "id", "level"]).withColumn("level", F.col("level") - 1)
    linked = None
    for keys, writers in ((["scope", "hash", "level", "context"], found), (["scope", "hash", "level"], found), (["scope", "hash"], found.filter("level = 0"))):
        asked = materialize(_latest(writers, left, keys), "asked")
        linked = asked if linked is None else linked.filter("parent is not null").unionByName(asked)
        left = asked.filter("parent is null").drop("parent")
        if left.isEmpty():
            break
    votes = linked.filter("parent is not null").groupBy("scope", "id", "parent").agg(F.sum("weight").alias("w"))
    best = votes.groupBy("scope", "id").agg(F.max(F.struct("w", (-F.col("parent")).alias("p"))).alias("b")).select("scope", "id", (-F.col("b.p")).alias("parent"))
    links = materialize(src.select("scope", "id").join(best, ["scope", "id"], "left"), "replies")
    tree = links.select("scope", "id", "parent", F.coalesce("parent", "id").alias("top"), F.col("parent").isNotNull().cast("long").alias("depth"), F.col("parent").isNull().alias("done"))
    while not tree.filter("not done").isEmpty():
        up = tree.select("scope", F.col("id").alias("top"), F.col("top").alias("top2"), F.col("depth").alias("depth2"), F.col("done").alias("done2"))
        step = tree.filter("not done").join(up, ["scope", "top"]).select("scope", "id", "parent", F.col("top2").alias("top"), (F.col("depth") + F.col("depth2")).alias("depth"), F.col("done2").alias("done"))
        tree = materialize(tree.filter("done").unionByName(step), "tree")
    # positions: sorted partitions are numbered; a conversation's earlier partitions give its offset
    ordered = tree.repartitionByRange("scope", "top", "depth", "id").sortWithinPartitions("scope", "top", "depth", "id")
    ordered = materialize(ordered.withColumn("row", F.monotonically_increasing_id()), "ordered").withColumn("part", F.shiftright("row", 33))
    runs = ordered.groupBy("scope", "top", "part").agg(F.min("row").alias("begin"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("scope", "top").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = runs.select("scope", "top", "part", "begin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = ordered.join(base, ["scope", "top", "part"]).withColumn("position", F.col("row") - F.col("begin") + F.col("base"))
    text = src.mapInArrow(_own_batches, "scope string, id long, text string")
    named = F.when(F.col("scope") != "", F.substring("scope", 2, 2**31 - 1)).cast(df.select(own.alias("s")).schema["s"].dataType)
    return placed.join(text, ["scope", "id"]).select(named.alias("scope"), "id", "parent", F.col("top").alias("root"), "depth", "position", "text")
