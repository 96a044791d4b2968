"""Packing by best-fit decreasing: every piece goes to the open window with the least room that still takes it.

1. Every document becomes ids of a public tokenizer and an end id; longer than a window, it is first cut into full windows and
   a rest. Pieces, with their ids, are written once. Each task numbers its pieces of one length.
2. Best-fit decreasing needs no more than the number of pieces of each length (at most ``window`` numbers). Equal lengths
   are placed together: the tightest open windows, found by a segment tree over the remaining capacity, each take as many as fit.
   The result is a list of runs: pieces number lo to hi of a length fill these windows from this offset on. It is exactly
   what placing the pieces one by one gives, for any number of documents.
3. A piece's number among all of its length is its number in its task plus those of earlier tasks (a running
   sum over tasks x lengths); its run follows by binary search. Ids aren't shuffled, and no length meets in one task.

Cases: a null or empty text is its end id alone; repeated rows are packed each; null ids are carried along; an empty table gives an empty
result; of extra columns only those named in ``carry`` are kept, and ones that clash with the operator's own are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, lean, materialize, slices, text_bytes, whole_texts
from .pretoken import default_tokenizer, encoder

WINDOW = 2048
END_ID = 1
_OWN = ("start", "length", "doc_tokens", "ids", "task", "number", "sequence_id", "offset")


def _piece_batches(path: str, window: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        enc = encoder(path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for batch in slices(batches):
            buf, offs = text_bytes(batch.column(batch.num_columns - 1))
            for a, b in blocks(offs):
                raw = buf[offs[a] : offs[b]].tobytes()
                at = offs[a : b + 1] - offs[a]
                texts = [raw[at[i] : at[i + 1]].decode("utf-8", "replace") for i in range(b - a)]
                doc, start, length, total, ids = [], [], [], [], []
                for i, x in enumerate(enc.encode(texts)):
                    x += end
                    n = len(x) // 4
                    for s in range(0, n, window):
                        doc.append(a + i)
                        start.append(s)
                        length.append(min(window, n - s))
                        total.append(n)
                        ids.append(x[4 * s : 4 * (s + window)])
                number = []
                for k in length:
                    number.append(seen[k])
                    seen[k] += 1
                cols = [batch.column(i).take(pa.array(doc)) for i in range(batch.num_columns - 1)]
                own = [pa.array(v, pa.int64()) for v in (start, length, total)] + [pa.array(ids, pa.binary())]
                own += [pa.array([task] * len(doc), pa.int32()), pa.array(number, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols + own, names=[*batch.schema.names[:-1], *_OWN[:6]])

    return run


def cut_pieces(df: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), path: str | None = None,
               window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``window`` ids, written once: ``carry``, start, length, doc_tokens, ids (little-endian uint32), task, number."""
    whole_texts(df.sparkSession)
    carry = [c for c in carry if c.lower() not in _OWN]
    src = df.select(*[F.col(f"`{c}`") for c in carry], F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    schema += (", " if carry else "") + "start long, length long, doc_tokens long, ids binary, task int, number long"
    return materialize(src.mapInArrow(lean(_piece_batches(path or default_tokenizer(), window, end_id)), schema), "pieces")


class _Open:
    """Open windows by remaining capacity: ranges of sequence ids, and a segment tree that finds the least sufficient capacity."""

    def __init__(self, window: int):
        self.size = 1
        while self.size <= window:
            self.size *= 2
        self.tree = [False] * (2 * self.size)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]

    def _mark(self, room: int) -> None:
        i = room + self.size
        self.tree[i] = bool(self.ranges[room])
        while i > 1:
            i //= 2
            self.tree[i] = self.tree[2 * i] or self.tree[2 * i + 1]

    def add(self, room: int, first: int, count: int) -> None:
        if room and count:
            self.ranges[room].append((first, count))
            self._mark(room)

    def tightest(self, need: int) -> int | None:
        """The least capacity >= need that an open window has."""
        i = need + self.size
        if not self.tree[i]:
            while i > 1 and (i % 2 == 1 or not self.tree[i + 1]):  # climb until a right neighbour has one
                i //= 2
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.tree[2 * i] else 2 * i + 1
        return i - self.size

    def take(self, room: int) -> tuple[int, int]:
        got = self.ranges[room].pop()
        self._mark(room)
        return got


def best_fit_runs(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, lo, per, first, offset): pieces lo, lo + 1, ... of that length fill the windows first, first + 1, ...
    with ``per`` in each, from ``offset`` on, until the next run of that length begins."""
    runs, made, open_ = [], 0, _Open(window)
    for length in sorted(counts, reverse=True):
        lo, left = 0, counts[length]
        while left:
            room = open_.tightest(length) if length <= window else None
            if room is None:
                per = window // length
                first, count, room = made, -(-left // per), window
                made += count
            else:
                per = room // length
                first, count = open_.take(room)
            full = min(count, left // per)
            rest = left - full * per if full < count else 0
            rest = min(rest, per)
            runs.append((length, lo, per, first, window - room))
            open_.add(room - per * length, first, full)
            used = full
            if full < count and rest:
                open_.add(room - rest * length, first + full, 1)
                used += 1
            if used < count:
                open_.add(room, first + used, count - used)
            lo += full * per + rest
            left -= full * per + rest
    return runs


def _place_batches(runs):
    def run(batches):
        length, lo, per, first, offset = runs.value
        key = (length << 40) | lo
        for batch in slices(batches):
            n, rank = (batch.column(batch.schema.names.index(c)).to_numpy() for c in ("length", "__rank"))
            at = np.searchsorted(key, (n << 40) | rank, "right") - 1
            inside = rank - lo[at]
            seq = first[at] + inside // per[at]
            off = offset[at] + inside % per[at] * n
            keep = [i for i, c in enumerate(batch.schema.names) if c != "__rank"]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(seq), pa.array(off)], names=[batch.schema.names[i] for i in keep] + ["sequence_id", "offset"])

    return run


def place(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (drops ``task`` and ``number``)."""
    spark = pieces.sparkSession
    counts = materialize(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = sorted(best_fit_runs(totals, window))
    table = np.array(runs, np.int64).reshape(-1, 5).T.copy()
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    ranked = pieces.join(base, ["length", "task"]).withColumn("__rank", F.col("number") + F.col("__before")).drop("task", "number", "__before")
    schema = ranked.drop("__rank").withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    return ranked.mapInArrow(_place_batches(spark.sparkContext.broadcast(table)), schema)


def pack(df: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), path: str | None = None, window: int = WINDOW,
         end_id: int = END_ID) -> DataFrame:
    """Pieces with their ids and places: ``carry``, start, length, doc_tokens, ids, sequence_id, offset."""
    return place(cut_pieces(df, text_col, carry, path, window, end_id), window)
