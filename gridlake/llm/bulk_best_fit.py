"""Best-fit packing in bulk-synchronous rounds: all pieces of a size class look for their tightest gaps at once.

1. Every document becomes ids of a public tokenizer and an end id; only longer ones are cut, into full windows and a rest. Pieces, with their ids,
   are written once; the rounds move (key, length) alone.
2. Pieces longer than half a window can't share one: each opens a sequence and leaves a gap. The others follow in size classes, large ones first.
3. A round range-sorts the class's pieces and the gaps by size (a piece before a gap of its size). A gap that takes several pieces of the class
   in any case stands for as many slots of equal shares of it; of gaps that take any piece, only the tightest that suffice take part. In ascending
   order a slot takes the largest waiting piece that still fits: the matching that best-fit decreasing makes with one piece per slot, in
   which pieces open and slots close like parentheses. Tasks match inside their range by depth, with numpy. What is left of a range is a row
   of slots, then a row of pieces; how such rows of all ranges meet is settled from their lengths alone (two numbers a task), and pieces and
   slots that fall to each other are joined by their rank.
4. Gaps shrink by what they took, and the next round begins. New sequences are opened for the pieces that the gaps, at the mean length left,
   can't hold, and where a round matched nothing. Offsets come last, as running sums inside each sequence (at most ``window`` rows).

No length, gap or copy meets in one task: equal sizes are dealt by key. To the driver go a histogram of gap sizes (at most ``window`` rows) and
two numbers a task.

Cases: a null or empty text is its end id alone; repeated rows are packed each; null ids are carried along; an empty table gives an empty result; of
extra columns only those named in ``carry`` are kept, and ones that clash with the operator's own are dropped.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import MAX_BROADCAST_IDS, blocks, materialize, slices, text_bytes, whole_texts, worker_cache
from .pretoken import _Ids as RememberedIds

WINDOW = 4096
END_ID = 1
#: Lower bounds of the size classes, as shares of a window.
CLASSES = (2, 3, 6, 24, 192)
_OWN = ("key", "piece", "start", "length", "ids", "sequence_id", "offset")

#: The pre-token pattern of the word vocabulary (fixed value).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Longest chunk that is remembered.
_MAX_CHUNK = 64
#: Characters for which lower-casing and splitting are the same here and in the tokenizer's library; other texts go to the library.
_PLAIN = r"[\t-\r -~¡-įı-ſЀ-џ‐-‧‰-⁞]*+"


class _ChunkIds(RememberedIds):
    """Ids of what stands between white space; pre-tokens don't reach across it. Long chunks aren't remembered."""

    def __init__(self, tokenizer):
        super().__init__(tokenizer)
        self.words = regex.compile(_PATTERN).findall
        self.known = RememberedIds(tokenizer)

    def rotate(self) -> None:
        super().rotate()
        self.known.rotate()

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            if chunk.isalpha():  # one pre-token
                seen = chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(self.symbols)
                ids = array("I", [t.id for t in self.model.tokenize(seen)]).tobytes()
            else:
                ids = b"".join([self[x] if x.isalpha() else self.known[x] for x in self.words(chunk)])
        if len(chunk) <= _MAX_CHUNK:
            self[chunk] = ids
        return ids


class WordEncoder:
    """Ids of texts for a lower-casing word vocabulary, equal to the library's: a remembered result per chunk and pre-token."""

    def __init__(self, raw: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = re.compile(_PLAIN).fullmatch
        self.known = _ChunkIds(self.tokenizer)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian uint32 bytes."""
        if not self.plain(text) or any(x in text for x in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.known.__getitem__, text.lower().split()))


def _piece_batches(vocabulary, tag: str, window: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        cache = worker_cache("word-ids")
        if tag not in cache:
            cache[tag] = WordEncoder(vocabulary.value)
        enc = cache[tag]
        key = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            buf, offs = text_bytes(batch.column(batch.num_columns - 1))
            for a, b in blocks(offs):
                enc.known.rotate()
                doc, piece, start, length, ids = [], [], [], [], []
                for i in range(a, b):
                    x = enc.encode(buf[offs[i] : offs[i + 1]].tobytes().decode("utf-8", "replace")) + end
                    n = len(x) // 4
                    for s in range(0, n, window):
                        doc.append(i)
                        piece.append(s // window)
                        start.append(s)
                        length.append(min(window, n - s))
                        ids.append(x[4 * s : 4 * (s + window)])
                cols = [batch.column(i).take(pa.array(doc)) for i in range(batch.num_columns - 1)]
                own = [pa.array(range(key, key + len(doc)), pa.int64())]
                own += [pa.array(v, t) for v, t in ((piece, pa.int32()), (start, pa.int64()), (length, pa.int64()), (ids, pa.binary()))]
                key += len(doc)
                yield pa.RecordBatch.from_arrays(cols + own, names=[*batch.schema.names[:-1], *_OWN[:5]])

    return run


def window_pieces(df: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), path: str | None = None,
                  window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``window`` ids, written once: ``carry``, key (unique), piece, start, length, ids (little-endian uint32)."""
    spark = df.sparkSession
    whole_texts(spark)
    with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        raw = f.read()
    vocabulary, tag = spark.sparkContext.broadcast(raw), hashlib.sha1(raw.encode()).hexdigest()
    carry = [c for c in carry if c.lower() not in _OWN]
    src = df.select(*[F.col(f"`{c}`") for c in carry], F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[:-1])
    schema += "key long, piece int, start long, length long, ids binary"
    return materialize(src.mapInArrow(_piece_batches(vocabulary, tag, window, end_id), schema), "window-pieces")


class _Waiting:
    """Pieces that wait for a slot, the largest on top, in chunks."""

    def __init__(self):
        self.chunks: list[np.ndarray] = []

    def push(self, rows: np.ndarray) -> None:
        if rows.shape[1]:
            self.chunks.append(rows)

    def pop(self, n: int) -> np.ndarray:
        """Up to ``n`` of them, from the top down."""
        got = []
        while n and self.chunks:
            top = self.chunks.pop()
            if top.shape[1] > n:
                self.push(top[:, :-n])
                top = top[:, -n:]
            got.append(top[:, ::-1])
            n -= top.shape[1]
        return np.concatenate(got, axis=1) if got else np.zeros((2, 0), np.int64)


def match_sorted(is_gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Matches pieces (False) and slots (True) in ascending order, each slot with the last free piece before it:
    (matched pieces, their slots, free slots, free pieces), as positions."""
    level = np.cumsum(np.where(is_gap, -1, 1))
    least = np.minimum.accumulate(np.minimum(level, 0))
    free_gap = is_gap & (level < np.append(0, least[:-1]))
    depth = level - least + is_gap
    at = np.flatnonzero(~free_gap)
    order = at[np.argsort(depth[at], kind="stable")]
    # at one depth pieces and slots take turns; a piece without a slot is the last of its depth
    pair = ~is_gap[order[:-1]] & is_gap[order[1:]] & (depth[order[:-1]] == depth[order[1:]])
    pieces, slots = order[:-1][pair], order[1:][pair]
    open_ = ~is_gap
    open_[pieces] = False
    return pieces, slots, np.flatnonzero(free_gap), np.flatnonzero(open_)


_SWEEP = "part int, ord long, key long, length long, seq long, room long"


def _sweep_batches(batches):
    """One range of the sorted pieces and slots: matched pairs, slots left (``key`` is null, numbered upwards), and
    pieces left (``seq`` is null, numbered from the largest down); then, numbered -1, how many slots and pieces are left."""
    part, waiting, slots_left = TaskContext.get().partitionId(), _Waiting(), 0

    def rows(ord_, pieces, slots):
        n = len(ord_)
        null = pa.nulls(n, pa.int64())
        cols = [pa.array(np.full(n, part, np.int32)), pa.array(ord_)]
        cols += [pa.array(x) for x in pieces] if pieces is not None else [null, null]
        cols += [pa.array(x) for x in slots] if slots is not None else [null, null]
        return pa.RecordBatch.from_arrays(cols, names=["part", "ord", "key", "length", "seq", "room"])

    for batch in batches:
        is_gap, ids, amount = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        both = np.stack([ids, amount])
        pieces, slots, free_slots, free_pieces = match_sorted(is_gap)
        if len(pieces):
            yield rows(np.zeros(len(pieces), np.int64), both[:, pieces], both[:, slots])
        older = waiting.pop(len(free_slots))
        k = older.shape[1]
        if k:
            yield rows(np.zeros(k, np.int64), older, both[:, free_slots[:k]])
        left = free_slots[k:]
        if len(left):
            yield rows(np.arange(slots_left, slots_left + len(left)), None, both[:, left])
            slots_left += len(left)
        waiting.push(both[:, free_pieces])
    at = 0
    while waiting.chunks:
        left = waiting.pop(50_000)
        yield rows(np.arange(at, at + left.shape[1]), left, None)
        at += left.shape[1]
    if at or slots_left:
        yield rows(np.array([-1]), np.array([[-1], [slots_left]]), np.array([[-1], [at]]))


def ranges_met(left: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """How free slots and free pieces of ranges meet, from (part, slots left, pieces left) in order: runs of
    (rank of the first, count, part of the slots, first slot, part of the pieces, first piece)."""
    runs, waiting, rank = [], [], 0
    for part, slots, pieces in left:
        at = 0
        while at < slots and waiting:
            own, first, last = waiting.pop()
            n = min(slots - at, last - first)
            runs.append((rank, n, part, at, own, first))
            rank, at = rank + n, at + n
            if first + n < last:
                waiting.append((own, first + n, last))
        if pieces:
            waiting.append((part, 0, pieces))
    return runs


def _met(spark: SparkSession, swept: DataFrame, runs: list, slots: bool) -> DataFrame:
    """The rows left of one kind, with ``rank`` where they meet the other kind (null: they don't)."""
    table = [(r, n, a, b) if slots else (r, n, c, d) for r, n, a, b, c, d in runs]
    own = F.broadcast(spark.createDataFrame(table, "rank0 long, n long, part int, first long"))  # at most two runs a task
    rows = swept.filter("key is null" if slots else "seq is null").alias("s")
    inside = (F.col("s.part") == F.col("o.part")) & (F.col("s.ord") >= F.col("o.first")) & (F.col("s.ord") < F.col("o.first") + F.col("o.n"))
    rank = (F.col("o.rank0") + F.col("s.ord") - F.col("o.first")).alias("rank")
    return rows.join(own.alias("o"), inside, "left").select(rank, *[f"s.{c}" for c in ("key", "length", "seq", "room")])


def _sweep(spark: SparkSession, pieces: DataFrame, slots: DataFrame, single: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round: (matched pieces: key, length, seq), (pieces left: key, length), (gaps that took part: seq, room).
    ``single``: no gap has several slots."""
    docs = pieces.select(F.col("length").alias("size"), F.lit(False).alias("is_gap"), F.col("key").alias("id"), F.lit(0).cast("long").alias("slot"), F.col("length").alias("amount"))
    gaps = slots.select("size", F.lit(True).alias("is_gap"), F.col("seq").alias("id"), "slot", F.col("room").alias("amount"))
    order = ["size", "is_gap", "id", "slot"]
    ranged = docs.unionByName(gaps).repartitionByRange(*order).sortWithinPartitions(*order)
    swept = materialize(ranged.select("is_gap", "id", "amount").mapInArrow(_sweep_batches, _SWEEP), "sweep")
    # each range's last row says how many slots and pieces it has left
    runs = ranges_met(sorted((r["part"], r["length"], r["room"]) for r in swept.filter("ord = -1").collect()))
    swept = swept.filter("ord >= 0")
    matched = swept.filter("key is not null and seq is not null").select("key", "length", "seq", "room")
    left = swept.filter("seq is null").select("key", "length")
    idle = swept.filter("key is null")
    if runs:
        met = _met(spark, swept, runs, False)
        taken = met.filter("rank is not null").select("rank", "key", "length")
        open_ = _met(spark, swept, runs, True)
        idle, given = open_.filter("rank is null"), open_.filter("rank is not null").select("rank", "seq", "room")
        given = F.broadcast(given) if sum(r[1] for r in runs) <= MAX_BROADCAST_IDS else given
        far = materialize(taken.join(given, "rank"), "across")
        matched = matched.unionByName(far.select("key", "length", "seq", "room"))
        left = met.filter("rank is null").select("key", "length")
    after = matched.select("seq", "room", "length").unionByName(idle.select("seq", "room", F.lit(0).cast("long").alias("length")))
    if single:
        after = after.select("seq", (F.col("room") - F.col("length")).alias("room"))
    else:
        after = after.groupBy("seq").agg((F.max("room") - F.sum("length")).alias("room"))
    return matched.select("key", "length", "seq"), left, after


def _to_open(rooms: dict[int, int], pieces: int, tokens: int, hi: int, window: int) -> int:
    """Sequences to open so that the gaps hold the pieces left, all taken to have their mean length."""
    mean = max(1, -(-tokens // pieces))
    held = sum(n * (room // mean) for room, n in rooms.items())
    return max(0, -(-(pieces - held) // (window // mean)))


def bulk_best_fit(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``key, sequence_id, offset`` for pieces ``key, length`` (keys not negative, lengths of 1 to ``window``)."""
    spark = pieces.sparkSession
    rows = pieces.select("key", "length")
    placed = [rows.filter(F.col("length") * 2 > window).withColumn("seq", F.col("key"))]
    gaps = placed[0].filter(F.col("length") < window).select("seq", (F.lit(window) - F.col("length")).alias("room"))
    sizes = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    opened = 0
    bounds = sorted({window // c for c in CLASSES}, reverse=True) + [0]
    for hi, lo in zip(bounds, bounds[1:]):
        own = {k: n for k, n in sizes.items() if lo < k <= hi}
        left, count, tokens = rows.filter((F.col("length") > lo) & (F.col("length") <= hi)), sum(own.values()), sum(k * n for k, n in own.items())
        stuck = False
        while count:
            rooms = {r["room"]: r["n"] for r in gaps.filter(F.col("room") > lo).groupBy("room").agg(F.count(F.lit(1)).alias("n")).collect()}
            fresh = -(-count // (window // hi)) if stuck else _to_open(rooms, count, tokens, hi, window)
            if not rooms:
                fresh = max(fresh, 1)
            if fresh:
                new = spark.range(opened, opened + fresh).select((-1 - F.col("id")).alias("seq"), F.lit(window).cast("long").alias("room"))
                gaps, opened = gaps.unionByName(new), opened + fresh
                rooms[window] = rooms.get(window, 0) + fresh
            # the tightest gaps that take any piece of the class and have a slot for each
            need, widest = count, window
            for room in sorted(r for r in rooms if r >= hi):
                need -= rooms[room] * (room // hi)
                if need <= 0:
                    widest = room
                    break
            room = F.col("room")
            chosen = gaps.filter((room > lo) & (room <= widest)).withColumn("s", F.greatest(F.lit(1), F.floor(room / hi)))
            slots = chosen.select("seq", "room", F.floor(room / F.col("s")).alias("size"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("s"))).alias("slot"))
            matched, rest, after = _sweep(spark, left, slots, all(room // hi <= 1 for room in rooms if room <= widest))
            placed.append(matched)
            gaps = materialize(after.filter("room > 0").unionByName(gaps.filter((room <= lo) | (room > widest))), "gaps")
            now = rest.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("t")).first()
            stuck = now["n"] == count
            left, count, tokens = rest, now["n"], now["t"]
    every = placed[0]
    for part in placed[1:]:
        every = every.unionByName(part)
    before = Window.partitionBy("seq").orderBy(F.desc("length"), "key").rowsBetween(Window.unboundedPreceding, -1)
    return every.select("key", F.col("seq").alias("sequence_id"), F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))


def pack_bulk(df: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), path: str | None = None, window: int = WINDOW,
              end_id: int = END_ID) -> DataFrame:
    """Pieces with their ids and places: ``carry``, piece, start, length, ids, sequence_id, offset."""
    pieces = window_pieces(df, text_col, carry, path, window, end_id)
    return pieces.join(bulk_best_fit(pieces, window), "key").drop("key")
