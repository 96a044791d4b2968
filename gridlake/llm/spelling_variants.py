"""Spelling variant grouping over a bit-sliced position index.

1. Vocabulary: runs of letters of whole texts are counted in their tasks and added up by Spark.
2. Words at one inserted, deleted or replaced code point are sought among words that agree outside an interval: of a word of m code points
   (the base) and one of m or m + 1, the single difference lies in the left or in the right half, so both have the other half in common. Each word
   stands in a bucket per half, as base and as the longer word. A bucket of more than ``BLOCK`` words is divided in the same way:
   its interval is halved, so that its words agree on ever more, down to one code point. So no bucket is met by all pairs, however many words
   share a half, and no pair is lost.
3. Buckets are range-sorted into blocks of about ``BLOCK`` words of one m. A block is indexed by one bitset over its words per (position, letter). All its
   bases run through the same recurrences at once, one bit a word: Z (no error so far), S (one replaced) and I (the word has one letter more,
   read one position ahead). With B[p] the bitset of a base's p-th letter at position p:
   S' = S & B[p] | Z & ~B[p]; Z' = Z & B[p]; I' = I & B+[p] | Z', where B+ is taken at position p + 1.
   After the last letter, S of equal lengths and I of words one letter longer are the answers.
4. A word's form is its near word of largest count if that is at least ``ratio`` times its own; roots follow the forms by pointer jumping (counts
   grow by ``ratio`` at each step, so chains are short).

Cases: a null or empty text has no words; a null id counts as an empty one; repeated rows count each; ties between near words go to the smallest in
code-point order; an empty table gives an empty result; words of any alphabet and length are taken; only the id and text columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices, whole_texts

MIN_LETTERS, MIN_COUNT, RATIO, DAMAGE = 7, 2, 10, 31
#: Words of an index block, and the size from which a bucket is divided.
BLOCK = 2048
#: Buckets to divide that are broadcast at most (their keys are words without an interval); more are joined by a shuffle.
MAX_BROADCAST_BUCKETS = 100_000
_HELD_WORDS = 200_000


def _count_batches(min_letters: int, damage: int):
    """(word, n) of one task, in parts of bounded size; from one run in ``damage``, by hash, one letter is deleted."""
    runs = re.compile(f"[a-zÀ-ÿ]{{{min_letters},}}")

    def part(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        counts: Counter = Counter()
        crc = zlib.crc32
        for batch in slices(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_buffer()
                if raw is None:
                    continue
                words = runs.findall(raw.to_pybytes().lower().decode("utf-8", "replace"))  # bytes.lower() is A-Z alone
                if damage:
                    start = crc(f"{'' if key is None else key}:".encode())
                    for i, h in enumerate([crc(w.encode(), start) for w in words]):
                        if h % damage == 0:
                            w = words[i]
                            at = h % len(w)
                            words[i] = w[:at] + w[at + 1 :] if len(w) > min_letters else None
                counts.update(words)
                counts.pop(None, None)
                if len(counts) > _HELD_WORDS:
                    yield part(counts)
                    counts.clear()
        yield part(counts)

    return run


def vocabulary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT,
               damage: int = DAMAGE) -> DataFrame:
    """``word, n``, written: words of at least ``min_letters`` code points that stand ``min_count`` times in all texts."""
    whole_texts(df.sparkSession)
    src = df.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).filter("text is not null")
    counted = src.mapInArrow(_count_batches(min_letters, damage), "word string, n long")
    return materialize(counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count), "vocabulary")


def _bitsets(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The letters of one position, sorted, and for each a bitset over the words; the last row is empty."""
    own = np.unique(letters)
    bits = np.zeros((len(own) + 1, -(-len(letters) // 64) * 8), np.uint8)
    packed = np.packbits(letters == own[:, None], axis=1, bitorder="little")
    bits[:-1, : packed.shape[1]] = packed
    return own, bits.view(np.uint64)


def _rows(table: tuple[np.ndarray, np.ndarray], letters: np.ndarray) -> np.ndarray:
    """The bitset of each letter."""
    own, bits = table
    at = np.searchsorted(own, letters)
    at[at == len(own)] = len(own) - 1
    return bits[np.where(own[at] == letters, at, len(own))]


def near_pairs(words: list[str], m: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of (base of m code points, word of m or m + 1) that differ by one error."""
    grid = np.zeros((len(words), m + 1), np.uint32)
    size = np.array([len(w) for w in words])
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    grid[np.arange(m + 1) < size[:, None]] = flat
    index = [_bitsets(grid[:, p]) for p in range(m + 1)]
    same, longer = _rows(_bitsets(size), np.array([m, m + 1]))
    bases = np.flatnonzero(size == m)
    left, right = [], []
    for i in range(0, len(bases), BLOCK):
        own = bases[i : i + BLOCK]
        zero = np.broadcast_to(same | longer, (len(own), len(same)))
        replaced, ahead = np.zeros(zero.shape, np.uint64), zero
        for p in range(m):
            c = grid[own, p]
            here = _rows(index[p], c)
            replaced = (replaced & here) | (zero & ~here)
            zero = zero & here
            ahead = (ahead & _rows(index[p + 1], c)) | zero
        hits = (replaced & same) | (ahead & longer)
        some = np.flatnonzero(hits.any(axis=1))
        base, word = np.nonzero(np.unpackbits(hits[some].view(np.uint8), axis=1, bitorder="little"))
        left.append(own[some[base]])
        right.append(word)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64),) * 2


def _pair_batches(batches):
    """Near pairs, both ways, of the sorted bucket rows (m, bucket, word, n)."""

    def found(m: int, words: list, counts: list) -> pa.RecordBatch:
        a, b = near_pairs(words, m)
        more = np.array([len(words[j]) > m for j in b], bool)  # equal lengths are found from both sides
        a, b = np.concatenate((a, b[more])), np.concatenate((b, a[more]))
        w, n = pa.array(words, pa.string()), pa.array(counts, pa.int64())
        a, b = pa.array(a), pa.array(b)
        return pa.RecordBatch.from_arrays([w.take(a), n.take(a), w.take(b), n.take(b)], names=["word", "n", "other", "other_n"])

    m, bucket, words, counts = None, None, [], []
    for batch in slices(batches):
        for own_m, own_bucket, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if words and (own_m != m or (own_bucket != bucket and len(words) >= BLOCK)):
                yield found(m, words, counts)
                words, counts = [], []
            m, bucket = own_m, own_bucket
            words.append(word)
            counts.append(n)
    if words:
        yield found(m, words, counts)


_BUCKET = ["m", "a", "b", "outside"]


def _halves(rows: DataFrame) -> DataFrame:
    """Each bucket row in the two buckets of its halved interval; an interval of one code point stays."""
    mid = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    both = F.array(F.struct(F.col("a").alias("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("b").alias("b")))
    rows = rows.select("word", "n", "m", F.explode(F.filter(both, lambda x: x["a"] < x["b"])).alias("i")).select("word", "n", "m", "i.a", "i.b")
    behind = F.col("b") + 1 + F.length("word") - F.col("m")
    return rows.withColumn("outside", F.concat(F.substring("word", F.lit(1), F.col("a")), F.lit("|"), F.substring("word", behind, F.length("word"))))


def bucket_rows(words: DataFrame) -> DataFrame:
    """``m, a, b, outside, word, n``: the buckets that each word stands in, written."""
    roles = F.filter(F.array(F.length("word"), F.length("word") - 1), lambda m: m > 0)
    rows = words.select("word", "n", F.explode(roles).alias("m")).withColumn("a", F.lit(0)).withColumn("b", F.col("m"))
    rows, done = materialize(_halves(rows), "buckets"), None
    while True:
        large = materialize(rows.filter("b - a > 1").groupBy(*_BUCKET).agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > BLOCK).drop("k"), "large")
        n = large.count()
        if n == 0:
            return rows if done is None else done.unionByName(rows)
        large = F.broadcast(large) if n <= MAX_BROADCAST_BUCKETS else large
        kept = rows.join(large, _BUCKET, "left_anti")
        done = kept if done is None else done.unionByName(kept)
        rows = materialize(_halves(rows.join(large, _BUCKET, "left_semi")), "buckets")


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, other, other_n`` for all words at one error, both ways, each pair once; words are distinct."""
    rows = bucket_rows(words).select(*_BUCKET, F.xxhash64(*_BUCKET).alias("bucket"), "word", "n")
    ranged = rows.repartitionByRange(*_BUCKET).sortWithinPartitions(*_BUCKET, "word")
    return ranged.select("m", "bucket", "word", "n").mapInArrow(_pair_batches, "word string, n long, other string, other_n long").distinct()


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each of the distinct ``word, n``."""
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    table = words.join(near, "word", "left").withColumn("is_form", -F.col("best.n") >= F.col("n") * ratio)
    table = table.select(
        "word", F.when(F.col("is_form"), F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("is_form"), -F.col("best.n")).alias("form_n"),
    )
    table = materialize(table, "forms")
    roots = materialize(table.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:  # a root that has a form itself is followed, two steps become one
        up = roots.select(F.col("word").alias("root"), F.col("root").alias("above"))
        step = materialize(roots.join(up, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "roots")
        roots = step.select("word", "root")
        if step.filter("moved").isEmpty():
            break
    return table.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
