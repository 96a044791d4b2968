"""Language ID by prediction by partial matching: one variable-order byte context tree per language.

Training counts the byte sequences of up to ``ORDER + 1`` bytes in a bounded sample of labelled rows, per language.
A context tree is the set of these counts: an order-k context is a node, its children are the bytes seen after it.
Statistics are frozen after training. A byte that was seen c times in a context with n occurrences and d distinct
followers costs -log2(c / (n + d)) there; an unseen byte pays the escape -log2(d / (n + d)) and is coded by the next shorter context (method C,
without exclusions); a context that was never seen costs nothing. Below order 0 all 256 bytes cost 8 bits.

The code length of a text under each language is the exact sum over all its bytes, in 1/256 bits. Every text starts
after ``ORDER`` zero bytes. The best language wins (ties: the first in order); the score is its posterior probability at equal priors.

Plan. The counts are a Spark aggregation over the sample and are broadcast: their number is bounded by the sample's bytes and
filtered to the contexts that the dense tables need. Each worker process builds the tables once. A text is scored
where it lies, by one table look-up per byte for all languages together, in blocks of bounded size: no shuffle at all.

Cases: a null text, or one without a letter, is ``und`` with score 0; empty tables give empty results; without
labelled rows every text is ``und``; ties go to the first language in order; repeated rows are scored alike; extra columns are kept, and
clashing names are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, lean, materialize, slices, text_bytes, whole_texts, worker_cache

ORDER = 3
#: Rows of an Arrow batch.
BATCH_ROWS = 250
#: Bound of the training sample: rows per language, drawn by a hash of id and text (rows that are equal in both are drawn together).
MAX_ROWS_PER_LANGUAGE = 1000
#: Languages whose dense tables a worker holds at a time; more are scored in as many passes.
LANGUAGE_BLOCK = 16
#: Byte pairs that the order-3 tables index densely: the most frequent ones of the sample. Texts with other pairs
#: are scored by the same formulas from the sparse counts.
MAX_PAIRS = 2000
UNDETERMINED = "und"
_UNIT = 256  # code lengths in 1/256 bit


def _count_batches(order: int):
    """(lang, n-gram as a number with its length on top, count) of each batch of training rows."""

    def run(batches):
        for batch in slices(batches):
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            buf, offs = text_bytes(batch.column(1))
            for lang in sorted(set(langs)):
                parts, real = [], []
                for i in np.flatnonzero(langs == lang):
                    text = buf[offs[i] : offs[i + 1]]
                    parts += [np.zeros(order, np.uint8), text]
                    real += [np.zeros(order, bool), np.ones(len(text), bool)]
                joined, real = np.concatenate(parts).astype(np.int64), np.concatenate(real)
                keys, counts = [], []
                for k in range(order + 1):
                    own, n = np.unique(_gram(joined, k)[real], return_counts=True)
                    keys.append(own + ((k + 1) << 40))
                    counts.append(n)
                keys, counts = np.concatenate(keys), np.concatenate(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts.astype(np.int64))],
                    names=["lang", "gram", "n"],
                )

    return run


def _gram(b: np.ndarray, k: int) -> np.ndarray:
    """At each position the number of the k + 1 bytes that end there (positions before the k-th hold less)."""
    out = np.zeros(len(b), np.int64)
    for j in range(k + 1):
        out[j:] |= b[: len(b) - j] << (8 * j)
    return out


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_rows: int = MAX_ROWS_PER_LANGUAGE) -> dict:
    """Frozen counts per language from at most ``max_rows`` rows of each language, whole texts, drawn by a hash of the id."""
    whole_texts(df.sparkSession, BATCH_ROWS)
    text = F.col(f"`{text_col}`").cast("string")
    rows = df.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), text.alias("text"), F.xxhash64(F.col(f"`{id_col}`").cast("string"), text).alias("h"))
    rows = rows.filter("lang is not null and text is not null")
    totals = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("least")).orderBy("lang").collect()
    if not totals:
        return {"langs": [], "grams": np.zeros(0, np.int64), "counts": np.zeros((0, 0), np.int64)}
    # The hash is uniform: a threshold per language draws max_rows in expectation, without a sort or a shuffle of texts. Where rows
    # repeat so often that it draws none, those of the least hash are drawn, one of them.
    top = {r["lang"]: -(2**63) + int(min(1.0, max_rows / r["n"]) * (2.0**64 - 2**12)) if r["n"] > max_rows else 2**63 - 1 for r in totals}
    tops = F.create_map(*[F.lit(x) for pair in top.items() for x in pair])
    sample = rows.filter(F.col("h") <= tops[F.col("lang")]).select("lang", "text")
    none = [r["lang"] for r in totals if r["least"] > top[r["lang"]]]
    if none:
        sample = sample.unionByName(rows.filter(F.col("lang").isin(none)).groupBy("lang").agg(F.min_by("text", "h").alias("text")))
    grams = sample.mapInArrow(lean(_count_batches(ORDER), "ppm"), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    got = grams.toArrow()
    langs = sorted(r["lang"] for r in totals)
    place = {x: i for i, x in enumerate(langs)}
    lang_of = np.array([place[x] for x in got.column("lang").to_pylist()], np.int64)
    keys, where = np.unique(got.column("gram").to_numpy(), return_inverse=True)
    counts = np.zeros((len(keys), len(langs)), np.int32)
    counts[where, lang_of] = got.column("n").to_numpy()
    return {"langs": langs, "grams": keys, "counts": counts}


class _Tables:
    """Code lengths of all languages, by context and byte, from the frozen counts."""

    def __init__(self, model: dict, max_pairs: int = MAX_PAIRS):
        grams, counts = model["grams"], model["counts"].astype(np.float64)
        L = counts.shape[1]
        by = {k: (grams >> 40) == k + 1 for k in range(ORDER + 1)}
        key = {k: grams[by[k]] & ((1 << 40) - 1) for k in by}
        cnt = {k: counts[by[k]] for k in by}
        # Order -1 and 0: cost0[byte]
        self.cost0 = self._order(np.full((256, L), 8.0), cnt[0], key[0], np.zeros(len(key[0]), np.int64), 256)
        # Order 1: cost1[context byte, byte]
        self.cost1 = self._order(np.tile(self.cost0, (256, 1)), cnt[1], key[1], key[1] >> 8, 256)
        pair_n = np.zeros(65536)
        pair_n[key[1]] = cnt[1].sum(axis=1)
        best = np.argsort(-pair_n, kind="stable")[:max_pairs]
        best = np.sort(best[pair_n[best] > 0])
        P = self.pairs = max(len(best), 1)
        self.pid = np.full(65536, -1, np.int32)
        self.pid[best] = np.arange(len(best))
        # Order 2: cost2[pair context, byte], for indexed pairs.
        lower = self.cost1.reshape(256, 256, L)
        cost2 = lower[(best & 255)].reshape(-1, L) if len(best) else np.tile(self.cost0, (1, 1))
        ctx = self.pid[key[2] >> 8] if len(key[2]) else np.zeros(0, np.int64)
        on = ctx >= 0
        self.cost2 = self._order(cost2, cnt[2][on], ctx[on].astype(np.int64) * 256 + (key[2][on] & 255), ctx[on].astype(np.int64), 256)
        # Order 3: cost3[pair, pair] for four bytes whose two halves are both indexed.
        first, second = best >> 8, best & 255
        groups = (L + 3) // 4
        self.packed = [np.zeros(P * P, np.int64) for _ in range(groups)]
        g3 = key[3]
        a = self.pid[g3 >> 16] if len(g3) else np.zeros(0, np.int32)
        b = self.pid[g3 & 65535] if len(g3) else np.zeros(0, np.int32)
        self.sparse3 = (g3, cnt[3])
        inner = self.pid.reshape(256, 256)
        # statistics of every order-3 context, also of those that end in a pair that is not indexed
        self.ctx3, back = np.unique(g3 >> 8, return_inverse=True)
        self.n3 = np.zeros((len(self.ctx3), L))
        self.d3 = np.zeros((len(self.ctx3), L))
        np.add.at(self.n3, back, cnt[3])
        np.add.at(self.d3, back, (cnt[3] > 0).astype(float))
        self.g2, self.c2 = key[2], cnt[2]
        self.ctx2, back2 = np.unique(key[2] >> 8, return_inverse=True)
        self.n2 = np.zeros((len(self.ctx2), L))
        self.d2 = np.zeros((len(self.ctx2), L))
        np.add.at(self.n2, back2, cnt[2])
        np.add.at(self.d2, back2, (cnt[2] > 0).astype(float))
        order = np.argsort(a, kind="stable") if len(a) else np.zeros(0, np.int64)
        bounds = np.searchsorted(a[order], np.arange(P + 1)) if len(a) else np.zeros(P + 1, np.int64)
        for p in range(len(best)):  # all four-byte sequences that start with pair p
            # lower order: context (second byte of p, first byte of q), byte = second byte of q
            mid = inner[second[p], first]
            block = np.where((mid >= 0)[:, None], self.cost2[np.maximum(mid, 0) * 256 + second], 0.0)
            miss = np.flatnonzero(mid < 0)
            if len(miss):
                block[miss] = self._slow2((int(second[p]) << 8) | first[miss], second[miss])
            # escapes of the seen contexts p + first byte of q
            lo, hi = np.searchsorted(self.ctx3, [int(best[p]) << 8, (int(best[p]) + 1) << 8])
            n = np.zeros((256, L))
            d = np.zeros((256, L))
            n[self.ctx3[lo:hi] & 255] = self.n3[lo:hi]
            d[self.ctx3[lo:hi] & 255] = self.d3[lo:hi]
            n, d = n[first], d[first]
            with np.errstate(divide="ignore", invalid="ignore"):
                block += np.where(n > 0, -np.log2(d / (n + d)), 0.0)
                rows = order[bounds[p] : bounds[p + 1]]
                rows = rows[b[rows] >= 0]
                q = b[rows]
                c = cnt[3][rows]
                block[q] = np.where(c > 0, -np.log2(c / (n[q] + d[q])), block[q])
            fixed = np.rint(block * _UNIT).astype(np.int16)
            for g in range(groups):
                part = np.zeros((len(best), 4), np.int16)
                part[:, : min(4, L - 4 * g)] = fixed[:, 4 * g : 4 * g + 4]
                self.packed[g][p * P : p * P + len(best)] = part.view(np.int64)[:, 0]
        self.L = L
        self.cost2 = None  # the sparse counts serve the rest

    @staticmethod
    def _order(lower: np.ndarray, c: np.ndarray, cell: np.ndarray, ctx: np.ndarray, width: int) -> np.ndarray:
        """Costs of one order over ``lower``'s: rows are context * width + byte."""
        m, L = lower.shape
        n = np.zeros((max(m // width, 1), L))
        d = np.zeros_like(n)
        np.add.at(n, ctx, c)
        np.add.at(d, ctx, (c > 0).astype(float))
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(n > 0, -np.log2(d / (n + d)), 0.0)
            out = (lower.reshape(-1, width, L) + escape[:, None, :]).reshape(m, L)
            out[cell] = np.where(c > 0, -np.log2(c / (n[ctx] + d[ctx])), out[cell])
        return out

    def _find(self, table: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Rows of ``values`` at ``keys`` in the sorted ``table``; zeros where absent."""
        if len(table) == 0:
            return np.zeros((len(keys), values.shape[1]))
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return np.where((table[at] == keys)[:, None], values[at], 0.0)

    def _slow2(self, ctx: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Order-2 costs from the sparse counts."""
        ctx, byte = ctx.astype(np.int64), byte.astype(np.int64)
        n, d = self._find(self.ctx2, self.n2, ctx), self._find(self.ctx2, self.d2, ctx)
        c = self._find(self.g2, self.c2, (ctx << 8) | byte)
        low = self.cost1[(ctx & 255) * 256 + byte]
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(c > 0, -np.log2(c / (n + d)), np.where(n > 0, -np.log2(d / (n + d)), 0.0) + low)

    def _slow3(self, gram: np.ndarray) -> np.ndarray:
        """Order-3 costs of four-byte sequences from the sparse counts."""
        ctx = gram >> 8
        n, d = self._find(self.ctx3, self.n3, ctx), self._find(self.ctx3, self.d3, ctx)
        c = self._find(self.sparse3[0], self.sparse3[1], gram)
        low = self._slow2(ctx & 65535, gram & 255)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(c > 0, -np.log2(c / (n + d)), np.where(n > 0, -np.log2(d / (n + d)), 0.0) + low)

    def lengths(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Code lengths, in 1/256 bit, of each text under each language."""
        docs = len(offs) - 1
        # ORDER zero bytes stand before every text
        at = offs[:-1] + ORDER * (1 + np.arange(docs))
        padded = np.zeros(len(buf) + ORDER * docs, np.uint8)
        keep = np.ones(len(padded), bool)
        for j in range(1, ORDER + 1):
            keep[at - j] = False
        padded[keep] = buf
        out = np.zeros((docs, self.L), np.int64)
        if len(buf) == 0:
            return out
        pair = (padded[:-1].astype(np.int32) << 8) | padded[1:]
        ids = self.pid[pair]
        cell = ids[:-2] * self.pairs + ids[2:]
        bad = (ids[:-2] < 0) | (ids[2:] < 0)
        cell[bad] = 0
        real = keep[ORDER:]  # the byte at i + ORDER is coded by cell i
        slow = np.flatnonzero(bad & real)
        begin = at - ORDER
        stops = begin + np.diff(offs)
        edges = np.stack([begin, stops], 1).reshape(-1)
        full = np.flatnonzero(stops > begin)
        cuts = np.stack([begin[full], stops[full]], 1).reshape(-1)
        cuts = cuts[:-1] if cuts[-1] >= len(cell) else cuts
        off = bad | ~real
        for g, table in enumerate(self.packed):
            cost = table[cell]
            cost[off] = 0
            parts = cost.view(np.int16).reshape(-1, 4)
            k = min(4, self.L - 4 * g)
            for j in range(k):
                sums = np.add.reduceat(parts[:, j], cuts, dtype=np.int64)[::2]
                out[full, 4 * g + j] = sums
        if len(slow):
            four = padded.astype(np.int64)
            gram = (four[slow] << 24) | (four[slow + 1] << 16) | (four[slow + 2] << 8) | four[slow + 3]
            uniq, back = np.unique(gram, return_inverse=True)
            cost = np.rint(self._slow3(uniq) * _UNIT).astype(np.int64)[back]
            np.add.at(out, np.searchsorted(begin, slow, "right") - 1, cost)
        return out


def _score_batches(model, key: str, first: int, last: bool):
    """Scores under the languages of one block; ``first`` is the number of its first one. Earlier blocks' best language, its bits and the sum of
    likelihoods relative to it come in the last columns, and go on in them, without the text after the last block."""

    def run(batches):
        cache = worker_cache("ppm")
        if key not in cache:
            cache.clear()
            cache[key] = _Tables(model.value)
        t = cache[key]
        for batch in slices(batches):
            n = batch.num_columns
            buf, offs = text_bytes(batch.column(n - 4))
            best, least, total = (batch.column(n - 3 + k).to_numpy().copy() for k in range(3))
            for a, b in blocks(offs):
                bits = t.lengths(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]) / _UNIT
                low = bits.min(axis=1)
                own = (2.0 ** -np.minimum(bits - low[:, None], 1000)).sum(axis=1)
                better = low < least[a:b]
                best[a:b] = np.where(better, first + bits.argmin(axis=1), best[a:b])
                new = np.minimum(low, least[a:b])
                total[a:b] = total[a:b] * 2.0 ** -np.minimum(least[a:b] - new, 1000) + own * 2.0 ** -np.minimum(low - new, 1000)
                least[a:b] = new
            keep = [i for i in range(n - 3) if not (last and i == n - 4)]
            cols = [batch.column(i) for i in keep] + [pa.array(x) for x in (best, least, total)]
            yield pa.RecordBatch.from_arrays(cols, names=[batch.schema.names[i] for i in [*keep, n - 3, n - 2, n - 1]])

    return run


def predict(df: DataFrame, model: dict, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (default: all) with ``lang_pred`` and ``score`` of the whole text."""
    whole_texts(df.sparkSession, BATCH_ROWS)
    text = F.col(f"`{text_col}`").cast("string")
    carry = [c for c in (df.columns if carry is None else carry) if c.lower() not in ("lang_pred", "score")]
    has_letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    if not model["langs"]:
        return df.select(*[F.col(f"`{c}`") for c in carry], F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    cols = [F.col(f"`{c}`") for c in carry]
    start = [F.lit(0).cast("long").alias("__best"), F.lit(1e300).alias("__least"), F.lit(0.0).alias("__total")]
    out = df.select(*cols, has_letter.alias("__letter"), text.alias("__text"), *start)
    sc = df.sparkSession.sparkContext
    for first in range(0, len(model["langs"]), LANGUAGE_BLOCK):
        if first:  # a worker holds one block's tables at a time
            out = materialize(out, "languages")
        last = first + LANGUAGE_BLOCK >= len(model["langs"])
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields if not (last and f.name == "__text"))
        counts = model["counts"][:, first : first + LANGUAGE_BLOCK]
        part = {"grams": model["grams"], "counts": counts}
        key = f"{id(model)}-{first}-{len(model['grams'])}-{int(counts.sum())}"
        out = out.mapInArrow(lean(_score_batches(sc.broadcast(part), key, first, last)), schema)
    langs = F.array(*map(F.lit, model["langs"]))
    named = F.when(F.col("__letter"), F.get(langs, F.col("__best").cast("int"))).otherwise(F.lit(UNDETERMINED))
    score = F.when(F.col("__letter"), F.lit(1.0) / F.col("__total")).otherwise(F.lit(0.0))
    return out.select(*cols, named.alias("lang_pred"), score.alias("score"))


def held_out(id_col: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))
