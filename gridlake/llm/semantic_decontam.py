"""Benchmark decontamination by latent semantic retrieval.

1. The words of all documents, as 32-bit hashes, are written once; all passes read them. Document frequencies of hashed words come from
   partial counts per task.
2. Right singular vectors of the TF-IDF matrix of passages, over the words that the benchmark uses, by a randomised SVD: three passes of A'(A Q) over all
   documents and all benchmark items; the row blocks of the sums are added up by Spark, only a
   (features x rank) matrix, whose size is a parameter, meets on the driver.
3. One pass over all whole texts: windows of about each item's length, a fresh one every quarter, are folded into the
   whitened latent space and compared with the items by cosine. Windows at or above ``MIN_COSINE`` are candidates.
4. In the same task each candidate is checked on words: enough of the item's rarer words (a bound, so nothing is lost), then the longest common subsequence (LCS) of item and window,
   and the LCS of the item's answer (its last fifth, at least four words). A copy has ``COPY_SHARE`` of the item's words in order; a
   paraphrase has ``PARAPHRASE_SHARE`` of them and ``ANSWER_SHARE`` of the answer.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case. Items are broadcast in blocks of
at most ``MAX_ITEMS``; documents are not shuffled at all.

Cases: null and empty texts match nothing; items that are null or have no words are left out; equal items each
give a row; rows of one document id in the input are judged one by one; an empty table gives an empty result; extra columns and
clashing names don't matter, only id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, drop_garbage, materialize, release, slices, text_bytes, whole_texts
from .shingles import word_hashes, word_spans

FEATURES = 1 << 15
RANK, OVERSAMPLE = 64, 8
#: Words of a passage, a row of the decomposed matrix.
PASSAGE_WORDS = 32
MAX_ITEMS = 2_000
#: Words of a group; windows are whole numbers of groups.
GROUP = 4
#: From measured recall against the rule on words (README): at 0.6 a paraphrase with 65 % of the words was lost in three of ten cases.
MIN_COSINE = 0.4
COMMON_SHARE = 0.3
COPY_SHARE, PARAPHRASE_SHARE, ANSWER_SHARE = 0.75, 0.6, 0.75
_BLOCK_ROWS = 1024
#: Words of a numpy block (a longer text is a block of its own), rows of a chunk of a sum, items whose words are counted, windows that are compared
#: and rows that are turned at a time.
_BLOCK_WORDS, _CHUNK, _ITEM_BLOCK, _WINDOWS, _TURNED = 1 << 16, 32, 256, 4096, 256
#: A task of a product takes at most about this many words, so that a lost one is soon repeated.
MAX_TASK_WORDS = 500_000_000

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of each text as 32-bit hashes, and the first of each text."""
    begins, ends, first = word_spans(buf, offs, _SEPARATOR)
    return word_hashes(buf, begins, ends).astype("<u4"), first


def _feature(words: np.ndarray) -> np.ndarray:
    return (words & words.dtype.type(FEATURES - 1)).astype(np.int64)


def _word_batches(batches):
    """The words of each text as 32-bit hashes."""
    for batch in slices(batches):
        ids, (buf, offs) = batch.column(0), text_bytes(batch.column(1))
        for a, b in blocks(offs):
            w, first = _words(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(first.astype(np.int64) * 4), pa.py_buffer(w)])
            yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), raw.cast(pa.binary())], names=["id", "words"])


def _word_blocks(batches):
    """(ids, words, first word of each text) in blocks of bounded size, from written words or from texts."""
    for batch in slices(batches):
        if batch.schema.types[-1] == pa.string():
            yield from _word_blocks(_word_batches([pa.RecordBatch.from_arrays([batch.column(0), batch.column(batch.num_columns - 1)], names=["id", "text"])]))
            continue
        col = batch.column(batch.num_columns - 1).cast(pa.large_binary())
        offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
        every = np.frombuffer(col.buffers()[2], "<u4") if col.buffers()[2] is not None else np.zeros(0, "<u4")
        for a, b in blocks(offs, _BLOCK_WORDS * 4):
            yield batch.column(0).slice(a, b - a), every[offs[a] // 4 : offs[b] // 4], (offs[a : b + 1] - offs[a]) // 4


def _frequency_batches(batches):
    """Partial document frequencies of one task: (feature, n); texts and words are counted under the two numbers after the features."""
    total, docs, words = np.zeros(FEATURES, np.int64), 0, 0
    for _, w, first in _word_blocks(batches):
        docs, words = docs + len(first) - 1, words + len(w)
        f = _feature(w).astype(np.uint16)
        order = np.argsort(f, kind="stable")  # equal features stand together, in the order of their texts
        f, doc = f[order], np.repeat(np.arange(len(first) - 1), np.diff(first))[order]
        fresh = np.ones(len(f), bool)
        fresh[1:] = (f[1:] != f[:-1]) | (doc[1:] != doc[:-1])
        total += np.bincount(f[fresh], minlength=FEATURES)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, [FEATURES, FEATURES + 1])), pa.array(np.append(total[at], [docs, words]))], names=["feature", "n"]
    )


def _passages(w: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passage number and feature of each word."""
    count = np.diff(first)
    per = -(-count // PASSAGE_WORDS)
    base = np.concatenate(([0], np.cumsum(per)))[:-1]
    inside = np.arange(len(w)) - np.repeat(first[:-1], count)
    return np.repeat(base, count) + inside // PASSAGE_WORDS, _feature(w)


def segment_sums(rows: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of ``rows[at]`` over consecutive segments of the given sizes (none empty): segments are cut into chunks, chunks add up one
    row each at a time, the longest first, and the chunks of a segment are summed in the same way."""
    while True:
        per = -(-sizes // _CHUNK)
        n = int(per.sum())
        turn = (np.arange(n) - np.repeat(np.cumsum(per) - per, per)) * _CHUNK
        begin = np.repeat(np.cumsum(sizes) - sizes, per) + turn
        size = np.minimum(_CHUNK, np.repeat(sizes, per) - turn)
        order = np.argsort(-size, kind="stable")
        begin, falling = begin[order], -size[order]
        out = rows.take(at[begin], axis=0)
        for k in range(1, _CHUNK):
            m = int(np.searchsorted(falling, -k))  # chunks of more than k rows
            if m == 0:
                break
            out[:m] += rows.take(at[begin[:m] + k], axis=0)
        back = np.empty(n, np.int64)
        back[order] = np.arange(n)
        if n == len(sizes):
            return out[back]
        rows, at, sizes = out, back, per


def running_sums(rows: np.ndarray) -> np.ndarray:
    """The sums of the first 0, 1, ... rows, added one after another. Parts of the table are turned on their side for it: numpy's own
    running sum down the rows goes through the whole table once for each column."""
    n, width = rows.shape
    out = np.zeros((n + 1, width), rows.dtype)
    for a in range(0, n, _TURNED):
        side = np.concatenate((out[a, None], rows[a : a + _TURNED])).T.copy()
        out[a + 1 : a + _TURNED + 1] = np.cumsum(side, axis=1, dtype=rows.dtype, out=side)[:, 1:].T
    return out


def _gram_batches(q, idf):
    """Row blocks of A'(A Q), summed over the passages of one task. Rows of A have unit length."""

    def run(batches):
        # only features with a weight have rows, so that the tables stay small
        used = np.flatnonzero(idf.value)
        row = np.full(FEATURES, len(used), np.uint16)
        row[used] = np.arange(len(used))
        weight = np.append(idf.value[used], 0).astype(np.float32)
        weighted = q.value[used] * weight[:-1, None]
        out = np.zeros(weighted.shape, np.float32)
        for _, w, first in _word_blocks(batches):
            if len(w) == 0:
                continue
            p, f = _passages(w, first)
            f = row[f]
            known = f < len(used)
            p, f = p[known], f[known]
            if len(p) == 0:
                continue
            p = np.cumsum(np.append(0, p[1:] != p[:-1]))  # passages with a known word
            sizes = np.bincount(p)
            y = segment_sums(weighted, f, sizes)
            # lengths of the rows of A: equal words of a passage stand together; free places hold a row without weight
            slot = np.full((len(sizes), PASSAGE_WORDS), len(used), np.uint16)
            slot[p, np.arange(len(p)) - (np.cumsum(sizes) - sizes)[p]] = f
            slot.sort(axis=1)
            fresh = np.ones(slot.shape, bool)
            fresh[:, 1:] = slot[:, 1:] != slot[:, :-1]
            at = np.flatnonzero(fresh)
            x = np.diff(np.append(at, fresh.size)) * weight[slot.ravel()[at]]
            norm = np.sqrt(np.bincount(at // PASSAGE_WORDS, x * x, len(slot)))
            y /= np.maximum(norm, 1e-9).astype(np.float32)[:, None] ** 2
            order = np.argsort(f, kind="stable")
            f = f[order]
            begins = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1])))
            out[f[begins]] += segment_sums(y, p[order], np.diff(np.append(begins, len(f))))
        out *= weight[:-1, None]
        parts = [out[i : i + _BLOCK_ROWS].tobytes() for i in range(0, len(used), _BLOCK_ROWS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names=["block", "part"])

    return run


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of one row block, whatever the number of tasks: their parts are read one after another."""
    block, total = None, 0.0
    for batch in batches:
        for i in range(batch.num_rows):
            block = batch.column("block").slice(0, 1)
            total = total + np.frombuffer(batch.column("part")[i].as_buffer(), np.float32).astype(np.float64)
    yield pa.RecordBatch.from_arrays([block, pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["block", "part"])


def _latent(passages: DataFrame, idf: np.ndarray, rank: int) -> np.ndarray:
    """Features x rank: right singular vectors, whitened by their singular values; rows of zeros for features without weight."""
    sc = passages.sparkSession.sparkContext
    q = np.random.default_rng(7).standard_normal((FEATURES, rank + OVERSAMPLE)).astype(np.float32)
    weight = sc.broadcast(idf)

    def apply(q: np.ndarray) -> np.ndarray:
        sent = sc.broadcast(q)
        parts = passages.mapInArrow(_gram_batches(sent, weight), "block int, part binary")
        rows = parts.groupBy("block").applyInArrow(_sum_blocks, "block int, part binary").collect()
        del parts
        sent.destroy()
        drop_garbage(passages.sparkSession)
        out = np.zeros_like(q)
        if rows:
            out[np.flatnonzero(idf)] = np.concatenate([np.frombuffer(r["part"], np.float32).reshape(-1, q.shape[1]) for r in sorted(rows, key=lambda r: r["block"])])
        return out

    for _ in range(2):
        q = np.linalg.qr(apply(q))[0].astype(np.float32)
    z = apply(q)
    values, u = np.linalg.eigh(q.T.astype(np.float64) @ z)
    top = np.argsort(-values)[:rank]
    # directions that no passage has are left out
    scale = np.where(values[top] > 1e-6 * max(values.max(), 1e-30), 1 / np.sqrt(np.maximum(values[top], 1e-30)), 0.0)
    return ((q @ u[:, top]) * scale).astype(np.float32)


def lcs_length(a, b) -> int:
    """Length of the longest common subsequence, by one bit vector over ``a``."""
    at: dict = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        m = at.get(x)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _prepare(ids: list, texts: list[str], fold: np.ndarray, idf: np.ndarray) -> SimpleNamespace:
    """Words of the items, and their unit vectors in the latent space by window length (in groups)."""
    raw = [t.encode() for t in texts]
    offs = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)
    w, first = _words(np.frombuffer(b"".join(raw), np.uint8), offs)
    own = [i for i in range(len(ids)) if first[i + 1] > first[i]]
    words = [w[first[i] : first[i + 1]] for i in own]
    vectors = [fold[_feature(x)].sum(axis=0) for x in words]
    unit = np.array([v / max(np.linalg.norm(v), 1e-9) for v in vectors], np.float32).reshape(len(own), fold.shape[1])
    # Window lengths on a ladder of groups; each item goes to the nearest step.
    ladder = [2]
    while words and ladder[-1] * GROUP < max(map(len, words)):
        ladder.append(max(ladder[-1] + 1, round(ladder[-1] * 1.35)))
    nearest = np.array([int(np.argmin([abs(np.log(m * GROUP / len(x))) for m in ladder])) for x in words], int)
    steps = [(m, np.flatnonzero(nearest == i), unit[nearest == i].T.copy()) for i, m in enumerate(ladder) if (nearest == i).any()]
    # An LCS of PARAPHRASE_SHARE of an item takes at least ``need`` of its rarer words: all but the COMMON_SHARE most frequent tokens.
    vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(1, "<u4")
    rare = np.zeros((len(words), len(vocabulary) + 1), bool)
    need = np.zeros(len(words))
    for i, x in enumerate(words):
        distinct, n = np.unique(x, return_counts=True)
        order = np.argsort(idf[_feature(distinct)], kind="stable")
        common = order[np.cumsum(n[order]) <= COMMON_SHARE * len(x)]
        rare[i, np.searchsorted(vocabulary, np.delete(distinct, common))] = True
        need[i] = PARAPHRASE_SHARE * len(x) - n[common].sum()
    # per block of items: the items in which each word of the vocabulary is rarer, as one list with the begin of each word
    lists = []
    for c in range(0, len(words), _ITEM_BLOCK):
        word, item = np.nonzero(rare[c : c + _ITEM_BLOCK].T)
        lists.append((c, np.searchsorted(word, np.arange(rare.shape[1] + 1)), item))
    # only features with a weight have rows, so that the table stays small; all others share a row of zeros
    used = np.flatnonzero(idf > 0)
    row = np.full(FEATURES, len(used), np.int64)
    row[used] = np.arange(len(used))
    padded = np.vstack([fold[used], np.zeros((1, fold.shape[1]), np.float32)])
    return SimpleNamespace(ids=[ids[i] for i in own], words=[x.tolist() for x in words], fold=padded, row=row, steps=steps, numbers=_numbers(vocabulary), lists=lists, need=need)


def _search_batches(items):
    def run(batches):
        it = items.value
        for ids, w, first in _word_blocks(batches):
            found = _search(it, w, first)
            if found:
                doc = pa.array([x[0] for x in found])
                cols = [[it.ids[x[1]] for x in found]] + [[x[k] for x in found] for k in range(2, 8)]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(doc)] + [pa.array(c, t) for c, t in zip(cols, _TYPES)], names=["id", "item", "cosine", "lcs", "item_words", "answer_share", "begin_word", "kind"]
                )

    return run


_TYPES = [pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.string()]


def _numbers(vocabulary: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The words of a vocabulary, and tables from the low bits of a word to its number: words that share them are in different tables."""
    size = 1 << max(10, (16 * len(vocabulary)).bit_length())
    tables, left = [], np.arange(len(vocabulary))
    while len(left):
        table = np.full(size, len(vocabulary), np.int32)
        low = vocabulary[left] & np.uint32(size - 1)
        table[low] = left
        tables.append(table)
        left = left[table[low] != left]
    return np.append(vocabulary, np.zeros(1, "<u4")), tables


def _known(w: np.ndarray, numbers: tuple[np.ndarray, list[np.ndarray]]) -> np.ndarray:
    """The number of each word in the vocabulary; all others share the one after the last."""
    vocabulary, tables = numbers
    out = np.full(len(w), len(vocabulary) - 1, np.int32)
    for table in tables:
        at = table[w & np.uint32(len(table) - 1)]
        np.copyto(out, at, where=vocabulary[at] == w)
    return out


def _rare_counts(begin: np.ndarray, item: np.ndarray, places: np.ndarray, known: np.ndarray, n_words: int, asked: np.ndarray, lo: np.ndarray,
                 hi: np.ndarray) -> np.ndarray:
    """How many of the rarer words of the items ``asked`` stand at places lo to hi (without hi): the places of each item's are
    listed, in order."""
    per = (begin[1:] - begin[:-1])[known]
    some = np.flatnonzero(per)
    per = per[some]
    pick = np.arange(per.sum()) + np.repeat(begin[known[some]] - np.cumsum(per) + per, per)
    key = item[pick] * (n_words + 1) + np.repeat(places[some], per)
    key.sort()
    asked = asked * (n_words + 1)
    return np.searchsorted(key, asked + hi) - np.searchsorted(key, asked + lo)


def _search(it: SimpleNamespace, w: np.ndarray, first: np.ndarray) -> list[tuple]:
    """One row per (document, item) that passes, with the window of the largest cosine that does."""
    count = np.diff(first)
    groups = -(-count // GROUP)
    start = np.concatenate(([0], np.cumsum(groups)))
    if start[-1] == 0:
        return []
    # every document begins a new group; the missing words are zero rows
    own = _feature(w)
    f = np.full(start[-1] * GROUP, len(it.fold) - 1, np.int64)
    f[np.arange(len(w)) + np.repeat(start[:-1] * GROUP - first[:-1], count)] = it.row[own]
    sums = it.fold.take(f[0::GROUP], axis=0)
    for k in range(1, GROUP):
        sums += it.fold.take(f[k::GROUP], axis=0)
    run = running_sums(sums)
    docs, lo, begin, stop, asked, value = ([] for _ in range(6))
    for m, own, q in it.steps:
        # windows of each document: one every stride from its start and one that ends with it; a shorter document is one window
        stride = max(1, m // 4)
        rest = np.maximum(groups - m, 0)
        n_windows = np.where(groups > 0, -(-rest // stride) + 1, 0)
        doc = np.repeat(np.arange(len(groups)), n_windows)
        turn = np.arange(len(doc)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        begins = start[doc] + np.minimum(turn * stride, rest[doc])
        ends = begins + np.minimum(m, groups[doc])
        margin = m * GROUP // 4 + GROUP
        for a in range(0, len(doc), _WINDOWS):
            part = slice(a, a + _WINDOWS)
            v = run.take(ends[part], axis=0)
            v -= run.take(begins[part], axis=0)
            norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", v, v)), 1e-6)
            cos = v @ q
            rows, cols = np.divmod(np.flatnonzero(cos >= (MIN_COSINE * norm)[:, None]), len(own))
            value.append(cos[rows, cols] / norm[rows])
            docs.append(doc[a + rows])
            asked.append(own[cols])
            # word range of each window, a little wider, inside its document
            lo.append(first[docs[-1]])
            word = lo[-1] + (begins[a + rows] - start[docs[-1]]) * GROUP
            begin.append(np.maximum(lo[-1], word - margin))
            stop.append(np.minimum(first[docs[-1] + 1], word + m * GROUP + margin))
    if not sum(map(len, docs)):
        return []
    docs, lo, begin, stop, asked, value = map(np.concatenate, (docs, lo, begin, stop, asked, value))
    # rarer words of the item in the range
    known = _known(w, it.numbers)
    places = np.flatnonzero(known < len(it.numbers[0]) - 1)
    known = known[places]
    keep = np.zeros(len(docs), bool)
    for c, word_begin, item in it.lists:
        here = np.flatnonzero((asked >= c) & (asked < c + _ITEM_BLOCK))
        if len(here):
            n = _rare_counts(word_begin, item, places, known, len(w), asked[here] - c, begin[here], stop[here])
            keep[here] = n >= it.need[asked[here]]
    best: dict[tuple[int, int], tuple] = {}
    left = np.flatnonzero(keep)
    for i in left[np.argsort(-value[left], kind="stable")]:
        d, item = int(docs[i]), int(asked[i])
        if (d, item) in best:
            continue
        lo_i, begin_i, stop_i = int(lo[i]), int(begin[i]), int(stop[i])
        span, words = w[begin_i:stop_i].tolist(), it.words[item]
        n = len(words)
        common = lcs_length(words, span)
        if common < PARAPHRASE_SHARE * n:
            continue
        answer = words[-max(4, n // 5) :]
        share = lcs_length(answer, span) / len(answer)
        kind = "copy" if common >= COPY_SHARE * n else "paraphrase" if share >= ANSWER_SHARE else None
        if kind:
            best[d, item] = (d, item, float(value[i]), common, n, share, begin_i - lo_i, kind)
    return [best[k] for k in sorted(best)]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """One row per (document row, benchmark item) found in it:
    ``id, item, cosine, lcs, item_words, answer_share, begin_word, kind``."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    whole_texts(spark)
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).filter("text is not null")
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text_col}`").cast("string").alias("text")).filter("text is not null")
    schema = "id long, item long, cosine double, lcs long, item_words long, answer_share double, begin_word long, kind string"
    words = materialize(src.mapInArrow(_word_batches, "id long, words binary"), "words")
    counts = words.mapInArrow(_frequency_batches, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    f, n = counts.column("feature").to_numpy(), counts.column("n").to_numpy()
    total, n_words = int(n[f == FEATURES].sum()), int(n[f == FEATURES + 1].sum())
    df = np.zeros(FEATURES)
    df[f[f < FEATURES]] = n[f < FEATURES]
    idf = np.log((total + 1) / (df + 1)) + 1e-3
    # The passages are described by the benchmark's words alone (at most FEATURES hashes of them); other words have no weight.
    # (written, so that no task runs two Python functions and an executor keeps one worker a core)
    item_words = materialize(items.mapInArrow(_word_batches, "item long, words binary"), "item-words")
    asked = item_words.mapInArrow(_frequency_batches, "feature long, n long").select("feature").distinct().toArrow().column("feature").to_numpy()
    asked = asked[asked < FEATURES]
    idf = np.where(np.isin(np.arange(FEATURES), asked), idf, 0.0)
    # Each task sends a whole (features x rank) sum, so there are two tasks a core, or as many as their bound of words asks for.
    tasks = max(2 * sc.defaultParallelism, -(-n_words // MAX_TASK_WORDS))
    passages = words.select("words").unionByName(item_words.select("words")).coalesce(tasks)
    fold = (_latent(passages, idf, RANK) * idf[:, None]).astype(np.float32)
    many = items.count()
    found = None
    turns = max(1, -(-many // MAX_ITEMS) * (1 if many <= MAX_ITEMS else 2))
    for turn in range(turns):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(turns)) == turn).orderBy("item", "text").collect()
        sent = sc.broadcast(_prepare([r["item"] for r in part], [r["text"] for r in part], fold, idf))
        hits = words.mapInArrow(_search_batches(sent), schema)
        found = hits if found is None else found.unionByName(hits)
    found = materialize(found, "found")
    release(words, item_words)
    drop_garbage(spark)
    return found

