"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Sketch (Dahlgaard, Knudsen and Thorup, 2017): ``t`` bins, ``2 t`` rounds. In the first ``t`` rounds every shingle of a
document is thrown into one hashed bin; in round ``t + j`` all go to bin ``j``, so that every bin fills. A bin
keeps its smallest (round, hash). A document stops after the round that fills its last bin: a long one after one
or a few rounds, so the work is about t log t + set size. The bins are a sample with replacement whose share of
agreement concentrates around the similarity like fully random MinHash.

Plan. One pass over the texts writes per document the set size, a 128-bit fingerprint of its shingle set and its
band hashes. Documents with one fingerprint form a class (similarity 1); classes go on with their smallest id.
Bands of class representatives meet in buckets. A bucket is not expanded into pairs: its members are verified
against one centre, and the links found are contracted. Only members that are then still in different components
of one bucket meet again: first at another centre, at last in all pairs across the components, less those that can't
reach the similarity because too many of their shingles stand in no other open document. So no link between two
candidates is lost unless both are connected anyhow. Links are confirmed on full shingle sets.

Recall: two sets of similarity s share a band with probability 1 - (1 - s^8)^64: 0.99999 at 0.8, more above.

Equality rests on 128 bits of hashes (classes) and on 64 bits a shingle (verification), not on the words themselves.

Skew. Rows of large classes and buckets meet their smallest id by a broadcast of the large ones alone (a sized list), all others by a
shuffle; counts and smallest ids are added up before any shuffle.

Cases: null and empty texts have no shingles and stay alone; equal texts share a class; rows of one id are one document: if they differ, the one
with the fewest shingles (ties: the smaller fingerprint) stands for it, rows without words never do, and each row has its own set size and the document's
component; a row with a null id stays alone, with a null component, and is kept; an empty table gives an empty result; extra columns and
clashing names don't matter, only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MAX_BROADCAST_IDS, blocks, drop_garbage, lean, materialize, release, sized, slices, text_bytes, whole_texts
from .graph import components
from .shingles import U, mix, shingle_sets

BANDS, ROWS = 64, 8
#: Rows of an Arrow batch: sets and sketches take several times the bytes of their texts.
BATCH_ROWS = 250
#: Rows from which a class or a bucket counts as large.
LARGE = 256
BINS = BANDS * ROWS


def sketch(elems: np.ndarray, first: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Bins of each set: one row per set of ``elems[first[d]:first[d + 1]]``; empty sets get the largest value."""
    n = len(first) - 1
    full = U(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * bins, full, U)
    doc = np.repeat(np.arange(n), np.diff(first))
    x = elems
    for r in range(2 * bins):
        if len(x) == 0:
            break
        h = mix(x ^ mix(np.array([r + 1], U) * U(0xD1342543DE82EF95))[0])
        where = doc * bins + ((h & U(0xFFFFFFFF)) * U(bins) >> U(32)).astype(np.int64) if r < bins else doc * bins + (r - bins)
        np.minimum.at(out, where, (U(r) << U(48)) | (h >> U(16)))
        live = np.unique(doc)
        open_ = np.zeros(n, bool)
        open_[live] = (out.reshape(n, bins)[live] == full).any(axis=1)
        if not open_[live].all():
            keep = open_[doc]
            x, doc = x[keep], doc[keep]
    return out.reshape(n, bins)


def band_hashes(rows: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A hash per band of each sketch; the band's number is part of it."""
    n, bins = rows.shape
    per = bins // bands
    cube = rows.reshape(n, bands, per)
    h = np.zeros((n, bands), U) + mix(np.arange(1, bands + 1, dtype=U))
    for k in range(per):
        h = mix(h * U(0x9FB21C651E98DF25) + cube[:, :, k])
    return h


_SKETCH = "id long, n_shingles long, fp1 long, fp2 long, bands array<long>"


def _fingerprints(elems: np.ndarray, first: np.ndarray) -> list[pa.Array]:
    """128 bits of each set: two sums of mixed elements."""
    out = []
    for mixed in (mix(elems ^ U(0x5851F42D4C957F2D)), mix(elems + U(0x14057B7EF767814F))):
        run = np.concatenate((np.zeros(1, U), np.cumsum(mixed)))
        out.append(pa.array((run[first[1:]] - run[first[:-1]]).view(np.int64)))
    return out


def _sketch_batches(width: int):
    def run(batches):
        for batch in slices(batches):
            ids, (buf, offs) = batch.column(0), text_bytes(batch.column(1))
            for a, b in blocks(offs):
                elems, first = shingle_sets(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a], width)
                n = np.diff(first)
                bands = band_hashes(sketch(elems, first)).view(np.int64)
                empty = n == 0
                at = np.concatenate(([0], np.cumsum(np.where(empty, 0, BANDS)))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(bands[~empty].reshape(-1)))
                cols = [ids.slice(a, b - a), pa.array(n.astype(np.int64)), *_fingerprints(elems, first), lists]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "n_shingles", "fp1", "fp2", "bands"])

    return run


_SETS = "id long, n_shingles long, fp1 long, fp2 long, elems array<long>"


def _set_batches(width: int):
    def run(batches):
        for batch in slices(batches):
            ids, (buf, offs) = batch.column(0), text_bytes(batch.column(1))
            for a, b in blocks(offs):
                elems, first = shingle_sets(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a], width)
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(elems.view(np.int64)))
                cols = [ids.slice(a, b - a), pa.array(np.diff(first).astype(np.int64)), *_fingerprints(elems, first), lists]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "n_shingles", "fp1", "fp2", "elems"])

    return run


def _with_least(rows: DataFrame, keys: list[str], least: str, written) -> DataFrame:
    """Rows whose keys repeat, with ``least``, the smallest id of the key, and ``m``, its number of rows."""
    found = rows.groupBy(*keys).agg(F.min("id").alias(least), F.count(F.lit(1)).alias("m")).filter("m > 1")
    found = written(found, "keys")
    large = found.filter(F.col("m") > LARGE)
    if found.count() <= MAX_BROADCAST_IDS:
        return rows.join(F.broadcast(found), keys)
    # at most rows / LARGE keys: their rows stay where they are
    own = rows.join(sized(large), keys)
    return own.unionByName(rows.join(sized(large.select(*keys)), keys, "left_anti").join(found.filter(F.col("m") <= LARGE), keys))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` per row: links are pairs with 100 |A & B| >= percent |A | B| over the
    distinct shingles of ``width`` words; ``kept`` marks the smallest id of a component."""
    whole_texts(df.sparkSession, BATCH_ROWS)
    src = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    scratch: list[DataFrame] = []

    def written(part: DataFrame, tag: str) -> DataFrame:
        scratch.append(materialize(part, tag))
        return scratch[-1]

    docs = written(src.mapInArrow(lean(_sketch_batches(width), "sets"), _SKETCH), "sketch")

    # One set stands for each id.
    full = docs.filter("n_shingles > 0 and id is not null")
    key = ["n_shingles", "fp1", "fp2"]
    several = written(full.groupBy("id").agg(F.min(F.struct(*key)).alias("c"), F.max(F.struct(*key)).alias("d")).filter("c <> d").select("id", "c.*"), "several")
    if not several.isEmpty():
        once = full.join(sized(several.select("id")), "id", "left_anti")
        full = once.unionByName(full.join(sized(several), ["id", *key], "left_semi"))
    # Classes of equal shingle sets, by the smallest id of each.
    shared = _with_least(full.select("id", *key), key, "rep", written).select("id", "rep", F.col("n_shingles").alias("n"))
    shared = written(shared.distinct(), "classes")
    heads = full.select("id", F.col("n_shingles").alias("n"), "bands").join(sized(shared.filter("id <> rep").select("id").distinct()), "id", "left_anti")
    # Bucket rows (key, id): the smallest id of a bucket is its first centre.
    rows = heads.select("id", F.explode("bands").alias("key"))
    heads = heads.select("id", "n").distinct()
    buckets = written(_with_least(rows, ["key"], "centre", written).filter("m > 1").select("key", "id", "centre").distinct(), "buckets")

    sizes = heads
    star = buckets.filter("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    tested = written(_size_bound(star, sizes, percent), "pairs")
    links = _verify(src, tested, width, percent, "links1", written)
    for turn in (2, 3):
        comp = components(links)
        scratch.append(comp)
        named = buckets.select("key", "id").join(comp, "id", "left").select("key", "id", F.coalesce("comp", "id").alias("comp"))
        split = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
        split = written(split, "split")
        named = written(named.join(sized(split), "key"), f"open{turn}")
        if turn == 2:  # another centre of each bucket, drawn by hash
            centre = written(named.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "id"), "id", "comp")).alias("c")), "centres")
            pairs = named.join(sized(centre), "key").filter("comp <> c.comp").select("id", F.col("c.id").alias("other"))
        else:  # all that is left across components and can reach the similarity at all
            named = named.join(_shared(src, named, sizes, width, written), "id").filter(F.col("c") * 100 >= F.col("n") * percent)
            right = named.select("key", *[F.col(x).alias(f"{x}2") for x in ("id", "comp", "n", "c", *_BITS)])
            only = lambda x, y: sum(F.bit_count(F.col(f"{b}{x}").bitwiseAND(F.bitwise_not(f"{b}{y}"))) for b in _BITS)
            most = F.least("c", "c2", F.col("n") - only("", "2"), F.col("n2") - only("2", ""))
            near = (F.col("comp") < F.col("comp2")) & (most * 100 >= (F.col("n") + F.col("n2") - most) * percent)
            pairs = named.join(right, ["key"]).filter(near).select("id", F.col("id2").alias("other"))
        pairs = pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
        pairs = written(_size_bound(pairs, sizes, percent).join(tested, ["a", "b"], "left_anti"), f"pairs{turn}")
        if pairs.isEmpty():
            continue
        tested = tested.unionByName(pairs)
        links = links.unionByName(_verify(src, pairs, width, percent, f"links{turn}", written))
    comp = components(links)
    scratch.append(comp)
    member = shared.select("id", "rep").unionByName(comp.select("id", F.col("id").alias("rep")).join(shared.select("id"), "id", "left_anti"))
    joined = member.join(comp.select(F.col("id").alias("rep"), "comp"), "rep", "left").select("id", F.coalesce("comp", "rep").alias("component_id"))
    result = docs.select("id", "n_shingles").join(joined, "id", "left")
    result = result.select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
    result = materialize(result, "near-duplicates")
    release(*scratch)
    drop_garbage(df.sparkSession)
    return result.select(
        F.col("id").alias(id_col), "n_shingles", "component_id", (F.col("id").isNull() | (F.col("id") == F.col("component_id"))).alias("kept")
    )


def _shared(src: DataFrame, named: DataFrame, sizes: DataFrame, width: int, written) -> DataFrame:
    """``(id, n, c, bits)`` of the ids in ``named``: set size, how many of its shingles any other of these ids has too, and
    a bitmap of its shingles.

    A shingle of one document alone is in no intersection, so two documents share at most the smaller ``c``; and each bit that
    only one of them has is a shingle that the other lacks. Both are bounds, never estimates.
    """
    ids = written(named.select("id").distinct(), "open-ids")
    bits = f"{_SETS}, {', '.join(f'{b} long' for b in _BITS)}"
    sets = _one_set(written(src.join(sized(ids), "id", "left_semi").mapInArrow(lean(_bit_batches(width), "sets"), bits), "open-sets"))
    # each id has one set, so rows of a shingle can be counted before they are shuffled
    elems = sets.select("id", F.explode("elems").alias("e"))
    alone = elems.groupBy("e").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("k")).filter("k = 1").groupBy("id").agg(F.count(F.lit(1)).alias("u"))
    bits = sets.select("id", *_BITS)
    n = sizes.join(ids, "id", "left_semi").join(alone, "id", "left").select("id", "n", (F.col("n") - F.coalesce("u", F.lit(0))).alias("c"))
    return n.join(bits, "id")


#: Columns of a bitmap of 1,024 bits.
_BITS = tuple(f"bits{i}_" for i in range(16))


def _bit_batches(width: int):
    sets = _set_batches(width)

    def run(batches):
        for batch in sets(batches):
            lists = batch.column(4)
            first = lists.offsets.to_numpy()
            elems = lists.values.to_numpy().view(U)
            words = np.zeros((len(first) - 1) * len(_BITS), U)
            slot = elems % U(64 * len(_BITS))
            owner = np.repeat(np.arange(len(first) - 1), np.diff(first)) * len(_BITS) + (slot // U(64)).astype(np.int64)
            np.bitwise_or.at(words, owner, U(1) << (slot % U(64)))
            cols = words.view(np.int64).reshape(-1, len(_BITS))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.ascontiguousarray(cols[:, i])) for i in range(len(_BITS)))], names=[*batch.schema.names, *_BITS])

    return run


def _size_bound(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose set sizes allow the similarity: the intersection is at most the smaller set."""
    a = sizes.select(F.col("id").alias("a"), F.col("n").alias("na"))
    b = sizes.select(F.col("id").alias("b"), F.col("n").alias("nb"))
    return pairs.join(a, "a").join(b, "b").filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b")


def _verify(src: DataFrame, pairs: DataFrame, width: int, percent: int, tag: str, written) -> DataFrame:
    """Pairs that hold on full shingle sets. Only texts of ids in ``pairs`` are shingled again and shuffled."""
    ids = materialize(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), f"{tag}-ids")
    texts = src.join(sized(ids), "id", "left_semi")
    full = materialize(texts.mapInArrow(lean(_set_batches(width), "sets"), _SETS), f"{tag}-sets")
    sets = _one_set(full)
    left = sets.select(F.col("id").alias("a"), F.col("elems").alias("ea"))
    right = sets.select(F.col("id").alias("b"), F.col("elems").alias("eb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("ea", "eb"))
    union = F.size("ea") + F.size("eb") - F.col("n")
    found = written(both.withColumn("n", common).filter(F.col("n") * 100 >= union * percent).select("a", "b"), tag)
    release(ids, full)
    return found


def _one_set(sets: DataFrame) -> DataFrame:
    """The set that stands for each id: with words, then the fewest shingles, then the smaller fingerprint."""
    sets = sets.filter("n_shingles > 0")
    if sets.groupBy("id").count().filter("count > 1").isEmpty():
        return sets
    rest = [c for c in sets.columns if c not in ("id", "n_shingles", "fp1", "fp2")]
    one = sets.groupBy("id").agg(F.min_by(F.struct(*rest), F.struct("n_shingles", "fp1", "fp2")).alias("s"))
    return one.select("id", "s.*")
