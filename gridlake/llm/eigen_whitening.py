"""Embedding whitening by incremental eigendecomposition.

1. Lattice. An entry c becomes floor(scale * c) + offset, an integer, so that counts and sums are exact. The vectors' dimension is
   the most frequent length (ties: the larger); a vector of another length is left out like one with a null or non-finite entry.
2. Spectra. Each task holds count, mean, eigenvalues and eigenvectors of its scatter matrix. It takes in vectors by centred rank-one updates, after
   reducing each block of ``BLOCK`` x dimension vectors to the rows of its triangular factor (a sixteenth of the updates, the same sum). An update D + z z' is deflated (entries of z that are negligible; equal eigenvalues, rotated so that one of them keeps all of
   z), the secular equation is solved for all remaining roots at once, each from its nearer pole, and the eigenvectors follow from a z that is
   computed back from the roots (Gu and Eisenstat), so that they stay orthogonal.
3. Tasks' spectra are combined ``FAN_IN`` at a time, in rounds: every eigenpair of one is a rank-one update of the other, and the
   difference of the means is one more. Only the last spectrum (dimension x dimension) reaches the driver.
4. Rayleigh-Ritz: one more pass over all vectors sums the covariance in the basis found, centred with the exact sums; its eigenvectors turn
   the basis, its eigenvalues are the result. A last pass measures the covariance of the whitened vectors against the identity.

Cases: rows with a null vector, a null or non-finite entry are left out; lattice entries saturate at +-2^40; repeated rows count each; a null id is
kept; an eigenvalue of at most 1e-12 of the largest has no direction to scale: its whitened value is null, and it isn't part of the identity error;
equal eigenvalues have any orthogonal directions; a deviation beyond a long is null; fewer dimensions than ``components`` give fewer components;
an empty table gives an empty result; only the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices, whole_texts

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Vectors of a block, as a multiple of the dimension: it becomes at most one rank-one update a dimension.
BLOCK = 16
#: Spectra that one task combines in a round.
FAN_IN = 8
_LIMIT = float(1 << 40)
_EPS = np.finfo(float).eps
_FLAT = 1e-12


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z2_i / (d_i - x) = 0 for ascending distinct d and positive z2: (pole that each root is
    measured from, distance to it)."""
    k = len(d)
    gap = np.append(np.diff(d), z2.sum())
    mid = d + gap / 2
    f = 1 + (z2[:, None] / (d[:, None] - mid)).sum(axis=0)
    left = f >= 0  # the root lies in the left half of its interval
    left[-1] = True
    pole = np.where(left, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    delta = d[:, None] - d[pole]
    lo = np.where(left, 0.0, -gap / 2)
    hi = np.where(left, gap / 2, 0.0)
    if f[-1] < 0:  # the last root may lie anywhere up to the sum
        lo[-1], hi[-1] = gap[-1] / 2, gap[-1]
    x = (lo + hi) / 2
    # poles on both sides of each root; the last interval has none on its right
    lower = np.triu(np.broadcast_to(z2[:, None], (k, k)))
    dl = d - d[pole]
    dr = np.append(d[1:], np.inf) - d[pole]
    last = np.arange(k) == k - 1
    for _ in range(100):
        r = 1 / (delta - x)
        r2 = r * r
        psi, dpsi = np.einsum("ij,ij->j", lower, r), np.einsum("ij,ij->j", lower, r2)
        phi, dphi = np.where(last, 0.0, z2 @ r - psi), np.where(last, 0.0, z2 @ r2 - dpsi)
        f = 1 + psi + phi
        lo, hi = np.where(f < 0, x, lo), np.where(f > 0, x, hi)
        done = (np.abs(f) <= 4 * _EPS * k * (1 + np.abs(psi) + np.abs(phi))) | (hi - lo <= 2 * _EPS * np.maximum(np.abs(lo), np.abs(hi)))
        if done.all():
            break
        # each half is replaced by one pole with the same value and slope; their quadratic gives the next point
        a, b = dl - x, np.where(last, 1.0, dr - x)
        p, q = dpsi * a * a, dphi * b * b
        c = f - dpsi * a - dphi * b
        with np.errstate(all="ignore"):
            # c + p / (a - s) + q / (b - s) = 0 for the step s
            qa, qb = c, -(c * (a + b) + p + q)
            qc = c * a * b + p * b + q * a
            root = np.sqrt(np.maximum(qb * qb - 4 * qa * qc, 0))
            s = np.where(qb > 0, 2 * qc / (-qb - root), np.where(qa == 0, -qc / qb, (-qb + root) / (2 * qa)))
            s2 = np.where(qb > 0, (-qb - root) / (2 * qa), 2 * qc / (-qb + root))
            ok1, ok2 = (x + s >= lo) & (x + s <= hi), (x + s2 >= lo) & (x + s2 <= hi)
            one = a + p / c  # only the left pole: the last interval
            s = np.where(last, one, np.where(ok1, s, np.where(ok2, s2, np.nan)))
        new = x + s
        new = np.where(np.isfinite(new) & (new >= lo) & (new <= hi) & (new != 0), new, (lo + hi) / 2)
        x = np.where(done, x, new)
    return pole, x


def rank_one(d: np.ndarray, q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of q diag(d) q' + v v'."""
    z = v @ q
    z2 = z * z
    norm2 = z2.sum()
    if norm2 <= 0:
        return d, q
    tol = 8 * _EPS * max(abs(d[-1]), abs(d[0]), norm2)
    # entries too small to move anything
    live = np.flatnonzero(np.abs(z) * np.sqrt(norm2) > tol)
    if len(live) == 0:
        return d, q
    q = q.copy()
    if len(live) > 1 and (np.diff(d[live]) <= tol).any():
        # runs of equal eigenvalues: rotate within their space until the last one holds all of z
        keep, run = [], [live[0]]
        for i in [*live[1:], None]:
            if i is not None and d[i] - d[run[0]] <= tol:
                run.append(i)
                continue
            if len(run) > 1:
                part = z[run]
                length = np.sqrt((part * part).sum())
                u = part / length
                u[-1] += 1 if u[-1] >= 0 else -1  # Householder vector onto the last axis
                u /= np.sqrt((u * u).sum())
                q[:, run] -= 2 * np.outer(q[:, run] @ u, u)
                z[run] = part - 2 * u * (u @ part)
                z[run[:-1]] = 0
            keep.append(run[-1])
            run = [i]
        live = np.array(keep)
    dk, zk = d[live], z[live]
    pole, x = secular_roots(dk, zk * zk)
    new = dk[pole] + x
    # differences d_i - root_j without cancellation, then z computed back from the roots
    diff = (dk[:, None] - dk[pole]) - x
    if len(live) > 1:
        span = dk - dk[:, None]
        np.fill_diagonal(span, -1.0)
        ratio = diff / span
        np.fill_diagonal(ratio, np.diag(diff))
        back = np.multiply.reduce(ratio, axis=1)
        zk = np.sign(zk) * np.sqrt(np.abs(back))
    w = zk[:, None] / diff
    w /= np.sqrt((w * w).sum(axis=0))
    q[:, live] = q[:, live] @ w
    d = d.copy()
    d[live] = new
    order = np.argsort(d, kind="stable")
    return d[order], np.ascontiguousarray(q[:, order])


class Spectrum:
    """Count, mean, eigenvalues and eigenvectors of the scatter matrix of the vectors seen."""

    def __init__(self, dim: int):
        self.n, self.mean, self.d, self.q = 0, np.zeros(dim), np.zeros(dim), np.eye(dim)

    def add(self, rows: np.ndarray) -> None:
        """Take in vectors: the triangular factor of a block has the scatter of its rows about their mean, and each of its
        rows is one centred rank-one update; so is the step of the mean."""
        dim = len(self.mean)
        for i in range(0, len(rows), BLOCK * dim):
            block = rows[i : i + BLOCK * dim]
            mean = block.mean(axis=0)
            block = block - mean
            self._update(len(block), mean, np.linalg.qr(block, "r") if len(block) > dim else block)

    def _update(self, n: int, mean: np.ndarray, vectors) -> None:
        """Adds ``n`` vectors with that mean, whose scatter about it is the sum of v v' over ``vectors``."""
        for v in vectors:
            self.d, self.q = rank_one(self.d, self.q, v)
        gap, total = mean - self.mean, self.n + n
        if self.n:
            self.d, self.q = rank_one(self.d, self.q, gap * np.sqrt(self.n * n / total))
        self.mean = self.mean + gap * (n / total)
        self.n = total

    def merge(self, other: Spectrum) -> None:
        if other.n:
            self._update(other.n, other.mean, (np.sqrt(value) * v for value, v in zip(other.d, other.q.T) if value > 0))

    def packed(self) -> bytes:
        return np.concatenate(([float(self.n)], self.mean, self.d, self.q.ravel())).tobytes()

    @classmethod
    def unpacked(cls, raw: bytes, dim: int) -> Spectrum:
        x = np.frombuffer(raw, np.float64)
        out = cls(dim)
        out.n, out.mean, out.d, out.q = int(x[0]), x[1 : dim + 1].copy(), x[dim + 1 : 2 * dim + 1].copy(), x[2 * dim + 1 :].reshape(dim, dim).copy()
        return out


def _lattice(batch: pa.RecordBatch, dim: int, scale: int) -> np.ndarray:
    """floor(scale * entry) of the vectors of a batch, one row each."""
    lists = batch.column(batch.num_columns - 1)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * scale), -_LIMIT, _LIMIT).reshape(-1, dim)


def _spectrum_batches(dim: int, scale: int):
    def run(batches):
        own, total = Spectrum(dim), np.zeros(dim, np.int64)
        for batch in slices(batches):
            rows = _lattice(batch, dim, scale)
            total += rows.astype(np.int64).sum(axis=0)
            own.add(rows)
        if own.n:
            yield _one(TaskContext.get().partitionId(), own.n, total, own)

    return run


def _one(part: int, n: int, total: np.ndarray, spectrum: Spectrum) -> pa.RecordBatch:
    cols = [pa.array([part], pa.int64()), pa.array([n], pa.int64()), pa.array([total.tolist()], pa.list_(pa.int64())), pa.array([spectrum.packed()], pa.binary())]
    return pa.RecordBatch.from_arrays(cols, names=["part", "n", "total", "spectrum"])


_SPECTRA = "part long, n long, total array<long>, spectrum binary"


def _merge_batches(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total, part = None, np.zeros(dim, np.int64), 0
        for batch in batches:
            for i in range(batch.num_rows):
                got = Spectrum.unpacked(batch.column("spectrum")[i].as_py(), dim)
                total += np.array(batch.column("total")[i].as_py(), np.int64)
                if own is None:
                    own, part = got, batch.column("part")[i].as_py() // FAN_IN
                else:
                    own.merge(got)
        if own is not None:
            yield _one(part, own.n, total, own)

    return run


def _covariance_batches(dim: int, scale: int, model):
    """Per task: the sum of y y' for y = (x - mean) basis."""

    def run(batches):
        mean, basis = model.value
        out = np.zeros((basis.shape[1], basis.shape[1]))
        for batch in slices(batches, 4096):
            y = (_lattice(batch, dim, scale) - mean) @ basis
            out += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([out.tobytes()], pa.binary())], names=["part", "total"])

    return run


def _add_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, total = 0, None
    for batch in batches:
        for i in range(batch.num_rows):
            got = np.frombuffer(batch.column("total")[i].as_buffer(), np.float64)
            total = got.copy() if total is None else total + got
            part = batch.column("part")[i].as_py() // FAN_IN
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["part", "total"])


def _rounds(parts: DataFrame, step, schema: str, tag: str):
    """Combine ``FAN_IN`` parts per task until one is left: its row, or None for an empty table."""
    parts = materialize(parts, tag)
    while parts.count() > 1:
        grouped = parts.groupBy(F.expr(f"part div {FAN_IN}").alias("__g"))
        parts = materialize(grouped.applyInArrow(step, schema), tag)
    return parts.first()


def _covariance(valid: DataFrame, dim: int, scale: int, mean: np.ndarray, basis: np.ndarray, n: int) -> np.ndarray:
    model = valid.sparkSession.sparkContext.broadcast((mean, basis))
    schema = "part long, total binary"
    row = _rounds(valid.mapInArrow(_covariance_batches(dim, scale, model), schema), _add_batches, schema, "covariance")
    return np.frombuffer(row["total"], np.float64).reshape(basis.shape[1], -1) / n


def _whitened_batches(dim: int, scale: int, model):
    def run(batches):
        n, total, mean, basis, width = model.value
        for batch in slices(batches):
            rows = _lattice(batch, dim, scale)
            w = (rows - mean) @ basis
            # n x - S: the offset cancels; beyond 2^31 by exact integers
            whole = n * rows.astype(np.int64).astype(object) - total if n * 2 * _LIMIT > 2**62 else n * rows.astype(np.int64) - total
            wide = whole.dtype == object or np.abs(whole).max(initial=0) >= int(np.sqrt(2.0**63 / dim)) - 1
            if wide:
                sums = (whole.astype(object) ** 2).sum(axis=1)
                far = pa.array([int(x) if x < 2**63 else None for x in sums], pa.int64())
            else:
                far = pa.array((whole * whole).sum(axis=1))
            flat = np.full((len(rows), width), np.nan)
            flat[:, : w.shape[1]] = w
            values = pa.array(flat.ravel(), mask=np.isnan(flat).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), far, lists], names=["id", "deviation", "whitened"])

    return run


def usable(df: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector is there and has only finite entries."""
    v = F.col(f"`{vec_col}`")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return df.filter(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: bad(x.cast("double"))))


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
           offset: int = OFFSET) -> tuple[DataFrame, dict]:
    """``(rows, model)``: ``id, deviation, whitened array<double>`` per usable row; the model has n, sums, mean, components (columns of
    ``basis``), eigenvalues, their share of the trace, and the identity error."""
    spark = df.sparkSession
    whole_texts(spark)
    empty = {"n": 0, "dim": 0, "sums": [], "eigenvalues": [], "explained": [], "identity_error": None}
    src = usable(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v")), "v")
    lengths = src.groupBy(F.size("v").alias("k")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("k")).first()
    schema = f"id {src.schema['id'].dataType.simpleString()}, deviation long, whitened array<double>"
    if lengths is None:
        return spark.createDataFrame([], schema), empty
    dim = lengths["k"]
    valid = src.filter(F.size("v") == dim)
    got = _rounds(valid.select("v").mapInArrow(_spectrum_batches(dim, scale), _SPECTRA), _merge_batches(dim), _SPECTRA, "spectra")
    n, total = got["n"], np.array(got["total"], np.int64)
    mean = total / n
    # Rayleigh-Ritz over the whole basis
    basis = Spectrum.unpacked(bytes(got["spectrum"]), dim).q
    e, u = np.linalg.eigh(_covariance(valid.select("v"), dim, scale, mean, basis, n))
    order = np.argsort(-e, kind="stable")
    e, basis = np.maximum(e[order], 0), (basis @ u)[:, order]
    width = min(components, dim)
    solid = int(min(width, (e > _FLAT * max(e[0], 1e-300)).sum())) if e[0] > 0 else 0
    scaled = basis[:, :solid] / np.sqrt(e[:solid])
    error = 0.0
    if solid:
        error = float(np.abs(_covariance(valid.select("v"), dim, scale, mean, scaled, n) - np.eye(solid)).max())
    trace = float(e.sum())
    model = {
        "n": n, "dim": dim, "sums": [int(x) + n * offset for x in total], "basis": basis[:, :width], "eigenvalues": e[:width].tolist(),
        "explained": [float(x / trace) if trace else 0.0 for x in e[:width]], "identity_error": error,
    }
    sent = spark.sparkContext.broadcast((n, total, mean, scaled, width))
    return valid.mapInArrow(_whitened_batches(dim, scale, sent), schema), model
