"""Whitening of embeddings by an incremental eigendecomposition.

Entries become integers, ``x = floor(64 c) + 1000000``, so counts, sums and deviations are
exact. The covariance is never formed from raw products:

1. Each partition keeps the mean and the spectrum (eigenvalues and eigenvectors) of its
   scatter matrix. A vector changes the scatter by a centred rank-one term; the new
   eigenvalues are the roots of the secular equation. Directions that the term does not
   touch, and equal eigenvalues, are deflated. Vectors that repeat within a batch are one
   weighted update.
2. Spectra are combined in groups of ``FAN``, level by level, in tasks: the second
   spectrum enters the first as one rank-one update for each of its eigenpairs and one
   for the distance of the means.
3. The result is refined: one pass over all rows sums the covariance in the basis found
   (Rayleigh-Ritz over the whole space), centred by exact integers, and the eigenvectors
   of that nearly diagonal matrix turn the basis to double precision.

The driver holds matrices of the size of one dimension squared, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectide.llm.common import col, written
from vectide.sizing import deal_out

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Spectra that one task combines.
FAN = 16
#: Rows whose results one batch holds.
STEP_ROWS = 2048
EPS = np.finfo(np.float64).eps
#: Eigenvalues below this share of the largest are zero to double precision.
RANK = 1e-12
#: Entries of a scaled vector stay below this, so that their sums are exact.
MOST = 1 << 50


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum z2 / (d - x)``, one above each of the ascending ``d``, as differences.

    Returns for each root ``w``, the row of ``d - root``, and the root itself. The
    roots are sought from the nearer pole, so that differences keep their precision.
    """
    k = len(d)
    total = z2.sum()
    upper = np.append(d[1:], d[-1] + total)
    gap = upper - d
    lower = np.tri(k, dtype=bool)
    # The middle says which pole is nearer.
    with np.errstate(divide="ignore", invalid="ignore"):
        mid = 1 + (z2[None, :] / ((d[None, :] - d[:, None]) - gap[:, None] / 2)).sum(axis=1)
    right = (mid < 0) & (np.arange(k) < k - 1)
    origin = np.arange(k) + right
    delta = d[None, :] - d[origin][:, None]
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, np.where(np.arange(k) == k - 1, gap, gap / 2))
    mu = (low + high) / 2
    at = np.arange(k)
    over = upper - d[origin]
    for _ in range(100):
        w = delta - mu[:, None]
        t = z2[None, :] / w
        below = np.where(lower, t, 0.0)
        psi, total_t = below.sum(axis=1), t.sum(axis=1)
        f = 1 + total_t
        s = t / w
        dpsi, ds = np.where(lower, s, 0.0).sum(axis=1), s.sum(axis=1)
        bound = EPS * k * (1 + np.abs(psi) + np.abs(total_t - psi))
        low, high = np.where(f < 0, np.maximum(low, mu), low), np.where(f < 0, high, np.minimum(high, mu))
        done = (np.abs(f) <= bound) | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
        if done.all():
            break
        # Both neighbouring poles are matched in value and slope (the middle way).
        d1, d2 = w[at, at], over - mu
        dphi = ds - dpsi
        a = (d1 + d2) * f - d1 * d2 * ds
        b = d1 * d2 * f
        c = f - d1 * dpsi - d2 * dphi
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = mu + step
        outside = ~((new > low) & (new < high))
        mu = np.where(done, mu, np.where(outside, (low + high) / 2, new))
    return delta - mu[:, None], d[origin] + mu


def rank_one(d: np.ndarray, q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of ``q diag(d) q' + v v'``; ``d`` is ascending."""
    z = q.T @ v
    norm = np.sqrt(z @ z)
    if norm == 0.0 or not np.isfinite(norm):
        return d, q
    tol = 8 * EPS * max(d[-1], norm * norm)
    active = np.abs(z) * norm > tol
    if not active.any():
        return d, q
    idx = np.flatnonzero(active)
    close = np.diff(d[idx]) <= tol
    if close.any():
        # Equal eigenvalues: a reflection leaves the term in one direction of each run.
        q, z = q.copy(), z.copy()
        edge = np.flatnonzero(np.r_[True, ~close, True])
        for a, b in zip(edge, edge[1:]):
            if b - a > 1:
                run = idx[a:b]
                u = z[run].copy()
                size = np.sqrt(u @ u)
                u[-1] += size if u[-1] >= 0 else -size
                q[:, run] -= np.outer(q[:, run] @ u, u) * (2 / (u @ u))
                z[run] = 0.0
                z[run[-1]] = -size if u[-1] >= 0 else size
                active[run[:-1]] = False
        idx = np.flatnonzero(active)
    da, za = d[idx], z[idx]
    w, roots = secular_roots(da, za * za)
    k = len(idx)
    # The vector for which the roots found are exact: its eigenvectors are orthogonal.
    gaps = da[None, :] - da[:, None]
    shifted = np.concatenate([gaps[:, 1:], np.ones((k, 1))], axis=1)
    ratio = -w.T / np.where(np.tri(k, k, -1, dtype=bool), gaps, shifted)
    fixed = np.sqrt(np.abs(np.prod(ratio, axis=1))) * np.where(za < 0, -1.0, 1.0)
    turn = (fixed[None, :] / w).T
    turn /= np.sqrt((turn * turn).sum(axis=0))[None, :]
    if k == len(d):
        return roots, q @ turn
    d, q = d.copy(), q.copy()
    d[idx], q[:, idx] = roots, q[:, idx] @ turn
    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


class Spectrum:
    """Count, exact sums and the spectrum of the scatter around the mean of some integer vectors."""

    def __init__(self, dim: int):
        self.n = 0
        self.sums = np.zeros(dim, np.int64)
        self.d, self.q = np.zeros(dim), np.eye(dim)

    def mean(self) -> np.ndarray:
        return (self.sums - self.n * SHIFT) / self.n

    def add(self, x: np.ndarray, weight: int = 1) -> None:
        """A vector that occurs ``weight`` times."""
        if self.n:
            away = (x - SHIFT) - self.mean()
            self.d, self.q = rank_one(self.d, self.q, np.sqrt(self.n * weight / (self.n + weight)) * away)
        self.n += weight
        self.sums = self.sums + weight * x

    def merge(self, other: Spectrum) -> None:
        if not self.n or not other.n:
            if other.n:
                self.n, self.sums, self.d, self.q = other.n, other.sums, other.d, other.q
            return
        away = other.mean() - self.mean()
        self.d, self.q = rank_one(self.d, self.q, np.sqrt(self.n * other.n / (self.n + other.n)) * away)
        for value, direction in zip(other.d[::-1], other.q.T[::-1]):
            if value > 0:
                self.d, self.q = rank_one(self.d, self.q, np.sqrt(value) * direction)
        self.n += other.n
        self.sums = self.sums + other.sums

    def row(self) -> pa.RecordBatch:
        lists = [pa.array([x.ravel()], pa.list_(t)) for x, t in ((self.sums, pa.int64()), (self.d, pa.float64()), (self.q, pa.float64()))]
        return pa.RecordBatch.from_arrays([pa.array([self.n]), *lists], names=["n", "sums", "d", "q"])

    @staticmethod
    def of(n: int, sums, d, q) -> Spectrum:
        out = Spectrum(len(d))
        out.n, out.sums, out.d = n, np.array(sums, np.int64), np.array(d)
        out.q = np.array(q).reshape(len(d), len(d))
        return out


_SHAPE = "n long, sums array<long>, d array<double>, q array<double>"


def usable(vector: Column) -> Column:
    """Whether a vector is there, has entries, and all of them are finite (and below ``MOST`` when scaled)."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) >= MOST / SCALE)
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad)


def integers(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and the integer vector ``x`` of the rows with a usable vector."""
    x = F.transform(col(vector_col), lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))
    return rows.where(usable(col(vector_col))).select(col(id_col).alias("id"), x.alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim)


def spectrum(vectors: DataFrame, dim: int, fan: int = FAN) -> Spectrum:
    """The spectrum of all vectors ``x``, by partitions and then level by level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Spectrum(dim)
        for batch in batches:
            if batch.num_rows:
                distinct, times = np.unique(_matrix(batch.column("x"), dim), axis=0, return_counts=True)
                for x, n in zip(distinct, times.tolist()):
                    held.add(x, n)
        if held.n:
            yield held.row()

    def combined(table: pa.Table) -> pa.Table:
        held = Spectrum(dim)
        for r in table.sort_by("g").drop_columns(["g", "up"]).to_pylist():
            held.merge(Spectrum.of(**r))
        return pa.Table.from_batches([held.row()]).append_column("g", pa.array([table["up"][0].as_py()], pa.int64()))

    level = written(vectors.select("x").mapInArrow(run, _SHAPE).withColumn("g", F.spark_partition_id().cast("long")))
    count = level.agg(F.max("g")).first()[0] + 1
    while count > 1:
        up = level.withColumn("up", F.floor(F.col("g") / fan))
        level = written(up.groupBy("up").applyInArrow(combined, f"{_SHAPE}, g long"))
        count = -(-count // fan)
    return Spectrum.of(**level.drop("g").first().asDict())


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n x - sums``, exact: as long while it fits, else as whole numbers of any size."""
    if n * int(np.abs(x).max(initial=0)) < 1 << 62:
        return n * x - sums
    return n * x.astype(object) - sums.astype(object)


def deviations(away: np.ndarray) -> list[int | None]:
    """Sums of squares, exact; null where they exceed a long."""
    most = max(int(away.max(initial=0)), -int(away.min(initial=0)))
    if away.dtype != object and most * most * away.shape[1] < 1 << 63:
        return (away * away).sum(axis=1).tolist()
    exact = (away.astype(object) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def _summed(vectors: DataFrame, dim: int, basis: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Covariance and mean of the centred vectors in a basis, from one pass; sums of a task are one batch."""
    k = basis.shape[1]
    i, j = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, means = np.zeros((k, k)), np.zeros(k)
        seen = False
        for batch in batches:
            if batch.num_rows:
                y = (centred(_matrix(batch.column("x"), dim), n, sums) / n).astype(np.float64) @ basis
                products += y.T @ y
                means += y.sum(axis=0)
                seen = True
        if seen:
            a, b = np.r_[i, np.arange(k)], np.r_[j, np.full(k, -1)]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.r_[products[i, j], means])], names=["i", "j", "v"])

    parts = vectors.select("x").mapInArrow(run, "i long, j long, v double")
    out, mean = np.zeros((k, k)), np.zeros(k)
    for a, b, v in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        if b < 0:
            mean[a] = v / n
        else:
            out[a, b] = out[b, a] = v / n
    return out - np.outer(mean, mean), mean


class Whitening:
    """The fitted transform: ``basis`` holds unit eigenvectors by falling eigenvalue."""

    def __init__(self, n: int, sums: np.ndarray, basis: np.ndarray, values: np.ndarray, trace: float, error: float):
        self.n, self.sums, self.basis, self.values = n, sums, basis, values
        self.trace, self.error = trace, error


def fit(vectors: DataFrame, dim: int, components: int = COMPONENTS, fan: int = FAN) -> Whitening:
    """The whitening of the vectors ``x``, at most ``components`` of them and none with eigenvalue zero."""
    rough = spectrum(vectors, dim, fan)
    n, sums = rough.n, rough.sums
    basis = np.linalg.qr(rough.q)[0]
    projected, _ = _summed(vectors, dim, basis, n, sums)
    values, turn = np.linalg.eigh(projected)
    trace = float(np.trace(projected))
    kept = [k for k in np.argsort(-values, kind="stable") if values[k] > RANK * values.max()][:components]
    basis, values = basis @ turn[:, kept], values[kept]
    # Either sign is right; the largest entry is positive.
    basis = basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(len(kept))] < 0, -1.0, 1.0)
    covariance, _ = _summed(vectors, dim, basis / np.sqrt(values), n, sums)
    error = float(np.abs(covariance - np.eye(len(kept))).max(initial=0.0))
    return Whitening(n, sums, basis, values, trace, error)


def whiten(
    rows: DataFrame, id_col: str = "id", vector_col: str = "vector", components: int = COMPONENTS, fan: int = FAN
) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` of every usable vector and component.

    Rows without a vector, with an empty one, or with an entry that is null, not finite or
    beyond 2^44 are left out. The dimension is that of most vectors, the higher of equally
    frequent ones; vectors of another length are left out as well. Components whose
    eigenvalue is zero (constant directions) cannot be whitened and are not returned, so
    vectors that are all alike, and empty tables, give no rows. Rows and ids may repeat.
    """
    kind = rows.select(col(id_col)).schema[0].dataType.simpleString()
    shape = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    vectors = integers(rows, id_col, vector_col)
    sizes = vectors.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if sizes is None:
        return rows.sparkSession.createDataFrame([], shape)
    dim = sizes["dim"]
    vectors = deal_out(vectors.where(F.size("x") == dim))
    found = fit(vectors, dim, components, fan)
    n, sums, k = found.n, found.sums, len(found.values)
    if not k:
        return rows.sparkSession.createDataFrame([], shape)
    scaled, explained, error = found.basis / np.sqrt(found.values), found.values / found.trace, found.error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, STEP_ROWS):
                batch = whole.slice(start, STEP_ROWS)
                m = batch.num_rows
                away = centred(_matrix(batch.column("x"), dim), n, sums)
                y = (away / n).astype(np.float64) @ scaled
                at = pa.array(np.repeat(np.arange(m), k))
                columns = [
                    batch.column("id").take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)),
                    pa.array(deviations(away), pa.int64()).take(at),
                    pa.array(y.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, shape)
