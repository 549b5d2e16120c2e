"""Embedding whitening by incremental eigendecomposition.

The covariance is that of the *fit list*: every distinct quantised vector
once.  Its eigenpairs are found in four steps:

1. Every partition keeps the eigenvalues and eigenvectors of the scatter of
   the vectors it has seen.  A new vector x changes it by the centred rank-one
   term k / (k + 1) (x - mean)(x - mean)'.  The new eigenvalues are the roots
   of the secular equation 1 + sum z_i^2 / (d_i - t) = 0, after deflation of
   components with no weight and of equal eigenvalues (:func:`rank_one`).
2. Spectra are combined, ``FAN`` at a time: the eigenpairs of one are added
   to the other as successive rank-one updates, then the term between the
   two means.
3. A distributed Rayleigh-Ritz pass over the fit list: the exact mean is
   subtracted, rows are projected on the basis found, and the projections'
   covariance, nearly diagonal, gives the last rotation.  The basis is a whole
   one, so the result is the spectrum to double precision.
4. A second pass measures the covariance of the whitened fit list.

A partial spectrum is d x d numbers, for any number of rows; the driver holds
one.  An update costs O(d^3), so d in the hundreds is the practical bound.

Defined results: rows whose vector is null or holds null or non-finite entries
go; of vectors of different lengths the shorter ones count as filled up with
zeros; copies count once in the fit list, yet every remaining row gets its
result; directions without variance give no component, so a table with fewer
than two distinct vectors gives no rows, nor does an empty one; of equal
eigenvalues any basis may come out; columns beyond ``vec_id`` and the vector
are not read.  ``deviation`` is exact or, beyond 64 bits, an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dichot.llm.spark import parts, per_group, ready, shuffle_partitions, written

EPS = np.finfo(np.float64).eps
#: spectra that one task combines
FAN = 8
#: distinct vectors that one task takes in, in bytes of 64-bit entries
SHARE = 4 << 20
#: an eigenvalue below this share of the largest one is no direction
FLAT = 1e-12


# ------------------------------------------------------------------ one rank-one update

def _roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + sum z2_i / (d_i - t) = 0 for rising ``d`` and positive
    ``z2``, each as the index of its nearer pole and the distance from it.

    All roots are improved together: the sums over the poles left and right of
    a root are each matched by one pole in value and slope, which gives a
    quadratic step; a step that leaves the bracket is a bisection."""
    n, total = len(d), z2.sum()
    right = np.append(d[1:], d[-1] + total)
    half = (right - d) / 2
    value = 1 + z2 @ (1 / (d[:, None] - d[None, :] - half))    # at the middle of each interval
    upper = (value < 0) & (np.arange(n) < n - 1)      # root nearer to the right pole
    origin = np.arange(n) + upper
    delta = d[:, None] - d[origin]
    low, high = np.where(upper, -half, 0.0), np.where(upper, 0.0, half)
    last = n - 1
    if value[last] < 0:
        low[last], high[last] = half[last], 2.001 * half[last]
    at = (low + high) / 2
    left = (np.arange(n)[:, None] <= np.arange(n)[None, :]).astype(np.float64)
    a0, b0 = d - d[origin], right - d[origin]
    for _ in range(60):
        inverse = 1 / (delta - at)
        square = inverse * inverse
        w, slopes = 1 + z2 @ inverse, z2 @ square
        # what rounding of the terms and of the root itself can make of w
        done = (np.abs(w) <= 8 * EPS * (z2 @ np.abs(inverse) + 1 + np.abs(at) * slopes)) | (high - low <= 2 * EPS * np.abs(at))
        if done.all():
            break
        low, high = np.where(w < 0, at, low), np.where(w >= 0, at, high)
        psi = z2 @ (square * left)
        phi = slopes - psi
        a, b = a0 - at, b0 - at
        c = w - a * psi - b * phi
        lin, con = (a + b) * w - a * b * (psi + phi), a * b * w
        root = np.sqrt(np.maximum(lin * lin - 4 * con * c, 0))
        with np.errstate(all="ignore"):
            step = np.where(lin <= 0, (lin - root) / (2 * c), 2 * con / (lin + root))
            step[last] = a[last] * w[last] / c[last]      # nothing right of the last root
        new = at + step
        at = np.where(done, at, np.where((new > low) & (new < high), new, (low + high) / 2))
    return origin, at


def rank_one(d: np.ndarray, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``u diag(d) u' + v v'`` for rising ``d``, rising again."""
    z = u.T @ v
    norm = float(z @ z)
    if norm == 0:
        return d, u
    floor = 8 * EPS * max(abs(d[-1]), norm)
    # deflation: no weight in a direction, or two equal eigenvalues (rotated into one)
    live = norm ** 0.5 * np.abs(z) > floor
    if np.any(np.diff(d[live]) <= floor):
        d, u, z = d.copy(), u.copy(), z.copy()
        last = -1
        for i in np.flatnonzero(live):
            if last >= 0 and d[i] - d[last] <= floor:
                r = np.hypot(z[i], z[last])
                c, s = z[i] / r, z[last] / r
                u[:, last], u[:, i] = c * u[:, last] - s * u[:, i], s * u[:, last] + c * u[:, i]
                d[last], d[i] = c * c * d[last] + s * s * d[i], s * s * d[last] + c * c * d[i]
                z[last], z[i] = 0.0, r
                live[last] = False
            last = i
        live &= norm ** 0.5 * np.abs(z) > floor
    at = np.flatnonzero(live)
    if not len(at):
        return d, u
    whole = len(at) == len(d)
    poles = d if whole else d[at]
    origin, off = _roots(poles, z[at] ** 2)
    n = len(at)
    dist = (poles[:, None] - poles[origin]) - off      # pole i less root j, without cancellation
    # weights for which these roots are exact keep the vectors orthogonal
    base = poles[None, :] - poles[:, None]             # pole j less pole i
    under = np.ones((n, n))
    if n > 1:
        j = np.arange(n)
        under[:, :-1] = np.where(j[None, :-1] < j[:, None], base[:, :-1], base[:, 1:])
    weight = np.sqrt(np.abs(np.prod(-dist / under, axis=1))) * np.sign(z[at])
    q = weight[:, None] / dist
    q /= np.sqrt((q * q).sum(0))
    roots = poles[origin] + off
    if whole:
        return roots, u @ q
    d, u = d.copy(), u.copy()
    d[at], u[:, at] = roots, u[:, at] @ q
    order = np.argsort(d, kind="stable")
    return d[order], u[:, order]


class Spectrum:
    """Count, mean and eigenpairs of the scatter of some vectors."""

    def __init__(self, width: int):
        self.n, self.mean = 0, np.zeros(width)
        self.d, self.u = np.zeros(width), np.eye(width)

    def add(self, x: np.ndarray) -> None:
        off = x - self.mean
        if self.n:
            self.d, self.u = rank_one(self.d, self.u, off * (self.n / (self.n + 1)) ** 0.5)
        self.n += 1
        self.mean = self.mean + off / self.n

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        if not self.n:
            self.n, self.mean, self.d, self.u = other.n, other.mean, other.d, other.u
            return
        n = self.n + other.n
        for e, v in zip(other.d, other.u.T):
            if e > 0:
                self.d, self.u = rank_one(self.d, self.u, v * e ** 0.5)
        off = other.mean - self.mean
        self.d, self.u = rank_one(self.d, self.u, off * (self.n * other.n / n) ** 0.5)
        self.n, self.mean = n, self.mean + off * (other.n / n)

    def numbers(self) -> np.ndarray:
        return np.concatenate([[self.n], self.mean, self.d, self.u.ravel()])

    @classmethod
    def of(cls, numbers: np.ndarray, width: int) -> Spectrum:
        out = cls(width)
        out.n, out.mean = int(numbers[0]), numbers[1:1 + width].copy()
        out.d, out.u = numbers[1 + width:1 + 2 * width].copy(), numbers[1 + 2 * width:].reshape(width, width).copy()
        return out


# ------------------------------------------------------------------ on Spark

def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists of 64-bit integers as rows, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if np.all(lengths == width):
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    row, place = np.repeat(np.arange(len(column)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    there = place < width                              # what lies beyond is zero in every vector
    out[row[there], place[there]] = flat[there]
    return out


def _vectors(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.tolist() for v in values], pa.list_(pa.float64()))


def _spectra(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Spectrum(width)
        for batch in batches:
            for x in _matrix(batch.column("x"), width).astype(np.float64):
                found.add(x)
        if found.n:
            yield pa.RecordBatch.from_arrays([_vectors([found.numbers()])], names=["s"])
    return run


def _combine(width: int, group: pa.Table) -> pa.Table:
    rows = sorted(group.column("s").to_pylist())
    found = Spectrum(width)
    for row in rows:
        found.merge(Spectrum.of(np.array(row), width))
    return pa.table({"s": _vectors([found.numbers()])})


def _sums(work):
    """Per partition one row with the sum of ``work(batch)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                total = work(batch) if total is None else total + work(batch)
        if total is not None:
            yield pa.RecordBatch.from_arrays([_vectors([total])], names=["s"])
    return run


def _added(rows: DataFrame, length: int) -> np.ndarray:
    """The sum of ``s`` over all rows, added up ``FAN`` at a time in two levels
    of groups by place, so no task adds more than its share of rows."""
    long = rows.select(F.posexplode("s").alias("i", "v"), (F.spark_partition_id() % (FAN * FAN)).alias("g"))
    got = long.groupBy("i", "g").agg(F.sum("v").alias("v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(length)
    for r in got:
        out[r["i"]] = r["v"]
    return out


def quantised(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, x``: floor(256 c) of every entry, for vectors whose entries
    are all there and finite."""
    whole = F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    return embeddings.where(whole).select("vec_id", F.transform(
        vector, lambda c: F.floor(c.cast("double") * 256).cast("bigint")).alias("x"))


def basis(fit: DataFrame, width: int) -> np.ndarray:
    """Orthonormal columns near the eigenvectors of the scatter of ``fit``."""
    kind = "s array<double>"
    spectra = written(fit.mapInArrow(_spectra(width), kind), "spectra")
    rows = spectra.count()
    while rows > 1:
        rows = -(-rows // FAN)
        # by content, so that a recomputed task deals its rows out alike
        keyed = spectra.withColumn("g", F.pmod(F.xxhash64("s"), F.lit(rows)))
        spectra = written(keyed.groupBy("g").applyInArrow(per_group(_combine, width), kind), "spectra")
        rows = spectra.count()
    return np.linalg.qr(Spectrum.of(np.array(spectra.first()["s"]), width).u)[0]


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = 4) -> DataFrame:
    """One row for each remaining row and component: ``vec_id, component, n,
    deviation, whitened, explained, identity_error``."""
    spark = ready(embeddings)
    rows = quantised(embeddings, vector)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    # zeros at the end do not make vectors different
    trimmed = F.when(F.element_at("x", -1) != 0, F.col("x")).otherwise(
        F.slice("x", 1, F.coalesce(F.array_max(F.transform("x", lambda c, i: F.when(c != 0, i + 1))), F.lit(0))))
    fit = written(rows.select(F.when(F.size("x") > 0, trimmed).otherwise(F.col("x")).alias("x")).distinct(), "fit")
    n, width = fit.agg(F.count("*"), F.max(F.size("x"))).first()
    if n < 2 or not width:
        return spark.createDataFrame([], schema)
    # how many tasks follows from the rows; the vectors are dealt out by content
    tasks = parts(spark, 8 * n * width, SHARE) if n > shuffle_partitions(spark) else 1
    fit = written(fit.repartition(tasks, F.xxhash64("x")), "fit")
    sums = {r["i"]: r["s"] for r in fit.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.sum("c").alias("s")).collect()}
    total = np.array([sums.get(i, 0) for i in range(width)], dtype=object)
    mean = np.array([t / n for t in total], dtype=np.float64)
    u = basis(fit, width)

    def projected(batch):
        y = (_matrix(batch.column("x"), width) - mean) @ u
        return (y.T @ y).ravel()

    ritz = _added(fit.mapInArrow(_sums(projected), "s array<double>"), width * width).reshape(width, width) / n
    e, w = np.linalg.eigh((ritz + ritz.T) / 2)
    e, v = e[::-1], (u @ w)[:, ::-1]
    trace, k = float(np.trace(ritz)), int(np.sum(e[:components] > FLAT * max(e[0], 0)))
    if not k or trace <= 0:
        return spark.createDataFrame([], schema)
    axes, share = v[:, :k] / np.sqrt(e[:k]), e[:k] / trace

    def white(batch):
        y = (_matrix(batch.column("x"), width) - mean) @ axes
        return np.concatenate([y.sum(0), (y.T @ y).ravel()])

    seen = _added(fit.mapInArrow(_sums(white), "s array<double>"), k + k * k) / n
    error = float(np.abs(seen[k:].reshape(k, k) - np.outer(seen[:k], seen[:k]) - np.eye(k)).max())

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            y = (x - mean) @ axes
            bound = (max(int(np.abs(x).max(initial=0)) * n + max(abs(int(t)) for t in total), 1)) ** 2 * width
            whole = x if bound < 2 ** 63 else x.astype(object)
            centred = whole * n - (total.astype(np.int64) if bound < 2 ** 63 else total)
            deviation = (centred * centred).sum(1)
            rows_, m = len(x), k
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(np.repeat(np.arange(rows_), m))),
                pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), rows_)),
                pa.array(np.full(rows_ * m, n, np.int64)),
                pa.array(np.repeat(deviation, m).tolist(), pa.int64()),
                pa.array(y.ravel()), pa.array(np.tile(share, rows_)), pa.array(np.full(rows_ * m, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(result, schema)
