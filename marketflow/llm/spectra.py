"""Eigenvectors of a covariance by rank-one updates, and vectors whitened with them.

Every partition keeps the eigendecomposition of its own scatter matrix and takes one vector after the other into it: a vector, centred on the mean so
far, changes the scatter by a matrix of rank one, whose effect on the spectrum is found from the secular equation, with deflation
where a component or a gap is too small to matter. Two spectra are combined in the same way, the eigenvectors of one being taken into
the other by successive rank-one updates, and then the difference of the means. No covariance is formed for it. At last the vectors themselves refine the
result: their projections on the eigenvectors give a small matrix (Rayleigh and Ritz), whose own eigenvectors turn the basis, until it
is diagonal to working precision.

A task holds two matrices of dimension squared, whatever the number of vectors; vectors are only ever shuffled to find equal ones and to deal these out.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import prepare, shuffle_parts, stored

SCALE, SHIFT = 64, 1_000_000  # fixed values: an entry c is the integer floor(64 c) + 1000000
BOUND = 1 << 61  # of the integers
COMPONENTS = 16
EPS = np.finfo(float).eps
TASK_ROWS = 2048  # vectors of a task, as far as twenty times the session's shuffle partitions allow
ROUNDS = 6  # refinements at most; two are usual


def secular(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(w / (d - x)) = 0`` for ascending distinct ``d`` and positive ``w``, each as a pole and an offset from it.

    The root after pole j lies before the next, the last one before ``d[-1] + sum(w)``. All are found together: each step fits a constant
    and the two poles beside the root, a step that leaves the known bracket halves it instead. Offsets are taken from the nearer
    pole, so that the distance to both is known to full relative precision.
    """
    k = len(d)
    after = np.append(d[1:], d[-1] + w.sum())
    gap = after - d
    lower = np.tri(k, dtype=bool)  # [j, i]: pole i is not beyond root j
    middle = 1 + (w / (d - (d + gap / 2)[:, None])).sum(1)
    left = (middle >= 0) | (np.arange(k) == k - 1)
    base = np.where(left, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    low, high = np.where(left, 0.0, -gap / 2), np.where(left, np.where(middle >= 0, gap / 2, gap), 0.0)
    poles = d - d[base][:, None]
    near, far = d - d[base], after - d[base]
    x = (low + high) / 2
    for _ in range(80):
        apart = poles - x[:, None]
        terms = w / apart
        slopes = terms / apart
        f = 1 + terms.sum(1)
        done = (np.abs(f) <= 4 * EPS * k * (1 + np.abs(terms).sum(1))) | (high - low <= 4 * EPS * np.maximum(np.abs(low), np.abs(high)))
        if done.all():
            break
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        before = (slopes * lower).sum(1)
        beyond = slopes.sum(1) - before
        p, q = near - x, far - x
        a = (p + q) * f - p * q * (before + beyond)
        b = p * q * f
        c = f - p * before - q * beyond
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            moved = x + step
        x = np.where(done, x, np.where(np.isfinite(moved) & (moved > low) & (moved < high), moved, (low + high) / 2))
    return base, x


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) once ``rho * v v'`` is added, ``rho`` not negative."""
    z = vectors.T @ v
    size = np.linalg.norm(z)
    if not rho * size * size > 0:
        return values, vectors
    z, rho = z / size, rho * size * size
    small = 8 * EPS * max(np.abs(values).max(), rho)
    live = rho * np.abs(z) > small
    close = np.flatnonzero(live)
    if len(close) > 1 and (np.diff(values[close]) * np.abs(z[close][1:] * z[close][:-1]) / (z[close][1:] ** 2 + z[close][:-1] ** 2) <= small).any():
        vectors, values = vectors.copy(), values.copy()
        last = close[0]
        for i in close[1:]:  # equal eigenvalues: a rotation leaves all of the update to one of the two
            r = np.hypot(z[last], z[i])
            c, s = z[i] / r, z[last] / r
            if abs((values[i] - values[last]) * c * s) <= small:
                vectors[:, last], vectors[:, i] = c * vectors[:, last] - s * vectors[:, i], s * vectors[:, last] + c * vectors[:, i]
                values[last], values[i] = c * c * values[last] + s * s * values[i], s * s * values[last] + c * c * values[i]
                z[i], z[last], live[last] = r, 0.0, False
            last = i
    at = np.flatnonzero(live)
    if not len(at):
        return values, vectors
    at = at[np.argsort(values[at], kind="stable")]
    d, w = values[at], rho * z[at] ** 2
    base, offset = secular(d, w)
    apart = (d[:, None] - d[base]) - offset  # [i, j]: pole i less root j
    # Weights for which the found roots are exact: the eigenvectors are orthogonal however close they are.
    gaps = d[:, None] - d
    np.fill_diagonal(gaps, 1.0)
    again = np.sqrt(np.abs(np.prod(apart / gaps, axis=1))) * np.where(z[at] < 0, -1.0, 1.0)
    inner = again[:, None] / apart
    inner /= np.linalg.norm(inner, axis=0)
    new_values, new_vectors = values.copy(), vectors.copy()
    new_values[at], new_vectors[:, at] = d[base] + offset, vectors[:, at] @ inner
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


@dataclass
class Spectrum:
    """Number, exact sums, and the eigendecomposition of the scatter matrix of some integer vectors."""

    count: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, [0] * dim, np.zeros(dim), np.eye(dim))

    def add(self, rows: np.ndarray) -> Spectrum:
        """Integer vectors taken in one after the other, each centred on the mean of those before it."""
        count, values, vectors = self.count, self.values, self.vectors
        mean = np.array([(s - SHIFT * count) / max(count, 1) for s in self.sums])  # less the shift, so that no digits are spent on it
        for x in (rows - SHIFT).astype(float):
            off = x - mean
            values, vectors = rank_one(values, vectors, off, count / (count + 1))
            mean = mean + off / (count + 1)
            count += 1
        return Spectrum(count, [a + b for a, b in zip(self.sums, exact_sums(rows))], values, vectors)

    def join(self, other: Spectrum) -> Spectrum:
        """Both together: the eigenvectors of one, and the difference of the means, are taken into the other."""
        if not self.count or not other.count:
            return self if self.count else other
        values, vectors = self.values, self.vectors
        for e, v in zip(other.values, other.vectors.T):
            values, vectors = rank_one(values, vectors, v, max(e, 0.0))
        count = self.count + other.count
        apart = np.array([(a * other.count - b * self.count) / (self.count * other.count) for a, b in zip(self.sums, other.sums)])
        values, vectors = rank_one(values, vectors, apart, self.count * other.count / count)
        return Spectrum(count, [a + b for a, b in zip(self.sums, other.sums)], values, vectors)


def exact_sums(rows: np.ndarray) -> list[int]:
    """Sums of integer columns, beyond 64 bits if need be."""
    return [(int(h) << 32) + int(l) for h, l in zip((rows >> 32).sum(0), (rows & 0xFFFFFFFF).sum(0))]


def integers(vectors: DataFrame) -> DataFrame:
    """The rows that take part, with ``x`` (integer entries) and ``dim``."""
    v = F.col("embedding").cast("array<double>")
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.where(v.isNotNull() & ~F.coalesce(odd, F.lit(True)))
    held = lambda c: F.greatest(F.least(c * SCALE, F.lit(float(BOUND))), F.lit(-float(BOUND)))
    x = F.transform(v, lambda c: F.floor(held(c)) + F.lit(SHIFT).cast("long"))
    return rows.select("vec_id", x.alias("x"), F.size("embedding").alias("dim")).where("dim > 0")


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def deviations(rows: np.ndarray, count: int, sums: list[int]) -> np.ndarray:
    """``count * x - sums`` exactly: in 64 bits where that is enough, else in integers of any length."""
    bounds = [] if not len(rows) else [(int(a), int(b)) for a, b in zip(rows.min(0), rows.max(0))]
    most = max((count * max(abs(a), abs(b)) + abs(s) for (a, b), s in zip(bounds, sums)), default=0)
    span = max((max(abs(count * a - s), abs(count * b - s)) for (a, b), s in zip(bounds, sums)), default=0)
    if most < 1 << 62 and span * span * rows.shape[1] < 1 << 63:
        return rows * count - np.array(sums, dtype=np.int64)
    return rows.astype(object) * count - np.array(sums, dtype=object)


def centred(rows: np.ndarray, count: int, sums: list[int]) -> np.ndarray:
    """The rows less the mean, the difference taken in integers."""
    return deviations(rows, count, sums).astype(float) / count


def _per_partition(fit: DataFrame, start, add) -> list:
    """One combined value per partition of the fit list, as (value,) of a picklable kind."""

    def work(batches: Iterator[pa.RecordBatch]):
        value = None
        for batch in batches:
            if batch.num_rows:
                value = add(start() if value is None else value, batch)
        if value is not None:
            yield value

    return fit.select("x").mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"blob": [pickle.dumps(v)]}) for v in work(batches)), "blob binary").rdd.map(lambda row: pickle.loads(bytes(row.blob)))


def spectrum(fit: DataFrame, dim: int) -> Spectrum:
    """Of all rows: partitions on their own, then combined in a tree of tasks."""
    parts = _per_partition(fit, lambda: Spectrum.empty(dim), lambda own, batch: own.add(_matrix(batch, dim)))
    return parts.treeReduce(Spectrum.join, 3)


def projected(fit: DataFrame, whole: Spectrum, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum, and covariance about their mean, of the centred rows projected on the columns of ``basis``."""
    dim, count, sums = len(basis), whole.count, whole.sums
    k = basis.shape[1]

    def add(own, batch):
        y = centred(_matrix(batch, dim), count, sums) @ basis
        return own[0] + y.sum(0), own[1] + y.T @ y

    total, products = _per_partition(fit, lambda: (np.zeros(k), np.zeros((k, k))), add).treeReduce(lambda a, b: (a[0] + b[0], a[1] + b[1]), 3)
    mean = total / count
    return total, products / count - np.outer(mean, mean)


def refine(fit: DataFrame, whole: Spectrum, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors of the covariance: the basis is turned until its projections do not correlate."""
    basis = np.linalg.qr(whole.vectors)[0]
    for _ in range(rounds):
        matrix = projected(fit, whole, basis)[1]
        rest = np.abs(matrix - np.diag(np.diag(matrix))).max(initial=0)
        values, turn = np.linalg.eigh((matrix + matrix.T) / 2)
        basis = np.linalg.qr(basis @ turn[:, ::-1])[0]
        if rest <= 64 * EPS * np.abs(values).max(initial=0):
            break
    return values[::-1], basis


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every row that takes part and every component.

    Rows whose vector is null or empty, or holds null or non-finite entries, take no part. Equal integer vectors count once for the fit and
    are whitened each; null and repeated ids are ids like any other. Vectors of different lengths are fitted apart, length by length.
    Directions in which the rows do not differ are no components, so a single distinct vector, like an empty table, gives no row.
    Integers beyond 2^61 are held at that bound; a deviation beyond 64 bits is null. Other columns take no part.
    """
    spark = prepare(vectors.sparkSession)
    rows = stored(integers(vectors), "integers")
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    result = spark.createDataFrame([], schema)
    for (dim,) in sorted(rows.select("dim").distinct().collect()):
        own = rows.where(F.col("dim") == dim)
        # Dealt by work, not by bytes: a vector of 64 dimensions costs more than a millisecond.
        parts = min(-(-own.count() // TASK_ROWS), 20 * shuffle_parts(spark))
        part = _whitened(own, stored(own.select("x").distinct().repartition(max(1, parts)), "fit"), dim, components, schema)
        result = result.unionByName(part)
    return result


def _whitened(rows: DataFrame, fit: DataFrame, dim: int, components: int, schema: str) -> DataFrame:
    whole = spectrum(fit, dim)
    values, basis = refine(fit, whole)
    trace = values.sum()
    used = min(components, int((values > dim * EPS * max(values[0], 0)).sum())) if values[0] > 0 else 0
    turn = basis[:, :used] / np.sqrt(values[:used])
    error = float(np.abs(projected(fit, whole, turn)[1] - np.eye(used)).max(initial=0)) if used else 0.0
    explained = values[:used] / trace
    count, sums = whole.count, whole.sums

    def work(batches):
        for batch in batches:
            x = _matrix(batch, dim)
            off = deviations(x, count, sums)
            deviation = [d if d < 1 << 63 else None for d in map(int, (off * off).sum(1))]
            white = (off.astype(float) / count) @ turn
            size = len(x)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(np.repeat(np.arange(size), used))), pa.array(np.tile(np.arange(1, used + 1, dtype=np.int32), size)),
                pa.array(np.full(size * used, count, np.int64)), pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(size), used))),
                pa.array(white.ravel()), pa.array(np.tile(explained, size)), pa.array(np.full(size * used, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(work, schema)
