"""Embedding whitening: principal components by FEAST contour integration.

*Moments (Spark).*  Entries become whole numbers ``x = floor(256 * c)``.  The fit list (each distinct vector
once) is grouped on its whole content, with a map-side combine, so copies cost one row per task.  Its sums and
the products of centred entries are summed per task and then per entry in whole numbers: the covariance does not
depend on partitioning or on the order of the sums.  Vectors are centred on the rounded mean before they are
multiplied; the rest of the mean is taken off exactly, in whole numbers.

*Components (a ``d x d`` matrix, d = entries of a vector).*  FEAST: the spectral projector onto the eigenvalues inside
an interval is a contour integral of the resolvent, evaluated by Gauss-Legendre quadrature, each node a solve
with the complex shifted covariance; Rayleigh-Ritz on the projected block gives the eigenpairs, repeated until
their residuals vanish.  The interval is found, and the answer checked, by inertia: the signs of a symmetric
block factorisation of ``V - s`` count the eigenvalues above ``s``, so none can be missed.

Only the matrix and ``d`` sums come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import release, ship_package, stored

COMPONENTS = 4
SCALE = 256.0
NODES = 8          # quadrature nodes on the half circle
EXTRA = 4          # vectors of the projected block beyond those inside the interval
MAX_REFINEMENTS = 60
_LONG = 2.0 ** 63


# -- rows ------------------------------------------------------------------------------

def _entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values as double, offsets, usable) of a list column; a null entry is NaN, a null list is not usable."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths().fill_null(0), dtype=np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    off = np.concatenate(([0], np.cumsum(sizes)))
    scaled = np.floor(SCALE * values)
    bad = np.concatenate(([0], np.cumsum(~(np.abs(scaled) < _LONG))))
    usable = (bad[off[1:]] == bad[off[:-1]]) & np.asarray(column.is_valid())
    return scaled, off, usable


def _whole_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, x) of usable vectors, x as whole numbers."""
    for batch in batches:
        if not batch.num_rows:
            continue
        scaled, off, usable = _entries(batch.column(1))
        keep = np.flatnonzero(usable)
        mask = np.repeat(usable, np.diff(off))
        sizes = np.diff(off)[keep]
        x = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)),
                                     pa.array(scaled[mask].astype(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), x], ["id", "x"])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _whole_sum_rows(total: np.ndarray, name: str) -> pa.RecordBatch:
    """Whole-number sums as decimal text, one row per place."""
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)),
                                       pa.array([str(int(v)) for v in total])], ["place", name])


def _sum_batches(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(dim, dtype=object)
    for batch in batches:
        x = _matrix(batch.column(0), dim)
        if len(x):
            small = float(np.abs(x.astype(np.float64)).max()) * len(x) < _LONG / 2
            total = total + (x.sum(axis=0).astype(object) if small else x.astype(object).sum(axis=0))
    yield _whole_sum_rows(total, "s")


def _product_batches(batches: Iterator[pa.RecordBatch], centre: list[int]) -> Iterator[pa.RecordBatch]:
    """Sums of products of centred entries, one row per place of the upper triangle."""
    dim = len(centre)
    upper = np.triu_indices(dim)
    total = np.zeros(len(upper[0]), dtype=object)
    middle = np.array(centre, dtype=object)
    for batch in batches:
        x = _matrix(batch.column(0), dim)
        if not len(x):
            continue
        widest = float(np.abs(x.astype(np.float64) - middle.astype(np.float64)).max()) + 1
        if widest * widest * len(x) < 2.0 ** 53:  # exact in doubles, so the product may use them
            c = (x - middle.astype(np.int64)).astype(np.float64)
            total = total + (c.T @ c)[upper].astype(np.int64).astype(object)
        else:
            c = x.astype(object) - middle
            total = total + (c.T @ c)[upper]
    yield _whole_sum_rows(total, "s")


def _added(partial: DataFrame) -> list[int]:
    """Totals by place; a task sends one row per place, the sums run on the executors."""
    rows = partial.groupBy("place").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    return [int(r.s) for r in sorted(rows, key=lambda r: r.place)]


# -- components ------------------------------------------------------------------------

def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are above ``shift``, by Sylvester's law of inertia.

    ``matrix - shift`` is eliminated symmetrically with complete pivoting; a pivot is one diagonal entry or a
    two-by-two block, which always has one eigenvalue of each sign.
    """
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    ratio = (1 + 17 ** 0.5) / 8
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        p = int(diagonal.argmax())
        off = np.abs(a)
        np.fill_diagonal(off, 0)
        r, s = np.unravel_index(int(off.argmax()), a.shape)
        if diagonal[p] == 0 and off[r, s] == 0:
            break  # what is left is zero: eigenvalues at the shift
        if diagonal[p] >= ratio * off[r, s]:
            above += bool(a[p, p] > 0)
            pivots = [p]
        else:
            above += 1
            pivots = [r, s]
        rest = np.delete(np.arange(len(a)), pivots)
        c = a[np.ix_(rest, pivots)]
        a = a[np.ix_(rest, rest)] - c @ np.linalg.solve(a[np.ix_(pivots, pivots)], c.T)
        a = (a + a.T) / 2
    return above


def _edge(matrix: np.ndarray, count: int, low: float, high: float) -> tuple[float, float]:
    """(low, high) around the ``count``-th largest eigenvalue, by bisection on the inertia."""
    for _ in range(100):
        middle = (low + high) / 2
        if high - low <= 1e-6 * high or not low < middle < high:
            break
        if eigenvalues_above(matrix, middle) >= count:
            low = middle
        else:
            high = middle
    return low, high


def _interval(matrix: np.ndarray, wanted: int, floor: float, top: float) -> tuple[float, float, int]:
    """(lower end, upper end, eigenvalues inside): the ``wanted`` largest, and those that are as good as equal to
    the last of them."""
    top = _edge(matrix, 1, floor, top)[1]
    last = _edge(matrix, wanted, floor, top)[0]
    inside = eigenvalues_above(matrix, last)
    if inside < eigenvalues_above(matrix, floor):  # cut in the middle of the gap that follows
        middle = (_edge(matrix, inside + 1, floor, last)[1] + last) / 2
        last = middle if eigenvalues_above(matrix, middle) == inside else last
    else:
        last = max(floor, last / 2)
    return last, top + 0.1 * (top - last), eigenvalues_above(matrix, last)


def feast(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest positive eigenvalues (fewer, if fewer are positive) and unit eigenvectors, falling.

    The projected block is enlarged while it does not converge (many eigenvalues beside the interval).  Raises if
    the pairs found inside the interval are not as many as the inertia says.
    """
    dim = len(matrix)
    top = float(min(np.trace(matrix), np.abs(matrix).sum(axis=1).max())) if dim else 0.0
    if not top > 0:
        return np.zeros(0), np.zeros((dim, 0))
    top *= 1 + 1e-9
    floor = dim * np.finfo(float).eps * top  # an eigenvalue below is a zero
    wanted = min(wanted, eigenvalues_above(matrix, floor))
    low, high, inside = _interval(matrix, wanted, floor, top)
    block = min(dim, inside + max(EXTRA, inside // 2))
    while True:
        values, vectors, residual = _refined(matrix, low, high, inside, block)
        if len(values) == inside and residual <= 1e-12 * top:
            break
        if block == dim:
            raise ArithmeticError(f"{len(values)} components found of {inside} that the inertia counts, residual {residual}")
        block = min(dim, 2 * block)
    order = np.argsort(-values, kind="stable")[:wanted]
    vectors = vectors[:, order] / np.linalg.norm(vectors[:, order], axis=0)
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order], vectors * sign


def _refined(matrix: np.ndarray, low: float, high: float, inside: int, block: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(values, vectors, largest residual) of the Ritz pairs inside (low, high), refined until they stand still."""
    dim = len(matrix)
    middle, radius = (high + low) / 2, (high - low) / 2
    x, weight = np.polynomial.legendre.leggauss(NODES)
    shifts = radius * np.exp(1j * np.pi * (1 + x) / 2)
    eye = np.eye(dim)
    solvers = [np.linalg.inv((middle + z) * eye - matrix) for z in shifts]
    y = np.random.default_rng(11).standard_normal((dim, block))
    best = (np.zeros(0), np.zeros((dim, 0)), np.inf)
    worse = 0
    for _ in range(MAX_REFINEMENTS):
        projected = sum(w / 2 * np.real(z * (solver @ y)) for z, w, solver in zip(shifts, weight, solvers))
        basis, size, _ = np.linalg.svd(projected, full_matrices=False)
        basis = basis[:, size > 1e-14 * size[0]]
        ritz = basis.T @ matrix @ basis
        values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
        y = basis @ turn
        within = values > low
        residual = float(np.abs(matrix @ y[:, within] - y[:, within] * values[within]).max(initial=0.0))
        if within.sum() == inside and residual < best[2]:
            best, worse = (values[within], y[:, within], residual), 0 if residual < best[2] / 2 else worse + 1
        else:
            worse += 1
        if worse > 3 and best[2] < np.inf:
            break
    return best


# -- operator --------------------------------------------------------------------------

def _project_batches(batches: Iterator[pa.RecordBatch], centre: list[int], rest: np.ndarray, axes: np.ndarray
                     ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch, x, whitened): ``rest`` is what the mean has beyond the whole-number ``centre``."""
    middle = np.array(centre, dtype=object)
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column(batch.num_columns - 1), len(centre))
        wide = max(map(abs, centre), default=0) >= 2 ** 62 or float(np.abs(x.astype(np.float64)).max()) >= 2.0 ** 62
        c = (x.astype(object) - middle).astype(np.float64) if wide else (x - middle.astype(np.int64)).astype(np.float64)
        yield batch, x, (c - rest) @ axes


def _identity_batches(batches: Iterator[pa.RecordBatch], centre, rest, axes) -> Iterator[pa.RecordBatch]:
    """Per task: sums of whitened values, and of their products."""
    k = axes.shape[1]
    total = np.zeros(k + k * k)
    for _, _, z in _project_batches(batches, centre, rest, axes):
        total[:k] += z.sum(axis=0)
        total[k:] += (z.T @ z).reshape(-1)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "s"])


def _whitened_batches(batches: Iterator[pa.RecordBatch], centre, rest, axes, n: int, sums: list[int]
                      ) -> Iterator[pa.RecordBatch]:
    k, total = axes.shape[1], sum(s * s for s in sums)
    own = np.array(sums, dtype=object)
    for batch, x, z in _project_batches(batches, centre, rest, axes):
        exact = x.astype(object)
        deviation = n * n * (exact * exact).sum(axis=1) - 2 * n * (exact @ own) + total
        rows = len(z)
        dev = pa.array([int(v) if v < 2 ** 63 else None for v in deviation], type=pa.int64())
        index = pa.array(np.repeat(np.arange(rows), k))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(index), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), dev.take(index),
             pa.array(z.reshape(-1))], ["vec_id", "component", "deviation", "whitened"])


def whitened_components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                        components: int = COMPONENTS) -> DataFrame:
    """Whitened principal components: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    One row per usable row of ``vectors`` and component (numbered from 1 by falling eigenvalue).  Rows whose vector is
    null, or holds a null or non-finite entry or one whose ``x`` is no long, are left out.  All vectors share one
    length: rows of another length than the commonest of the distinct vectors (the longer one on a tie) are left
    out too.  ``n`` counts the distinct vectors.  Components of eigenvalue zero do not exist: with one distinct
    vector, empty vectors or an empty table the result is empty.  Repeated rows, and rows without an id, are
    answered each for itself.  Equal eigenvalues have arbitrary, but one and the same, axes for all rows.
    ``deviation`` is null where the exact value is beyond a long.  Other columns are not read.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    whole = rows.mapInArrow(_whole_batches, "id long, x array<long>")
    every = stored(whole.select("x").distinct(), "whitening-fit")
    by_size = every.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = by_size.orderBy(F.desc("n"), F.desc("d")).first()
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if first is None or first.d == 0:
        release(every)
        return spark.createDataFrame([], schema)
    dim, n = first.d, first.n
    fit = every.filter(F.size("x") == dim)

    sums = _added(fit.mapInArrow(lambda it: _sum_batches(it, dim), "place int, s string"))
    centre = [round(Fraction(s, n)) for s in sums]
    left = [s - n * c for s, c in zip(sums, centre)]  # n times what the mean has beyond the centre
    products = _added(fit.mapInArrow(lambda it: _product_batches(it, centre), "place int, s string"))
    cov = np.zeros((dim, dim))
    for (i, j), p in zip(zip(*np.triu_indices(dim)), products):
        cov[i, j] = cov[j, i] = float(Fraction(n * p - left[i] * left[j], n * n))

    values, axes = feast(cov, components)
    if not len(values):
        release(every)
        return spark.createDataFrame([], schema)
    axes = axes / np.sqrt(values)
    rest = np.array([float(Fraction(r, n)) for r in left])
    got = {r.place: r.s for r in fit.mapInArrow(lambda it: _identity_batches(it, centre, rest, axes),
                                                "place int, s double").groupBy("place").agg(F.sum("s").alias("s")).collect()}
    k = len(values)
    mean = np.array([got[i] for i in range(k)]) / n
    second = np.array([got[k + i] for i in range(k * k)]).reshape(k, k) / n
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())
    release(every)

    share = F.array(*[F.lit(float(v / np.trace(cov))) for v in values])
    out = (whole.filter(F.size("x") == dim)
           .mapInArrow(lambda it: _whitened_batches(it, centre, rest, axes, n, sums),
                       "vec_id long, component int, deviation long, whitened double"))
    return out.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(share, F.col("component") - 1).alias("explained"), F.lit(error).alias("identity_error"))
