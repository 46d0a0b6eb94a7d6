"""Whitening of vectors: leading components of the covariance by contour integration (FEAST).

Spark takes the distinct vectors, their sums and their covariance, and projects
every row. What the driver solves is as large as a vector is wide, however many
rows there are:

* the inertia of the shifted covariance (signs of the pivots of a symmetric
  elimination) counts the eigenvalues above any value, so bisection cuts the
  upper end of the spectrum into intervals with known counts;
* a quadrature of complex shifted solves around each interval filters a block of
  vectors down to the eigenvectors inside, and Rayleigh-Ritz extracts them;
* an interval is done when as many have converged as the inertia counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import stored

# Gauss points on the upper half of a contour, and steps of one block.
NODES = 8
STEPS = 40

# Most eigenvalues of an interval, unless they are too close to part.
PER_INTERVAL = 8


# The solver.


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """Numbers of positive, zero and negative eigenvalues, by symmetric elimination with pivots of size 1 and 2."""
    left = np.array(matrix, dtype="float64")
    tiny = np.abs(left).max(initial=0.0) * len(left) * np.finfo("float64").eps
    alpha = (1 + math.sqrt(17)) / 8
    positive = negative = 0
    while len(left):
        size = np.abs(left)
        if size.max() <= tiny:
            return positive, len(left), negative
        at = int(size.diagonal().argmax())
        i, j = np.unravel_index(size.argmax(), size.shape)
        if size[at, at] >= alpha * size[i, j]:
            chosen = [at]
            positive += int(left[at, at] > 0)
            negative += int(left[at, at] < 0)
        else:
            # An off-diagonal entry that outweighs the diagonal: one eigenvalue of each sign.
            chosen = [int(i), int(j)]
            positive += 1
            negative += 1
        rest = np.setdiff1d(np.arange(len(left)), chosen)
        side = left[np.ix_(rest, chosen)]
        left = left[np.ix_(rest, rest)] - side @ np.linalg.solve(left[np.ix_(chosen, chosen)], side.T)
        left = (left + left.T) / 2
    return positive, 0, negative


def above(matrix: np.ndarray, value: float) -> int:
    """How many eigenvalues lie above ``value``."""
    return inertia(matrix - value * np.eye(len(matrix)))[0]


def intervals(matrix: np.ndarray, k: int, floor: float, most: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, count) from the top down, together holding the ``k`` highest eigenvalues above ``floor``.

    A bound that parts two eigenvalues is moved to the middle between them as
    far as bisection tells; eigenvalues closer than rounding stay together, so
    the last interval may hold more than asked for.
    """
    n = len(matrix)
    top = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-12)
    found, high, some = [], top, above(matrix, floor)
    k = min(k, some)
    close = top * n * np.finfo("float64").eps * 4

    def edge(rank: int) -> tuple[float, float]:
        """Bounds around the eigenvalue of this rank, counted from the top."""
        low, up = floor, top
        while up - low > max(close, 1e-3 * abs(low + up) / 2):
            middle = (low + up) / 2
            if above(matrix, middle) >= rank:
                low = middle
            else:
                up = middle
        return low, up

    done = 0
    while done < k:
        rank = min(done + most, k)
        while True:
            # Move down past eigenvalues that can't be told from this one.
            last = edge(rank)[0]
            rank = max(rank, above(matrix, last - close))
            below = floor if rank == some else edge(rank + 1)[1]
            if rank == some or last - below > close:
                break
            rank += 1
        low = floor if rank == some else (last + below) / 2
        count = above(matrix, low) - done
        found.append((low, high, count))
        done, high = done + count, low
    return found


def _filtered(matrix: np.ndarray, block: np.ndarray, low: float, high: float, nodes: int) -> np.ndarray:
    """The block's part in the eigenvectors between the bounds, by Gauss quadrature over a half circle."""
    radius, centre = (high - low) / 2, (high + low) / 2
    points, weights = np.polynomial.legendre.leggauss(nodes)
    out = np.zeros_like(block)
    for point, weight in zip(points, weights, strict=True):
        turn = np.exp(0.5j * math.pi * (1 - point))
        shifted = (centre + radius * turn) * np.eye(len(matrix)) - matrix
        out += 0.5 * weight * np.real(radius * turn * np.linalg.solve(shifted, block.astype(complex)))
    return out


def contour_eigenpairs(
    matrix: np.ndarray, low: float, high: float, count: int, nodes: int = NODES
) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between the bounds, descending, and their unit vectors as columns.

    The block is half as large again as the count. It ends when the residuals no
    longer fall, and is refused, to be tried with a larger one, unless exactly
    ``count`` values inside have converged.
    """
    n = len(matrix)
    scale = np.abs(matrix).sum(axis=1).max()
    tolerance = 1e-13 * scale
    width = min(n, count + max(2, count // 2))
    random = np.random.default_rng(0)
    while True:
        block = random.standard_normal((n, width))
        best, kept, since = math.inf, None, 0
        for _ in range(STEPS):
            basis, size, _ = np.linalg.svd(_filtered(matrix, block, low, high, nodes), full_matrices=False)
            basis = basis[:, size > size[0] * 1e-14]
            values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
            block = basis @ turned
            inside = np.flatnonzero((values > low) & (values <= high))[::-1]
            if len(inside) == count:
                vectors = block[:, inside]
                residual = np.linalg.norm(matrix @ vectors - vectors * values[inside], axis=0).max(initial=0.0)
                if residual < best / 2:
                    since = 0
                if residual < best:
                    best, kept = residual, (values[inside], vectors)
            since += 1
            if since > 3 and best <= tolerance:
                return kept
        if width == n:
            raise ArithmeticError(f"{count} eigenvalues between {low} and {high} did not converge")
        width = min(n, 2 * width)


def leading_components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest eigenvalues, descending, and unit eigenvectors as columns.

    Values not above rounding are left out. Each vector's largest entry is
    positive. Of equal eigenvalues any vectors that span their space are returned.
    """
    scale = float(np.trace(covariance))
    k = min(k, len(covariance))
    if not k or scale <= 0:
        return np.zeros(0), np.zeros((len(covariance), 0))
    # On a scale of 1, so that bounds and shifts are the same for any unit.
    matrix = covariance / scale
    floor = len(matrix) * np.finfo("float64").eps * 8
    parts = [contour_eigenpairs(matrix, *part) for part in intervals(matrix, k, floor)]
    values = np.concatenate([p[0] for p in parts])[:k]
    vectors = np.concatenate([p[1] for p in parts], axis=1)[:, :k]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values * scale, vectors * signs


# The tables.


def whole_vectors(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, x): each entry c as floor(scale * c), for rows whose vector has neither null nor non-finite entries.

    An empty vector stays. Null ids stay. An entry outside the range of a long becomes its nearest end.
    """
    c = F.col("embedding")
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    whole = F.transform(c, lambda v: F.floor(v.cast("double") * F.lit(scale)).cast("long"))
    return vectors.where(c.isNotNull() & ~bad).select("vec_id", whole.alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows; shorter ones end in zeros."""
    values, sizes = column.flatten().to_numpy(), column.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width), "int64")
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _summed(rows: DataFrame, column: str, of_matrix, size: int, width: int) -> np.ndarray:
    """Sum over all rows of ``size`` numbers made from each batch's matrix; tasks add up their own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += of_matrix(_matrix(batch.column(column), width))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["part"])

    cells = rows.select(column).mapInArrow(run, "part array<double>").select(F.posexplode("part").alias("cell", "value"))
    out = np.zeros(size)
    for cell, value in cells.groupBy("cell").agg(F.sum("value")).collect():  # as many rows as cells
        out[cell] = value
    return out


@dataclass(frozen=True)
class Fit:
    """What the distinct vectors say: their number, width, exact sums, covariance's trace and leading components."""

    n: int
    width: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums], dtype="float64")

    def white(self, x: np.ndarray) -> np.ndarray:
        """Each row less the mean, projected on the components, over the root of their variance."""
        return (x - self.mean) @ self.vectors / np.sqrt(self.values)


def fit(vectors: DataFrame, k: int) -> Fit:
    """Sums, covariance and components of the distinct vectors ``x``.

    The divisor is their number. Vectors are centred before they are
    multiplied. A table without vectors, or with one only, has no components.
    """
    distinct = stored(vectors.select("x").distinct(), "distinct-vectors")
    n, width = distinct.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    sums = [0] * width
    cells = distinct.select(F.posexplode("x").alias("cell", "value")).groupBy("cell")
    for cell, value in cells.agg(F.sum(F.col("value").cast("decimal(38,0)"))).collect():  # as many rows as a vector has entries
        sums[cell] = int(value)
    none = Fit(n, width, tuple(sums), 0.0, np.zeros(0), np.zeros((width, 0)), 0.0)
    if not n or not width:
        return none
    mean, upper = none.mean, np.triu_indices(width)

    def products(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return (centred.T @ centred)[upper]

    covariance = np.zeros((width, width))
    covariance[upper] = _summed(distinct, "x", products, len(upper[0]), width) / n
    covariance += np.triu(covariance, 1).T
    values, parts = leading_components(covariance, k)
    found = Fit(n, width, tuple(sums), float(np.trace(covariance)), values, parts, 0.0)
    return Fit(*list(vars(found).values())[:-1], _identity_error(distinct, found))


def _identity_error(distinct: DataFrame, found: Fit) -> float:
    """Largest absolute entry of the whitened distinct vectors' covariance less the identity."""
    k = len(found.values)
    if not k:
        return 0.0
    mean = _summed(distinct, "x", lambda x: found.white(x).sum(axis=0), k, found.width) / found.n

    def products(x: np.ndarray) -> np.ndarray:
        centred = found.white(x) - mean
        return (centred.T @ centred).ravel()

    covariance = _summed(distinct, "x", products, k * k, found.width).reshape(k, k) / found.n
    return float(np.abs(covariance - np.eye(k)).max())


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum of (n * x - S)^2 per row, exactly; null where it has more than 63 bits."""
    far = [max(abs(n * int(x.max(initial=0)) - int(s)), abs(n * int(x.min(initial=0)) - int(s))) for s in (min(sums, default=0), max(sums, default=0))]
    if max(far) ** 2 * max(x.shape[1], 1) < 2**63:
        return ((n * x - sums.astype("int64")) ** 2).sum(axis=1).tolist()
    exact = [int(v) for v in ((n * x.astype(object) - sums) ** 2).sum(axis=1)] if x.shape[1] else [0] * len(x)
    return [v if v < 2**63 else None for v in exact]


def whitened(vectors: DataFrame, k: int = 4) -> DataFrame:
    """For each (vec_id, x) and component up to ``k``: vec_id, component, n, deviation, whitened, explained, identity_error.

    Components are numbered from 1 by falling variance; those without variance
    are left out, so equal vectors, a single one or an empty table give no rows.
    Shorter vectors count as ending in zeros. Repeated rows, also of one id,
    count once in the fit and each in the result. ``deviation`` is null where it
    exceeds a long. Only sums and products as large as a vector is wide, squared,
    reach the driver and the tasks.
    """
    found = fit(vectors, k)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(found.values)
        sums = np.array(found.sums, dtype=object)
        explained = found.values / found.trace if k else found.values
        for batch in batches:
            if not k:
                continue
            x = _matrix(batch.column("x"), found.width)
            row = np.repeat(np.arange(len(x)), k)
            n = len(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(row)),
                    pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(n, found.n), pa.int64()),
                    pa.array(_deviation(x, found.n, sums), pa.int64()).take(pa.array(row)),
                    pa.array(found.white(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(n, found.identity_error)),
                ],
                names,
            )

    return vectors.select("vec_id", "x").mapInArrow(run, schema)


def whiten_embeddings(embeddings: DataFrame, k: int = 4) -> DataFrame:
    """:func:`whitened` of the whole numbers in ``embedding``; columns but it and ``vec_id`` are not read."""
    return whitened(whole_vectors(embeddings), k)
