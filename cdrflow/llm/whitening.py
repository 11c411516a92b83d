"""Embedding whitening; leading eigenpairs by spectrum slicing.

Vectors become whole numbers, so counts, sums and second moments are exact
sums over the cluster, whatever the order of addition: the covariance is the
exact one, rounded once.  Only that matrix (dimension by dimension) reaches the
driver, which takes it apart:

* the LDL' factors of V - s I have as many positive pivots as V has
  eigenvalues above s, so bisection with such counts isolates each of the
  leading eigenvalues;
* inverse iteration at the interval's middle, then Rayleigh quotient
  iteration, which converges cubically, gives the pair; a quotient that leaves
  its interval sends it back to bisection;
* counts on both sides of the result certify its number.

Eigenvalues that lie closer than rounding lets counts tell are taken from one
interval, each vector orthogonal to those before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship

ship(__name__)

SCALE, SHIFT = 64, 1_000_000
#: Entries of this size and more are not told apart from infinite ones.
TOO_LARGE = float(1 << 34)
#: Share of the trace under which a direction counts as having no variance.
NO_VARIANCE = 1e-12
EPS = float(np.finfo(float).eps)


def pivots(matrix: np.ndarray) -> tuple[int, int]:
    """How many positive and negative eigenvalues a symmetric matrix has, from its pivoted LDL' factors.

    Pivots are single entries, or 2 by 2 blocks (one eigenvalue of either
    sign) where all of the diagonal is small (Bunch and Parlett).
    """
    a = np.array(matrix, dtype=float)
    positive = negative = 0
    alpha = (1 + 17**0.5) / 8
    while len(a):
        diagonal = np.abs(a.diagonal())
        r = int(diagonal.argmax())
        aside = np.abs(a - np.diag(a.diagonal()))
        p, q = divmod(int(aside.argmax()), len(a))
        if diagonal[r] == 0 and aside[p, q] == 0:
            break
        if diagonal[r] >= alpha * aside[p, q]:
            d = a[r, r]
            positive, negative = positive + (d > 0), negative + (d < 0)
            rest = np.delete(np.arange(len(a)), r)
            column = a[rest, r]
            a = a[np.ix_(rest, rest)] - np.outer(column / d, column)
        else:
            positive, negative = positive + 1, negative + 1
            rest = np.delete(np.arange(len(a)), [p, q])
            block, columns = a[np.ix_([p, q], [p, q])], a[np.ix_(rest, [p, q])]
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(block, columns.T)
        a = (a + a.T) / 2
    return int(positive), int(negative)


def count_above(matrix: np.ndarray, s: float) -> int:
    """Number of eigenvalues above ``s``."""
    return pivots(matrix - s * np.eye(len(matrix)))[0]


def _solve(matrix: np.ndarray, s: float, v: np.ndarray, size: float) -> np.ndarray:
    """(matrix - s I)^-1 v, scaled to length 1; an exactly singular matrix is moved by a rounding error."""
    for nudge in (0.0, EPS * size, 4 * EPS * size):
        try:
            w = np.linalg.solve(matrix - (s + nudge) * np.eye(len(matrix)), v)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(w).all() and w.any():
            return w / np.linalg.norm(w)
    return v


@dataclass(frozen=True)
class EigenPair:
    value: float
    vector: np.ndarray
    #: Eigenvalues above its upper and above its lower limit; its number lies between.
    above: tuple[int, int]


def leading_pairs(matrix: np.ndarray, most: int) -> list[EigenPair]:
    """The ``most`` leading eigenpairs of a covariance, by falling value, without those of no variance."""
    trace, n = float(np.trace(matrix)), len(matrix)
    if not n or trace <= 0:
        return []
    counts: dict[float, int] = {}

    def above(s: float) -> int:
        if s not in counts:
            counts[s] = count_above(matrix, s)
        return counts[s]

    bottom, top = trace * NO_VARIANCE, trace * (1 + 4 * n * EPS)
    counts[top] = 0
    near = 8 * n * EPS * trace  # closer shifts than this tell nothing new
    pairs: list[EigenPair] = []
    start = np.cos(np.arange(1, n + 1) ** 2.0)  # any vector that no eigenvector is orthogonal to
    for j in range(1, min(most, above(bottom)) + 1):
        low = max(s for s, c in counts.items() if c >= j)
        high = min(s for s, c in counts.items() if c < j)
        found = np.array([p.vector for p in pairs]).reshape(-1, n)

        def free(v: np.ndarray, found: np.ndarray = found) -> np.ndarray:
            for _ in range(2):
                v = v - found.T @ (found @ v)
            return v / np.linalg.norm(v)

        while True:
            if (above(high), above(low)) != (j - 1, j) and high - low > near:
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) >= j else (low, middle)
                continue
            v, middle = free(start), (low + high) / 2
            for _ in range(3):
                v = free(_solve(matrix, middle, v, trace))
            value = float(v @ matrix @ v)
            best = (np.inf, value, v)
            for _ in range(12):
                error = float(np.linalg.norm(matrix @ v - value * v))
                if error >= best[0] / 2 and best[0] < near:
                    break
                best = min(best, (error, value, v), key=lambda x: x[0])
                v = free(_solve(matrix, value, v, trace))
                value = float(v @ matrix @ v)
            error, value, v = best
            if low - near <= value <= high + near and error <= near:
                break
            if high - low <= near:
                raise ArithmeticError(f"eigenvalue {j} was not found between {low} and {high}")
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= j else (low, middle)
        margin = near + error
        certificate = (above(value + margin), above(value - margin))
        if not certificate[0] < j <= certificate[1]:
            raise ArithmeticError(f"eigenvalue {j} has {certificate} eigenvalues above its limits")
        pairs.append(EigenPair(value, v, certificate))
    return pairs


def whole_numbers(vector: Column) -> Column:
    """floor(64 c) + 1,000,000 for each entry c; null where the vector or an entry is null, not finite or too large."""
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < TOO_LARGE, F.lit(False)))
    return F.when(fits, F.transform(vector, lambda c: F.floor(SCALE * c.cast("double")) + SHIFT))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(vec_id, x) of the vectors that have whole numbers and the table's dimension, and that dimension.

    The dimension is the length that most vectors have (ties: the longest).
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), whole_numbers(F.col(vector_col)).alias("x"))
    rows = rows.where(F.size("x") > 0)
    lengths = rows.groupBy(F.size("x").alias("d")).count()
    found = lengths.agg(F.max(F.struct("count", "d")).alias("most")).first()["most"]
    d = found["d"] if found else 0
    return rows.where(F.size("x") == d), d


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _summed(vectors: DataFrame, d: int, part: Callable[[np.ndarray], np.ndarray], exact: bool) -> dict[int, int | float]:
    """Sums over all vectors of the numbers that ``part`` gives for a batch: each task adds up its own, then Spark."""
    kind = "decimal(38,0)" if exact else "double"
    schema = pa.schema([("cell", pa.int32()), ("value", pa.decimal128(38, 0) if exact else pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                values = part(_matrix(b.column(0), d))
                total = values if total is None else total + values
        if total is not None:
            values = [Decimal(int(v)) for v in total] if exact else total
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(values, schema[1].type)], schema=schema)

    sums = vectors.select("x").mapInArrow(run, f"cell int, value {kind}").groupBy("cell").agg(F.sum("value").alias("value"))
    return {r["cell"]: int(r["value"]) if exact else r["value"] for r in sums.collect()}  # d * d at most


def _exact_products(z: np.ndarray) -> np.ndarray:
    """z' z as Python integers; in blocks whose products floating point holds exactly."""
    most = int(np.abs(z).max(initial=0)) ** 2
    if most >= 1 << 53:
        z = z.astype(object)
        return z.T @ z
    rows, total = max(1, (1 << 53) // max(1, most)), 0
    for i in range(0, len(z), rows):
        block = z[i : i + rows].astype(float)
        total = total + (block.T @ block).astype(np.int64).astype(object)
    return total


@dataclass(frozen=True)
class Whitening:
    """What whitening needs: numbers of the fit list, exact sums, eigenpairs and the check of the result."""

    n: int
    sums: list[int]
    trace: float
    pairs: list[EigenPair]
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x minus the mean; whole numbers are taken off first, so that nothing is lost."""
        near = np.array([s // self.n for s in self.sums])
        return (x - near) - np.array([(s % self.n) / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        directions = np.array([p.vector / p.value**0.5 for p in self.pairs])
        return self.centred(x) @ directions.T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 over the dimensions, exact; None where it is over 63 bits."""
        n, near = self.n, np.array([s // self.n for s in self.sums])
        rest = np.array([s % n for s in self.sums])
        z = x - near
        if int(np.abs(z).max(initial=0)) ** 2 * len(near) >= 1 << 62 or n * int(np.abs(z).max(initial=0)) * len(near) >= 1 << 62:
            z, rest = z.astype(object), rest.astype(object)
        squares, mixed, own = (z * z).sum(1), z @ rest, sum(int(r) ** 2 for r in rest)
        exact = (n * n * int(a) - 2 * n * int(b) + own for a, b in zip(squares, mixed))
        return [v if v < 1 << 63 else None for v in exact]


def fit(vectors: DataFrame, d: int, components: int = 16) -> Whitening | None:
    """Whitening over each distinct vector of column ``x`` once; None where there is none."""
    distinct = materialize(vectors.select("x").distinct(), "whitening-fit")
    sums = _summed(distinct, d, lambda x: np.append(x.sum(0, dtype=object), len(x)), exact=True)
    if not sums:
        return None
    n, totals = sums[d], [sums[i] for i in range(d)]
    near = np.array([s // n for s in totals])
    rest = [s - n * int(c) for s, c in zip(totals, near)]
    upper = np.triu_indices(d)
    products = _summed(distinct, d, lambda x: np.asarray(_exact_products(x - near))[upper], exact=True)
    covariance = np.zeros((d, d))
    for cell, (i, j) in enumerate(zip(*upper)):  # an exact quotient of whole numbers, rounded once
        covariance[i, j] = covariance[j, i] = (n * products[cell] - rest[i] * rest[j]) / (n * n)
    model = Whitening(n, totals, float(np.trace(covariance)), leading_pairs(covariance, components))
    k = len(model.pairs)
    if not k:
        return model

    def moments(x: np.ndarray) -> np.ndarray:
        w = model.project(x)
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    found = _summed(distinct, d, moments, exact=False)
    mean = np.array([found[i] for i in range(k)]) / n
    cov = np.array([found[k + i] for i in range(k * k)]).reshape(k, k) / n - np.outer(mean, mean)
    return Whitening(n, totals, model.trace, model.pairs, float(np.abs(cov - np.eye(k)).max()))


def whiten(
    vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component.

    Vectors that are null or empty, hold a null, a NaN, an infinite entry or
    one of 2^34 and more, or whose length is not the table's (most frequent,
    then longest) one, are left out.  Equal vectors count once in the fit, but
    each row is whitened; a null id stays null.  There are fewer components
    than asked for where the vectors span fewer dimensions, and no rows for an
    empty table or one distinct vector.  ``deviation`` is null where it is over
    63 bits.  Other columns are not read, so their names cannot clash.
    """
    rows, d = usable(vectors, id_col, vector_col)
    model = fit(rows, d, components) if d else None
    columns = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not model.pairs:
        return vectors.sparkSession.createDataFrame([], columns)
    k = len(model.pairs)
    explained = np.array([p.value / model.trace for p in model.pairs])
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    schema = pa.schema([(c.split()[0], t) for c, t in zip(columns.split(", "), kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1), d)
            m = len(x)
            if not m:
                continue
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(model.project(x).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, model.identity_error)),
                ],
                schema=schema,
            )

    return rows.mapInArrow(run, columns)
