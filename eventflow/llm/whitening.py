"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers, ``x = floor(SCALE * c) + OFFSET``. The fit list holds each
distinct vector once. Its matrix X, centred by the exact column sums, is never formed or
collected; it stays on Spark as packed blocks of whole numbers. The bidiagonalisation
alternates products ``X v`` (one number a vector) and ``X' u`` (one number a dimension), both in
one pass over the blocks: a task multiplies its rows by ``v``, and its products by its rows
again. A left vector is as long as the fit list, so it is kept as the right vector ``p`` that
gives it, ``u = X p``; its products with all earlier left vectors, which full
reorthogonalisation takes away, then follow from ``X'X p``, which the same pass returns. Right
vectors are reorthogonalised against all earlier ones, twice. The driver holds a few
vectors and a small bidiagonal matrix, of the dimension's size. Its singular value decomposition
gives the components and their deviations.

At most ``FULL`` dimensions are bidiagonalised to the end. Beyond that it stops when all wanted
components have converged to double precision, starts once more with a random vector, so that
repeated deviations are not missed, and stops when that has brought no change. Where a
bidiagonal entry vanishes, it goes on with a random vector from what is left. Components
whose deviation is zero in double precision do not exist: a fit list of rank r gives
r of them at most.

Rows whose vector is null, empty, or holds null or non-finite entries, or entries too large
for exact whole numbers (``|SCALE * c| >= 2 ** 44``), are left out; so are vectors that do not have the
most frequent dimension (the smaller of equally frequent ones). Null and repeated ids are rows
like others. ``deviation`` is exact; beyond the range of a long it is null. Empty tables,
and tables with one distinct vector, which has no component, give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import col, write_cut

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
FULL = 256
BLOCK_BYTES = 1 << 20
LARGEST = 1 << 44
EPS = float(np.finfo(np.float64).eps)


def whole(vectors: DataFrame, vec_id: str, embedding: str, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, x): the rows that take part, with their whole numbers."""
    v = col(embedding).cast("array<double>")
    fits = F.forall(v, lambda c: F.coalesce(F.abs(c * scale) < LARGEST, F.lit(False)))
    rows = vectors.where(fits & (F.size(v) > 0)).select(
        col(vec_id).alias("vec_id"), F.transform(v, lambda c: F.floor(c * scale).cast("long") + offset).alias("x"))
    dims = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("many"))
    most = dims.orderBy(F.desc("many"), "d").limit(1).collect()
    return rows.where(F.size("x") == (most[0]["d"] if most else 0))


def pack(rows: DataFrame, dim: int) -> DataFrame:
    """(block): the distinct vectors as binary blocks of 64-bit whole numbers."""
    most = max(1, BLOCK_BYTES // (8 * dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype("<i8")
            blocks = [flat[i:i + most * dim].tobytes() for i in range(0, len(flat), most * dim)]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], names=["block"])

    return rows.select("x").distinct().mapInArrow(run, "block binary")


class Fit:
    """The fit list: its blocks, number, exact sums, and passes over the centred rows."""

    def __init__(self, rows: DataFrame):
        first = rows.select(F.size("x")).first()
        self.dim = first[0] if first else 0
        self.blocks = write_cut(pack(rows, self.dim), "whitening") if self.dim else None
        self.n, self.sums = 0, []
        if self.blocks is not None:
            got = self._add(lambda x, _: np.append(x.sum(axis=0, dtype=np.int64), len(x)), exact=True)
            self.n, self.sums = got[-1], got[:-1]

    def _add(self, of: Callable, exact: bool = False) -> list:
        """The sums over all blocks of the numbers that ``of`` makes of a block's whole
        numbers and its centred rows. A few numbers a task leave the workers; Spark adds them.
        Exact sums are of whole numbers and added as decimals."""
        dim, centre = self.dim, None if exact else self.centre()

        def run(batches):
            total = None
            for batch in batches:
                for block in batch.column(0):
                    x = np.frombuffer(block.as_buffer(), dtype="<i8").reshape(-1, dim)
                    part = of(x, None if centre is None else centre(x))
                    # A block of whole numbers below 2 ** 44 has sums within 64 bits; beyond it Python adds.
                    part = [int(v) for v in part] if exact else np.asarray(part, dtype=np.float64)
                    total = part if total is None else (
                        [a + b for a, b in zip(total, part)] if exact else total + part)
            if total is not None:
                values = [str(v) for v in total] if exact else total
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(total)), pa.int32()),
                     pa.array(values, pa.string() if exact else pa.float64())], names=["slot", "value"])

        kind = "string" if exact else "double"
        parts = self.blocks.mapInArrow(run, f"slot int, value {kind}")
        value = F.col("value").cast("decimal(38,0)") if exact else F.col("value")
        got = parts.groupBy("slot").agg(F.sum(value).alias("value")).collect()
        return [(int(r["value"]) if exact else r["value"]) for r in sorted(got, key=lambda r: r["slot"])]

    def add(self, of: Callable) -> np.ndarray:
        return np.array(self._add(lambda x, c: of(c)))

    def centre(self) -> Callable:
        """Centred rows, from the whole part and the rest of each mean: no digits cancel."""
        n = self.n
        low = np.array([s // n for s in self.sums], dtype=np.int64)
        rest = np.array([(s % n) / n for s in self.sums])
        return lambda x: (x - low) - rest

    def gram(self, v: np.ndarray) -> np.ndarray:
        """X'(X v): both products in one pass."""
        return self.add(lambda c: (c @ v) @ c)


def bidiagonalise(gram: Callable, dim: int, steps: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(deviations times sqrt(n), components as rows), largest first, of the matrix X that
    ``gram(v) = X'(X v)`` gives products of; see the module."""
    rng = np.random.RandomState(dim)
    right, left, images = np.zeros((0, dim)), np.zeros((0, dim)), np.zeros((0, dim))
    diag, above = [], []
    most, again, last = 0.0, None, None

    def orthogonal(v):
        for _ in range(2):
            v = v - right.T @ (right @ v)
        return v

    def another():
        """A random direction beside all earlier ones; None when there is none."""
        v = orthogonal(rng.standard_normal(dim))
        size = np.linalg.norm(v)
        return v / size if len(right) < dim and size > 1e-8 else None

    v, beta = another(), 0.0
    while v is not None and len(diag) < steps:
        # u = X v less its part along the last left vector, then along all of them.
        p = v - beta * left[-1] if beta else v
        image = gram(p)
        for _ in range(2):
            along = left @ image
            p, image = p - left.T @ along, image - images.T @ along
        size = float(np.sqrt(max(p @ image, 0.0)))
        most = max(most, size)
        right = np.vstack([right, v])
        if size <= most * dim * EPS ** 0.5 * 1e-4:
            if beta == 0.0:
                # A random direction that X maps to nothing: no deviation is left.
                right = right[:-1]
                break
            # The last left vector already spans this product: a column without a diagonal.
            diag.append(0.0)
            above.append(beta)
            left, images = np.vstack([left, np.zeros(dim)]), np.vstack([images, np.zeros(dim)])
            v, beta = another(), 0.0
            continue
        diag.append(size)
        above.append(beta)
        left, images = np.vstack([left, p / size]), np.vstack([images, image / size])
        # The next right vector: X'u less what is known of it.
        z = orthogonal(images[-1] - size * v)
        beta = float(np.linalg.norm(z))
        most = max(most, beta)
        done = len(diag)
        if beta <= most * dim * EPS * 8:
            v, beta = another(), 0.0
            continue
        v = z / beta
        if dim > FULL and done >= 2 * wanted and (again is None or done >= again + wanted):
            s, q, end = _decompose(diag, above)
            if np.all(beta * np.abs(end[:wanted]) <= 4 * EPS * s[0]):
                if again is not None and np.allclose(s[:wanted], last, rtol=1e-12):
                    break
                again, last = done, s[:wanted]
                v, beta = another(), 0.0
    if not diag:
        return np.zeros(0), np.zeros((0, dim))
    s, q, _ = _decompose(diag, above)
    return s, q @ right


def _decompose(diag: list, above: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(singular values, right vectors as rows, last entries of the left vectors) of the
    bidiagonal matrix; ``above[i]`` stands over ``diag[i]``."""
    b = np.diag(diag) + np.diag(above[1:], 1)
    p, s, q = np.linalg.svd(b)
    return s, q, p[-1]


def components(fit: Fit, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, unit components as rows, trace) of the fit list's covariance."""
    if fit.n < 2:
        return np.zeros(0), np.zeros((0, fit.dim)), 0.0
    trace = float(fit.add(lambda c: [np.square(c).sum()])[0]) / fit.n
    s, found = bidiagonalise(fit.gram, fit.dim, min(fit.dim, fit.n - 1) if fit.dim > FULL else fit.dim, wanted)
    e = s * s / fit.n
    real = e > trace * fit.dim * EPS * 64
    e, found = e[real][:wanted], found[real][:wanted]
    return e, found / np.linalg.norm(found, axis=1, keepdims=True), trace


def identity_error(fit: Fit, turn: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = turn.shape[1]
    mean = fit.add(lambda c: (c @ turn).sum(axis=0)) / fit.n

    def product(c):
        w = c @ turn - mean
        return (w.T @ w).ravel()

    return float(np.abs(fit.add(product).reshape(k, k) / fit.n - np.eye(k)).max())


def _deviation(x: np.ndarray, sums: list, n: int) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exact; null beyond the range of a long."""
    top = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if top < 1 << 62 and x.shape[1] * top * top < 1 << 62:
        return pa.array(np.square(n * x - np.array(sums, dtype=np.int64)).sum(axis=1), pa.int64())
    # The range of single rows may still be small: the differences, not the products, count.
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
           wanted: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each
    row that takes part and each component."""
    rows = whole(vectors, vec_id, embedding)
    kind = vectors.schema[vec_id].dataType
    schema = (f"vec_id {kind.simpleString()}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    fit = Fit(rows)
    e, found, trace = components(fit, wanted)
    if not len(e):
        return vectors.sparkSession.createDataFrame([], schema)
    turn = (found / np.sqrt(e)[:, None]).T
    error, centre = identity_error(fit, turn), fit.centre()
    n, sums, dim, k, share = fit.n, fit.sums, fit.dim, len(e), e / trace

    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)
            for a in range(0, len(x), 4096):
                part = x[a:a + 4096]
                each = np.repeat(np.arange(len(part)), k)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, len(part)).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1), len(part)), pa.int32()),
                    pa.array(np.full(len(each), n), pa.int64()),
                    _deviation(part, sums, n).take(pa.array(each)),
                    pa.array((centre(part) @ turn).ravel(), pa.float64()),
                    pa.array(np.tile(share, len(part)), pa.float64()),
                    pa.array(np.full(len(each), error), pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
