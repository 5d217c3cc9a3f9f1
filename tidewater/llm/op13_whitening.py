"""Embedding whitening by QDWH spectral divide-and-conquer.

Every entry c of a vector becomes the whole number x = floor(scale * c). Spark makes the fit list (each distinct x vector
once, whatever the number of its copies), its count n and sums S, and then its covariance V, centred before multiplying:
each task adds up its own rows' products, and the d x d partial sums meet in a grouped sum by entry. Only n, S and V
(their size depends on the dimension, not on the rows) come to the driver.

The driver splits V into its components. The polar factor U of V - shift * I, found by the QDWH iteration, gives the
spectral projector (U + I) / 2 onto the eigenvalues above the shift; bases of its range and of the rest split V into two
smaller blocks, and so on down to single components. The d x components whitening matrix is then sent to all tasks.

Defined cases: a vector that is null or holds a null or non-finite entry is left out, like an empty one. Vectors of
another length than the most frequent one of the fit list (the smaller of equally frequent ones) are left out too. Copies
and rows that share an id or lack one are scored row by row. Components beyond the rank of V (eigenvalue below ``RANK`` of
the largest; all of them, if the fit list has one vector) have whitened null, and identity_error covers the others only,
null if there are none. A deviation beyond 64 bits is null. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import WorkTables, own_columns, table

SCALE, COMPONENTS = 256, 4
#: Eigenvalues below this share of the largest count as zero.
RANK = 1e-12
EPS = np.finfo(float).eps


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH (dynamically weighted Halley) iterations.

    Raises LinAlgError for a singular matrix, whose factor is not unique.
    """
    x = a / np.linalg.norm(a)
    low = min(1.0, 1 / np.linalg.norm(np.linalg.inv(x)))  # below the least singular value
    if low < 4 * EPS:
        raise np.linalg.LinAlgError("singular")
    one = np.eye(len(a))
    for _ in range(60):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        w = root + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root)) / 2
        b = (w - 1) ** 2 / 4
        c = w + b - 1
        if c > 100:  # far from convergence: the QR form is the stable one
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, one]))
            new = b / c * x + (w - b / c) / np.sqrt(c) * (q[: len(a)] @ q[len(a) :].T)
        else:
            new = b / c * x + (w - b / c) * np.linalg.solve(one + c * (x.T @ x), x.T).T
        new = (new + new.T) / 2
        moved, x, low = np.linalg.norm(new - x), new, min(1.0, low * (w + b * square) / (1 + c * square))
        if 1 - low < 10 * EPS and moved < np.cbrt(EPS):
            return x
    raise np.linalg.LinAlgError("no polar factor")


def _split(a: np.ndarray, shift: float, rng: np.random.Generator) -> np.ndarray | None:
    """An orthogonal basis whose first columns span the eigenvectors above the shift; None where the shift splits nothing."""
    n = len(a)
    try:
        projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    except np.linalg.LinAlgError:
        return None
    k = round(float(np.trace(projector)))
    if not 0 < k < n or np.linalg.norm(projector @ projector - projector) > 1e-10 * n:
        return None
    span = np.linalg.qr(projector @ rng.standard_normal((n, k)))[0]
    basis = np.linalg.qr(projector @ span, mode="complete")[0]
    left = np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k])
    return np.hstack([basis, np.full((n, 1), float(k))]) if left <= 100 * n * EPS * np.linalg.norm(a) else None


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix by spectral divide-and-conquer."""
    rng, size = np.random.default_rng(0), np.linalg.norm(a)
    values, vectors, todo = [], [], [(np.asarray(a, float), np.eye(len(a)))]
    while todo:
        block, basis = todo.pop()
        n = len(block)
        mean = float(np.trace(block)) / n
        spread = np.linalg.norm(block - mean * np.eye(n))
        if n == 1 or spread <= 4 * EPS * size:  # one component, or a block of equal eigenvalues
            values += [float(v) for v in np.diag(block)]
            vectors += list(basis.T)
            continue
        # The mean lies strictly inside the spectrum; near an eigenvalue another shift close by is taken.
        shifts = [float(np.median(np.diag(block))), mean, *(mean + spread / np.sqrt(n) * t for t in (0.03, -0.03, 0.11, -0.11, 0.3, -0.3))]
        split = next((s for s in (_split(block, shift, rng) for shift in shifts) if s is not None), None)
        if split is None:
            raise np.linalg.LinAlgError("no shift splits the block")
        own, k = split[:, :-1], int(split[0, -1])
        for part in (own[:, :k], own[:, k:]):
            inner = part.T @ block @ part
            todo.append(((inner + inner.T) / 2, basis @ part))
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors)[order].T


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """The vector's entries times ``scale``, rounded down; null where it is unusable."""
    usable = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))) & ~F.isnan(c)) & (F.size(vector) > 0)
    return F.when(usable, F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale)))))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's column sums."""
    total = None
    for batch in batches:
        if batch.num_rows:
            own = _matrix(batch.column(0)).sum(axis=0)
            total = own if total is None else total + own
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total, pa.int64())], ["i", "total"])


def _products(mean: np.ndarray, by: np.ndarray | None = None):
    """A task's sums of products of the centred rows (projected by ``by``), upper triangle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = _matrix(batch.column(0)) - mean
                y = y if by is None else y @ by
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "total"])

    return run


def covariance(fit: DataFrame, n: int, mean: np.ndarray, by: np.ndarray | None = None) -> np.ndarray:
    """The covariance (divisor n) of ``fit``'s rows, or of their projections."""
    d = len(mean) if by is None else by.shape[1]
    out = np.zeros((d, d))
    for r in fit.mapInArrow(_products(mean, by), "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.total / n
    return out


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Per row the exact sum of (n * x - S)^2; in 64 bits where that is certain to fit, else in whole numbers of any size."""
    largest = max(1, int(abs(x).max(initial=0)), *(abs(s) // n + 1 for s in sums))
    if len(sums) * (2 * n * largest) ** 2 < 2**63:
        return ((n * x - np.array(sums)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v < 2**63 else None for v in exact]


_OUT = [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())]


def _whitened(n: int, sums: list[int], by: np.ndarray, rank: int, explained: list[float | None], error: float | None):
    """All components of each row: ``by`` has the ``rank`` projections, the components after them have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = len(explained)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, rows = _matrix(batch.column(1)), batch.num_rows
            z = np.zeros((rows, count))
            z[:, :rank] = (x - np.array(sums, float) / n) @ by
            whitened = pa.array(z.ravel(), mask=np.tile(np.arange(count) >= rank, rows))
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(rows), count))), pa.array(np.tile(np.arange(1, count + 1), rows), pa.int32()), pa.array(np.full(rows * count, n)),
                pa.array([v for v in _deviation(x, n, sums) for _ in range(count)], pa.int64()), whitened, pa.array(explained * rows, pa.float64()), pa.array([error] * (rows * count), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [name for name, _ in _OUT])

    return run


def whiten(vectors: DataFrame, count: int | None = None, scale: int = SCALE, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per usable vector and component up to ``count`` (all, if None), numbered by falling eigenvalue.

    (vec_id, component, n, deviation, whitened, explained, identity_error), as the module's text says.
    """
    spark = vectors.sparkSession
    shape = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = own_columns(vectors, id_column, vector_column).select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), whole_numbers(F.col(f"`{vector_column}`"), scale).alias("x")).filter("x IS NOT NULL")
    fit = WorkTables(spark).put(rows.select("x").distinct(), "fit")
    lengths = fit.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], shape)
    d, n = lengths.d, lengths.n
    fit, rows = fit.filter(F.size("x") == d), rows.filter(F.size("x") == d)
    sums = [r.total for r in fit.mapInArrow(_sums, "i int, total long").groupBy("i").agg(F.sum("total").alias("total")).orderBy("i").collect()]
    mean = np.array([s / n for s in sums])
    v = covariance(fit, n, mean)
    e, axes = components(v)
    count = min(count or d, d)
    trace = float(np.trace(v))
    rank = int((e[:count] > RANK * max(e[0], 0)).sum()) if e[0] > 0 else 0
    by = axes[:, :rank] / np.sqrt(e[:rank])
    error = float(abs(covariance(fit, n, mean, by) - np.eye(rank)).max()) if rank else None
    explained = [max(float(x), 0.0) / trace if trace > 0 else None for x in e[:count]]
    return rows.mapInArrow(_whitened(n, sums, by, rank, explained, error), shape)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), COMPONENTS)
