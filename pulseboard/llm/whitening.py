"""Whitening of fixed-point vectors: exact scatter in Spark, a small eigenproblem, one projection pass.

The vectors are integers, so the counts, sums and the scatter of all distinct vectors are exact whatever the order of
additions: tasks centre on the rounded mean before they multiply, and what the rounding leaves is taken off exactly.  The
centred scatter (dimension x dimension) is factored by pivoted Cholesky; one-sided Jacobi rotates the columns of the triangular factor until
they are orthogonal: their squared norms are the scatter's eigenvalues and, normalised, they are its eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.llm.common import stored

COMPONENTS = 16
#: Entries are clamped to this size before the offset is added.
LIMIT = float(2**52)
#: Rows multiplied at once, and the entry size up to which their products are exact as doubles.
BLOCK, SMALL = 4096, 1 << 20


def fixed_point(vector: Column, scale: int = 64, offset: int = 1_000_000) -> Column:
    """floor(scale * entry) + offset as longs; null for a null vector and one with a null or non-finite entry.  Products beyond 2^52 in size are clamped."""
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(LIMIT)), F.lit(-LIMIT))).cast("long") + offset)
    return F.when(sound, x)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def scatter_sums(fit: DataFrame, dim: int, centre: np.ndarray, products: bool) -> dict[int, int]:
    """Exact sums over ``fit`` (x) of y = x - centre (key -1 - i) and, with ``products``, of y_i * y_j (key i * dim + j, i <= j)."""
    rows, cols = np.triu_indices(dim)
    keys = np.concatenate([-1 - np.arange(dim), rows * dim + cols]) if products else -1 - np.arange(dim)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(keys), object)
        for batch in batches:
            y = matrix(batch.column("x"), dim) - centre
            small = np.abs(y).max(axis=1, initial=0) <= SMALL
            for part, exact in ((y[small], True), (y[~small], False)):
                for i in range(0, len(part), BLOCK):
                    block = part[i:i + BLOCK]
                    block = block.astype(float) if exact else block.astype(object)
                    sums = block.sum(axis=0)
                    if products:
                        sums = np.concatenate([sums, (block.T @ block)[rows, cols]])
                    total += (sums.astype(np.int64) if exact else sums).astype(object)
        if any(total):
            at = np.flatnonzero(total)
            yield pa.record_batch([pa.array(keys[at], pa.int64()), pa.array([str(v) for v in total[at]], pa.string())], names=["cell", "value"])

    summed = fit.mapInArrow(add, "cell long, value string").groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    return {r["cell"]: int(r["value"]) for r in summed.collect()}  # at most dim * (dim + 3) / 2 numbers


def pivoted_cholesky(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with c[order][:, order] = L L', L lower triangular with as many columns as the rank."""
    a, dim = c.astype(float).copy(), len(c)
    order, low = np.arange(dim), np.zeros((dim, dim))
    tiny = dim * np.finfo(float).eps * max(np.diag(a).max(initial=0.0), 0.0)
    for k in range(dim):
        p = k + int(np.argmax(np.diag(a)[k:]))
        if a[p, p] <= tiny:
            return low[:, :k], order
        for m in (a, a.T, low):
            m[[k, p]] = m[[p, k]]
        order[[k, p]] = order[[p, k]]
        low[k, k] = np.sqrt(a[k, k])
        low[k + 1:, k] = a[k + 1:, k] / low[k, k]
        a[k + 1:, k + 1:] -= np.outer(low[k + 1:, k], low[k + 1:, k])
    return low, order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor with its columns rotated pair by pair until all are orthogonal to rounding; disjoint pairs turn together."""
    f, r = factor.copy(), factor.shape[1]
    seats = np.arange(r + r % 2)
    for _ in range(sweeps if r > 1 else 0):
        worst = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            a, b = seats[:half], seats[half:][::-1]
            a, b = a[(a < r) & (b < r)], b[(a < r) & (b < r)]
            x, y = f[:, a], f[:, b]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            off = np.abs(xy) / np.sqrt(xx * yy)
            worst = max(worst, off.max(initial=0.0))
            turn = off > np.finfo(float).eps
            zeta = np.where(turn, (yy - xx) / np.where(turn, 2 * xy, 1.0), 0.0)
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0.0)
            cos = 1 / np.sqrt(1 + t * t)
            f[:, a], f[:, b] = cos * x - cos * t * y, cos * t * x + cos * y
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if worst < 4 * np.finfo(float).eps:
            break
    return f


def principal(scatter: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as columns) of a positive semi-definite matrix, greatest first; those of rank only."""
    low, order = pivoted_cholesky(scatter)
    f = np.zeros_like(low)
    f[order] = low
    f = one_sided_jacobi(f)
    norm = np.sqrt((f * f).sum(0))
    best = np.argsort(-norm, kind="stable")[:most]
    v = f[:, best] / norm[best]
    sign = np.sign(v[np.abs(v).argmax(axis=0), np.arange(len(best))]) if len(best) else np.ones(0)
    return norm[best] ** 2, v * sign


def whiten(rows: DataFrame, vec_id: str = "vec_id", x: str = "x", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row per input row and component.

    ``x`` holds longs.  Rows with a null vector, an empty one, or one of another length than most rows (ties: the longer) are dropped.
    The fit list is each distinct vector once: n of them, with sums S and covariance V (divisor n).  ``component`` numbers the unit
    eigenvectors of V from 1 by falling eigenvalue e, up to ``components`` and the rank of V (none where all vectors are equal: no
    rows).  ``deviation`` is the exact sum of (n * x - S)^2, null beyond a long; ``whitened`` the projection of x - S / n on the component over sqrt(e);
    ``explained`` is e / trace(V); ``identity_error`` the largest absolute entry of the whitened fit list's covariance minus the identity.
    Repeated rows and null ids are rows like others; an empty table gives no rows; other columns are ignored.
    What reaches the driver is the scatter, dimension x dimension numbers; vectors never do.
    """
    source = rows.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{x}`").alias("x")).where(F.size("x") > 0)
    schema = f"vec_id {source.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    top = source.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    if not top:
        return rows.sparkSession.createDataFrame([], schema)
    dim = top[0]["dim"]
    source = source.where(F.size("x") == dim)
    fit = stored(source.select("x").distinct(), "fit-list")
    n = fit.count()
    sums = scatter_sums(fit, dim, np.zeros(dim, np.int64), False)
    total = [sums.get(-1 - i, 0) for i in range(dim)]
    centre = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
    cells = scatter_sums(fit, dim, centre, True)
    rest = [cells.get(-1 - i, 0) for i in range(dim)]
    scatter = np.zeros((dim, dim))
    for i in range(dim):
        for j in range(i, dim):
            scatter[i, j] = scatter[j, i] = (n * cells.get(i * dim + j, 0) - rest[i] * rest[j]) / n  # whole numbers until here
    values, vectors = principal(scatter, components)
    k, mean = len(values), np.array(rest, float) / n
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    turn, explained = vectors / np.sqrt(values / n), values / np.trace(scatter)

    def project(y: np.ndarray) -> np.ndarray:
        return (y.astype(float) - mean) @ turn

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = project(matrix(batch.column("x"), dim) - centre)
            total += np.vstack([w.sum(axis=0), w.T @ w])
        yield pa.record_batch([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "value"])

    table = np.zeros((k + 1) * k)
    for r in fit.mapInArrow(squares, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect():
        table[r["cell"]] = r["value"]
    first, second = table[:k] / n, table[k:].reshape(k, k) / n
    error = float(np.abs(second - np.outer(first, first) - np.eye(k)).max())
    left = np.array(rest, object)

    def deviations(y: np.ndarray) -> list[int | None]:
        if (n * (int(np.abs(y).max(initial=0)) + 1)) ** 2 * dim < 1 << 63:
            d = n * y - left.astype(np.int64)
            return (d * d).sum(axis=1).tolist()
        d = n * y.astype(object) - left
        return [v if v < 1 << 63 else None for v in (d * d).sum(axis=1)]

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                part = batch.slice(i, BLOCK)
                y = matrix(part.column("x"), dim) - centre
                m = len(y)
                at = pa.array(np.repeat(np.arange(m), k))
                yield pa.record_batch([
                    part.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                    pa.array(deviations(y), pa.int64()).take(at), pa.array(project(y).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return source.mapInArrow(rate, schema)
