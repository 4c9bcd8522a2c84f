"""Embedding whitening: principal directions by Golub-Kahan-Lanczos bidiagonalisation.

With X the centred vectors, a step goes from v to u = Xv and from u back to Xᵀu, each made
orthogonal to all that came before, so that X V = U B with B upper bidiagonal. The singular
values of the small B are those of X, and its right singular vectors, carried through V,
are the eigenvectors of the covariance.

u has one entry for each row of the table and is never stored: every u is X a for a vector
a of the dimension, which the driver keeps. One pass over the table gives all that a step
needs: Xᵀ(X p) and, for the reorthogonalisation, (X a_j)ᵀ(X p) for all earlier j. What a
pass sends to the driver is two numbers for each dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearbook.llm.tables import written

#: Bytes of centred vectors that a task of a pass reads, and rows of one numpy product.
TASK_BYTES, BLOCK_ROWS = 64 << 20, 8192
#: Singular values under this share of the largest are rounding, not directions.
RANK = 1e-10
#: A direction is found when what its vectors leave over is under this share of the largest value.
SETTLED = 1e-13


def quantised(vectors: DataFrame, scale: float = 64.0, shift: int = 1_000_000, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(id, x)`` with x = floor(scale * c) + shift for every entry c, taken as double.

    Vectors that are null or hold a null, an infinity or a NaN are left out. Equal rows stay;
    other columns are not read. An entry whose x is over a bigint is an error.
    """
    known = vectors.filter(F.col(vec_col).isNotNull())
    # The guard is inside, as Spark may evaluate x for a row before it is filtered. NaN is no less.
    x = F.transform(vec_col, lambda c: F.when(F.abs(c) < float("inf"), F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(shift)))
    points = known.select(F.col(id_col), x.cast("array<bigint>").alias("x"))
    return points.filter(F.forall("x", lambda c: c.isNotNull()))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """The packed rows of a binary column as one matrix of int64."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dimension) if len(column) else np.zeros((0, dimension), np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(at, BLOCK_ROWS)


class Centred:
    """Integer vectors in a stored table, minus their mean, and sums over all of them."""

    def __init__(self, points: DataFrame, id_col: str) -> None:
        self.spark, self.id_col = points.sparkSession, id_col
        points = points.select(F.col(id_col).alias("id"), "x").filter("x is not null")
        sizes = points.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
        self.d, self.n = (sizes["size"], sizes["count"]) if sizes else (0, 0)
        points = points.filter(F.size("x") == self.d)
        self.id_type = points.schema["id"].dataType.simpleString()
        sums = points.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("s")).collect() if self.d else []
        self.sums = np.zeros(self.d, np.int64)
        for r in sums:
            self.sums[r.i] = r.s
        self.rows = self._store(points) if self.d else None

    def _store(self, points: DataFrame) -> DataFrame:
        """``(id, m, deviation)``: n * x - S packed, and the sum of its squares."""
        n, d, total = self.n, self.d, self.sums

        def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _blocks(batches):
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)
                if np.abs(x).max() >= 2**62 // n:
                    raise OverflowError("n * x is over a bigint")
                m = n * x - total
                if (m.astype(float) ** 2).sum(axis=1).max() > 9.2e18:
                    raise OverflowError("the sum of (n * x - S)^2 is over a bigint")
                offsets = np.arange(0, 8 * d * (len(m) + 1), 8 * d, dtype=np.int64)
                packed = pa.Array.from_buffers(pa.large_binary(), len(m), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(m, "<i8"))])
                yield pa.RecordBatch.from_arrays([batch.column(0), packed.cast(pa.binary()), pa.array((m * m).sum(axis=1))], names=["id", "m", "deviation"])

        stored, _ = written(points.mapInArrow(centre, f"id {self.id_type}, m binary, deviation bigint"), "centred-vectors")
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-n * d * 8 // TASK_BYTES))
        return stored.coalesce(tasks)

    def summed(self, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """The sum over all rows of what ``of`` gives for blocks of centred rows."""
        n, d = self.n, self.d

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in _blocks(batches):
                total += of(_matrix(batch.column(0), d) / n)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["i", "value"])

        out = np.zeros(size)
        for r in self.rows.select("m").mapInArrow(partial, "i int, value double").groupBy("i").agg(F.sum("value").alias("value")).collect():
            out[r.i] = r.value
        return out


def _orthogonal(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``v`` minus its part in the columns of ``basis``; twice, for what rounding leaves."""
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def bidiagonalise(x: Centred, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values of the centred rows, at most ``wanted``, and as columns
    their right singular vectors.

    It stops when these are settled, at the latest when V has the whole dimension. If a
    product vanishes, the space so far is closed and a new direction is begun, so equal
    values are found as often as they occur in a closed space.
    """
    d, rng = x.d, np.random.default_rng(seed)
    scale = np.sqrt(x.summed(lambda z: (z * z).sum(axis=0), d).sum())
    V, A, G = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))  # columns v, a (u = X a), and Xᵀu
    alphas, betas = [], []  # the diagonal of B, and above it
    v = rng.standard_normal(d)
    v, beta = v / np.linalg.norm(v), 0.0
    while scale > 0:
        k = V.shape[1]
        p = v - beta * A[:, -1] if beta else v

        def step(z: np.ndarray, p: np.ndarray = p, A: np.ndarray = A) -> np.ndarray:
            xp = z @ p  # a block of u before reorthogonalisation
            out = np.zeros(2 * d + 1)
            out[:d], out[d : d + A.shape[1]], out[-1] = z.T @ xp, (z @ A).T @ xp, xp @ xp
            return out

        got = x.summed(step, 2 * d + 1)
        g, h, s = got[:d], got[d : d + k], got[-1]
        alpha = np.sqrt(max(s - h @ h, 0.0))
        V = np.column_stack([V, v])
        if alpha > RANK * scale:
            a, back = (p - A @ h) / alpha, (g - G @ h) / alpha
        else:
            alpha, a, back = 0.0, np.zeros(d), np.zeros(d)  # v is a direction without spread
        A, G = np.column_stack([A, a]), np.column_stack([G, back])
        alphas.append(alpha)
        w = _orthogonal(back - alpha * v, V)
        beta = float(np.linalg.norm(w))
        if V.shape[1] == d:
            break
        if beta <= RANK * scale:  # closed: go on with any direction that is left
            beta, w = 0.0, _orthogonal(rng.standard_normal(d), V)
        elif V.shape[1] > wanted:
            left, values, _ = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
            if beta * np.abs(left[-1, :wanted]).max() <= SETTLED * values[0]:
                break
        betas.append(beta)
        v = w / np.linalg.norm(w)
    if not alphas:
        return np.zeros(0), np.zeros((d, 0))
    _, values, right = np.linalg.svd(np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1))
    keep = values[:wanted] > RANK * scale
    return values[:wanted][keep], (V @ right.T)[:, :wanted][:, keep]


def whiten(points: DataFrame, components: int = 32, id_col: str = "vec_id") -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)`` for every
    row of ``points (id, x)`` and component, at most ``components`` of them.

    ``x`` are integers. Components are the unit eigenvectors of the covariance (divisor
    n), by falling eigenvalue from 1, with their largest entry positive; ``whitened`` is
    the centred row along the component over the square root of its eigenvalue,
    ``explained`` the eigenvalue's share of the trace, ``deviation`` the exact sum of
    (n * x - S)^2, and ``identity_error`` one value: how far the covariance of all
    ``whitened`` is from the identity at most.

    The dimension is the commonest length (of two as common, the longer); null vectors and
    those of another length are left out. Directions without spread are no components: an
    empty table, or equal vectors only, give no rows. Equal rows count and are returned
    each, rows without id too. A ``deviation`` over a bigint is an error.
    """
    spark = points.sparkSession
    x = Centred(points, id_col)
    schema = f"`{id_col}` {x.id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    values, vectors = bidiagonalise(x, components) if x.d else (np.zeros(0), np.zeros((0, 0)))
    if not len(values):
        return spark.createDataFrame([], schema)
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    n, d, c = x.n, x.d, len(values)
    onto = vectors / (values / np.sqrt(n))
    trace = x.summed(lambda z: (z * z).sum(axis=0), d).sum() / n
    explained = values**2 / n / trace

    def moments(z: np.ndarray) -> np.ndarray:
        w = z @ onto
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    sums = x.summed(moments, c + c * c) / n
    covariance = sums[c:].reshape(c, c) - np.outer(sums[:c], sums[:c])
    error = float(np.abs(covariance - np.eye(c)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            rows = batch.num_rows
            w = (_matrix(batch.column(1), d) / n) @ onto
            at = pa.array(np.repeat(np.arange(rows), c))
            columns = [
                batch.column(0).take(at), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), rows)), pa.array(np.full(rows * c, n)), batch.column(2).take(at),
                pa.array(w.ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * c, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.rows.mapInArrow(project, schema)
