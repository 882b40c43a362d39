"""Centred cross products of columns, one distributed aggregate for all that needs them.

Correlations, linear and ridge regression and principal components are functions of the
row count, the means and the matrix of centred cross products.  The means come from one
aggregate; a second pass then adds up x x^T of the centred rows per task, block by block
of ``BLOCK`` columns, as matrix products, and blocks are added up by block.  Only the finished
matrix, as large as the results themselves, reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of a block, and rows multiplied at a time.
BLOCK = 128
ROWS = 8_192


@dataclass
class Gram:
    names: list[str]
    n: int
    mean: np.ndarray
    products: np.ndarray  # centred: n times the covariance

    def of(self, names: Sequence[str]) -> "Gram":
        at = [self.names.index(c) for c in names]
        return Gram(list(names), self.n, self.mean[at], self.products[np.ix_(at, at)])

    def correlation(self) -> np.ndarray:
        """NaN for constant columns, 1 on the diagonal of others."""
        d = np.diag(self.products)
        size = np.sqrt(np.outer(d, d))
        out = np.divide(self.products, size, out=np.full_like(self.products, np.nan), where=size > 0)
        out[np.diag_indices(len(d))] = np.where(d > 0, 1.0, np.nan)
        return out

    def solve(self, target: str, alpha: float = 0.0) -> tuple[np.ndarray, float]:
        """Coefficients of the other columns and the intercept that minimise squares plus alpha |coefficients|^2."""
        t = self.names.index(target)
        x = [k for k in range(len(self.names)) if k != t]
        a, b = self.products[np.ix_(x, x)], self.products[x, t]
        # Columns that the others make up have no coefficient of their own: the shortest solution.
        scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
        m = a / np.outer(scale, scale) + alpha * np.diag(1 / scale ** 2)
        value, vector = np.linalg.eigh(m)
        keep = value > max(value.max(initial=0.0), 0.0) * 1e-12
        coef = vector[:, keep] @ ((vector[:, keep].T @ (b / scale)) / value[keep]) / scale
        return coef, float(self.mean[t] - coef @ self.mean[x])

    def components(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Loadings (columns) of the ``k`` largest principal components and their shares of the variance;
        the largest loading of each is positive."""
        value, vector = np.linalg.eigh(self.products)
        order = np.argsort(-value, kind="stable")[:k]
        out = vector[:, order]
        out = out * np.where(out[np.abs(out).argmax(axis=0), np.arange(out.shape[1])] >= 0, 1.0, -1.0)
        total = value.sum()
        return out, np.maximum(value[order], 0) / total if total > 0 else np.zeros(len(order))


def gram(df: DataFrame, cols: Sequence[str | tuple[str, Column]] = (), vector: str | None = None,
         vector_names: Sequence[str] = ()) -> Gram:
    """The Gram matrix of numeric columns (or (name, expression) pairs) and of the elements of a vector column.

    Rows with a null or NaN in any of them are left out.  ``df`` is read twice: store it first if it is dear.
    """
    named = [(c, F.col(c)) if isinstance(c, str) else c for c in cols]
    parts = [F.array(*[e.cast("double") for _, e in named])] if named else []
    if vector is not None:
        parts.append(vector_to_array(vector))
    rows = df.select(F.concat(*parts).alias("x")).where(F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e)))
    names = [n for n, _ in named] + list(vector_names)
    d = len(names)
    first = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)]).first()
    if not first["n"]:
        return Gram(names, 0, np.zeros(d), np.zeros((d, d)))
    mean = np.array(first[1:], float)
    return Gram(names, first["n"], mean, _products(rows, mean))


def _products(rows: DataFrame, mean: np.ndarray) -> np.ndarray:
    import numpy as np
    import pyarrow as pa

    d, step = len(mean), ROWS
    edges = list(range(0, d, BLOCK)) + [d]
    blocks = [(i, j) for i in range(len(edges) - 1) for j in range(i + 1)]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {b: 0.0 for b in blocks}
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d) - mean
                for i, j in blocks:
                    total[i, j] = total[i, j] + x[:, edges[i]:edges[i + 1]].T @ x[:, edges[j]:edges[j + 1]]
        found = [(i, j, m.tobytes()) for (i, j), m in total.items() if not isinstance(m, float)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int32(), pa.int32(), pa.binary()))],
                                             names=["i", "j", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, object] = {}
        for batch in batches:
            for i, j, s in zip(*(c.to_pylist() for c in batch.columns)):
                m = np.frombuffer(s)
                held[i, j] = held[i, j] + m if (i, j) in held else m
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in held], pa.int32()), pa.array([k[1] for k in held], pa.int32()),
                 pa.array([m.tobytes() for m in held.values()], pa.binary())], names=["i", "j", "sums"])

    shape = "i int, j int, sums binary"
    sums = rows.mapInArrow(multiply, shape).repartition(len(blocks), "i", "j").mapInArrow(add, shape).collect()
    out = np.zeros((d, d))
    for r in sums:
        a, b = slice(edges[r["i"]], edges[r["i"] + 1]), slice(edges[r["j"]], edges[r["j"] + 1])
        out[a, b] = np.frombuffer(r["sums"]).reshape(a.stop - a.start, -1)
        out[b, a] = out[a, b].T
    return out
