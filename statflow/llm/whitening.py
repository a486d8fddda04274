"""Operator 12: whitening of embeddings by QDWH spectral divide and conquer.

Entries become whole numbers x = floor(64 c) + 1,000,000. The fit list holds each distinct
x vector once. Its sums, and its second moments about the whole number nearest to
the mean, are added up in whole numbers, which no order of addition changes; the
covariance is their exact quotient, rounded once, so the same table gives the same
model on every cluster. ``qdwh.eigen`` splits the covariance into components; the matrix
of the first few is broadcast (dimensions x components numbers) and every row is
projected where it lies. The largest departure of the whitened fit list's
covariance from the identity is measured in a pass of its own.

The driver holds one covariance: its size follows the dimensions, not the rows.

Defined results: a row whose vector is null or holds a null or non-finite entry goes, as
does one with an entry whose x no bigint holds. The fit list has the vectors of the
length that most distinct vectors have (the larger one of two); rows of another
length come back with null deviation and whitened. Repeated rows come back each. A
deviation beyond a bigint is null. A component without variance (up to rounding) has null
whitened and doesn't count for ``identity_error``, which is null if no component has any.
Empty vectors have no components, so no rows. A row without id stays, its id
null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import stage
from statflow.llm.qdwh import EPS, eigen

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Up to this distance from the centre, ``ROWS`` products add up exactly in doubles.
NARROW, ROWS = 1 << 20, 1 << 13

SUMS = "i int, values array<string>"
WHITENED = (
    "component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, x): the rows that take part, their entries as whole numbers."""
    value = lambda c: c.cast("double") * F.lit(float(SCALE))
    fits = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(value(c)) < F.lit(float((1 << 63) - (1 << 30))))
    usable = F.col(vec_col).isNotNull() & F.forall(vec_col, fits)
    x = F.transform(vec_col, lambda c: F.floor(value(c)) + F.lit(OFFSET).cast("long"))
    return vectors.where(F.coalesce(usable, F.lit(False))).select(F.col(id_col).alias("vec_id"), x.alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten() if not isinstance(column, pa.ChunkedArray) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _sum_rows(z: np.ndarray) -> list[int]:
    """Exact sums of the columns."""
    if int(np.abs(z.astype(float)).max(initial=0)) * len(z) < 1 << 62:
        return z.sum(0).tolist()
    return z.astype(object).sum(0).tolist()


def _strings(rows: list[tuple[int, list[int]]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in rows], pa.int32()), pa.array([[str(v) for v in vs] for _, vs in rows], pa.list_(pa.string()))],
        names=["i", "values"],
    )


def _task_sums(dim: int) -> Callable:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for batch in batches:
            x = _matrix(batch.column("x"), dim)
            n += len(x)
            total = [a + b for a, b in zip(total, _sum_rows(x))]
        yield _strings([(0, [n, *total])])

    return of


def centred(x: np.ndarray, centre: list[int]) -> np.ndarray:
    """x less the centre, as int64, or as Python integers where that could overflow."""
    middle = np.array(centre, object)
    if len(x) and max(abs(float(x.max())), abs(float(x.min()))) + max(abs(float(c)) for c in centre) < 2.0**62:
        return x - middle.astype(np.int64)
    return x.astype(object) - middle


def products(z: np.ndarray) -> np.ndarray:
    """z' z, exactly, as Python integers."""
    far = np.abs(z).max(axis=1, initial=0) > NARROW
    near = z[~far].astype(float)
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for i in range(0, len(near), ROWS):
        part = near[i : i + ROWS]
        total = total + (part.T @ part).astype(np.int64).astype(object)
    wide = z[far].astype(object)
    return total + wide.T @ wide if len(wide) else total


def _task_moments(dim: int, centre: list[int]) -> Callable:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), object)
        for batch in batches:
            total = total + products(centred(_matrix(batch.column("x"), dim), centre))
        yield _strings([(i, row.tolist()) for i, row in enumerate(total)])

    return of


def _add_up(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    total = [sum(map(int, vs)) for vs in zip(*rows["values"])]
    return pd.DataFrame({"i": [key[0]], "values": [[str(v) for v in total]]})


def _exact_sums(partial: DataFrame) -> list[list[int]]:
    """Rows of whole numbers, added up over all tasks: as many as one covariance has."""
    found = partial.groupBy("i").applyInPandas(_add_up, SUMS).collect()
    return [[int(v) for v in r["values"]] for r in sorted(found, key=lambda r: r["i"])]


class Model:
    """n, sums and the first components of a fit list."""

    def __init__(self, n: int, sums: list[int], moments: list[list[int]], centre: list[int], k: int):
        dim = len(sums)
        self.n, self.sums = n, sums
        d = [s - n * c for s, c in zip(sums, centre)]
        # n^2 times the covariance is a whole number; one division rounds it.
        cov = np.array([[(n * moments[i][j] - d[i] * d[j]) / (n * n) for j in range(dim)] for i in range(dim)], float)
        values, vectors = eigen(cov.reshape(dim, dim))
        trace = sum(n * moments[i][i] - d[i] * d[i] for i in range(dim)) / (n * n)
        self.k = min(k, dim)
        self.values, self.vectors = values[: self.k], vectors[:, : self.k]
        self.varies = self.values > (dim * EPS * values[0] if dim else 0)
        self.explained = [float(max(0.0, e) / trace) if trace else None for e in self.values]
        self.weights = self.vectors / np.sqrt(np.where(self.varies, self.values, 1.0))

    def off_mean(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        largest = max((abs(s) for s in self.sums), default=0)
        if len(x) and max(abs(float(x.max())), abs(float(x.min()))) * self.n + largest < 2.0**62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def whiten(self, off: np.ndarray) -> np.ndarray:
        return (off / self.n).astype(float) @ self.weights

    def deviation(self, off: np.ndarray) -> list[int | None]:
        if off.dtype != object and len(off) and float(np.abs(off).max()) ** 2 * off.shape[1] < 2.0**62:
            return (off * off).sum(1).tolist()
        total = (off.astype(object) ** 2).sum(1).tolist()
        return [t if t < 1 << 63 else None for t in total]


def _task_whitened_moments(model, dim: int) -> Callable:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        total = np.zeros((m.k + 1, m.k))
        for batch in batches:
            w = m.whiten(m.off_mean(_matrix(batch.column("x"), dim)))
            total[: m.k] += w.T @ w
            total[m.k] += w.sum(0)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "v"])

    return of


def identity_error(fit: DataFrame, model, dim: int) -> float | None:
    """The largest entry of the whitened fit list's covariance minus the identity."""
    m = model.value
    moments = fit.mapInArrow(_task_whitened_moments(model, dim), "i int, j int, v double")
    total = np.zeros((m.k + 1, m.k))
    for r in moments.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # (components + 1) x components rows
        total[r["i"], r["j"]] = r["v"]
    mean = total[m.k] / m.n
    off = np.abs(total[: m.k] / m.n - np.outer(mean, mean) - np.eye(m.k))[np.ix_(m.varies, m.varies)]
    return float(off.max()) if off.size else None


def _project(model, dim: int, error: float | None) -> Callable:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            lengths = batch.column("x").value_lengths().to_numpy(zero_copy_only=False)
            same = np.nonzero(lengths == dim)[0]
            off = m.off_mean(_matrix(batch.column("x").take(pa.array(same)), dim))
            whitened = np.full((batch.num_rows, m.k), np.nan)
            whitened[same] = np.where(m.varies, m.whiten(off), np.nan)
            deviation = np.full(batch.num_rows, None, object)
            deviation[same] = m.deviation(off)
            shape = batch.num_rows * m.k
            number = np.tile(np.arange(m.k), batch.num_rows)
            flat = whitened.ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(batch.num_rows), m.k))),
                    pa.array(number + 1, pa.int32()),
                    pa.array(np.full(shape, m.n), pa.int64()),
                    pa.array(np.repeat(deviation, m.k).tolist(), pa.int64()),
                    pa.array(flat, pa.float64(), mask=np.isnan(flat)),
                    pa.array([m.explained[c] for c in number], pa.float64()),
                    pa.array([error] * shape, pa.float64()),
                ],
                names=["vec_id", *(c.split()[0] for c in WHITENED.split(", "))],
            )

    return of


def whiten(vectors: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors`` and component, up to ``k``: vec_id and ``WHITENED``."""
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, id_col, vec_col)
    distinct = stage(rows.select("x").distinct(), "whitening-fit")
    result = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, {WHITENED}"
    most = distinct.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if most is None or not most["dim"]:
        return spark.createDataFrame([], result)
    dim = most["dim"]
    fit = distinct.where(F.size("x") == dim)
    (n, *sums), = _exact_sums(fit.mapInArrow(_task_sums(dim), SUMS))
    centre = [(2 * s + n) // (2 * n) for s in sums]
    model = Model(n, sums, _exact_sums(fit.mapInArrow(_task_moments(dim, centre), SUMS)), centre, k)
    model = spark.sparkContext.broadcast(model)  # dim x k numbers
    return rows.mapInArrow(_project(model, dim, identity_error(fit, model, dim)), result)
