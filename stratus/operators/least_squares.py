"""Least squares with an intercept that also holds for collinear inputs (F2).

One aggregate gives the means, a second the Gram matrix of the centred inputs and label: each task adds up its rows'
products and sends one number per pair of columns, which Spark sums.  The driver gets (columns + 1)^2 / 2 numbers,
whatever the rows.  The Gram matrix of the scaled inputs is factorised by Cholesky with pivoting, which tells its rank,
and of all solutions the one of the smallest norm is taken: the coefficients are those of a least-squares solver
on standardised inputs, and predictions do not depend on how inputs are repeated.

NULL and NaN inputs count as 0.0, as in scoring; rows without a label take no part.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

#: A pivot below this share of the largest one ends the factorisation.
TOLERANCE = 1e-11


def _value(name: str) -> Column:
    x = F.col(name).cast("double")
    return F.when(x.isNull() | F.isnan(x), F.lit(0.0)).otherwise(x)


@dataclass
class LinearModel:
    features: list
    coefficients: list
    intercept: float
    rank: int
    prediction: str = "prediction"

    def transform(self, df: DataFrame) -> DataFrame:
        terms = F.lit(self.intercept)
        for c, b in zip(self.features, self.coefficients):
            if b:
                terms = terms + F.lit(b) * _value(c)
        return df.withColumn(self.prediction, terms)


def gram(data: DataFrame, columns: list[Column], centre: list[float]) -> np.ndarray:
    """Sums of products of the centred columns."""
    width, mean = len(columns), np.array(centre)

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                x = batch["x"].flatten().to_numpy().reshape(-1, width) - mean
                total += x.T @ x
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "v": total[i, j]})

    sums = data.select(F.array(*columns).alias("x")).mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    for r in sums.collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def pivoted_factor(a: np.ndarray, tolerance: float = TOLERANCE) -> np.ndarray:
    """R, of full row rank, with R'R = ``a`` (symmetric, not negative) up to ``tolerance`` of its largest pivot."""
    left, rows, first = a.copy(), [], None
    while len(rows) < len(a):
        k = int(left.diagonal().argmax())
        pivot = left[k, k]
        first = pivot if first is None else first
        if pivot <= tolerance * first or pivot <= 0:
            break
        rows.append(left[k] / np.sqrt(pivot))
        left = left - np.outer(rows[-1], rows[-1])
        left[k, :] = left[:, k] = 0.0
    return np.array(rows).reshape(-1, len(a))


def smallest_solution(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, int]:
    """(x, rank): the x of least norm with ``a`` x = ``b``, for a symmetric ``a`` and a ``b`` in its range."""
    r = pivoted_factor(a)
    if not len(r):
        return np.zeros(len(a)), 0
    inner = r @ r.T
    x = r.T @ np.linalg.solve(inner, np.linalg.solve(inner, r @ b))
    x += r.T @ np.linalg.solve(inner, np.linalg.solve(inner, r @ (b - a @ x)))  # one step of refinement
    return x, len(r)


def fit(data: DataFrame, features, label: str, prediction: str = "prediction") -> LinearModel:
    features = list(features)
    rows = data.where(F.col(label).isNotNull())
    columns = [*map(_value, features), F.col(label).cast("double")]
    mean = list(rows.agg(*[F.avg(c) for c in columns]).first())
    if mean[-1] is None:
        raise ValueError(f"no rows with a {label}")
    g = gram(rows, columns, mean)
    a, b = g[:-1, :-1], g[:-1, -1]
    scale = np.sqrt(a.diagonal())
    flat = scale <= 1e-9 * max(1.0, float(scale.max(initial=0.0)))
    scale = np.where(flat, 1.0, scale)
    a = np.where(flat[:, None] | flat, 0.0, a / np.outer(scale, scale))
    x, rank = smallest_solution(a, np.where(flat, 0.0, b / scale))
    beta = x / scale
    return LinearModel(features, beta.tolist(), float(mean[-1] - beta @ np.array(mean[:-1])), rank, prediction)
