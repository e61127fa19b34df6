"""One mergeable matrix of pairwise co-moments.

Each task keeps, for every pair of columns, the number of rows where both are present and the means, squared
deviations and co-deviations over those rows; batches and tasks are merged by the update for parallel
variances, so nothing cancels.  A task sends one row a column; Spark groups them by column.  One scan,
whatever the number of pairs; memory is the square of the number of columns.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.materialize import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

#: Deviations that small beside the mean are rounding: the column is constant.
CONSTANT = 1e-12


def of_batch(x: np.ndarray) -> np.ndarray:
    """(6, k, k): n, mean of i, mean of j, squares of i, squares of j, products, over the rows of ``x`` (NaN: missing)."""
    there = ~np.isnan(x)
    m = there.astype(np.float64)
    centre = np.where(there, x, 0.0).sum(axis=0) / np.maximum(m.sum(axis=0), 1)
    d = np.where(there, x - centre, 0.0)
    n, s, q, p = m.T @ m, d.T @ m, (d * d).T @ m, d.T @ d
    some = np.maximum(n, 1)
    return np.stack([n, centre[:, None] + s / some, centre[None, :] + s.T / some, np.maximum(q - s * s / some, 0.0),
                     np.maximum(q.T - s.T * s.T / some, 0.0), p - s * s.T / some])


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a[0] + b[0]
    some = np.maximum(n, 1)
    # where one side is empty the other's means count alone
    dx, dy = (np.where((a[0] > 0) & (b[0] > 0), b[k] - a[k], 0.0) for k in (1, 2))
    share, both = b[0] / some, a[0] * b[0] / some
    mx, my = (np.where(a[0] > 0, a[k] + d * share, b[k]) for k, d in ((1, dx), (2, dy)))
    return np.stack([n, mx, my, a[3] + b[3] + dx * dx * both, a[4] + b[4] + dy * dy * both, a[5] + b[5] + dx * dy * both])


def correlation(m: np.ndarray) -> list:
    """Pearson r of each pair, None where fewer than two rows or a constant side tell nothing."""
    n, mx, my, xx, yy, xy = m
    fit = (n > 1) & (xx > n * (CONSTANT * mx) ** 2) & (yy > n * (CONSTANT * my) ** 2)
    with np.errstate(divide="ignore", invalid="ignore"):
        r = xy / np.sqrt(xx * yy)
    return [float(v) if ok else None for v, ok in zip(r, fit)]


def pairwise_correlations(df: DataFrame, columns) -> DataFrame:
    """(x, y, n, r) for every ordered pair of ``columns``, over the rows where both are present; NaN counts as missing."""
    columns, spark = list(columns), df.sparkSession
    k = len(columns)
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns])

    def run(batches):
        total = np.zeros((6, k, k))
        for batch in batches:
            if batch.num_rows:
                total = merged(total, of_batch(batch["x"].flatten().to_numpy().reshape(-1, k)))
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(k), pa.int32()), "part": pa.array([part] * k, pa.int32()),
                                          "m": [total[:, i].tobytes() for i in range(k)]})

    def together(table: pa.Table) -> pa.Table:
        table, total = table.sort_by("part"), np.zeros((6, k))
        for m in table["m"].to_pylist():
            total = merged(total, np.frombuffer(m, dtype=np.float64).reshape(6, k))
        i = table["i"][0].as_py()
        return pa.table({"x": [columns[i]] * k, "y": columns, "n": pa.array(total[0].astype(np.int64)),
                         "r": pa.array(correlation(total), pa.float64())})

    # a row a column and task, written: no optimizer rule looks through the join below into a wide feature plan
    parts = materialize(df.select(x.alias("x")).mapInArrow(run, "i int, part int, m binary"), "co-moments")
    found = parts.groupBy("i").applyInArrow(together, "x string, y string, n long, r double")
    # every pair has a row, without any input too
    pairs = spark.createDataFrame([(a, b) for a in columns for b in columns], "x string, y string")
    return pairs.join(found, ["x", "y"], "left").select("x", "y", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "r")
