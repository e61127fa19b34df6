"""Exact quantiles that rank only the values near them.

Spark's ``percentile`` aggregate is exact, but its final step merges one
(value -> count) map per group into a single task: memory grows with the
number of distinct values.  Here the same result is computed as a
distributed plan:

1. One aggregate over all columns: counts, and for each quantile two values of a
   mergeable sketch that bracket it (``MARGIN`` of the rank to each side, three
   times what the sketch may err).  A column of up to ``SKETCH`` values has an open bracket.
2. One scan counts the values below each bracket (a single row a task) and the distinct
   values inside; values above are left out.  Partial aggregates, so about
   2 * ``MARGIN`` of the distinct values are shuffled.
3. ``repartitionByRange`` lays them in order, written once with their partition id, so
   no task holds all of them.  Totals a partition (a table bounded by the partition count,
   broadcast) and a running sum inside each partition give every value its rank interval;
   the values below a bracket are its first row.
4. The target ranks ``floor`` / ``ceil`` of ``q * (n - 1)`` (one row per
   column and requested q: a statically bounded table, broadcast) pick the
   two order statistics, which are interpolated linearly as pandas and
   Spark's ``percentile`` do.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.materialize import materialize


SKETCH = 10_000
MARGIN = 3 / SKETCH


def brackets(src: DataFrame, columns, qs) -> list[tuple]:
    """(column, q, n, low, high): an open side is infinite.  At most len(columns) * len(qs) rows reach the driver."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        at = [min(1.0, max(0.0, q + side)) for q in qs for side in (-MARGIN, MARGIN)]
        aggs += [F.count(x), F.percentile_approx(x, at, SKETCH)]
    row, out = src.agg(*aggs).first(), []
    for i, c in enumerate(columns):
        n, ends = row[2 * i], row[2 * i + 1]
        for j, q in enumerate(qs if n else ()):
            low = ends[2 * j] if n > SKETCH and q > MARGIN else -math.inf
            high = ends[2 * j + 1] if n > SKETCH and q < 1 - MARGIN else math.inf
            out.append((c, q, n, low, high))
    return out


def exact_quantiles(df: DataFrame, columns, qs, where=None) -> DataFrame:
    """Long form ``(column, q, value)`` for every column and q in ``qs``.

    NULL and NaN are skipped (pandas).  A column without values yields no rows.
    """
    columns, qs = list(columns), list(dict.fromkeys(float(q) for q in qs))
    src = df.filter(where) if where is not None else df
    found = brackets(src, columns, qs)
    if not found:
        return df.sparkSession.createDataFrame([], "column string, q double, value double")

    def inside(c, low, high):
        """NULL stands for all values below the bracket."""
        x = F.col(c).cast("double")
        return F.when(x.isNotNull() & ~F.isnan(x) & (x <= high), F.struct(F.when(x >= low, x).alias("x")))

    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(q).alias("q"), inside(c, low, high).alias("v"))
                                for c, q, _, low, high in found]))
    values = src.select(pairs.alias("_s")).select("_s.*").where(F.col("v").isNotNull()).select("column", "q", "v.x")
    counts = values.groupBy("column", "q", "x").agg(F.count(F.lit(1)).alias("_c"))
    ranged = materialize(counts.repartitionByRange("column", "q", "x")
                         .withColumn("_pid", F.spark_partition_id()), "quantiles")
    # One row per (column, q, partition): bounded by the partition count.
    parts = ranged.groupBy("column", "q", "_pid").agg(F.sum("_c").alias("_pn"))
    before = Window.partitionBy("column", "q").orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    offsets = parts.select("column", "q", "_pid", (F.sum("_pn").over(before) - F.col("_pn")).alias("_off"))
    within = Window.partitionBy("column", "q", "_pid").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ranks = (ranged.join(F.broadcast(offsets), ["column", "q", "_pid"])
             .withColumn("_end", F.col("_off") + F.sum("_c").over(within))
             .withColumn("_start", F.col("_end") - F.col("_c")).where(F.col("x").isNotNull()))
    targets = df.sparkSession.createDataFrame([(c, q, q * (n - 1)) for c, q, n, _, _ in found], "column string, q double, _pos double")
    targets = targets.select("column", "q", "_pos", F.floor("_pos").alias("_lo"), F.ceil("_pos").alias("_hi"))
    hit_lo = (F.col("_start") <= F.col("_lo")) & (F.col("_lo") < F.col("_end"))
    hit_hi = (F.col("_start") <= F.col("_hi")) & (F.col("_hi") < F.col("_end"))
    picked = ranks.join(F.broadcast(targets), ["column", "q"]).where(hit_lo | hit_hi)
    stats = picked.groupBy("column", "q").agg(
        F.max(F.when(hit_lo, F.col("x"))).alias("_vlo"), F.max(F.when(hit_hi, F.col("x"))).alias("_vhi"),
        F.first("_pos").alias("_pos"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    lo, hi, p = F.col("_vlo"), F.col("_vhi"), F.col("_pos")
    value = F.when((F.col("_lo") == F.col("_hi")) | (lo == hi), lo).otherwise(
        (F.col("_hi") - p) * lo + (p - F.col("_lo")) * hi)
    return stats.select("column", "q", value.alias("value"))
