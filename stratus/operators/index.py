"""Positional operators on ordered series.

Spark rows have no position, but the reference's feature code is positional
(``shift``, ``rolling``, ``iloc``, ``X[:split]``).  :func:`with_row_index`
gives every row its 0-based position in (key, time, tie-break) order without
ever routing the series through one task:

1. ``repartitionByRange`` on the full ordering key.  The range partitioner
   samples the data, so partitions come out of similar size even when one
   station holds a third of all rows; ``sortWithinPartitions`` orders each.
2. Inside a partition ``monotonically_increasing_id`` encodes
   (partition id, position in partition).
3. The sorted, tagged rows are written once to the shared checkpoint folder
   (lineage is cut; the upstream plan runs once for the sample and once for the write).
4. Per-partition row counts form a table with one row per partition, a size
   fixed by the partition count and not by the data.  A running sum over it
   gives each partition's starting offset; it is broadcast back.

The result is deterministic (the ordering key must be unique), so a lost
executor recomputes the same indices.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scale_shuffle_partitions
from ..sources.materialize import materialize

_POS_BITS = 33  # monotonically_increasing_id = partition_id << 33 | position


def _as_list(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def _free(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_row_index(df: DataFrame, order_by, key=None, tiebreak=None, index_col: str = "row_idx",
                   key_index_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add ``index_col``: global 0-based position in (key, order_by, tiebreak) order.

    If ``key_index_col`` is given, also add the position within each key
    (restarting at 0 per key).  The ordering columns together must be unique.
    """
    keys, order, tb = _as_list(key), _as_list(order_by), _as_list(tiebreak)
    sort_cols = keys + order + tb
    # Without an explicit count AQE coalesces adjacent range partitions to its
    # advisory size; coalescing keeps them in key order.  The initial count
    # (also used by the later window exchange) follows the input size.
    if not num_partitions:
        scale_shuffle_partitions(df)
    ranged = (df.repartitionByRange(num_partitions, *sort_cols) if num_partitions
              else df.repartitionByRange(*sort_cols))
    ranged = (ranged
              .sortWithinPartitions(*sort_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()
                          - F.shiftleft(F.col("_pid").cast("long"), _POS_BITS)))
    # Materialise once in the shared checkpoint folder: the size table and the
    # main pass both read it, the upstream plan runs once, and lineage is cut
    # before the (long) window stage.  (_pid, _pos) are stored as columns, so
    # nothing depends on how the files are split when read back.
    ranged = materialize(ranged, "row-index")
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a single-partition window here is bounded by n.
    offsets = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")
                                                     .rowsBetween(Window.unboundedPreceding, 0))
                                     - F.col("_n")).alias("_off"))
    out = (ranged.join(F.broadcast(offsets), "_pid")
           .withColumn(index_col, F.col("_off") + F.col("_pos"))
           .drop("_pid", "_pos", "_off"))
    if key_index_col:
        if not keys:
            out = out.withColumn(key_index_col, F.col(index_col))
        else:
            # One row per key; AQE broadcasts it when small, else shuffles both sides.
            first = out.groupBy(*keys).agg(F.min(index_col).alias("_first"))
            out = (out.join(first, keys)
                   .withColumn(key_index_col, F.col(index_col) - F.col("_first"))
                   .drop("_first"))
    return out


def series_sizes(indexed: DataFrame, key=None, index_col: str = "row_idx") -> DataFrame:
    """Rows and first global index per series (one row per key)."""
    keys = _as_list(key)
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.min(index_col).alias("first_idx")]
    return indexed.groupBy(*keys).agg(*aggs) if keys else indexed.agg(*aggs)


def chrono_split(indexed: DataFrame, fraction: float = 0.8, key=None, index_col: str = "row_idx",
                 key_index_col: str = "series_idx", split_col: str = "is_train") -> DataFrame:
    """Chronological split: the first ``int(n * fraction)`` rows of each series train.

    ``indexed`` must carry the within-series index (``key_index_col``); the
    per-series row count comes from a one-row-per-series aggregate.
    """
    keys = _as_list(key)
    if not keys:
        n = indexed.select(F.count(F.lit(1))).scalar()  # uncorrelated scalar subquery
        return indexed.withColumn(split_col, F.col(key_index_col) < F.floor(n * F.lit(fraction)))
    # One row per series; AQE broadcasts it when small.
    n = indexed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    cut = F.floor(F.col("_n") * F.lit(fraction))
    return indexed.join(n, keys).withColumn(split_col, F.col(key_index_col) < cut).drop("_n")


def latest(df: DataFrame, ts: str = "date_time", key=None, tiebreak=None) -> DataFrame:
    """Last row (by time, then tie-break) per series.

    With a key the largest time alone is aggregated (a hash aggregate, one row per series and task is shuffled) and
    joined back; AQE broadcasts that table while it is small.  Only the rows at their series' last time are then ranked
    by the tie-break.  Without a key it is one ``max_by``.
    """
    keys, tb = _as_list(key), _as_list(tiebreak)
    if not keys:
        ordering = F.struct(*[F.col(c) for c in [ts] + tb])
        return df.agg(F.max_by(F.struct(*df.columns), ordering).alias("_row")).select("_row.*")
    names = {c: _free(df, f"_last_{i}") for i, c in enumerate([*keys, ts])}
    nth = _free(df, "_nth")
    last = df.groupBy(*keys).agg(F.max(ts).alias(names[ts])).withColumnsRenamed({k: names[k] for k in keys})
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    rows = df.join(last, reduce(lambda x, y: x & y, same)).select(*df.columns)
    order = [F.col(c).desc() for c in tb] or [F.lit(1)]
    ranked = rows.withColumn(nth, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(nth) == 1).select(*keys, *[c for c in df.columns if c not in keys])


def recent(df: DataFrame, n: int = 72, ts: str = "date_time", tiebreak=None) -> DataFrame:
    """Newest ``n`` rows (top-k: a TakeOrderedAndProject, never a full sort)."""
    order = [F.col(c).desc() for c in [ts] + _as_list(tiebreak)]
    return df.orderBy(*order).limit(n)


def head_after(indexed: DataFrame, start_col: str, k: int, index_col: str = "series_idx") -> DataFrame:
    """First ``k`` rows at or after position ``start_col`` (e.g. the test split start)."""
    return indexed.filter((F.col(index_col) >= F.col(start_col)) & (F.col(index_col) < F.col(start_col) + k))
