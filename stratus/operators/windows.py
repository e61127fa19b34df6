"""Row-based series windows: lags (D1), trailing rolling mean / sample std /
sum (D2-D4) and calendar-mean anomalies (D5).

An unpartitioned ``Window.orderBy`` would send the whole series to one task.
Instead rows are cut into fixed-size chunks of the global row index; the last
``halo`` rows of every chunk are also copied into the next chunk, so each
chunk holds every earlier row its windows can reach.  The rows are hashed by
(key, chunk) and sorted by (key, chunk, row_idx): a chunk has at most
``chunk_rows + halo`` rows whatever the skew of the keys, and all window
columns share one exchange and one sort.  Copies are dropped afterwards.

Spark evaluates a moving frame anew for every row (45 rows a row for the
reference's frames of 3 to 24).  Columns of integers and doubles are therefore
computed over the sorted rows in Arrow batches, all rows of a batch at a time
(:class:`Trailing`); a task holds one batch and ``halo`` rows.  Other types
(decimals) go through Spark's window functions, over the same exchange and sort.

Rolling results follow pandas ``rolling(n)`` (``min_periods = n``): a value is
produced only when the frame holds ``n`` non-missing observations.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .index import _as_list, _free

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

DEFAULT_CHUNK_ROWS = 65536
#: Rows that are computed at a time, whatever the session's Arrow batches.
BATCH_ROWS = 16384


@dataclass(frozen=True)
class WindowSpec:
    """One derived column: ``kind`` in lag / mean / std / sum over ``n`` rows."""
    name: str
    kind: str
    column: str
    n: int

    @property
    def reach(self) -> int:
        """How many earlier rows the value depends on."""
        return self.n if self.kind == "lag" else self.n - 1


def lag_specs(columns: dict, lags) -> list[WindowSpec]:
    """``columns`` maps output prefix -> source column; lags outer, columns inner."""
    return [WindowSpec(f"{prefix}_lag_{k}", "lag", col, k) for k in lags for prefix, col in columns.items()]


def _expr(spec: WindowSpec, w) -> F.Column:
    c = F.col(spec.column)
    if spec.kind == "lag":
        # pandas ``shift`` turns integers into floats (NaN padding): lags are doubles.
        return F.lag(c, spec.n).over(w).cast("double")
    frame = w.rowsBetween(-(spec.n - 1), Window.currentRow)
    agg = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum}[spec.kind]
    return F.when(F.count(c).over(frame) == spec.n, agg(c).over(frame))


def add_series_windows(indexed: DataFrame, specs, key=None, index_col: str = "row_idx",
                       chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Add every ``WindowSpec`` column to a frame carrying a global row index
    (see :func:`stratus.operators.index.with_row_index`)."""
    specs = list(specs)
    if not specs:
        return indexed
    keys = _as_list(key)
    halo = max(s.reach for s in specs)
    if chunk_rows < halo:
        raise ValueError(f"chunk_rows={chunk_rows} must be at least the window reach {halo}")
    idx = F.col(index_col)
    home = F.floor(idx / chunk_rows).cast("long")
    in_halo = F.pmod(idx, F.lit(chunk_rows)) >= chunk_rows - halo
    chunks = F.when(in_halo, F.array(home, home + 1)).otherwise(F.array(home))
    copied = indexed.withColumn("_chunk", F.explode(chunks)).withColumn("_copy", F.col("_chunk") != home)
    laid = copied.repartition(*keys, "_chunk").sortWithinPartitions(*keys, "_chunk", index_col)
    types = {f.name: f.dataType for f in indexed.schema.fields}
    fast = [s for s in specs if isinstance(types.get(s.column), (T.IntegralType, T.DoubleType, T.FloatType))]
    w = Window.partitionBy(*keys, "_chunk").orderBy(index_col)
    laid = laid.withColumns({s.name: _expr(s, w) for s in specs if s not in fast})
    out = _trailing_columns(laid, fast, keys, halo) if fast else laid.filter(~F.col("_copy"))
    return out.select(*indexed.columns, *[s.name for s in specs])


def _trailing_columns(laid: DataFrame, specs, keys, halo: int) -> DataFrame:
    """The columns of ``specs`` over rows sorted by (key, _chunk, position), without the copied rows."""
    # keys are compared with the row before: types that Arrow does not compare, or NaN, as strings
    series, types = {"_chunk": F.col("_chunk")}, {f.name: f.dataType for f in laid.schema.fields}
    for k in keys:
        plain = isinstance(types[k], (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))
        series[k if plain else _free(laid, f"_key_{k}")] = F.col(k) if plain else F.col(k).cast("string")
    laid = laid.withColumns({n: c for n, c in series.items() if n not in laid.columns})
    whole = {s.name for s in specs if s.kind == "sum" and isinstance(types[s.column], T.IntegralType)}
    kept = [c for c in laid.columns if c not in series and c != "_copy" or c in keys]
    schema = laid.select(*kept).schema
    for s in specs:
        schema = schema.add(s.name, "long" if s.name in whole else "double")
    names, marks = schema.names, list(series)

    def run(batches):
        state = Trailing(specs, whole, halo)
        for batch in joined(batches, BATCH_ROWS):
            columns = state.add(batch, marks)
            own = pc.invert(batch["_copy"])
            rows = pa.RecordBatch.from_arrays([*[batch[c] for c in kept], *columns], names)
            yield rows.filter(own)

    return laid.mapInArrow(run, schema)


def joined(batches, rows: int):
    """Consecutive batches put together until they have ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if n:
        yield pa.concat_batches(held)


class Trailing:
    """Lags and trailing sums, means and deviations over rows that arrive sorted by series, batch by batch."""

    def __init__(self, specs, whole, halo: int):
        self.specs, self.whole, self.halo = specs, whole, halo
        self.last = None      # the row before, as a batch: its series goes on if the marks are equal
        self.age = 0          # rows of the open series so far
        self.tail: dict = {}  # column -> values and nulls of the last ``halo`` rows

    def add(self, batch: pa.RecordBatch, marks: list[str]) -> list[pa.Array]:
        """One array per spec for the rows of ``batch``."""
        age = self._ages(batch, marks)
        out: dict = {}
        for c in dict.fromkeys(s.column for s in self.specs):
            mine = [s for s in self.specs if s.column == c]
            with np.errstate(all="ignore"):
                out.update(self._column(batch[c], age, c, mine))
        return [out[s.name] for s in self.specs]

    def _ages(self, batch, marks) -> np.ndarray:
        """How many rows of its own series stand before each row."""
        n = batch.num_rows
        begins = np.zeros(n, dtype=bool)
        for c in marks:
            x = batch[c]
            begins[1:] |= _differ(x.slice(1), x.slice(0, n - 1))
            begins[0] |= self.last is None or bool(_differ(x.slice(0, 1), self.last[c])[0])
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(begins, at, -self.age))
        age = at - start
        self.age = int(age[-1]) + 1
        self.last = pa.RecordBatch.from_arrays([batch[c].slice(n - 1) for c in marks], marks)
        return age

    def _column(self, x: pa.Array, age: np.ndarray, name: str, specs) -> dict:
        n, halo = len(x), self.halo
        null = x.is_null().to_numpy(zero_copy_only=False)
        values = x.fill_null(0).to_numpy(zero_copy_only=False)
        if name in self.tail:
            values, null = np.concatenate([self.tail[name][0], values]), np.concatenate([self.tail[name][1], null])
        else:
            values, null = np.concatenate([np.zeros(halo, values.dtype), values]), np.concatenate([np.ones(halo, bool), null])
        self.tail[name] = values[len(values) - halo:].copy(), null[len(null) - halo:].copy()
        v, out = values.astype("f8"), {}

        def back(a, j):
            return a[halo - j:halo - j + n]

        for s in specs:
            if s.kind == "lag":
                out[s.name] = pa.array(back(v, s.n), mask=(age < s.n) | back(null, s.n))
        gaps = null.any()
        for width in {s.n for s in specs if s.kind != "lag"}:
            frames = [s for s in specs if s.kind != "lag" and s.n == width]
            kinds = {s.kind for s in frames}
            total, mean, second = np.zeros(n), np.zeros(n), np.zeros(n)
            exact = np.zeros(n, dtype=np.int64)
            mask = age < width - 1
            # oldest to newest, each step as Spark's and DuckDB's aggregates do it: the same bits, so trees split alike
            for k, j in enumerate(range(width - 1, -1, -1), 1):
                y = back(v, j)
                total += y
                if any(s.name in self.whole for s in frames):
                    exact += back(values, j)
                if "std" in kinds:
                    delta = y - mean
                    step = delta / k
                    mean += step
                    second += delta * (delta - step)
                if gaps:
                    mask |= back(null, j)
            got = {"sum": total, "mean": total / width, "std": np.sqrt(second / (width - 1)) if width > 1 else None}
            for s in frames:
                x = exact if s.name in self.whole else got[s.kind]
                out[s.name] = pa.nulls(n, pa.float64()) if x is None else pa.array(x, mask=mask)
        return out


def _differ(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Whether two arrays' values differ, nulls being equal to each other."""
    nulls = pc.xor(a.is_null(), b.is_null())
    return pc.or_(pc.fill_null(pc.not_equal(a, b), False), nulls).to_numpy(zero_copy_only=False)


def lags(indexed: DataFrame, columns: dict, lags_, key=None, index_col: str = "row_idx",
         chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    return add_series_windows(indexed, lag_specs(columns, lags_), key, index_col, chunk_rows)


def rolling(indexed: DataFrame, column: str, n: int, kind: str = "mean", name: str | None = None,
            key=None, index_col: str = "row_idx", chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    spec = WindowSpec(name or f"{column}_roll_{kind}_{n}", kind, column, n)
    return add_series_windows(indexed, [spec], key, index_col, chunk_rows)


def anomaly(df: DataFrame, columns: dict, by: str = "month", key=None) -> DataFrame:
    """``<out> = value - mean(value) over all rows sharing (key, by)``.

    The means come from a partial aggregate (one row per key and calendar
    value).  Without a key the table has at most 12 rows and is broadcast;
    with keys it is joined normally so AQE can broadcast it or split skew.
    """
    keys = _as_list(key)
    grp = keys + [by]
    means = df.groupBy(*grp).agg(*[F.avg(src).alias(f"_mean_{out}") for out, src in columns.items()])
    if not keys:
        means = F.broadcast(means)
    joined = df.join(means, grp, "left")
    return joined.select(*df.columns, *[(F.col(src) - F.col(f"_mean_{out}")).alias(out)
                                        for out, src in columns.items()])
