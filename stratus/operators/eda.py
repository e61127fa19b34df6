"""Exploratory statistics.

Most functions are one aggregation plan: partial aggregates on the map side, a
single small shuffle, no collect of rows.  Column names are parameters; defaults are
the raw observation names.  pandas semantics kept where they differ from SQL:
``groupby`` drops NULL keys, ``std`` is the sample deviation, a missing value
compares false, correlations are pairwise-complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import MONSOON_MONTHS, month_name, week_ending_sunday
from ..functions.rounding import half_even, half_up
from ..functions.rules import nan_to_null, numeric_columns
from ..sources.materialize import materialize
from .index import _free
from .moments import pairwise_correlations
from .quantiles import exact_quantiles

# Fixed values that must equal the reference's results.
DESCRIBE_COLUMNS = ("tempC", "FeelsLikeC", "humidity", "pressure", "windspeedKmph", "precipMM", "cloudcover")
HISTOGRAM_BINS = 50
RAIN_HEAVY_MM = 1.0
TOP_CORRELATIONS = 10


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def _missing(df: DataFrame, c: str):
    cond = F.col(c).isNull()
    return cond | F.isnan(F.col(c)) if _is_float(df, c) else cond


def _unpivot(wide: DataFrame, names: list[str], key: str, value: str, value_type: str) -> DataFrame:
    cols = [F.col(n).cast(value_type).alias(n) for n in names]
    return wide.select(*cols).unpivot([], names, key, value)


def overview(df: DataFrame, ts: str = "date_time") -> DataFrame:
    """Rows, columns, first/last time, whole days between them."""
    start, end = F.min(ts), F.max(ts)
    seconds = F.timestamp_diff("SECOND", start, end)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).alias("n_columns"),
                  start.alias("start"), end.alias("end"),
                  F.floor(seconds / 86400).alias("duration_days"))


def null_counts(df: DataFrame) -> DataFrame:
    """NULL (and NaN) count of every column, one pass, long form."""
    names = df.columns
    wide = df.agg(*[F.count_if(_missing(df, c)).alias(c) for c in names])
    return _unpivot(wide, names, "column", "n_missing", "long")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows repeating an earlier identical row (NULL equals NULL, NaN equals NaN).

    128 bits of hash a row are shuffled.  Only rows whose hash occurs twice or more are then
    compared by value: their hashes are joined back (broadcast by AQE while few) and grouped whole.
    """
    names = df.columns
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in names])  # a hash passes over NULLs
    h1, h2 = (F.xxhash64(F.lit(seed), nulls, *names) for seed in (1, 2))
    a, b = _free(df, "_hash_a"), _free(df, "_hash_b")
    hashed = df.withColumns({a: h1, b: h2})
    again = materialize(hashed.groupBy(a, b).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(a, b), "repeated-hashes")
    rows = hashed.join(again, [a, b], "left_semi").groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    return rows.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("n_duplicates"))


QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, columns=DESCRIBE_COLUMNS, digits: int = 2,
             relative_error: float | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles (linear interpolation), max.

    Moments come from one aggregate over all columns.  Exact quartiles come
    from :func:`stratus.operators.quantiles.exact_quantiles`, a distributed
    plan whose memory per task does not grow with the number of distinct
    values.  ``relative_error`` switches to Spark's fixed-size quantile
    sketch (``percentile_approx``) instead.
    """
    present = [c for c in columns if c in df.columns]
    moments = []
    for i, c in enumerate(present):
        # pandas skips NaN in every statistic, as the exact quartiles do.
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        fields = [F.lit(i).alias("_ord"), F.lit(c).alias("column"), F.count(x).alias("count"),
                  F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                  F.max(x).alias("max")]
        if relative_error is not None:
            acc = int(round(1 / relative_error))
            fields += [F.percentile_approx(x, q, acc).alias(f"p{int(q * 100)}") for q in QUARTILES]
        moments.append(F.struct(*fields).alias(c))
    wide = df.agg(*moments)
    stats = wide.select(F.explode(F.array(*[F.col(c) for c in present])).alias("s")).select("s.*")
    if relative_error is None:
        q = exact_quantiles(df, present, QUARTILES)
        quart = q.groupBy("column").agg(*[F.max(F.when(F.col("q") == qv, F.col("value"))).alias(f"p{int(qv * 100)}")
                                          for qv in QUARTILES])
        stats = stats.join(quart, "column", "left")  # one row per column on each side
    r = lambda c: half_even(F.col(c), digits).alias(c)
    return stats.orderBy("_ord").select("column", "count", r("mean"), r("std"), r("min"), r("p25"), r("p50"),
                                        r("p75"), r("max"))


def rain_stats(df: DataFrame, precip: str = "precipMM") -> DataFrame:
    """E5: hours with rain (> 0) and share, heavy hours (> 1), max, mean."""
    df = nan_to_null(df)
    p = F.col(precip)
    return df.agg(F.count_if(p > 0).alias("rain_hours"),
                  F.avg(F.coalesce(p > 0, F.lit(False)).cast("int")).alias("rain_share"),
                  F.count_if(p > RAIN_HEAVY_MM).alias("heavy_rain_hours"),
                  F.max(p).alias("max_precip"), F.avg(p).alias("avg_precip"))


def monsoon_share(df: DataFrame, precip: str = "precipMM", ts: str = "date_time") -> DataFrame:
    """Percent of all rain that fell in monsoon months."""
    df = nan_to_null(df)
    p = F.col(precip)
    monsoon = F.coalesce(F.sum(F.when(F.month(ts).isin(*MONSOON_MONTHS), p)), F.lit(0.0))
    return df.agg((F.try_divide(monsoon, F.sum(p)) * 100).alias("monsoon_share_pct"))


def correlations_with(df: DataFrame, target: str = "tempC", columns=None) -> DataFrame:
    """Pearson r of every numeric column against ``target`` (long form), NULL for a constant column."""
    cols = list(columns) if columns else numeric_columns(df)
    found = pairwise_correlations(df, list(dict.fromkeys([*cols, target])))
    return found.where((F.col("y") == target) & F.col("x").isin(*cols)).select(F.col("x").alias("column"), "r")


def top_correlations(df: DataFrame, target: str = "tempC", k: int = TOP_CORRELATIONS, columns=None) -> DataFrame:
    """The ``k`` largest signed correlations, target itself excluded."""
    corr = correlations_with(df, target, columns).filter(F.col("column") != target)
    # Rank on r rounded to 10 dp so columns whose r differs only by float
    # noise (e.g. a value and its anomaly) tie and fall back to the name.
    ranked = half_up("r", 10).desc()
    return corr.filter(F.col("r").isNotNull()).orderBy(ranked, F.col("column")).limit(k)


def correlation_matrix(df: DataFrame, columns=DESCRIBE_COLUMNS) -> DataFrame:
    """Strict lower triangle of the correlation matrix as (x, y, r)."""
    present = [c for c in columns if c in df.columns]
    place = F.create_map(*[v for i, c in enumerate(present) for v in (F.lit(c), F.lit(i))])
    return pairwise_correlations(df, present).where(place[F.col("x")] > place[F.col("y")]).select("x", "y", "r")


def monthly_temperature(df: DataFrame, temp: str = "tempC", ts: str = "date_time") -> DataFrame:
    """Per calendar month mean/min/max temperature, rounded half-even."""
    df = nan_to_null(df)
    m = F.month(ts)
    return (df.filter(m.isNotNull()).groupBy(m.alias("month"))
            .agg(half_even(F.avg(temp), 2).alias("mean"), half_even(F.min(temp), 2).alias("min"),
                 half_even(F.max(temp), 2).alias("max"))
            .withColumn("month_name", month_name("month")))


def monthly_means(df: DataFrame, columns=("tempC", "humidity", "precipMM", "pressure"),
                  ts: str = "date_time") -> DataFrame:
    """Per calendar month means of the given columns."""
    df = nan_to_null(df)
    m = F.month(ts)
    present = [c for c in columns if c in df.columns]
    return (df.filter(m.isNotNull()).groupBy(m.alias("month"))
            .agg(*[F.avg(c).alias(c) for c in present]))


def weekly_resample(df: DataFrame, ts: str = "date_time", temp: str = "tempC", humidity: str = "humidity",
                    precip: str = "precipMM") -> DataFrame:
    """Weeks ending Sunday, labelled by that Sunday; every week between
    the first and last is emitted (means NULL, rain sum 0 when empty)."""
    df = nan_to_null(df)
    week = week_ending_sunday(ts)
    weekly = df.filter(F.col(ts).isNotNull()).groupBy(week.alias("week")).agg(
        F.avg(temp).alias("avg_temp"), F.avg(humidity).alias("avg_humidity"), F.sum(precip).alias("_rain"))
    # Calendar of all week labels: one row per week of the observed span.
    span = weekly.agg(F.min("week").alias("lo"), F.max("week").alias("hi"))
    calendar = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 7 DAYS"))).alias("week"))
    return (calendar.join(weekly, "week", "left")
            .select("week", "avg_temp", "avg_humidity", F.coalesce("_rain", F.lit(0.0)).alias("total_rain")))


def hourly_profile(df: DataFrame, temp: str = "tempC", ts: str = "date_time") -> DataFrame:
    """Hour-of-day mean and sample std, with the +-1 std band."""
    df = nan_to_null(df)
    h = F.hour(ts)
    prof = df.filter(h.isNotNull()).groupBy(h.alias("hour")).agg(
        F.avg(temp).alias("mean"), F.stddev_samp(temp).alias("std"))
    return prof.withColumns({"lower": F.col("mean") - F.col("std"), "upper": F.col("mean") + F.col("std")})


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS, where=None) -> DataFrame:
    """Equal-width histogram from min to max, numpy conventions:
    the last bin is closed, a constant column spans value +- 0.5, every bin
    is emitted."""
    src = df.filter(where) if where is not None else df
    x = F.col(column).cast("double")
    src = src.select(x.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    # Two uncorrelated scalar subqueries (one-row aggregates) give the range.
    mn, mx = src.agg(F.min("x")).scalar(), src.agg(F.max("x")).scalar()
    lo = F.when(mn == mx, mn - 0.5).otherwise(mn)
    hi = F.when(mn == mx, mx + 0.5).otherwise(mx)
    step = (hi - lo) / bins
    guess = F.least(F.floor((F.col("x") - lo) * (bins / (hi - lo))).cast("int"), F.lit(bins - 1))
    # as numpy does, the computed edges decide where the quotient was rounded across one
    at = (F.when(F.col("x") < F.col("g") * step + lo, F.col("g") - 1)
          .when((F.col("x") >= (F.col("g") + 1) * step + lo) & (F.col("g") < bins - 1), F.col("g") + 1).otherwise(F.col("g")))
    counts = src.withColumn("g", guess).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.col("id") * step + lo).alias("lower"),
        F.when(F.col("id") == bins - 1, hi).otherwise((F.col("id") + 1) * step + lo).alias("upper"))
    return (edges.join(counts, "bin", "left")
            .select("bin", "lower", "upper", F.coalesce("count", F.lit(0)).alias("count")))


def quantile(df: DataFrame, column: str, q: float, where=None, name: str | None = None,
             relative_error: float | None = None) -> DataFrame:
    """One-row table with the ``q`` quantile of ``column`` (NULL when empty)."""
    name = name or f"p{int(q * 100)}"
    if relative_error is not None:
        src = df.filter(where) if where is not None else df
        return src.agg(F.percentile_approx(F.col(column).cast("double"), q, int(round(1 / relative_error))).alias(name))
    # A global aggregate always returns one row, NULL for an empty input.
    return exact_quantiles(df, [column], [q], where).agg(F.max("value").alias(name))
