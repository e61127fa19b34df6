"""Batch forecasts.

The reference answers one HTTP request at a time from the last row of one
series.  Here a forecast is a batch job: the latest engineered row of every
series (a ``max_by`` aggregate, no sort) is crossed with the requested
horizons by ``explode`` and scored by the fitted models in one pass.

Parity with the reference is deliberate: only the calendar fields are moved
to the target time; lags, rolling statistics, ``day_sin``/``day_cos``,
``year``, season flags and anomalies stay at the last observation.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import half_even
from ..operators.index import latest

# Fixed values that must equal the reference's results.
STANDARD_HORIZONS = (1, 3, 6)
CUSTOM_HORIZONS = (1, 3, 6, 12, 24)
HOURLY_MIN, HOURLY_MAX, HOURLY_DEFAULT = 1, 48, 24
FALLBACK = dict(temperature=26.0, feels_like=27.0, rain_probability=25.0, humidity=60, pressure=1010, wind_speed=10)
CARRIED = (("humidity", "humidity", 60), ("pressure", "pressure", 1010), ("wind_speed", "windspeedKmph", 10))


def standard_horizons(hours: int = 6):
    """1, 3 and 6 hours (the reference's ``h <= max(hours, 6)`` keeps all)."""
    return [h for h in STANDARD_HORIZONS if h <= max(hours, 6)]


def hourly_horizons(num_hours: int = HOURLY_DEFAULT):
    """Every hour 1..N, N within the API bounds."""
    if not HOURLY_MIN <= num_hours <= HOURLY_MAX:
        raise ValueError(f"hours must be between {HOURLY_MIN} and {HOURLY_MAX}")
    return list(range(1, num_hours + 1))


def custom_horizon(h: int):
    """A single allowed horizon (optional overrides are accepted and ignored)."""
    if h not in CUSTOM_HORIZONS:
        raise ValueError("horizon_hours must be one of: 1, 3, 6, 12, 24")
    return [h]


def future_rows(engineered: DataFrame, horizons, ts: str = "date_time", key=None, tiebreak=None) -> DataFrame:
    """G1: latest row per series x horizons, calendar fields moved forward."""
    last = latest(engineered, ts, key, tiebreak)
    fut = F.col(ts) + F.make_dt_interval(hours=F.col("horizon_hours"))
    rows = last.withColumn("horizon_hours", F.explode(F.array(*[F.lit(int(h)) for h in horizons])))
    rows = rows.withColumn("forecast_for", fut)
    t = F.col("forecast_for")
    two_pi = F.lit(2 * math.pi)
    moved = {"hour": F.hour(t), "day": F.dayofmonth(t), "month": F.month(t), "weekday": F.weekday(t),
             "quarter": F.quarter(t),
             "hour_sin": F.sin(two_pi * F.hour(t) / F.lit(24.0)), "hour_cos": F.cos(two_pi * F.hour(t) / F.lit(24.0)),
             "month_sin": F.sin(two_pi * F.month(t) / F.lit(12.0)), "month_cos": F.cos(two_pi * F.month(t) / F.lit(12.0))}
    return rows.withColumns({k: v for k, v in moved.items() if k in rows.columns or k in ("hour", "month")})


def with_default_features(rows: DataFrame, features) -> DataFrame:
    """Absent feature columns become 0.0 (present NULLs are not touched)."""
    missing = {c: F.lit(0.0) for c in features if c not in rows.columns}
    return rows.withColumns(missing) if missing else rows


def forecast(engineered: DataFrame, models: dict, features, horizons, ts: str = "date_time", key=None,
             tiebreak=None, optional=()) -> DataFrame:
    """Score the future rows with all three models in one plan.  A missing model is an error, unless its name
    is in ``optional``: then its column is NULL."""
    missing = [n for n in ("temp", "feels", "rain") if n not in models and n not in optional]
    if missing:
        raise ValueError(f"no model for {', '.join(missing)}")
    keys = [key] if isinstance(key, str) else list(key or [])
    scored = with_default_features(future_rows(engineered, horizons, ts, key, tiebreak), features)
    for name in ("temp", "feels", "rain"):
        if name in models:
            scored = models[name].transform(scored)
    none = F.lit(None).cast("double")
    prob = F.col("rain_probability") * 100 if "rain" in models else none
    feels = F.col("feels_pred") if "feels" in models else none
    temp = F.col("temp_pred") if "temp" in models else none
    carried = [(F.col(src).cast("int") if src in scored.columns else F.lit(d)).alias(out) for out, src, d in CARRIED]
    return scored.select(
        *keys, F.col("horizon_hours"),
        F.date_format("forecast_for", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        half_even(temp, 1).alias("temperature"),
        half_even(feels, 1).alias("feels_like"),
        half_even(prob, 1).alias("rain_probability"),
        *carried)


def fallback(horizons, issued_at) -> DataFrame:
    """Constant forecasts, only when a caller asks for them explicitly."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(int(h),) for h in horizons], "horizon_hours int")
    return df.select(
        "horizon_hours",
        F.date_format(F.lit(issued_at).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("horizon_hours")),
                      "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        *[F.lit(v).alias(k) for k, v in FALLBACK.items()])
