"""Forecast monitoring (H1-H3): fill actuals into issued forecasts, derive
the error column and flag drift week over week."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import week_ending_sunday
from ..functions.rules import nan_to_null, rain_label
from ..session import scale_shuffle_partitions
from .index import _as_list

# Decimal shape of the forecast table's temperature columns.
TEMP_DECIMAL = "decimal(5,2)"
DRIFT_WEEKLY_WORSENING = 0.10   # > 10 % worse than the previous week


def backfill_actuals(forecasts: DataFrame, observations: DataFrame, ts: str = "date_time", temp: str = "tempC",
                     feels: str | None = None, precip: str = "precipMM", key=None, as_of=None) -> DataFrame:
    """H1: join each forecast to the observation at ``forecast_for``.

    Only forecasts whose target time is at or before ``as_of`` (default: the
    latest observation) are evaluated; the rest keep NULL actuals.  This is an
    equi-join on (key, time): each side is shuffled once on that key.  Several
    observations of one time are averaged; without a ``feels`` column
    ``feels_actual`` is NULL.
    """
    keys = _as_list(key)
    for side in (forecasts, observations):
        scale_shuffle_partitions(side)
    felt = F.col(feels) if feels else F.lit(None).cast("double")
    # one row per (key, time): a repeated observation must not repeat forecasts
    obs = (nan_to_null(observations).groupBy(*keys, F.col(ts).alias("_obs_ts"))
           .agg(F.avg(temp).alias("_t"), F.avg(felt).alias("_f"), F.max(rain_label(precip)).alias("_r")))
    cutoff = F.lit(as_of) if as_of is not None else observations.select(F.max(ts)).scalar()
    cond = [forecasts["forecast_for"] == obs["_obs_ts"]] + [forecasts[k] == obs[k] for k in keys]
    joined = forecasts.join(obs, cond, "left")
    ready = (F.col("forecast_for") <= cutoff) & F.col("_obs_ts").isNotNull()
    out = joined.select(
        *[forecasts[c] for c in forecasts.columns if c not in ("temp_actual", "feels_actual", "rained_actual",
                                                               "evaluated_at", "temp_error")],
        F.when(ready, F.col("_t")).cast(TEMP_DECIMAL).alias("temp_actual"),
        F.when(ready, F.col("_f")).cast(TEMP_DECIMAL).alias("feels_actual"),
        F.when(ready, F.col("_r") == 1).alias("rained_actual"),
        F.when(ready, F.col("forecast_for")).alias("evaluated_at"))
    return with_temp_error(out)


def with_temp_error(forecasts: DataFrame) -> DataFrame:
    """H2: generated column ``temp_error = temp_actual - temp_predicted``."""
    err = F.col("temp_actual").cast(TEMP_DECIMAL) - F.col("temp_predicted").cast(TEMP_DECIMAL)
    return forecasts.withColumn("temp_error", err.cast(TEMP_DECIMAL))


def weekly_drift(evaluated: DataFrame, mae_threshold: float, ts: str = "forecast_for") -> DataFrame:
    """H3: weekly MAE per horizon; drift when MAE exceeds ``mae_threshold`` or
    is more than 10 % above the previous week's MAE for the same horizon.

    The window runs over the weekly aggregate (one row per horizon and week),
    never over forecast rows.
    """
    weekly = (evaluated.filter(F.col("temp_error").isNotNull())
              .groupBy("horizon_hours", week_ending_sunday(ts).alias("week"))
              .agg(F.avg(F.abs(F.col("temp_error").cast("double"))).alias("mae"),
                   F.count(F.lit(1)).alias("n")))
    weeks = Window.partitionBy("horizon_hours").orderBy("week")
    # a gap in the weeks has no previous week
    prev = F.when(F.date_diff("week", F.lag("week").over(weeks)) == 7, F.lag("mae").over(weeks))
    return (weekly.withColumn("prev_mae", prev)
            .withColumn("change", F.try_divide(F.col("mae") - F.col("prev_mae"), F.col("prev_mae")))
            .withColumn("drift", (F.col("mae") > mae_threshold)
                        | F.coalesce(F.col("change") > DRIFT_WEEKLY_WORSENING, F.lit(False))))
