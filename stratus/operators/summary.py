"""Historical roll-ups behind the API and dashboard (E15-E23) and the SQL
reporting views (E18, E19).

Rounding follows the producer: pandas ``.round`` (half-even) for the API and
dashboard payloads, SQL ``ROUND`` (half-up) for the two views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import dashboard_season, month_name
from ..functions.rounding import half_even, half_up
from ..functions.rules import nan_to_null


def _month(ts):
    return F.month(ts)


def api_monthly(df: DataFrame, ts: str = "date_time", temp: str = "tempC", humidity: str = "humidity",
                precip: str = "precipMM", pressure: str = "pressure") -> DataFrame:
    """Monthly averages of the history endpoint, 2 dp half-even."""
    df = nan_to_null(df)
    m = _month(ts)
    return (df.filter(m.isNotNull()).groupBy(m.alias("month"))
            .agg(half_even(F.avg(temp)).alias("avg_temp"), half_even(F.avg(humidity)).alias("avg_humidity"),
                 half_even(F.avg(precip)).alias("avg_rain"), half_even(F.avg(pressure)).alias("avg_pressure")))


def api_yearly(df: DataFrame, ts: str = "date_time", temp: str = "tempC", humidity: str = "humidity",
               precip: str = "precipMM") -> DataFrame:
    """Yearly average temperature, total rain, average humidity."""
    df = nan_to_null(df)
    y = F.year(ts)
    return (df.filter(y.isNotNull()).groupBy(y.alias("year"))
            .agg(half_even(F.avg(temp)).alias("avg_temp"), half_even(F.sum(precip)).alias("total_rain"),
                 half_even(F.avg(humidity)).alias("avg_humidity")))


def api_totals(df: DataFrame, ts: str = "date_time") -> DataFrame:
    """Record count and date range as text."""
    fmt = "yyyy-MM-dd HH:mm:ss"
    return df.agg(F.count(F.lit(1)).alias("total_records"),
                  F.date_format(F.min(ts), fmt).alias("start"), F.date_format(F.max(ts), fmt).alias("end"))


def monthly_weather_summary(history: DataFrame, ts: str = "recorded_at", temp: str = "temp_c",
                            humidity: str = "humidity", precip: str = "precip_mm") -> DataFrame:
    """The ``monthly_weather_summary`` view, by (year, month), NULL
    groups kept, SQL half-up rounding, ordered."""
    history = nan_to_null(history)
    return (history.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month"))
            .agg(F.count(F.lit(1)).alias("records"),
                 half_up(F.avg(temp), 2).alias("avg_temp"),
                 half_up(F.min(temp), 2).alias("min_temp"),
                 half_up(F.max(temp), 2).alias("max_temp"),
                 half_up(F.avg(humidity), 1).alias("avg_humidity"),
                 half_up(F.sum(precip), 2).alias("total_rain_mm"),
                 F.count_if(F.col(precip) > 0).alias("rainy_hours"))
            .orderBy("year", "month"))


def forecast_accuracy(forecasts: DataFrame) -> DataFrame:
    """The ``forecast_accuracy`` view over evaluated forecasts."""
    err = F.col("temp_error")
    return (forecasts.filter(F.col("temp_actual").isNotNull())
            .groupBy("horizon_hours")
            .agg(F.count(F.lit(1)).alias("total_forecasts"),
                 half_up(F.avg(F.abs(err)), 3).alias("mean_abs_temp_error"),
                 half_up(F.stddev_samp(err), 3).alias("std_temp_error"),
                 F.count_if(F.abs(err) < 1).alias("within_1_degree"),
                 F.count_if(F.col("evaluated_at").isNotNull()).alias("evaluated_count"))
            .orderBy("horizon_hours"))


def dashboard_stats(df: DataFrame, ts: str = "date_time", temp: str = "tempC", humidity: str = "humidity",
                    pressure: str = "pressure", precip: str = "precipMM") -> DataFrame:
    """Headline statistics of the dashboard."""
    df = nan_to_null(df)
    fmt = "yyyy-MM-dd HH:mm:ss"
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.date_format(F.min(ts), fmt).alias("start"), F.date_format(F.max(ts), fmt).alias("end"),
        half_even(F.avg(temp)).alias("temp_mean"), half_even(F.stddev_samp(temp)).alias("temp_std"),
        F.min(temp).alias("temp_min"), F.max(temp).alias("temp_max"),
        half_even(F.avg(humidity)).alias("humidity_mean"), half_even(F.avg(pressure)).alias("pressure_mean"),
        half_even(F.avg(F.coalesce(F.col(precip) > 0, F.lit(False)).cast("int")) * 100).alias("rain_probability"))


def dashboard_monthly(df: DataFrame, ts: str = "date_time", temp: str = "tempC", humidity: str = "humidity",
                      precip: str = "precipMM", max_temp: str = "maxtempC", min_temp: str = "mintempC") -> DataFrame:
    """Dashboard month table at 1 dp; max/min are means of the daily
    max/min temperature columns."""
    df = nan_to_null(df)
    m = _month(ts)
    aggs = [half_even(F.avg(temp), 1).alias("avg_temp"), half_even(F.avg(humidity), 1).alias("avg_humidity"),
            half_even(F.avg(precip), 1).alias("avg_rain")]
    if max_temp in df.columns:
        aggs.append(half_even(F.avg(max_temp), 1).alias("max_temp"))
    if min_temp in df.columns:
        aggs.append(half_even(F.avg(min_temp), 1).alias("min_temp"))
    return (df.filter(m.isNotNull()).groupBy(m.alias("month")).agg(*aggs)
            .withColumn("month_name", month_name("month")))


def seasonal_summary(df: DataFrame, ts: str = "date_time", temp: str = "tempC",
                     humidity: str = "humidity") -> DataFrame:
    """Per dashboard season, the unweighted mean of monthly means."""
    df = nan_to_null(df)
    m = _month(ts)
    monthly = (df.filter(m.isNotNull()).groupBy(m.alias("month"))
               .agg(F.avg(temp).alias("t"), F.avg(humidity).alias("h")))
    return (monthly.groupBy(dashboard_season("month").alias("season"))
            .agg(half_even(F.avg("t"), 1).alias("avg_temp"), half_even(F.avg("h"), 1).alias("avg_humidity"),
                 F.count(F.lit(1)).alias("n_months")))


def class_balance_weight(df: DataFrame, label: str = "will_rain", train_col: str | None = "is_train") -> DataFrame:
    """Negatives / positives on the training rows (NULL without positives)."""
    src = df.filter(F.col(train_col)) if train_col else df
    y = F.col(label)
    return src.agg(F.try_divide(F.count_if(y == 0).cast("double"), F.count_if(y == 1)).alias("scale_pos_weight"))
