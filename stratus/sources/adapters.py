"""Observation views over the driver's test tables.

The workload is about one or many regularly sampled observation series.  The
test warehouse has no weather table, so these adapters derive series with the
reference's raw column names from ``events`` and ``lineitem``:

* :func:`obs_hourly` - one row per hour of ``events`` (gaps at the smallest scale)
* :func:`obs_daily`  - one row per ship day of ``lineitem``
* :func:`obs_rows`   - every ``lineitem`` row, keyed by supplier (many series,
  ties on time, used for scale runs)
* :func:`persistence_forecasts` - forecast rows for every horizon built by
  carrying the observed value forward (a model-free forecast)

Every adapter is an aggregation or projection the optimizer can prune and push
filters into; none collects data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import day_start, hour_start
from ..functions.rounding import half_up
from ..functions.rules import rain_label

# Horizons accepted by the forecast table (fixed values).
FORECAST_HORIZONS = (1, 3, 6, 12, 24)
# Ordering columns that make lineitem rows unique (whole rows are distinct).
LINEITEM_TIEBREAK = ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
                     "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _share(event_type: str):
    """Share of events of one type: bounded, and the same at every scale."""
    return F.avg((F.col("event_type") == event_type).cast("int"))


def obs_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    return (ev.groupBy(hour_start("ts").alias("date_time"))
            .agg(half_up(F.avg("value"), 2).alias("tempC"),
                 half_up(F.greatest(_share("purchase") - 0.2, F.lit(0.0)) * 20, 2).alias("precipMM"),
                 half_up(_share("view") * 100, 2).alias("humidity"),
                 half_up(_share("click") * 100, 2).alias("cloudcover"),
                 half_up((F.min("value") + F.max("value")) / 2, 2).alias("FeelsLikeC"),
                 F.count(F.lit(1)).alias("pressure"),
                 half_up(F.max("value"), 2).alias("windspeedKmph")))


def obs_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_quantity", "l_discount", "l_tax")
    return (li.groupBy(day_start("l_shipdate").alias("date_time"))
            .agg(half_up(F.avg("l_quantity"), 2).alias("tempC"),
                 half_up(F.avg("l_discount") * 1000, 2).alias("humidity"),
                 half_up(F.greatest(F.avg((F.col("l_discount") >= 0.1).cast("int")) - 0.05, F.lit(0.0)) * 20, 2).alias("precipMM"),
                 F.count(F.lit(1)).alias("pressure"),
                 half_up(F.avg("l_tax") * 100, 2).alias("windspeedKmph"),
                 F.max("l_quantity").alias("maxtempC"),
                 F.min("l_quantity").alias("mintempC")))


def obs_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("location"),
        F.col("l_shipdate").alias("date_time"),
        F.col("l_quantity").alias("tempC"),
        F.col("l_tax").alias("precipMM"),
        (F.col("l_discount") * 1000).alias("humidity"),
        *LINEITEM_TIEBREAK,
    )


def persistence_forecasts(obs: DataFrame, ts: str = "date_time", horizons=FORECAST_HORIZONS) -> DataFrame:
    """Forecast rows for each issue time and horizon: predicted = observed now."""
    h = F.explode(F.array(*[F.lit(x) for x in horizons])).alias("horizon_hours")
    base = obs.select(F.col(ts).alias("created_at"), "tempC", "precipMM", "humidity", "pressure",
                      "windspeedKmph", h)
    return base.select(
        "created_at",
        (F.col("created_at") + F.make_dt_interval(hours=F.col("horizon_hours"))).alias("forecast_for"),
        F.col("horizon_hours").cast("short").alias("horizon_hours"),
        F.col("tempC").alias("temp_predicted"),
        F.col("tempC").alias("feels_predicted"),
        (rain_label("precipMM") * 100).cast("double").alias("rain_prob_pct"),
        F.col("humidity").alias("humidity_pred"),
        F.col("pressure").alias("pressure_pred"),
        F.col("windspeedKmph").alias("wind_pred"),
    )


# ---- the same views as DuckDB SQL, for oracle queries -----------------------

def sql_half_up(expr: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def sql_half_even(expr: str, digits: int = 2) -> str:
    return f"CAST(ROUND_EVEN(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


OBS_HOURLY_SQL = f"""
SELECT date_trunc('hour', ts) AS date_time,
       {sql_half_up('avg(value)')} AS tempC,
       {sql_half_up("greatest(avg(CAST(event_type = 'purchase' AS INTEGER)) - 0.2, 0.0) * 20")} AS precipMM,
       {sql_half_up("avg(CAST(event_type = 'view' AS INTEGER)) * 100")} AS humidity,
       {sql_half_up("avg(CAST(event_type = 'click' AS INTEGER)) * 100")} AS cloudcover,
       {sql_half_up('(min(value) + max(value)) / 2')} AS FeelsLikeC,
       count(*) AS pressure,
       {sql_half_up('max(value)')} AS windspeedKmph
FROM events GROUP BY 1
"""

OBS_DAILY_SQL = f"""
SELECT date_trunc('day', l_shipdate)::TIMESTAMP AS date_time,
       {sql_half_up('avg(l_quantity)')} AS tempC,
       {sql_half_up('avg(l_discount) * 1000')} AS humidity,
       {sql_half_up('greatest(avg(CAST(l_discount >= 0.1 AS INTEGER)) - 0.05, 0.0) * 20')} AS precipMM,
       count(*) AS pressure,
       {sql_half_up('avg(l_tax) * 100')} AS windspeedKmph,
       max(l_quantity) AS maxtempC,
       min(l_quantity) AS mintempC
FROM lineitem GROUP BY 1
"""

OBS_ROWS_SQL = f"""
SELECT l_suppkey AS location, l_shipdate AS date_time, l_quantity AS tempC, l_tax AS precipMM,
       l_discount * 1000 AS humidity, {', '.join(LINEITEM_TIEBREAK)}
FROM lineitem
"""

PERSISTENCE_SQL = """
SELECT created_at, created_at + horizon_hours * INTERVAL 1 HOUR AS forecast_for,
       CAST(horizon_hours AS SMALLINT) AS horizon_hours,
       tempC AS temp_predicted, tempC AS feels_predicted,
       CAST(CASE WHEN precipMM > 0.1 THEN 100 ELSE 0 END AS DOUBLE) AS rain_prob_pct,
       humidity AS humidity_pred, pressure AS pressure_pred, windspeedKmph AS wind_pred
FROM (SELECT date_time AS created_at, tempC, precipMM, humidity, pressure, windspeedKmph,
             unnest([1, 3, 6, 12, 24]) AS horizon_hours FROM obs_hourly)
"""


def with_views(body: str, *views: str) -> str:
    """Prefix a DuckDB query with the named adapter views as CTEs."""
    defs = {"obs_hourly": OBS_HOURLY_SQL, "obs_daily": OBS_DAILY_SQL, "obs_rows": OBS_ROWS_SQL,
            "forecasts": PERSISTENCE_SQL}
    needed = list(views)
    if "forecasts" in needed and "obs_hourly" not in needed:
        needed.insert(0, "obs_hourly")
    ctes = ",\n".join(f"{v} AS ({defs[v]})" for v in needed)
    return f"WITH {ctes}\n{body}"
