"""Typed relational tables and their load rules.

The reference declares four PostgreSQL tables.  Here they are Parquet
datasets with explicit schemas; the column CHECK / NOT NULL rules become a
``rejection`` column, so one pass yields both the rows to append and the
rows to quarantine, without an extra scan per rule.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's results.
ALLOWED_HORIZONS = (1, 3, 6, 12, 24)
DEFAULT_MODEL_VERSION = "xgboost-v1"
DEFAULT_LOCATION = "unknown"  # the station name is a deployment setting

WEATHER_HISTORY = T.StructType([
    T.StructField("recorded_at", T.TimestampNTZType(), False),
    T.StructField("location", T.StringType()),
    T.StructField("temp_c", T.DecimalType(5, 2), False),
    T.StructField("feels_like_c", T.DecimalType(5, 2)),
    T.StructField("max_temp_c", T.DecimalType(5, 2)),
    T.StructField("min_temp_c", T.DecimalType(5, 2)),
    T.StructField("humidity", T.ShortType()),
    T.StructField("pressure_hpa", T.ShortType()),
    T.StructField("wind_speed_kmph", T.ShortType()),
    T.StructField("wind_dir_deg", T.ShortType()),
    T.StructField("cloud_cover_pct", T.ShortType()),
    T.StructField("visibility_km", T.ShortType()),
    T.StructField("precip_mm", T.DecimalType(6, 2)),
    T.StructField("dew_point_c", T.DecimalType(5, 2)),
    T.StructField("uv_index", T.ShortType()),
])

FORECAST_HISTORY = T.StructType([
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("forecast_for", T.TimestampNTZType(), False),
    T.StructField("horizon_hours", T.ShortType(), False),
    T.StructField("temp_predicted", T.DecimalType(5, 2)),
    T.StructField("feels_predicted", T.DecimalType(5, 2)),
    T.StructField("rain_prob_pct", T.DecimalType(5, 2)),
    T.StructField("humidity_pred", T.ShortType()),
    T.StructField("pressure_pred", T.ShortType()),
    T.StructField("wind_pred", T.ShortType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("temp_actual", T.DecimalType(5, 2)),
    T.StructField("feels_actual", T.DecimalType(5, 2)),
    T.StructField("rained_actual", T.BooleanType()),
    T.StructField("evaluated_at", T.TimestampNTZType()),
])

MODEL_METRICS = T.StructType([
    T.StructField("model_name", T.StringType(), False),
    T.StructField("model_version", T.StringType(), False),
    T.StructField("target", T.StringType(), False),
    T.StructField("metric_name", T.StringType(), False),
    T.StructField("metric_value", T.DecimalType(10, 6), False),
    T.StructField("train_samples", T.IntegerType()),
    T.StructField("test_samples", T.IntegerType()),
    T.StructField("n_features", T.IntegerType()),
    T.StructField("trained_at", T.TimestampNTZType(), False),
    T.StructField("notes", T.StringType()),
])

PREDICTION_LOGS = T.StructType([
    T.StructField("requested_at", T.TimestampNTZType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("horizon_hours", T.ShortType()),
    T.StructField("input_features", T.StringType()),
    T.StructField("temp_out", T.DecimalType(5, 2)),
    T.StructField("feels_out", T.DecimalType(5, 2)),
    T.StructField("rain_prob_out", T.DecimalType(5, 2)),
    T.StructField("latency_ms", T.IntegerType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("client_ip", T.StringType()),
    T.StructField("status", T.StringType()),
])

# Seed rows of the metrics table: (model, version, target, metric, value) with
# 92870 train / 23218 test samples and 71 features.
SEED_METRICS = (
    ("XGBoost", "v1.0", "temperature", "MAE", 0.000),
    ("XGBoost", "v1.0", "temperature", "RMSE", 0.011),
    ("XGBoost", "v1.0", "temperature", "R2", 1.000),
    ("XGBoost", "v1.0", "feels_like", "MAE", 0.056),
    ("XGBoost", "v1.0", "feels_like", "R2", 0.997),
    ("XGBoost", "v1.0", "rain", "Accuracy", 0.999),
    ("XGBoost", "v1.0", "rain", "F1", 0.999),
    ("LinearRegression", "v1.0", "temperature", "MAE", 0.006),
    ("LinearRegression", "v1.0", "temperature", "R2", 1.000),
    ("RandomForest", "v1.0", "temperature", "MAE", 0.000),
    ("RandomForest", "v1.0", "temperature", "R2", 1.000),
    ("LightGBM", "v1.0", "temperature", "MAE", 0.001),
    ("LightGBM", "v1.0", "temperature", "R2", 1.000),
)
SEED_SAMPLES = (92870, 23218, 71)


def _typed(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> list[Column]:
    """Cast every schema column; absent columns become their default or NULL.
    Integer columns round (as a numeric -> smallint cast does) before the cast."""
    defaults = defaults or {}
    out = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name)
            if isinstance(f.dataType, T.IntegralType):
                c = F.round(c.try_cast("double"))
            c = c.try_cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        out.append(c.alias(f.name))
    return out


def _unreadable(df: DataFrame, schema: T.StructType) -> list[tuple[Column, str]]:
    """Checks for values that are there but fit no value of the column's type (text, overflow)."""
    out = []
    for f, typed in zip(schema.fields, _typed(df, schema)):
        if f.name in df.columns:
            raw = F.col(f.name)
            there = raw.isNotNull()
            if isinstance(df.schema[f.name].dataType, (T.DoubleType, T.FloatType)):
                there = there & ~F.isnan(raw)
            out.append((there & typed.isNull(), f"{f.name} not representable"))
    return out


def _first_failure(checks) -> Column:
    expr = None
    for cond, reason in checks:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def conform_weather_history(df: DataFrame, location: str = DEFAULT_LOCATION) -> DataFrame:
    """Typed rows plus ``rejection`` (NULL = loadable).  Range checks pass
    on NULL, like SQL CHECK constraints."""
    unreadable = _first_failure(_unreadable(df, WEATHER_HISTORY)) if df.columns else F.lit(None)
    typed = df.select(*_typed(df, WEATHER_HISTORY, {"location": location, "precip_mm": 0}), unreadable.alias("_unreadable"))
    c = F.col
    checks = [(c("recorded_at").isNull(), "recorded_at missing"), (c("temp_c").isNull(), "temp_c missing"),
              (~c("humidity").between(0, 100), "humidity out of range"),
              (~c("wind_dir_deg").between(0, 360), "wind_dir_deg out of range"),
              (~c("cloud_cover_pct").between(0, 100), "cloud_cover_pct out of range")]
    return typed.withColumn("rejection", F.coalesce("_unreadable", _first_failure(checks))).drop("_unreadable")


def conform_forecasts(df: DataFrame, model_version: str = DEFAULT_MODEL_VERSION) -> DataFrame:
    """Typed forecast rows; horizons outside the allowed list are rejected."""
    unreadable = _first_failure(_unreadable(df, FORECAST_HISTORY)) if df.columns else F.lit(None)
    typed = df.select(*_typed(df, FORECAST_HISTORY, {"model_version": model_version}), unreadable.alias("_unreadable"))
    c = F.col
    checks = [(c("forecast_for").isNull(), "forecast_for missing"),
              (c("horizon_hours").isNull(), "horizon_hours missing"),
              (~c("horizon_hours").isin(*ALLOWED_HORIZONS), "horizon_hours not allowed")]
    return typed.withColumn("rejection", F.coalesce("_unreadable", _first_failure(checks))).drop("_unreadable")


def loadable(conformed: DataFrame) -> DataFrame:
    return conformed.filter(F.col("rejection").isNull()).drop("rejection")


def rejected(conformed: DataFrame) -> DataFrame:
    return conformed.filter(F.col("rejection").isNotNull())


def append(conformed: DataFrame, path: str, partition_by=()) -> None:
    """Append the loadable rows (Parquet; optionally partitioned)."""
    w = loadable(conformed).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def metrics_frame(spark: SparkSession, metrics: DataFrame | None = None, trained_at: datetime | None = None,
                  include_seed: bool = True) -> DataFrame:
    """Tidy ``model_metrics`` rows.  ``metrics`` is long-form
    (model_name, model_version, target, metric_name, metric_value,
    train_samples, test_samples, n_features) computed by Spark; the 13 seed
    rows are appended when ``include_seed``."""
    ts = trained_at or datetime(1970, 1, 1)
    parts = []
    if include_seed:
        tr, te, nf = SEED_SAMPLES
        seed = spark.createDataFrame([(m, v, t, n, float(x), tr, te, nf) for m, v, t, n, x in SEED_METRICS],
                                     "model_name string, model_version string, target string, metric_name string, "
                                     "metric_value double, train_samples int, test_samples int, n_features int")
        parts.append(seed)
    if metrics is not None:
        parts.append(metrics.select("model_name", "model_version", "target", "metric_name",
                                    F.col("metric_value").cast("double"), F.col("train_samples").cast("int"),
                                    F.col("test_samples").cast("int"), F.col("n_features").cast("int")))
    if not parts:
        raise ValueError("nothing to write")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*[c for c in out.columns if c != "metric_value"],
                      F.col("metric_value").cast(T.DecimalType(10, 6)).alias("metric_value"),
                      F.lit(ts).cast("timestamp_ntz").alias("trained_at"), F.lit(None).cast("string").alias("notes"))


def prediction_logs(scored: DataFrame, features, endpoint: str = "batch", horizon_col: str = "horizon_hours",
                    temp: str = "temperature", feels: str = "feels_like", prob: str = "rain_probability",
                    model_version: str = DEFAULT_MODEL_VERSION, requested_at: str | None = None) -> DataFrame:
    """One log row per scored row; inputs kept as a JSON object."""
    feats = [c for c in features if c in scored.columns]
    return scored.select(
        (F.col(requested_at) if requested_at else F.current_timestamp()).cast("timestamp_ntz").alias("requested_at"),
        F.lit(endpoint).alias("endpoint"),
        F.col(horizon_col).cast("short").alias("horizon_hours"),
        F.to_json(F.struct(*[F.col(c) for c in feats])).alias("input_features"),
        F.col(temp).cast(T.DecimalType(5, 2)).alias("temp_out"),
        F.col(feels).cast(T.DecimalType(5, 2)).alias("feels_out"),
        F.col(prob).cast(T.DecimalType(5, 2)).alias("rain_prob_out"),
        F.lit(None).cast("int").alias("latency_ms"),
        F.lit(model_version).alias("model_version"),
        F.lit(None).cast("string").alias("client_ip"),
        F.lit("success").alias("status"))
