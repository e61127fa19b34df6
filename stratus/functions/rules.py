"""Row-level rules: targets, interactions and the dashboard's classification
rules (B4, B5, B9-B14, B16, B17).  All are built-in Column expressions, so they
stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rounding import js_round

# Fixed values that must equal the reference's results.
RAIN_TARGET_THRESHOLD = 0.1          # will_rain = precip > 0.1
RAIN_CONDITION_THRESHOLD = 0.5       # "Rainy" label
CLOUDY_HUMIDITY = 80                 # "Cloudy" label
HOT_TEMP = 35                        # "Hot & Sunny"
WARM_TEMP = 28                       # "Warm"
RAIN_RISK_PCT = 40                   # rain risk when probability > 40
HOURLY_SUN_TEMP = 30                 # hourly strip: sun icon when temp > 30
RAIN_BUCKET_HIGH = 1.0               # monthly rain intensity: > 1
RAIN_BUCKET_MID = 0.2                # monthly rain intensity: > 0.2
CONDITION_LABELS = ("Rainy", "Cloudy", "Hot & Sunny", "Warm", "Clear & Pleasant")
FORECAST_LABELS = ("1 Hour", "3 Hours", "6 Hours")
# Columns never used as model features.
EXCLUDED_FROM_FEATURES = ("date_time", "location", "moonrise", "moonset", "sunrise", "sunset",
                          "tempC", "FeelsLikeC", "precipMM", "will_rain")
# Interaction features: (output, left, right).
INTERACTIONS = (
    ("temp_humidity", "tempC", "humidity"),
    ("temp_pressure", "tempC", "pressure"),
    ("wind_temp", "windspeedKmph", "tempC"),
    ("humidity_pressure", "humidity", "pressure"),
)
# Current-conditions projection: (output field, source column, default when the column is absent).
CURRENT_FIELDS = (
    ("temperature", "tempC", 25),
    ("feels_like", "FeelsLikeC", 25),
    ("humidity", "humidity", 60),
    ("pressure", "pressure", 1010),
    ("wind_speed", "windspeedKmph", 10),
    ("wind_dir", "winddirDegree", 180),
    ("cloud_cover", "cloudcover", 20),
    ("visibility", "visibility", 10),
    ("dew_point", "DewPointC", 15),
    ("precipitation", "precipMM", 0.0),
    ("uv_index", "uvIndex", 5),
    ("max_temp", "maxtempC", 30),
    ("min_temp", "mintempC", 20),
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _above(c, limit) -> Column:
    """``c > limit`` where a missing value, NULL or NaN, compares false (NaN is the largest value to Spark)."""
    x = _col(c)
    return F.coalesce((x > F.lit(limit)) & ~F.isnan(x.cast("double")), F.lit(False))


def nan_to_null(df: DataFrame) -> DataFrame:
    """``df`` with NaN as NULL in every floating-point column: both are missing, as in pandas."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def rain_label(precip="precipMM", threshold: float = RAIN_TARGET_THRESHOLD) -> Column:
    return _above(precip, threshold).cast("int")


def interactions(df: DataFrame, pairs=INTERACTIONS) -> DataFrame:
    """Products of column pairs; integral inputs multiply as long (no overflow)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = {}
    for out, a, b in pairs:
        if a not in types or b not in types:
            continue
        integral = all(isinstance(types[c], T.IntegralType) for c in (a, b))
        cast = "long" if integral else "double"
        cols[out] = F.col(a).cast(cast) * F.col(b).cast(cast)
    return df.withColumns(cols) if cols else df


def condition_label(temp="tempC", humidity="humidity", rain="precipMM") -> Column:
    """Ordered dashboard rule; the first matching condition wins."""
    rainy, cloudy, hot, warm, clear = CONDITION_LABELS
    return (F.when(_above(rain, RAIN_CONDITION_THRESHOLD), rainy)
            .when(_above(humidity, CLOUDY_HUMIDITY), cloudy)
            .when(_above(temp, HOT_TEMP), hot)
            .when(_above(temp, WARM_TEMP), warm)
            .otherwise(clear))


def rain_risk(prob) -> Column:
    """True when the rain probability (percent) is strictly above 40."""
    return _above(prob, RAIN_RISK_PCT)


def hourly_icon(prob, temp) -> Column:
    return (F.when(rain_risk(prob), "rain")
            .when(_above(temp, HOURLY_SUN_TEMP), "sun")
            .otherwise("partly_sunny"))


def rain_bucket(avg_rain) -> Column:
    return (F.when(_above(avg_rain, RAIN_BUCKET_HIGH), "high")
            .when(_above(avg_rain, RAIN_BUCKET_MID), "medium")
            .otherwise("low"))


def rain_banner(precip) -> Column:
    """'no_rain' when exactly 0, 'rain' when positive, NULL (no banner) otherwise."""
    p = _col(precip)
    return F.when(p == 0, "no_rain").when(_above(p, 0), "rain")


def forecast_label(position, horizon) -> Column:
    """Chart label by list position (1-based): the first three get fixed
    names, the rest '<h>h'."""
    pos = _col(position)
    fixed = F.element_at(F.array(*[F.lit(x) for x in FORECAST_LABELS]), pos.cast("int"))
    return F.when(pos.between(1, len(FORECAST_LABELS)), fixed).otherwise(
        F.concat(_col(horizon).cast("string"), F.lit("h")))


def forecast_chart_rows(df: DataFrame, position="position", horizon="horizon_hours",
                        temp="temperature", feels="feels_like", prob="rain_probability") -> DataFrame:
    return df.select(
        forecast_label(position, horizon).alias("name"),
        F.col(temp).alias("Temperature"),
        F.col(feels).alias("Feels Like"),
        js_round(prob).alias("Rain %"),
    )


def feature_columns(df: DataFrame, exclude=EXCLUDED_FROM_FEATURES) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def current_conditions(df: DataFrame, ts: str = "date_time", fields=CURRENT_FIELDS) -> list[Column]:
    """Projection list for the current-conditions payload.

    Integer fields are truncated toward zero like Python ``int()``.  A default
    is used only when the *column* is absent, never for a NULL value.
    """
    present = set(df.columns)
    out = []
    for name, src, default in fields:
        kind = "double" if isinstance(default, float) else "int"
        val = F.col(src).cast(kind) if src in present else F.lit(default).cast(kind)
        out.append(val.alias(name))
    out.append(F.date_format(F.col(ts), "yyyy-MM-dd HH:mm:ss").alias("timestamp"))
    return out
