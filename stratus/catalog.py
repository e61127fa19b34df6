"""Registry of runnable queries: one Spark plan per surveyed operator, each
paired (where SQL can express it) with an independent DuckDB statement.

Every query reads the driver's whole tables through the adapter views and
scales with them; nothing is sampled, capped or filtered by id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import calendar as cal
from .functions import rules
from .functions.rounding import half_up, round_doubles
from .operators import eda, evaluate, index, monitor, summary
from .plans import forecast as fc
from .plans import oracle_sql as O
from .plans.features import SeriesColumns, engineer
from .sources import adapters as A
from .sources import tables
from .sources.adapters import sql_half_even as E
from .sources.adapters import sql_half_up as R
from .sources.adapters import with_views
from .sources.materialize import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


ROWS_COLS = SeriesColumns(key=("location",), tiebreak=A.LINEITEM_TIEBREAK)


def hourly_features(spark, sf, drop=True):
    return engineer(A.obs_hourly(spark, sf), drop_incomplete=drop)


def rows_features(spark, sf, drop=True):
    return engineer(A.obs_rows(spark, sf), ROWS_COLS, drop_incomplete=drop)


def hourly_split(spark, sf, feats=None):
    """Complete-case hourly features, re-indexed after the filter, 80/20 split."""
    feats = feats if feats is not None else hourly_features(spark, sf)
    idx = index.with_row_index(feats, "row_idx", index_col="clean_idx", key_index_col="series_idx")
    return index.chrono_split(idx, 0.8)


HOURLY_FEATURES_CTE, HOURLY_FEATURES_FINAL, _ = O.feature_sql("obs_hourly", O.HOURLY_TYPES, round_digits=None)
HOURLY_SPLIT_SQL = with_views(
    f", {HOURLY_FEATURES_CTE.strip()},\n"
    f"clean AS ({HOURLY_FEATURES_FINAL}),\n"
    "idx AS (SELECT *, row_number() OVER (ORDER BY row_idx) - 1 AS series_idx, count(*) OVER () AS n FROM clean),\n"
    "split AS (SELECT *, series_idx < floor(n * 0.8) AS is_train FROM idx)\n", "obs_hourly")


# ---------------------------------------------------------------- sources ---

@register("a6_conform_weather_history", with_views("""
, src AS (
  SELECT date_time AS recorded_at, tempC AS temp_c, humidity, l_linenumber * 60 AS wind_dir_deg,
         tempC * 2 AS cloud_cover_pct, precipMM AS precip_mm FROM obs_rows),
typed AS (
  SELECT recorded_at, 'unknown' AS location, TRY_CAST(temp_c AS DECIMAL(5,2)) AS temp_c,
         TRY_CAST(humidity AS SMALLINT) AS humidity, TRY_CAST(wind_dir_deg AS SMALLINT) AS wind_dir_deg,
         TRY_CAST(cloud_cover_pct AS SMALLINT) AS cloud_cover_pct,
         coalesce(TRY_CAST(precip_mm AS DECIMAL(6,2)), CAST(0 AS DECIMAL(6,2))) AS precip_mm
  FROM src)
SELECT *, CASE WHEN recorded_at IS NULL THEN 'recorded_at missing'
               WHEN temp_c IS NULL THEN 'temp_c missing'
               WHEN humidity NOT BETWEEN 0 AND 100 THEN 'humidity out of range'
               WHEN wind_dir_deg NOT BETWEEN 0 AND 360 THEN 'wind_dir_deg out of range'
               WHEN cloud_cover_pct NOT BETWEEN 0 AND 100 THEN 'cloud_cover_pct out of range' END AS rejection
FROM typed""", "obs_rows"))
def a6_conform(spark, sf):
    rows = A.obs_rows(spark, sf)
    src = rows.select(F.col("date_time").alias("recorded_at"), F.col("tempC").alias("temp_c"), "humidity",
                      (F.col("l_linenumber") * 60).alias("wind_dir_deg"),
                      (F.col("tempC") * 2).alias("cloud_cover_pct"), F.col("precipMM").alias("precip_mm"))
    out = tables.conform_weather_history(src)
    return out.select("recorded_at", "location", "temp_c", "humidity", "wind_dir_deg", "cloud_cover_pct",
                      "precip_mm", "rejection")


@register("a7_conform_forecasts", with_views("""
SELECT forecast_for, horizon_hours, TRY_CAST(temp_predicted AS DECIMAL(5,2)) AS temp_predicted,
       'xgboost-v1' AS model_version,
       CASE WHEN forecast_for IS NULL THEN 'forecast_for missing'
            WHEN horizon_hours IS NULL THEN 'horizon_hours missing'
            WHEN horizon_hours NOT IN (1, 3, 6, 12, 24) THEN 'horizon_hours not allowed' END AS rejection
FROM forecasts""", "forecasts"))
def a7_conform(spark, sf):
    out = tables.conform_forecasts(A.persistence_forecasts(A.obs_hourly(spark, sf)))
    return out.select("forecast_for", "horizon_hours", "temp_predicted", "model_version", "rejection")


# ------------------------------------------------------------------- rules ---

@register("b_row_rules_hourly", with_views(f"""
SELECT date_time, {', '.join(O.calendar_sql())},
       CAST(month(date_time) IN (3, 4, 5) AS INTEGER) AS is_summer,
       CAST(month(date_time) IN (6, 7, 8, 9) AS INTEGER) AS is_monsoon,
       CAST(month(date_time) IN (11, 12, 1, 2) AS INTEGER) AS is_winter,
       {O.MONTH_ARRAY}[month(date_time)] AS month_name,
       CAST(coalesce(precipMM > 0.1, false) AS INTEGER) AS will_rain,
       CASE WHEN coalesce(precipMM > 0.5, false) THEN 'Rainy' WHEN coalesce(humidity > 80, false) THEN 'Cloudy'
            WHEN coalesce(tempC > 35, false) THEN 'Hot & Sunny' WHEN coalesce(tempC > 28, false) THEN 'Warm'
            ELSE 'Clear & Pleasant' END AS condition,
       coalesce(humidity > 40, false) AS rain_risk,
       CASE WHEN coalesce(humidity > 40, false) THEN 'rain' WHEN coalesce(tempC > 30, false) THEN 'sun'
            ELSE 'partly_sunny' END AS hourly_icon,
       CASE WHEN coalesce(precipMM > 1.0, false) THEN 'high' WHEN coalesce(precipMM > 0.2, false) THEN 'medium'
            ELSE 'low' END AS rain_bucket,
       CASE WHEN precipMM = 0 THEN 'no_rain' WHEN precipMM > 0 THEN 'rain' END AS rain_banner,
       tempC * humidity AS temp_humidity, humidity * pressure AS humidity_pressure,
       CAST(floor(tempC + 0.5) AS BIGINT) AS js_rounded_temp,
       {R('tempC', 1)} AS temp_half_up_1, {E('tempC', 1)} AS temp_half_even_1
FROM obs_hourly""", "obs_hourly"))
def b_row_rules_hourly(spark, sf):
    from .functions.rounding import half_even, half_up, js_round
    h = A.obs_hourly(spark, sf)
    t = cal.season_flags(cal.time_parts(h))
    t = rules.interactions(t, (("temp_humidity", "tempC", "humidity"), ("humidity_pressure", "humidity", "pressure")))
    return t.select(
        "date_time", "hour", "day", "month", "weekday", "quarter", "year", "is_summer", "is_monsoon", "is_winter",
        cal.month_name("month").alias("month_name"), rules.rain_label().alias("will_rain"),
        rules.condition_label().alias("condition"),
        rules.rain_risk("humidity").alias("rain_risk"),
        rules.hourly_icon("humidity", "tempC").alias("hourly_icon"),
        rules.rain_bucket("precipMM").alias("rain_bucket"), rules.rain_banner("precipMM").alias("rain_banner"),
        "temp_humidity", "humidity_pressure", js_round("tempC").alias("js_rounded_temp"),
        half_up("tempC", 1).alias("temp_half_up_1"), half_even("tempC", 1).alias("temp_half_even_1"))


@register("b_condition_rows", with_views("""
SELECT condition, count(*) AS n FROM (
  SELECT CASE WHEN coalesce(precipMM > 0.5, false) THEN 'Rainy' WHEN coalesce(humidity > 80, false) THEN 'Cloudy'
              WHEN coalesce(tempC > 35, false) THEN 'Hot & Sunny' WHEN coalesce(tempC > 28, false) THEN 'Warm'
              ELSE 'Clear & Pleasant' END AS condition FROM obs_rows) GROUP BY condition""", "obs_rows"))
def b_condition_rows(spark, sf):
    r = A.obs_rows(spark, sf)
    return r.groupBy(rules.condition_label().alias("condition")).agg(F.count(F.lit(1)).alias("n"))


@register("b16_current_conditions", with_views("""
SELECT CAST(trunc(arg_max(tempC, date_time)) AS INTEGER) AS temperature, CAST(trunc(arg_max(FeelsLikeC, date_time)) AS INTEGER) AS feels_like,
       CAST(trunc(arg_max(humidity, date_time)) AS INTEGER) AS humidity, CAST(arg_max(pressure, date_time) AS INTEGER) AS pressure,
       CAST(trunc(arg_max(windspeedKmph, date_time)) AS INTEGER) AS wind_speed, CAST(180 AS INTEGER) AS wind_dir,
       CAST(trunc(arg_max(cloudcover, date_time)) AS INTEGER) AS cloud_cover, CAST(10 AS INTEGER) AS visibility, CAST(15 AS INTEGER) AS dew_point,
       arg_max(precipMM, date_time) AS precipitation, CAST(5 AS INTEGER) AS uv_index, CAST(30 AS INTEGER) AS max_temp,
       CAST(20 AS INTEGER) AS min_temp, strftime(max(date_time), '%Y-%m-%d %H:%M:%S') AS timestamp
FROM obs_hourly""", "obs_hourly"))
def b16_current(spark, sf):
    last = index.latest(A.obs_hourly(spark, sf))
    return last.select(*rules.current_conditions(last))


# ------------------------------------------------------------- positional ---

@register("c1_row_index_rows", with_views("""
SELECT location, l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus,
       row_number() OVER (ORDER BY location, date_time, l_orderkey, l_partkey, l_linenumber, l_quantity,
                          l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) - 1 AS row_idx,
       row_number() OVER (PARTITION BY location ORDER BY date_time, l_orderkey, l_partkey, l_linenumber, l_quantity,
                          l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) - 1 AS series_idx
FROM obs_rows""", "obs_rows"))
def c1_row_index(spark, sf):
    r = A.obs_rows(spark, sf)
    idx = index.with_row_index(r, "date_time", key="location", tiebreak=A.LINEITEM_TIEBREAK,
                               key_index_col="series_idx")
    return idx.select("location", *A.LINEITEM_TIEBREAK, "row_idx", "series_idx")


@register("c2_chrono_split_rows", with_views("""
SELECT location, CAST(floor(count(*) * 0.8) AS BIGINT) AS n_train,
       count(*) - CAST(floor(count(*) * 0.8) AS BIGINT) AS n_test
FROM obs_rows GROUP BY location""", "obs_rows"))
def c2_split(spark, sf):
    r = A.obs_rows(spark, sf)
    idx = index.with_row_index(r, "date_time", key="location", tiebreak=A.LINEITEM_TIEBREAK,
                               key_index_col="series_idx")
    s = index.chrono_split(idx, 0.8, key="location")
    return s.groupBy("location").agg(F.count_if("is_train").alias("n_train"), F.count_if(~F.col("is_train")).alias("n_test"))


@register("c3_latest_per_location", with_views("""
SELECT location, arg_max(date_time, (date_time, l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice,
                                     l_discount, l_tax, l_returnflag, l_linestatus)) AS date_time,
       arg_max(l_orderkey, (date_time, l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice,
                            l_discount, l_tax, l_returnflag, l_linestatus)) AS l_orderkey,
       arg_max(l_linenumber, (date_time, l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice,
                              l_discount, l_tax, l_returnflag, l_linestatus)) AS l_linenumber
FROM obs_rows GROUP BY location""", "obs_rows"))
def c3_latest(spark, sf):
    r = A.obs_rows(spark, sf)
    last = index.latest(r, key="location", tiebreak=A.LINEITEM_TIEBREAK)
    return last.select("location", "date_time", "l_orderkey", "l_linenumber")


@register("c4_recent_72h", with_views("""
SELECT date_time, tempC, humidity, precipMM, pressure, windspeedKmph
FROM obs_hourly ORDER BY date_time DESC LIMIT 72""", "obs_hourly"))
def c4_recent(spark, sf):
    return index.recent(A.obs_hourly(spark, sf), 72).select("date_time", "tempC", "humidity", "precipMM",
                                                            "pressure", "windspeedKmph")


_HF_CTE, _HF_FINAL, _HF_COLS = O.feature_sql("obs_hourly", O.HOURLY_TYPES, round_digits=None)
_HF_NUMERIC = [c for c in _HF_COLS if c not in ("date_time", "row_idx")]


def _sql_corr(x: str, y: str) -> str:
    den = f"(stddev_samp({x}) * stddev_samp({y}))"
    return f"CASE WHEN {den} > 0 THEN covar_samp({x}, {y}) / {den} END"


@register("c5_top10_correlations", with_views(f"""
, {_HF_CTE.strip()},
clean AS ({_HF_FINAL}),
corrs AS (SELECT {', '.join(f'{_sql_corr(c, "tempC")} AS {c}' for c in _HF_NUMERIC)} FROM clean)
SELECT name AS "column", {R('r', 6)} AS r
FROM (UNPIVOT corrs ON COLUMNS(*) INTO NAME name VALUE r)
WHERE name <> 'tempC' AND r IS NOT NULL ORDER BY {R('r', 10)} DESC, name LIMIT 10""", "obs_hourly"))
def c5_top_corr(spark, sf):
    feats = hourly_features(spark, sf)
    cols = [c for c in rules.numeric_columns(feats) if c != "row_idx"]
    return round_doubles(eda.top_correlations(feats, "tempC", 10, cols), 6)


@register("c7_first_500_test_rows", HOURLY_SPLIT_SQL + f"""
SELECT series_idx, date_time, {R('tempC', 6)} AS tempC FROM split
WHERE series_idx >= (SELECT count(*) FILTER (WHERE is_train) FROM split)
  AND series_idx < (SELECT count(*) FILTER (WHERE is_train) FROM split) + 500""")
def c7_head(spark, sf):
    s = hourly_split(spark, sf)
    start = s.select(F.count_if("is_train")).scalar()
    out = s.filter((F.col("series_idx") >= start) & (F.col("series_idx") < start + 500))
    return round_doubles(out.select("series_idx", "date_time", "tempC"), 6)


# ---------------------------------------------------------------- windows ---

@register("d_features_hourly", O.features_query("obs_hourly", O.HOURLY_TYPES, dropna=True))
def d_features_hourly(spark, sf):
    """B1-B6 + D1-D5: the complete engineered table of the hourly series."""
    return round_doubles(hourly_features(spark, sf), 6)


@register("d_windows_hourly_all_rows", O.features_query("obs_hourly", O.HOURLY_TYPES, dropna=False))
def d_windows_hourly_all(spark, sf):
    """Window columns on every row, NULL warm-up positions included."""
    return round_doubles(hourly_features(spark, sf, drop=False), 6)


@register("d_features_rows_by_location", O.features_query("obs_rows", O.ROWS_TYPES, key="location",
                                                          tiebreak=A.LINEITEM_TIEBREAK, dropna=False))
def d_features_rows(spark, sf):
    """Per-station windows over every lineitem row (many series, time ties)."""
    return round_doubles(rows_features(spark, sf, drop=False), 6)


@register("e2_null_counts_features", with_views(
    f", {HOURLY_FEATURES_CTE.strip()},\nfeats AS (SELECT {', '.join(O.feature_sql('obs_hourly', O.HOURLY_TYPES, dropna=False, round_digits=None)[2])} FROM feat)\n"
    "SELECT name AS \"column\", CAST(n AS BIGINT) AS n_missing FROM (UNPIVOT (SELECT "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in
                O.feature_sql('obs_hourly', O.HOURLY_TYPES, dropna=False, round_digits=None)[2])
    + " FROM feats) ON COLUMNS(*) INTO NAME name VALUE n)", "obs_hourly"))
def e2_null_counts(spark, sf):
    return eda.null_counts(hourly_features(spark, sf, drop=False))


# ------------------------------------------------------------ statistics ---

@register("e1_overview", with_views("""
SELECT count(*) AS n_rows, CAST(8 AS INTEGER) AS n_columns, min(date_time) AS start, max(date_time) AS "end",
       CAST(floor((epoch(max(date_time)) - epoch(min(date_time))) / 86400) AS BIGINT) AS duration_days
FROM obs_hourly""", "obs_hourly"))
def e1_overview(spark, sf):
    return eda.overview(A.obs_hourly(spark, sf))


@register("e3_duplicate_count", with_views("""
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates FROM (
  SELECT count(*) AS n FROM obs_rows GROUP BY location, date_time, tempC, precipMM, humidity)""", "obs_rows"))
def e3_duplicates(spark, sf):
    return eda.duplicate_count(A.obs_rows(spark, sf).select("location", "date_time", "tempC", "precipMM", "humidity"))


_DESCRIBE_COLS = ("tempC", "FeelsLikeC", "humidity", "pressure", "windspeedKmph", "precipMM", "cloudcover")
_DESCRIBE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, {E(f'avg({c})')} AS mean, {E(f'stddev_samp({c})')} AS std, "
    f"{E(f'min({c})')} AS min, {E(f'quantile_cont({c}, 0.25)')} AS p25, {E(f'quantile_cont({c}, 0.5)')} AS p50, "
    f"{E(f'quantile_cont({c}, 0.75)')} AS p75, {E(f'max({c})')} AS max FROM obs_hourly" for c in _DESCRIBE_COLS)


@register("e4_describe", with_views(_DESCRIBE_SQL, "obs_hourly"))
def e4_describe(spark, sf):
    return eda.describe(A.obs_hourly(spark, sf), _DESCRIBE_COLS)


_ROW_DESCRIBE = ("tempC", "humidity", "precipMM")


@register("e4_describe_rows", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, {R(f'avg({c})', 6)} AS mean, {R(f'stddev_samp({c})', 6)} AS std, "
    f"{R(f'min({c})', 6)} AS min, {R(f'quantile_cont({c}, 0.25)', 6)} AS p25, {R(f'quantile_cont({c}, 0.5)', 6)} AS p50, "
    f"{R(f'quantile_cont({c}, 0.75)', 6)} AS p75, {R(f'max({c})', 6)} AS max FROM obs_rows" for c in _ROW_DESCRIBE), "obs_rows"))
def e4_describe_rows(spark, sf):
    """E4 over every lineitem row."""
    return round_doubles(eda.describe(A.obs_rows(spark, sf), _ROW_DESCRIBE, digits=8), 6)


@register("e13_quantiles_rows", with_views("""
SELECT q, quantile_cont(l_extendedprice, q) AS price FROM (SELECT unnest([0.001, 0.01, 0.5, 0.99, 0.999]) AS q), obs_rows GROUP BY q""".replace(
    "quantile_cont(l_extendedprice, q)", "CASE " + " ".join(
        f"WHEN q = {q} THEN {R(f'(SELECT quantile_cont(l_extendedprice, {q}) FROM obs_rows)', 6)}" for q in (0.001, 0.01, 0.5, 0.99, 0.999)) + " END"), "obs_rows"))
def e13_quantiles_rows(spark, sf):
    """E13's exact quantiles over every lineitem row, on a column of many distinct values."""
    from .operators.quantiles import exact_quantiles
    q = exact_quantiles(A.obs_rows(spark, sf), ["l_extendedprice"], (0.001, 0.01, 0.5, 0.99, 0.999))
    return round_doubles(q.select("q", F.col("value").alias("price")), 6)


@register("e5_rain_stats", with_views(f"""
SELECT count(*) FILTER (WHERE precipMM > 0) AS rain_hours,
       {R('avg(CAST(coalesce(precipMM > 0, false) AS INTEGER))', 6)} AS rain_share,
       count(*) FILTER (WHERE precipMM > 1.0) AS heavy_rain_hours, max(precipMM) AS max_precip,
       {R('avg(precipMM)', 6)} AS avg_precip
FROM obs_hourly""", "obs_hourly"))
def e5_rain(spark, sf):
    return round_doubles(eda.rain_stats(A.obs_hourly(spark, sf)), 6)


@register("e6_monsoon_share", with_views(f"""
SELECT {R("coalesce(sum(precipMM) FILTER (WHERE month(date_time) IN (6, 7, 8, 9)), 0.0) / NULLIF(sum(precipMM), 0) * 100", 6)}
       AS monsoon_share_pct FROM obs_daily""", "obs_daily"))
def e6_monsoon(spark, sf):
    return round_doubles(eda.monsoon_share(A.obs_daily(spark, sf)), 6)


_DAILY_NUM = ("tempC", "humidity", "precipMM", "pressure", "windspeedKmph", "maxtempC", "mintempC")


@register("e7_correlations_with_temp", with_views(f"""
, corrs AS (SELECT {', '.join(f"{_sql_corr(c, 'tempC')} AS {c}" for c in _DAILY_NUM)} FROM obs_daily)
SELECT name AS "column", {R('r', 6)} AS r FROM corrs UNPIVOT INCLUDE NULLS (r FOR name IN ({', '.join(_DAILY_NUM)}))""",
    "obs_daily"))
def e7_corr(spark, sf):
    return round_doubles(eda.correlations_with(A.obs_daily(spark, sf), "tempC", _DAILY_NUM), 6)


_MATRIX_COLS = ("tempC", "FeelsLikeC", "humidity", "pressure", "windspeedKmph", "precipMM", "cloudcover")
_PAIRS = [(_MATRIX_COLS[i], _MATRIX_COLS[j]) for i in range(len(_MATRIX_COLS)) for j in range(i)]


@register("e8_correlation_matrix", with_views(" UNION ALL ".join(
    f"SELECT '{x}' AS x, '{y}' AS y, {R(_sql_corr(x, y), 6)} AS r FROM obs_hourly" for x, y in _PAIRS), "obs_hourly"))
def e8_matrix(spark, sf):
    return round_doubles(eda.correlation_matrix(A.obs_hourly(spark, sf), _MATRIX_COLS), 6)


@register("e9_monthly_temperature", with_views(f"""
SELECT CAST(month(date_time) AS INTEGER) AS month, {E('avg(tempC)')} AS mean, {E('min(tempC)')} AS min,
       {E('max(tempC)')} AS max, {O.MONTH_ARRAY}[month(date_time)] AS month_name
FROM obs_daily GROUP BY month(date_time)""", "obs_daily"))
def e9_monthly_temp(spark, sf):
    return eda.monthly_temperature(A.obs_daily(spark, sf))


@register("e10_monthly_means", with_views(f"""
SELECT CAST(month(date_time) AS INTEGER) AS month, {R('avg(tempC)', 6)} AS tempC, {R('avg(humidity)', 6)} AS humidity,
       {R('avg(precipMM)', 6)} AS precipMM, {R('avg(pressure)', 6)} AS pressure
FROM obs_daily GROUP BY 1""", "obs_daily"))
def e10_monthly_means(spark, sf):
    return round_doubles(eda.monthly_means(A.obs_daily(spark, sf)), 6)


@register("e11_weekly_resample", with_views(f"""
, weekly AS (
  SELECT CAST(date_trunc('week', date_time) AS DATE) + 6 AS week, avg(tempC) AS avg_temp,
         avg(humidity) AS avg_humidity, sum(precipMM) AS rain
  FROM obs_daily GROUP BY 1),
cal AS (SELECT CAST(unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS DATE) AS week FROM weekly)
SELECT cal.week, {R('avg_temp', 6)} AS avg_temp, {R('avg_humidity', 6)} AS avg_humidity,
       {R('coalesce(rain, 0.0)', 6)} AS total_rain
FROM cal LEFT JOIN weekly USING (week)""", "obs_daily"))
def e11_weekly(spark, sf):
    return round_doubles(eda.weekly_resample(A.obs_daily(spark, sf)), 6)


@register("e12_hourly_profile", with_views(f"""
SELECT CAST(hour(date_time) AS INTEGER) AS hour, {R('avg(tempC)', 6)} AS mean, {R('stddev_samp(tempC)', 6)} AS std,
       {R('avg(tempC) - stddev_samp(tempC)', 6)} AS lower, {R('avg(tempC) + stddev_samp(tempC)', 6)} AS upper
FROM obs_hourly GROUP BY 1""", "obs_hourly"))
def e12_hourly(spark, sf):
    return round_doubles(eda.hourly_profile(A.obs_hourly(spark, sf)), 6)


def _sql_histogram(source: str, column: str, bins: int) -> str:
    return f"""
, src AS (SELECT CAST({column} AS DOUBLE) AS x FROM {source}),
b AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
             CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM src),
edges AS (SELECT CAST(i AS INTEGER) AS bin, i * ((hi - lo) / {bins}) + lo AS lower,
                 CASE WHEN i = {bins - 1} THEN hi ELSE (i + 1) * ((hi - lo) / {bins}) + lo END AS upper
          FROM b, range({bins}) t(i)),
counts AS (SELECT bin, count(*) AS n FROM src JOIN edges
           ON x >= lower AND (x < upper OR bin = {bins - 1}) GROUP BY 1)
SELECT edges.bin, {R('lower', 6)} AS lower, {R('upper', 6)} AS upper, coalesce(n, 0) AS count
FROM edges LEFT JOIN counts USING (bin)"""


@register("e13_rain_histogram", with_views(
    ", rain AS (SELECT precipMM FROM obs_hourly WHERE precipMM > 0)" + _sql_histogram("rain", "precipMM", 50),
    "obs_hourly"))
def e13_hist(spark, sf):
    h = A.obs_hourly(spark, sf)
    return round_doubles(eda.histogram(h, "precipMM", 50, where=F.col("precipMM") > 0), 6)


@register("e13_rain_p99", with_views(f"""
SELECT {R('quantile_cont(precipMM, 0.99)', 6)} AS p99 FROM obs_hourly WHERE precipMM > 0""", "obs_hourly"))
def e13_p99(spark, sf):
    return round_doubles(eda.quantile(A.obs_hourly(spark, sf), "precipMM", 0.99, where=F.col("precipMM") > 0), 6)


@register("e14_rain_by_month", with_views(f"""
SELECT CAST(month(date_time) AS INTEGER) AS month, {R('avg(precipMM)', 6)} AS precipMM FROM obs_daily GROUP BY 1""",
    "obs_daily"))
def e14_rain_month(spark, sf):
    return round_doubles(eda.monthly_means(A.obs_daily(spark, sf), ("precipMM",)), 6)


@register("e15_api_monthly", with_views(f"""
SELECT CAST(month(date_time) AS INTEGER) AS month, {E('avg(tempC)')} AS avg_temp, {E('avg(humidity)')} AS avg_humidity,
       {E('avg(precipMM)')} AS avg_rain, {E('avg(pressure)')} AS avg_pressure
FROM obs_daily GROUP BY 1""", "obs_daily"))
def e15_api_monthly(spark, sf):
    return summary.api_monthly(A.obs_daily(spark, sf))


@register("e16_api_yearly", with_views(f"""
SELECT CAST(year(date_time) AS INTEGER) AS year, {E('avg(tempC)')} AS avg_temp, {E('sum(precipMM)')} AS total_rain,
       {E('avg(humidity)')} AS avg_humidity
FROM obs_daily GROUP BY 1""", "obs_daily"))
def e16_api_yearly(spark, sf):
    return summary.api_yearly(A.obs_daily(spark, sf))


@register("e17_api_totals", with_views("""
SELECT count(*) AS total_records, strftime(min(date_time), '%Y-%m-%d %H:%M:%S') AS start,
       strftime(max(date_time), '%Y-%m-%d %H:%M:%S') AS "end" FROM obs_hourly""", "obs_hourly"))
def e17_totals(spark, sf):
    return summary.api_totals(A.obs_hourly(spark, sf))


@register("e18_monthly_weather_summary", with_views(f"""
SELECT CAST(year(date_time) AS INTEGER) AS year, CAST(month(date_time) AS INTEGER) AS month, count(*) AS records,
       {R('avg(tempC)')} AS avg_temp, {R('min(tempC)')} AS min_temp, {R('max(tempC)')} AS max_temp,
       {R('avg(humidity)', 1)} AS avg_humidity, {R('sum(precipMM)')} AS total_rain_mm,
       count(*) FILTER (WHERE precipMM > 0) AS rainy_hours
FROM obs_rows GROUP BY 1, 2 ORDER BY 1, 2""", "obs_rows"))
def e18_monthly_summary(spark, sf):
    rows = A.obs_rows(spark, sf)
    hist = rows.select(F.col("date_time").alias("recorded_at"), F.col("tempC").alias("temp_c"), "humidity",
                       F.col("precipMM").alias("precip_mm"))
    return summary.monthly_weather_summary(hist)


_BACKFILL_SQL = """
, cutoff AS (SELECT max(date_time) AS t FROM obs_hourly),
filled AS (
  SELECT f.created_at, f.forecast_for, f.horizon_hours, f.temp_predicted,
         CASE WHEN f.forecast_for <= cutoff.t AND o.date_time IS NOT NULL THEN CAST(o.tempC AS DECIMAL(5,2)) END AS temp_actual,
         CASE WHEN f.forecast_for <= cutoff.t AND o.date_time IS NOT NULL THEN CAST(o.FeelsLikeC AS DECIMAL(5,2)) END AS feels_actual,
         CASE WHEN f.forecast_for <= cutoff.t AND o.date_time IS NOT NULL THEN coalesce(o.precipMM > 0.1, false) END AS rained_actual,
         CASE WHEN f.forecast_for <= cutoff.t AND o.date_time IS NOT NULL THEN f.forecast_for END AS evaluated_at
  FROM forecasts f CROSS JOIN cutoff LEFT JOIN obs_hourly o ON f.forecast_for = o.date_time),
errs AS (SELECT *, CAST(temp_actual - CAST(temp_predicted AS DECIMAL(5,2)) AS DECIMAL(5,2)) AS temp_error FROM filled)
"""


def _backfilled(spark, sf):
    h = A.obs_hourly(spark, sf)
    return monitor.backfill_actuals(A.persistence_forecasts(h), h, feels="FeelsLikeC")


@register("e19_forecast_accuracy", with_views(_BACKFILL_SQL + f"""
SELECT horizon_hours, count(*) AS total_forecasts,
       {R('avg(abs(temp_error))', 3)} AS mean_abs_temp_error, {R('stddev_samp(temp_error)', 3)} AS std_temp_error,
       count(*) FILTER (WHERE abs(temp_error) < 1) AS within_1_degree,
       count(*) FILTER (WHERE evaluated_at IS NOT NULL) AS evaluated_count
FROM errs WHERE temp_actual IS NOT NULL GROUP BY horizon_hours ORDER BY horizon_hours""", "forecasts"))
def e19_accuracy(spark, sf):
    out = summary.forecast_accuracy(_backfilled(spark, sf))
    return out.withColumn("mean_abs_temp_error", F.col("mean_abs_temp_error").cast("double"))


@register("e20_dashboard_stats", with_views(f"""
SELECT count(*) AS total_rows, strftime(min(date_time), '%Y-%m-%d %H:%M:%S') AS start,
       strftime(max(date_time), '%Y-%m-%d %H:%M:%S') AS "end", {E('avg(tempC)')} AS temp_mean,
       {E('stddev_samp(tempC)')} AS temp_std, min(tempC) AS temp_min, max(tempC) AS temp_max,
       {E('avg(humidity)')} AS humidity_mean, {E('avg(pressure)')} AS pressure_mean,
       {E('avg(CAST(coalesce(precipMM > 0, false) AS INTEGER)) * 100')} AS rain_probability
FROM obs_hourly""", "obs_hourly"))
def e20_dashboard(spark, sf):
    return summary.dashboard_stats(A.obs_hourly(spark, sf))


@register("e21_dashboard_monthly", with_views(f"""
SELECT CAST(month(date_time) AS INTEGER) AS month, {E('avg(tempC)', 1)} AS avg_temp,
       {E('avg(humidity)', 1)} AS avg_humidity, {E('avg(precipMM)', 1)} AS avg_rain,
       {E('avg(maxtempC)', 1)} AS max_temp, {E('avg(mintempC)', 1)} AS min_temp,
       {O.MONTH_ARRAY}[month(date_time)] AS month_name
FROM obs_daily GROUP BY month(date_time)""", "obs_daily"))
def e21_dashboard_monthly(spark, sf):
    return summary.dashboard_monthly(A.obs_daily(spark, sf))


@register("e22_seasonal_summary", with_views(f"""
SELECT season, {E('avg(t)', 1)} AS avg_temp, {E('avg(h)', 1)} AS avg_humidity, count(*) AS n_months FROM (
  SELECT CASE WHEN m IN (3, 4, 5) THEN 'Summer' WHEN m IN (6, 7, 8, 9) THEN 'Monsoon'
              WHEN m IN (10, 11) THEN 'Post-Monsoon' WHEN m IN (12, 1, 2) THEN 'Winter' END AS season, t, h
  FROM (SELECT month(date_time) AS m, avg(tempC) AS t, avg(humidity) AS h FROM obs_daily GROUP BY 1))
GROUP BY season""", "obs_daily"))
def e22_seasons(spark, sf):
    return summary.seasonal_summary(A.obs_daily(spark, sf))


@register("e23_class_balance_weight", HOURLY_SPLIT_SQL + f"""
SELECT {R('CAST(count(*) FILTER (WHERE will_rain = 0) AS DOUBLE) / NULLIF(count(*) FILTER (WHERE will_rain = 1), 0)', 6)}
       AS scale_pos_weight FROM split WHERE is_train""")
def e23_weight(spark, sf):
    return round_doubles(summary.class_balance_weight(hourly_split(spark, sf)), 6)


# ------------------------------------------------------------- evaluation ---

def _persistence_eval(spark, sf):
    """Test rows of the hourly split with a model-free prediction: the
    previous hour's value (lag 1) and its rain label."""
    s = hourly_split(spark, sf).filter(~F.col("is_train"))
    return s.withColumn("rain_pred", rules.rain_label("precip_lag_1"))


_TEST_SQL = HOURLY_SPLIT_SQL + """, test AS (
  SELECT *, CAST(coalesce(precip_lag_1 > 0.1, false) AS INTEGER) AS rain_pred FROM split WHERE NOT is_train)
"""


@register("f9_regression_metrics", _TEST_SQL + f"""
SELECT {E('avg(abs(tempC - temp_lag_1))', 4)} AS mae, {E('sqrt(avg((tempC - temp_lag_1) * (tempC - temp_lag_1)))', 4)} AS rmse,
       {E('CASE WHEN var_samp(tempC) * (count(*) - 1) > 0 THEN 1 - sum((tempC - temp_lag_1) * (tempC - temp_lag_1)) / (var_samp(tempC) * (count(*) - 1)) END', 4)} AS r2,
       count(*) AS n
FROM test""")
def f9_regression(spark, sf):
    return evaluate.regression_metrics(_persistence_eval(spark, sf), "tempC", "temp_lag_1")


_CONF = """tp AS (SELECT count(*) FILTER (WHERE will_rain = 1 AND rain_pred = 1) AS tp,
                   count(*) FILTER (WHERE will_rain = 0 AND rain_pred = 1) AS fp,
                   count(*) FILTER (WHERE will_rain = 1 AND rain_pred = 0) AS fn,
                   count(*) FILTER (WHERE will_rain = 0 AND rain_pred = 0) AS tn FROM test)"""


def _sd(num, den):
    return f"coalesce(CAST({num} AS DOUBLE) / NULLIF({den}, 0), 0.0)"


@register("f10_classification_metrics", _TEST_SQL + f", {_CONF}\n" + f"""
SELECT {E(_sd('tp + tn', 'tp + fp + fn + tn'), 4)} AS accuracy, {E(_sd('tp', 'tp + fp'), 4)} AS precision,
       {E(_sd('tp', 'tp + fn'), 4)} AS recall, {E(_sd('2 * tp', '2 * tp + fp + fn'), 4)} AS f1, tp, fp, fn, tn
FROM tp""")
def f10_classification(spark, sf):
    return evaluate.classification_metrics(_persistence_eval(spark, sf), "will_rain", "rain_pred")


@register("f11_classification_report", _TEST_SQL + f", {_CONF},\n" + f"""
per AS (
  SELECT 'No Rain' AS class, {_sd('tn', 'tn + fn')} AS precision, {_sd('tn', 'tn + fp')} AS recall,
         {_sd('2 * tn', '2 * tn + fn + fp')} AS f1, tn + fp AS support FROM tp
  UNION ALL
  SELECT 'Rain', {_sd('tp', 'tp + fp')}, {_sd('tp', 'tp + fn')}, {_sd('2 * tp', '2 * tp + fp + fn')}, tp + fn FROM tp),
all_rows AS (
  SELECT * FROM per
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per
  UNION ALL SELECT 'weighted avg', {_sd('sum(precision * support)', 'sum(support)')},
                   {_sd('sum(recall * support)', 'sum(support)')}, {_sd('sum(f1 * support)', 'sum(support)')},
                   sum(support) FROM per)
SELECT class, {R('precision', 6)} AS precision, {R('recall', 6)} AS recall, {R('f1', 6)} AS f1,
       CAST(support AS BIGINT) AS support FROM all_rows""")
def f11_report(spark, sf):
    return round_doubles(evaluate.classification_report(_persistence_eval(spark, sf), "will_rain", "rain_pred"), 6)


@register("f12_confusion_matrix", _TEST_SQL + f", {_CONF}\n" + """
SELECT 0 AS actual, tn AS pred_0, fp AS pred_1 FROM tp UNION ALL SELECT 1, fn, tp FROM tp""")
def f12_confusion(spark, sf):
    return evaluate.confusion_matrix(_persistence_eval(spark, sf), "will_rain", "rain_pred")


@register("f13_residual_histogram", _TEST_SQL + ", resid AS (SELECT tempC - temp_lag_1 AS residual FROM test)"
          + _sql_histogram("resid", "residual", 60))
def f13_residuals(spark, sf):
    return round_doubles(evaluate.residual_histogram(_persistence_eval(spark, sf), "tempC", "temp_lag_1"), 6)


# ------------------------------------------------------------- monitoring ---

@register("h1_backfill_actuals", with_views(_BACKFILL_SQL + """
SELECT created_at, forecast_for, horizon_hours, temp_actual, feels_actual, rained_actual, evaluated_at, temp_error FROM errs""",
    "forecasts"))
def h1_backfill(spark, sf):
    return _backfilled(spark, sf).select("created_at", "forecast_for", "horizon_hours", "temp_actual",
                                         "feels_actual", "rained_actual", "evaluated_at", "temp_error")


@register("h3_weekly_drift", with_views(_BACKFILL_SQL + f"""
, weekly AS (
  SELECT horizon_hours, CAST(date_trunc('week', forecast_for) AS DATE) + 6 AS week,
         avg(abs(CAST(temp_error AS DOUBLE))) AS mae, count(*) AS n
  FROM errs WHERE temp_error IS NOT NULL GROUP BY 1, 2),
lagged AS (SELECT *, CASE WHEN week - lag(week) OVER (PARTITION BY horizon_hours ORDER BY week) = 7
                         THEN lag(mae) OVER (PARTITION BY horizon_hours ORDER BY week) END AS prev_mae FROM weekly)
SELECT horizon_hours, week, {R('mae', 6)} AS mae, n, {R('prev_mae', 6)} AS prev_mae,
       {R('(mae - prev_mae) / NULLIF(prev_mae, 0)', 6)} AS change,
       mae > 20.0 OR coalesce((mae - prev_mae) / NULLIF(prev_mae, 0) > 0.1, false) AS drift
FROM lagged""", "forecasts"))
def h3_drift(spark, sf):
    return round_doubles(monitor.weekly_drift(_backfilled(spark, sf), 20.0), 6)


# ------------------------------------------------------------- forecasting ---

@register("g1_future_feature_rows", with_views(f"""
, {HOURLY_FEATURES_CTE.strip()},
clean AS ({HOURLY_FEATURES_FINAL}),
last AS (SELECT * FROM clean ORDER BY date_time DESC LIMIT 1),
fut AS (SELECT *, unnest([1, 3, 6]) AS horizon_hours FROM last),
moved AS (SELECT *, date_time + horizon_hours * INTERVAL 1 HOUR AS forecast_for FROM fut)
SELECT horizon_hours, forecast_for, CAST(hour(forecast_for) AS INTEGER) AS hour, CAST(day(forecast_for) AS INTEGER) AS day,
       CAST(month(forecast_for) AS INTEGER) AS month, CAST(isodow(forecast_for) - 1 AS INTEGER) AS weekday,
       CAST(quarter(forecast_for) AS INTEGER) AS quarter, year,
       {R('sin(2 * pi() * hour(forecast_for) / 24.0)', 6)} AS hour_sin, {R('cos(2 * pi() * hour(forecast_for) / 24.0)', 6)} AS hour_cos,
       {R('day_sin', 6)} AS day_sin, {R('sin(2 * pi() * month(forecast_for) / 12.0)', 6)} AS month_sin,
       {R('temp_lag_1', 6)} AS temp_lag_1, {R('temp_roll_mean_24', 6)} AS temp_roll_mean_24
FROM moved""", "obs_hourly"))
def g1_future_rows(spark, sf):
    feats = hourly_features(spark, sf)
    rows = fc.future_rows(feats, fc.standard_horizons())
    return round_doubles(rows.select("horizon_hours", "forecast_for", "hour", "day", "month", "weekday", "quarter",
                                     "year", "hour_sin", "hour_cos", "day_sin", "month_sin", "temp_lag_1",
                                     "temp_roll_mean_24"), 6)


_FUTURE_COLS = ("horizon_hours", "forecast_for", "hour", "day", "month", "weekday", "quarter", "year", "hour_sin",
                "hour_cos", "day_sin", "month_sin", "temp_lag_1", "temp_roll_mean_24")


def _future_sql(horizons: str, key: str | None = None) -> str:
    """Projection of the moved calendar fields over a CTE ``moved``."""
    lead = f"{key}, " if key else ""
    return f"""
SELECT {lead}horizon_hours, forecast_for, CAST(hour(forecast_for) AS INTEGER) AS hour, CAST(day(forecast_for) AS INTEGER) AS day,
       CAST(month(forecast_for) AS INTEGER) AS month, CAST(isodow(forecast_for) - 1 AS INTEGER) AS weekday,
       CAST(quarter(forecast_for) AS INTEGER) AS quarter, year,
       {R('sin(2 * pi() * hour(forecast_for) / 24.0)', 6)} AS hour_sin, {R('cos(2 * pi() * hour(forecast_for) / 24.0)', 6)} AS hour_cos,
       {R('day_sin', 6)} AS day_sin, {R('sin(2 * pi() * month(forecast_for) / 12.0)', 6)} AS month_sin,
       {R('temp_lag_1', 6)} AS temp_lag_1, {R('temp_roll_mean_24', 6)} AS temp_roll_mean_24
FROM (SELECT *, date_time + horizon_hours * INTERVAL 1 HOUR AS forecast_for
      FROM (SELECT *, unnest({horizons}) AS horizon_hours FROM last))"""


@register("g5_hourly_future_rows", with_views(f"""
, {HOURLY_FEATURES_CTE.strip()},
clean AS ({HOURLY_FEATURES_FINAL}),
last AS (SELECT * FROM clean ORDER BY date_time DESC LIMIT 1)""" + _future_sql("range(1, 25)"), "obs_hourly"))
def g5_hourly_future_rows(spark, sf):
    """The hour-by-hour forecast rows (1..24, the API default) of the
    latest complete hourly row."""
    rows = fc.future_rows(hourly_features(spark, sf), fc.hourly_horizons(24))
    return round_doubles(rows.select(*_FUTURE_COLS), 6)


_ROWS_CTE, _ROWS_FINAL, _ = O.feature_sql("obs_rows", O.ROWS_TYPES, key="location", tiebreak=A.LINEITEM_TIEBREAK,
                                          round_digits=None)
_ROWS_DESC = ", ".join(f"{c} DESC" for c in ("date_time", *A.LINEITEM_TIEBREAK))


@register("g1_future_rows_by_location", with_views(f"""
, {_ROWS_CTE.strip()},
clean AS ({_ROWS_FINAL}),
last AS (SELECT * FROM clean QUALIFY row_number() OVER (PARTITION BY location ORDER BY {_ROWS_DESC}) = 1)"""
                                                   + _future_sql("[1, 3, 6]", "location"), "obs_rows"))
def g1_future_rows_by_location(spark, sf):
    """G1/G4 as a batch: the latest complete engineered row of every station
    (a hash aggregate of the largest time, joined back) x the standard
    horizons, calendar fields moved to the target time."""
    feats = rows_features(spark, sf)
    # read twice, for the largest time and for its rows: the features are computed once, the columns needed are written
    needed = ["location", "date_time", *A.LINEITEM_TIEBREAK, *[c for c in _FUTURE_COLS if c in feats.columns]]
    feats = materialize(feats.select(*needed), "complete-rows")
    rows = fc.future_rows(feats, fc.standard_horizons(), key="location", tiebreak=A.LINEITEM_TIEBREAK)
    return round_doubles(rows.select("location", *_FUTURE_COLS), 6)


# ------------------------------------------------------------------ models ---

def _train_config(feats):
    from .plans.features import model_features
    from .plans.training import TrainConfig
    return TrainConfig(features=model_features(feats))


@register("m_train_evaluate_temperature")
def m_train_temperature(spark, sf):
    """Standardised linear regression and the random forest
    (reference settings) fitted on the chronological train split of the
    hourly features; MAE / RMSE / R^2 per model on the test rows."""
    from .plans import training as T
    feats = hourly_features(spark, sf)
    cfg = _train_config(feats)
    cfg.models = ("LinearRegression", "RandomForest")
    data = T.prepare(feats, cfg)
    models = T.fit_baselines(data, cfg)
    return T.baseline_metrics(models, data, cfg.temp)


# --------------------------------------------------------- tables & charts ---

_HF_MODEL = [c for c in _HF_COLS if c not in set(rules.EXCLUDED_FROM_FEATURES) | {"row_idx"}]
_SEED_VALUES = ", ".join(f"('{m}', '{v}', '{t}', '{n}', {x})" for m, v, t, n, x in tables.SEED_METRICS)


@register("a8_model_metrics", _TEST_SQL + f""",
wide AS (
  SELECT {E('avg(abs(tempC - temp_lag_1))', 4)} AS MAE, {E('sqrt(avg((tempC - temp_lag_1) * (tempC - temp_lag_1)))', 4)} AS RMSE,
         {E('1 - sum((tempC - temp_lag_1) * (tempC - temp_lag_1)) / (var_samp(tempC) * (count(*) - 1))', 4)} AS R2
  FROM test),
sizes AS (SELECT count(*) FILTER (WHERE is_train) AS tr, count(*) FILTER (WHERE NOT is_train) AS te FROM split),
computed AS (
  SELECT 'Persistence' AS model_name, 'v1.0' AS model_version, 'temperature' AS target, name AS metric_name,
         value AS metric_value, CAST(tr AS INTEGER) AS train_samples, CAST(te AS INTEGER) AS test_samples,
         CAST({len(_HF_MODEL)} AS INTEGER) AS n_features
  FROM wide UNPIVOT (value FOR name IN (MAE, RMSE, R2)), sizes),
seed AS (
  SELECT m AS model_name, v AS model_version, t AS target, n AS metric_name, CAST(x AS DOUBLE) AS metric_value,
         92870 AS train_samples, 23218 AS test_samples, 71 AS n_features
  FROM (VALUES {_SEED_VALUES}) s(m, v, t, n, x))
SELECT model_name, model_version, target, metric_name, CAST(metric_value AS DECIMAL(10,6)) AS metric_value,
       train_samples, test_samples, n_features
FROM (SELECT * FROM seed UNION ALL SELECT * FROM computed)""")
def a8_model_metrics(spark, sf):
    """A8 + A5: seed rows plus metrics computed by Spark, in the tidy
    ``model_metrics`` shape (here for the lag-1 persistence forecaster)."""
    from .sources.observations import metrics_long
    feats = hourly_features(spark, sf)
    split = hourly_split(spark, sf, feats)
    test = split.filter(~F.col("is_train"))
    m = evaluate.regression_metrics(test, "tempC", "temp_lag_1").select(
        F.col("mae").alias("MAE"), F.col("rmse").alias("RMSE"), F.col("r2").alias("R2"))
    n_train = split.select(F.count_if("is_train")).scalar()
    n_test = split.select(F.count_if(~F.col("is_train"))).scalar()
    n_feat = len(_train_config(feats).features)
    wide = m.select(
        F.lit("Persistence").alias("model_name"), F.lit("v1.0").alias("model_version"),
        F.lit("temperature").alias("target"), n_train.alias("train_samples"), n_test.alias("test_samples"),
        F.lit(n_feat).alias("n_features"), "MAE", "RMSE", "R2")
    long = metrics_long(wide, ["model_name", "model_version", "target", "train_samples", "test_samples",
                               "n_features"], ["MAE", "RMSE", "R2"])
    out = tables.metrics_frame(spark, long)
    return out.select("model_name", "model_version", "target", "metric_name", "metric_value", "train_samples",
                      "test_samples", "n_features")


@register("a9_prediction_logs", with_views("""
SELECT created_at AS requested_at, 'batch' AS endpoint, horizon_hours,
       to_json(struct_pack(humidity_pred := humidity_pred, pressure_pred := pressure_pred, wind_pred := wind_pred))::VARCHAR
         AS input_features,
       TRY_CAST(temp_predicted AS DECIMAL(5,2)) AS temp_out, TRY_CAST(feels_predicted AS DECIMAL(5,2)) AS feels_out,
       TRY_CAST(rain_prob_pct AS DECIMAL(5,2)) AS rain_prob_out, 'xgboost-v1' AS model_version, 'success' AS status
FROM forecasts""", "forecasts"))
def a9_logs(spark, sf):
    f = A.persistence_forecasts(A.obs_hourly(spark, sf)).select(
        "*", F.col("temp_predicted").alias("temperature"), F.col("feels_predicted").alias("feels_like"),
        F.col("rain_prob_pct").alias("rain_probability"))
    logs = tables.prediction_logs(f, ["humidity_pred", "pressure_pred", "wind_pred"], requested_at="created_at")
    return logs.select("requested_at", "endpoint", "horizon_hours", "input_features", "temp_out", "feels_out",
                       "rain_prob_out", "model_version", "status")


@register("b17_forecast_chart_rows", with_views("""
SELECT CASE horizon_hours WHEN 1 THEN '1 Hour' WHEN 3 THEN '3 Hours' WHEN 6 THEN '6 Hours' END AS name,
       temp_predicted AS "Temperature", feels_predicted AS "Feels Like",
       CAST(floor(rain_prob_pct + 0.5) AS BIGINT) AS "Rain %"
FROM forecasts WHERE created_at = (SELECT max(created_at) FROM forecasts) AND horizon_hours IN (1, 3, 6)""",
    "forecasts"))
def b17_chart(spark, sf):
    f = A.persistence_forecasts(A.obs_hourly(spark, sf))
    newest = f.select(F.max("created_at")).scalar()
    std = fc.standard_horizons()
    latest = f.filter((F.col("created_at") == newest) & F.col("horizon_hours").isin(*std))
    pos = F.array_position(F.array(*[F.lit(h) for h in std]), F.col("horizon_hours").cast("int"))
    rows = latest.select(pos.alias("position"), "horizon_hours", F.col("temp_predicted").alias("temperature"),
                         F.col("feels_predicted").alias("feels_like"), F.col("rain_prob_pct").alias("rain_probability"))
    return rules.forecast_chart_rows(rows)


# ----------------------------------------------- sources, model tier, forecasts ---

_OBS_CSV = ("tempC", "precipMM", "humidity", "cloudcover", "FeelsLikeC", "windspeedKmph")


@register("a1_csv_observations", with_views(f"SELECT date_time, pressure, {', '.join(_OBS_CSV)} FROM obs_hourly", "obs_hourly"))
def a1_csv_observations(spark, sf):
    """A1: the hourly observations written as CSV with a header and read back typed."""
    from .sources.materialize import scratch
    from .sources.observations import TIMESTAMP_FORMAT, read_observations
    path = scratch(spark, "observations-csv")
    obs = A.obs_hourly(spark, sf).withColumn("date_time", F.date_format("date_time", TIMESTAMP_FORMAT))
    obs.write.option("header", True).csv(path)
    back = read_observations(spark, path, types={**{c: "double" for c in _OBS_CSV}, "pressure": "bigint"})
    return back.select("date_time", "pressure", *_OBS_CSV)


@register("a3_engineered_round_trip", O.features_query("obs_hourly", O.HOURLY_TYPES, dropna=True))
def a3_engineered_round_trip(spark, sf):
    """A2, A3: the engineered table written by year and month, found and read back in its column order."""
    from .sources.materialize import scratch
    from .sources.observations import load_observations, write_engineered
    folder = scratch(spark, "engineered")
    write_engineered(hourly_features(spark, sf), f"{folder}/engineered")
    return round_doubles(load_observations(spark, folder), 6)


def _first_test_rows(spark, sf, k):
    """The first ``k`` rows after the chronological split of every lineitem row."""
    idx = index.with_row_index(A.obs_rows(spark, sf), "date_time", tiebreak=("location", *A.LINEITEM_TIEBREAK))
    start = idx.select(F.floor(F.count(F.lit(1)) * F.lit(0.8))).scalar()
    head = index.head_after(idx.withColumn("test_start", start), "test_start", k, "row_idx")
    return head.select("row_idx", "date_time", "location", "l_orderkey", "l_linenumber", "tempC")


for _k in (500, 2000, 3000):
    register(f"c7_first_{_k}_test_rows_all", with_views(f"""
, idx AS (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY date_time, location, l_orderkey, l_partkey, l_linenumber,
            l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) - 1 AS row_idx FROM obs_rows)
SELECT row_idx, date_time, location, l_orderkey, l_linenumber, tempC FROM idx
WHERE row_idx >= floor(n * 0.8) AND row_idx < floor(n * 0.8) + {_k}""", "obs_rows"))(
        lambda spark, sf, k=_k: _first_test_rows(spark, sf, k))


@register("f13_residual_pairs", _TEST_SQL + f"""
SELECT date_time, {R('temp_lag_1', 6)} AS prediction, {R('tempC - temp_lag_1', 6)} AS residual FROM test""")
def f13_residual_pairs(spark, sf):
    test = _persistence_eval(spark, sf)
    return round_doubles(test.select("date_time", F.col("temp_lag_1").alias("prediction"),
                                     (F.col("tempC") - F.col("temp_lag_1")).alias("residual")), 6)


def _per_feature(agg: str) -> str:
    inner = ", ".join(f"{agg}(CAST({c} AS DOUBLE)) AS {c}" for c in _HF_MODEL)
    return f"(UNPIVOT (SELECT {inner} FROM split WHERE is_train) ON COLUMNS(*) INTO NAME feature VALUE v)"


@register("f1_feature_scaling", HOURLY_SPLIT_SQL + f"""
SELECT m.feature, {R('m.v', 6)} AS mean, {R('CASE WHEN s.v > 1e-9 THEN s.v ELSE 1.0 END', 6)} AS scale
FROM {_per_feature('avg')} m JOIN {_per_feature('stddev_pop')} s ON m.feature = s.feature""")
def f1_feature_scaling(spark, sf):
    from .plans import training as T
    feats = hourly_features(spark, sf)
    return round_doubles(T.scaling(hourly_split(spark, sf, feats), _train_config(feats).features), 6)


#: Boosting rounds of the registered model queries; the library's defaults are the full settings.
QUERY_ROUNDS = 5

_MEAN_SQL = HOURLY_SPLIT_SQL + """, size AS (
  SELECT count(*) FILTER (WHERE is_train) AS n_train, count(*) FILTER (WHERE NOT is_train) AS n_test,
         avg(tempC) FILTER (WHERE is_train) AS t, avg(FeelsLikeC) FILTER (WHERE is_train) AS f FROM split)"""


def _mean_rmse(data, label):
    """RMSE on the test rows of predicting the train rows' mean."""
    mean = data.filter("is_train").select(F.avg(label)).scalar()
    return data.filter(~F.col("is_train")).select(F.sqrt(F.avg(F.pow(F.col(label) - mean, 2)))).scalar()


def _model_data(spark, sf):
    from .plans import training as T
    feats = hourly_features(spark, sf)
    cfg = _train_config(feats)
    cfg.baseline_iters = cfg.final_iters = QUERY_ROUNDS
    return feats, cfg, T.prepare(feats, cfg)


@register("c6_top20_feature_importance")
def c6_importance(spark, sf):
    """The 20 most important features of the final temperature model (mean split gains)."""
    from .plans import training as T
    _, cfg, data = _model_data(spark, sf)
    return T.feature_importance(T.fit_final(data, cfg, ("temp",))["temp"], cfg.features, 20)


@register("f4_first_round_splits", HOURLY_SPLIT_SQL + f"""

, mean_ AS (SELECT avg(tempC) AS b, count(*) AS n FROM split WHERE is_train),
long_ AS (UNPIVOT (SELECT tempC AS y_, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _HF_MODEL)} FROM split WHERE is_train)
         ON {", ".join(_HF_MODEL)} INTO NAME feature VALUE x),
sorted_ AS (SELECT feature, list(x ORDER BY x) AS l FROM long_ GROUP BY feature),
cuts_ AS (SELECT DISTINCT feature, l[CAST(greatest(1, ceil(i / 256.0 * len(l))) AS INTEGER)] AS c, l[1] AS least
         FROM sorted_, (SELECT unnest(range(256)) AS i)),
sums_ AS (SELECT k.feature, k.c, sum(mean_.b - long_.y_) FILTER (WHERE long_.x < k.c) AS gl, count(*) FILTER (WHERE long_.x < k.c) AS hl,
                sum(mean_.b - long_.y_) AS g, count(*) AS h
         FROM cuts_ k JOIN long_ ON long_.feature = k.feature, mean_ WHERE k.c > k.least GROUP BY k.feature, k.c),
gains_ AS (SELECT *, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) AS gain FROM sums_)
SELECT feature, {R('c', 6)} AS threshold, {R('gain', 4)} AS gain, CAST(hl AS DOUBLE) AS left_hessian FROM gains_
QUALIFY row_number() OVER (PARTITION BY feature ORDER BY round(gain, 7) DESC, c) = 1 AND gain > 1e-7""")
def f4_first_round_splits(spark, sf):
    """for every feature the best first split of a boosted temperature model: threshold, gain and rows to the left."""
    from .operators import boosting
    from .plans import training as T
    _, cfg, data = _model_data(spark, sf)
    found = boosting.root_splits(data.filter("is_train"), cfg.features, cfg.temp, boosting.BoostConfig(**T.BOOST_BASELINE))
    return round_doubles(found.where("gain > 1e-7").withColumn("gain", half_up("gain", 4)), 6)


@register("f2_collinear_predictions", HOURLY_SPLIT_SQL + f"""
, m AS (SELECT avg(humidity) AS a, avg(pressure) AS b, avg(tempC) AS y FROM split WHERE is_train),
s AS (SELECT sum((humidity - a) * (humidity - a)) AS aa, sum((pressure - b) * (pressure - b)) AS bb,
             sum((humidity - a) * (pressure - b)) AS ab, sum((humidity - a) * (tempC - y)) AS ay,
             sum((pressure - b) * (tempC - y)) AS bs FROM split, m WHERE is_train)
SELECT date_time, {R('y + (ay * bb - bs * ab) / (aa * bb - ab * ab) * (humidity - a) + (bs * aa - ay * ab) / (aa * bb - ab * ab) * (pressure - b)', 6)}
       AS prediction FROM split, m, s WHERE NOT is_train""")
def f2_collinear_predictions(spark, sf):
    """least squares on inputs that hang together (a sum, a multiple and a constant among them), the test rows' predictions."""
    from .operators import least_squares
    rows = hourly_split(spark, sf, hourly_features(spark, sf)).withColumns({
        "both": F.col("humidity") + F.col("pressure"), "twice": F.col("pressure") * 2.0, "same": F.lit(5.0)})
    model = least_squares.fit(rows.filter("is_train"), ("humidity", "pressure", "both", "twice", "same"), "tempC")
    return round_doubles(model.transform(rows.filter(~F.col("is_train"))).select("date_time", "prediction"), 6)


@register("m_baselines_against_mean", _MEAN_SQL + f"""
SELECT model, n_train, n_test, CAST({len(_HF_MODEL)} AS INTEGER) AS n_features,
       (SELECT {R('sqrt(avg((tempC - t) * (tempC - t)))', 6)} FROM split, size WHERE NOT is_train) AS mean_rmse, true AS beats_mean
FROM size, (VALUES ('LinearRegression'), ('RandomForest'), ('GBT'), ('GBTLeafwise')) v(model)""")
def m_baselines_against_mean(spark, sf):
    """All four baselines, each against predicting the train mean."""
    from .plans import training as T
    _, cfg, data = _model_data(spark, sf)
    cfg.rf_trees = 20
    base = _mean_rmse(data, cfg.temp)
    metrics = T.baseline_metrics(T.fit_baselines(data, cfg), data, cfg.temp)
    return round_doubles(metrics.select(
        "model", data.select(F.count_if("is_train")).scalar().alias("n_train"), F.col("n").alias("n_test"),
        F.lit(len(cfg.features)).alias("n_features"), base.alias("mean_rmse"), (F.col("rmse") < base).alias("beats_mean")), 6)


@register("m_final_models", _MEAN_SQL + f"""
SELECT 'temp' AS model, n_test, (SELECT {R('sqrt(avg((tempC - t) * (tempC - t)))', 6)} FROM split, size WHERE NOT is_train) AS mean_rmse,
       CAST(20 AS BIGINT) AS n_importances, true AS sound FROM size
UNION ALL SELECT 'feels', n_test, (SELECT {R('sqrt(avg((FeelsLikeC - f) * (FeelsLikeC - f)))', 6)} FROM split, size WHERE NOT is_train), 20, true FROM size
UNION ALL SELECT 'rain', n_test, NULL, 20, true FROM size""")
def m_final_models(spark, sf):
    """The final temperature, feels-like and class-weighted rain models.  Sound:
    better than the train mean on the test rows, and rain probabilities between 0 and 1."""
    from .plans import training as T
    _, cfg, data = _model_data(spark, sf)
    models = T.fit_final(data, cfg)
    test = T.score(models, data.filter(~F.col("is_train")))
    parts = []
    for name, label in (("temp", cfg.temp), ("feels", cfg.feels), ("rain", None)):
        base = _mean_rmse(data, label) if label else F.lit(None).cast("double")
        sound = (F.sqrt(F.avg(F.pow(F.col(label) - F.col(f"{name}_pred"), 2))) < base if label
                 else F.min(F.col("rain_probability").between(0, 1)))
        n = T.feature_importance(models[name], cfg.features, 20).select(F.count(F.lit(1))).scalar()
        parts.append(test.agg(F.count(F.lit(1)).alias("n_test"), sound.alias("sound"))
                     .select(F.lit(name).alias("model"), "n_test", base.alias("mean_rmse"), n.alias("n_importances"), "sound"))
    return round_doubles(parts[0].unionByName(parts[1]).unionByName(parts[2]), 6)


_LAST_SQL = f"""
, {HOURLY_FEATURES_CTE.strip()},
clean AS ({HOURLY_FEATURES_FINAL}),
last AS (SELECT * FROM clean ORDER BY date_time DESC LIMIT 1)"""


@register("g3_scored_forecasts", with_views(_LAST_SQL + """
SELECT h AS horizon_hours, strftime(date_time + h * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS timestamp,
       CAST(trunc(humidity) AS INTEGER) AS humidity, CAST(pressure AS INTEGER) AS pressure,
       CAST(trunc(windspeedKmph) AS INTEGER) AS wind_speed, true AS has_temperature, true AS has_feels_like, true AS probability_sound
FROM (SELECT *, unnest([1, 3, 6]) AS h FROM last)""", "obs_hourly"))
def g3_scored_forecasts(spark, sf):
    """The latest complete row scored by all three final models for the standard horizons."""
    from .plans import training as T
    feats, cfg, data = _model_data(spark, sf)
    out = fc.forecast(feats, T.fit_final(data, cfg), cfg.features, fc.standard_horizons())
    return out.select("horizon_hours", "timestamp", "humidity", "pressure", "wind_speed",
                      F.col("temperature").isNotNull().alias("has_temperature"), F.col("feels_like").isNotNull().alias("has_feels_like"),
                      F.coalesce(F.col("rain_probability").between(0, 100), F.lit(False)).alias("probability_sound"))


@register("g2_absent_features", with_views(_LAST_SQL + f"""
SELECT h AS horizon_hours, CAST(0.0 AS DOUBLE) AS cloudcover, CAST(0.0 AS DOUBLE) AS temp_lag_48, {R('humidity', 6)} AS humidity,
       {R('temp_lag_1', 6)} AS temp_lag_1
FROM (SELECT *, unnest([1, 3, 6]) AS h FROM last)""", "obs_hourly"))
def g2_absent_features(spark, sf):
    """Future rows of a table without two of the model's features get 0.0 for them, the others stay."""
    wanted = ["cloudcover", "temp_lag_48", "humidity", "temp_lag_1"]
    feats = hourly_features(spark, sf).drop("cloudcover", "temp_lag_48")
    rows = fc.with_default_features(fc.future_rows(feats, fc.standard_horizons()), wanted)
    return round_doubles(rows.select("horizon_hours", *wanted), 6)


@register("g6_custom_horizon_rows", with_views(_LAST_SQL + _future_sql("[12]"), "obs_hourly"))
def g6_custom_horizon_rows(spark, sf):
    return round_doubles(fc.future_rows(hourly_features(spark, sf), fc.custom_horizon(12)).select(*_FUTURE_COLS), 6)


@register("g7_fallback_from_latest", with_views("""
SELECT CAST(h AS INTEGER) AS horizon_hours, strftime(t + h * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS timestamp,
       CAST(26.0 AS DOUBLE) AS temperature, CAST(27.0 AS DOUBLE) AS feels_like, CAST(25.0 AS DOUBLE) AS rain_probability,
       CAST(60 AS INTEGER) AS humidity, CAST(1010 AS INTEGER) AS pressure, CAST(10 AS INTEGER) AS wind_speed
FROM (SELECT max(date_time) AS t FROM obs_hourly), (SELECT unnest([1, 3, 6]) AS h)""", "obs_hourly"))
def g7_fallback(spark, sf):
    """The explicit fallback forecast, issued at the latest observation."""
    return fc.fallback(fc.standard_horizons(), A.obs_hourly(spark, sf).select(F.max("date_time")).scalar())

