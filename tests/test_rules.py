"""Row rules and rounding edge cases."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratus.functions import calendar as cal
from stratus.functions import rules
from stratus.functions.rounding import half_even, half_up, js_round


def test_condition_label_order_and_thresholds(spark):
    rows = [(20.0, 50, 0.6), (20.0, 81, 0.5), (36.0, 80, 0.0), (35.0, 10, 0.0), (28.5, 10, None), (28.0, None, 0.0),
            (None, None, None)]
    df = spark.createDataFrame(rows, "t double, h int, r double")
    got = [r.c for r in df.select(rules.condition_label("t", "h", "r").alias("c")).collect()]
    assert got == ["Rainy", "Cloudy", "Hot & Sunny", "Warm", "Warm", "Clear & Pleasant", "Clear & Pleasant"]


def test_rain_thresholds(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.10001,), (0.5,), (1.0,), (None,), (-1.0,)], "p double")
    out = df.select(rules.rain_label("p").alias("y"), rules.rain_banner("p").alias("b"),
                    rules.rain_bucket("p").alias("k")).collect()
    assert [r.y for r in out] == [0, 0, 1, 1, 1, 0, 0]
    assert [r.b for r in out] == ["no_rain", "rain", "rain", "rain", "rain", None, None]
    assert [r.k for r in out] == ["low", "low", "low", "medium", "medium", "low", "low"]


def test_rain_risk_is_strict(spark):
    df = spark.createDataFrame([(40.0, 31.0), (40.01, 20.0), (10.0, 30.0)], "p double, t double")
    out = df.select(rules.rain_risk("p").alias("r"), rules.hourly_icon("p", "t").alias("i")).collect()
    assert [r.r for r in out] == [False, True, False]
    assert [r.i for r in out] == ["sun", "rain", "partly_sunny"]


def test_rounding_modes(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (2.5,), (-2.5,), (0.285,), (2.675,)], "x double")
    out = df.select(half_up("x", 2).alias("u"), half_even("x", 2).alias("e"), half_even("x", 0).alias("e0"),
                    js_round("x").alias("j")).collect()
    assert [r.u for r in out] == [0.13, 0.14, 2.5, -2.5, 0.29, 2.68]
    assert [r.e for r in out] == [0.12, 0.14, 2.5, -2.5, 0.28, 2.68]
    assert [r.e0 for r in out] == [0.0, 0.0, 2.0, -2.0, 0.0, 3.0]
    assert [r.j for r in out] == [0, 0, 3, -2, 0, 3]


def test_calendar_parts_and_seasons(spark):
    ts = [datetime(2024, 1, 1, 5), datetime(2024, 10, 6, 23), datetime(2023, 6, 30, 0)]
    df = spark.createDataFrame([(t,) for t in ts], "date_time timestamp_ntz")
    out = cal.season_flags(cal.cyclical(cal.time_parts(df))).collect()
    assert [(r.hour, r.day, r.month, r.weekday, r.quarter, r.year) for r in out] == [
        (5, 1, 1, 0, 1, 2024), (23, 6, 10, 6, 4, 2024), (0, 30, 6, 4, 2, 2023)]
    assert [(r.is_summer, r.is_monsoon, r.is_winter) for r in out] == [(0, 0, 1), (0, 0, 0), (0, 1, 0)]
    assert out[2].month_cos == pytest.approx(-1.0)


def test_month_names_and_dashboard_season(spark):
    df = spark.range(0, 14).select(F.col("id").cast("int").alias("m"))
    out = df.select(cal.month_name("m").alias("n"), cal.dashboard_season("m").alias("s")).collect()
    assert [r.n for r in out][:3] == [None, "Jan", "Feb"] and out[13].n is None
    assert [r.s for r in out][10:12] == ["Post-Monsoon", "Post-Monsoon"]


def test_interactions_do_not_overflow(spark):
    df = spark.createDataFrame([(2_000_000_000, 2, 1.5)], "a int, b int, c double")
    out = rules.interactions(df, (("ab", "a", "b"), ("ac", "a", "c"))).collect()[0]
    assert out.ab == 4_000_000_000 and out.ac == 3_000_000_000.0


def test_current_conditions_defaults_only_for_absent_columns(spark):
    df = spark.createDataFrame([(datetime(2022, 3, 11, 23), 25.9, None, -3.7)],
                               "date_time timestamp_ntz, tempC double, humidity int, precipMM double")
    row = df.select(*rules.current_conditions(df)).collect()[0]
    assert row.temperature == 25 and row.humidity is None and row.pressure == 1010
    assert row.precipitation == -3.7 and row.timestamp == "2022-03-11 23:00:00"


def test_forecast_chart_rows(spark):
    df = spark.createDataFrame([(1, 1, 20.0, 21.0, 40.5), (2, 3, 20.0, 21.0, 2.5), (4, 12, 1.0, 1.0, -0.5)],
                               "position int, horizon_hours int, temperature double, feels_like double, "
                               "rain_probability double")
    out = rules.forecast_chart_rows(df).collect()
    assert [r.name for r in out] == ["1 Hour", "3 Hours", "12h"]
    assert [r["Rain %"] for r in out] == [41, 3, 0]
