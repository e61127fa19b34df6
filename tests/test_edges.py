"""Wrong or missing values at the edges: NaN, overflow, shifted files, repeated observations, gaps."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.functions import rules
from stratus.operators import eda, monitor, summary
from stratus.plans.features import engineer, model_features
from stratus.sources import adapters as A
from stratus.sources import observations as O
from stratus.sources import tables

BASE = datetime(2024, 6, 3)
NAN = float("nan")


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_hourly_adapter_is_alive_at_every_scale(spark, sf):
    h = A.obs_hourly(spark, f"/root/testdata/sf{sf}")
    r = h.agg(F.count_if(F.col("precipMM") > 0.1).alias("wet"), F.count_if(F.col("precipMM") <= 0.1).alias("dry"),
              F.stddev("humidity").alias("hum"), F.stddev("cloudcover").alias("cloud"), F.stddev("FeelsLikeC").alias("feels"),
              F.min("humidity").alias("lo"), F.max("humidity").alias("hi"), F.max("precipMM").alias("most")).first()
    assert r["wet"] > 50 and r["dry"] > 50
    assert min(r["hum"], r["cloud"], r["feels"]) > 0.5
    assert 0 <= r["lo"] and r["hi"] <= 100 and r["most"] <= 16


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_daily_rain_means_the_same_at_every_scale(spark, sf):
    d = A.obs_daily(spark, f"/root/testdata/sf{sf}")
    r = d.agg(F.avg((F.col("precipMM") > 0.1).cast("int")).alias("wet"), F.max("precipMM").alias("most")).first()
    assert 0.05 < r["wet"] < 0.75 and r["most"] <= 20


@pytest.fixture(scope="module")
def with_nan(spark):
    rows = [(BASE + timedelta(hours=i), t, 50.0, p, 1000.0) for i, (t, p) in enumerate([(10.0, NAN), (NAN, 0.0), (30.0, 2.0)])]
    return spark.createDataFrame(rows, "date_time timestamp_ntz, tempC double, humidity double, precipMM double, pressure double")


@pytest.mark.parametrize("run,want", [
    (lambda d: eda.rain_stats(d), {"rain_hours": 1, "heavy_rain_hours": 1, "max_precip": 2.0, "avg_precip": 1.0, "rain_share": 1 / 3}),
    (lambda d: eda.monsoon_share(d), {"monsoon_share_pct": 100.0}),
    (lambda d: eda.monthly_temperature(d), {"mean": 20.0, "min": 10.0, "max": 30.0}),
    (lambda d: eda.monthly_means(d), {"tempC": 20.0, "precipMM": 1.0}),
    (lambda d: eda.weekly_resample(d), {"avg_temp": 20.0, "total_rain": 2.0}),
    (lambda d: eda.hourly_profile(d).where("hour = 0"), {"mean": 10.0}),
    (lambda d: summary.api_monthly(d), {"avg_temp": 20.0, "avg_rain": 1.0}),
    (lambda d: summary.api_yearly(d), {"avg_temp": 20.0, "total_rain": 2.0}),
    (lambda d: summary.dashboard_stats(d), {"temp_mean": 20.0, "temp_max": 30.0, "rain_probability": 33.33}),
    (lambda d: summary.dashboard_monthly(d), {"avg_temp": 20.0, "avg_rain": 1.0}),
    (lambda d: summary.seasonal_summary(d), {"avg_temp": 20.0})])
def test_nan_is_missing_in_every_statistic(with_nan, run, want):
    got = run(with_nan).first().asDict()
    for k, v in want.items():
        assert got[k] == pytest.approx(v), k


def test_nan_in_correlations_and_rules(spark, with_nan):
    more = with_nan.union(spark.createDataFrame([(BASE, 20.0, 60.0, 1.0, 990.0), (BASE, 25.0, 70.0, 1.5, 980.0)], with_nan.schema))
    r = {x["column"]: x["r"] for x in eda.correlations_with(more).collect()}
    want = np.corrcoef([30, 20, 25], [2, 1, 1.5])[0, 1]
    assert r["precipMM"] == pytest.approx(want)
    first = with_nan.orderBy("date_time").select(
        rules.rain_label().alias("label"), rules.condition_label().alias("c"), rules.rain_risk("precipMM").alias("risk"),
        rules.rain_bucket("precipMM").alias("b"), rules.rain_banner("precipMM").alias("banner")).first()
    assert (first["label"], first["c"], first["risk"], first["b"], first["banner"]) == (0, "Clear & Pleasant", False, "low", None)


def test_files_of_another_column_order_fail_the_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date_time,tempC,humidity\n2024-01-01 00:00:00,26,60\n")
    assert O.read_observations(spark, str(tmp_path / "*.csv")).first()["tempC"] == 26
    (tmp_path / "b.csv").write_text("date_time,humidity,tempC\n2024-01-01 01:00:00,60,26\n")
    with pytest.raises(Exception, match="header|schema"):
        O.read_observations(spark, str(tmp_path / "*.csv")).collect()


def test_engineered_table_keeps_its_column_order(spark, tmp_path):
    feats = engineer(A.obs_hourly(spark, "/root/testdata/sf0.001"))
    O.write_engineered(feats, str(tmp_path / "engineered"))
    back = O.load_observations(spark, str(tmp_path))
    assert back.columns == feats.columns and model_features(back) == model_features(feats)
    (tmp_path / "engineered" / "_SUCCESS").unlink()
    (tmp_path / "raw.csv").write_text("date_time,tempC\n2024-01-01 00:00:00,1\n")
    assert O.load_observations(spark, str(tmp_path)).columns == ["date_time", "tempC"]


def test_values_that_fit_no_column_are_rejected(spark):
    rows = [(BASE, "20", "99999", "5"), (BASE, "20", "abc", "5"), (BASE, "20", "50", "1234567"), (BASE, "20", None, None), (BASE, "20", "50", "1")]
    df = spark.createDataFrame(rows, "recorded_at timestamp_ntz, temp_c string, humidity string, feels_like_c string")
    got = [r["rejection"] for r in tables.conform_weather_history(df).collect()]
    assert got == ["humidity not representable", "humidity not representable", "feels_like_c not representable", None, None]


def test_backfill_without_feels_and_with_repeated_observations(spark):
    f = spark.createDataFrame([(BASE, BASE + timedelta(hours=1), 1, 10.0)],
                              "created_at timestamp_ntz, forecast_for timestamp_ntz, horizon_hours int, temp_predicted double")
    obs = spark.createDataFrame([(BASE + timedelta(hours=1), 12.0, 0.0), (BASE + timedelta(hours=1), 14.0, 0.3)],
                                "date_time timestamp_ntz, tempC double, precipMM double")
    got = monitor.backfill_actuals(f, obs).collect()
    assert len(got) == 1 and float(got[0]["temp_actual"]) == 13.0 and got[0]["feels_actual"] is None and got[0]["rained_actual"]


def test_drift_needs_the_week_before(spark):
    rows = [(datetime(2024, 1, 3), 1, 1.0), (datetime(2024, 1, 31), 1, 3.0), (datetime(2024, 2, 7), 1, 6.0)]
    df = spark.createDataFrame(rows, "forecast_for timestamp_ntz, horizon_hours int, temp_error double")
    got = [(r["prev_mae"], r["drift"]) for r in monitor.weekly_drift(df, 100.0).orderBy("week").collect()]
    assert got == [(None, False), (None, False), (3.0, True)]


def test_histogram_equals_numpy_on_inner_edges(spark):
    values = [round(0.2 + 0.1 * i, 1) for i in range(176)]
    got = [r["count"] for r in eda.histogram(spark.createDataFrame([(v,) for v in values], "x double"), "x", 50).orderBy("bin").collect()]
    assert got == np.histogram(values, 50)[0].tolist()


def test_partition_count_for_a_hundred_terabytes():
    from stratus import session
    assert -(-100 * 10**12 // session.DEFAULT_INPUT_BYTES_PER_PARTITION) <= session.MAX_SHUFFLE_PARTITIONS
