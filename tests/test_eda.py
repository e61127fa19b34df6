"""Statistics edge cases against pandas semantics."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd

from stratus.operators import eda, summary


def _series(spark, values, start=datetime(2024, 1, 1), step=timedelta(hours=1)):
    rows = [(start + i * step, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "date_time timestamp_ntz, tempC double")


def test_constant_column_correlation_is_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "tempC double, c double")
    out = {r.column: r.r for r in eda.correlations_with(df, "tempC", ["tempC", "c"]).collect()}
    assert out["c"] is None and abs(out["tempC"] - 1.0) < 1e-12


def test_correlation_is_pairwise_complete(spark):
    pdf = pd.DataFrame({"tempC": [1.0, 2.0, 3.0, 4.0, 5.0], "x": [2.0, None, 1.0, 7.0, 3.0]})
    df = spark.createDataFrame(pdf)
    got = {r.column: r.r for r in eda.correlations_with(df, "tempC", ["x"]).collect()}["x"]
    assert abs(got - pdf.corr()["tempC"]["x"]) < 1e-12


def test_empty_and_one_row(spark):
    empty = _series(spark, [])
    assert eda.overview(empty).collect()[0].n_rows == 0
    assert eda.monthly_temperature(empty).count() == 0
    one = _series(spark, [3.0])
    r = eda.hourly_profile(one).collect()[0]
    assert r.mean == 3.0 and r.std is None


def test_all_null_column_counts(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None)], "a double, b string")
    got = {r.column: r.n_missing for r in eda.null_counts(df).collect()}
    assert got == {"a": 1, "b": 2}


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "a int, b string")
    assert eda.duplicate_count(df).collect()[0].n_duplicates == 2


def test_describe_matches_pandas(spark):
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([(v,) for v in vals], "tempC double")
    got = eda.describe(df, ["tempC"]).collect()[0]
    exp = pd.Series(vals).describe().round(2)
    assert (got["count"], got.mean, got.std, got.min, got.p25, got.p50, got.p75, got.max) == (
        8, exp["mean"], exp["std"], exp["min"], exp["25%"], exp["50%"], exp["75%"], exp["max"])


def test_weekly_resample_emits_empty_weeks(spark):
    # two observations three weeks apart: the middle weeks are empty
    start = datetime(2024, 1, 3)
    df = spark.createDataFrame([(start, 10.0, 50.0, 1.0), (start + timedelta(days=21), 20.0, 60.0, 2.0)],
                               "date_time timestamp_ntz, tempC double, humidity double, precipMM double")
    got = [(r.week, r.avg_temp, r.total_rain) for r in eda.weekly_resample(df).orderBy("week").collect()]
    pdf = df.toPandas().set_index("date_time")
    exp_t, exp_r = pdf["tempC"].resample("W").mean(), pdf["precipMM"].resample("W").sum()
    assert [g[0] for g in got] == [d.date() for d in exp_t.index]
    assert [g[1] for g in got][1:3] == [None, None]
    assert [g[2] for g in got] == list(exp_r.values)


def test_histogram_closed_last_bin_and_constant(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "x double")
    h = eda.histogram(df, "x", 5).orderBy("bin").collect()
    counts, edges = np.histogram([0.0, 1.0, 10.0], bins=5)
    assert [r["count"] for r in h] == list(counts)
    assert [r.lower for r in h] == list(edges[:-1])
    const = eda.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x", 50).collect()
    counts_c, _ = np.histogram([2.0, 2.0], bins=50)
    assert [r["count"] for r in sorted(const, key=lambda r: r.bin)] == list(counts_c)


def test_class_weight_without_positives_is_null(spark):
    df = spark.createDataFrame([(0, True), (0, True)], "will_rain int, is_train boolean")
    assert summary.class_balance_weight(df).collect()[0].scale_pos_weight is None


def test_monthly_groups_drop_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0, 5.0), (datetime(2024, 10, 1), 2.0, 6.0)],
                               "date_time timestamp_ntz, tempC double, humidity double")
    assert [r.month for r in eda.monthly_temperature(df).collect()] == [10]
    season = summary.seasonal_summary(df).collect()
    assert [(r.season, r.avg_temp) for r in season] == [("Post-Monsoon", 2.0)]


def test_describe_sketch_is_close(spark):
    df = spark.range(0, 10001).selectExpr("cast(id as double) / 100 as tempC")
    exact = eda.describe(df, ["tempC"]).first()
    approx = eda.describe(df, ["tempC"], relative_error=1e-3).first()
    assert abs(exact.p50 - approx.p50) <= 0.1 and abs(exact.p75 - approx.p75) <= 0.1


def test_describe_skips_nan_like_pandas(spark):
    vals = [1.0, float("nan"), 3.0, 4.0]
    df = spark.createDataFrame([(v,) for v in vals], "tempC double")
    got = eda.describe(df, ["tempC"]).collect()[0]
    exp = pd.Series(vals).describe().round(2)
    assert (got["count"], got.mean, got.std, got.min, got.p50, got.max) == (
        exp["count"], exp["mean"], exp["std"], exp["min"], exp["50%"], exp["max"])
