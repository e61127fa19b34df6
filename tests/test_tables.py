"""Typed tables, load rules, sinks and the streaming load."""

import json
import os
import tempfile
from datetime import datetime

from pyspark.sql import functions as F

from stratus.sources import observations, tables
from stratus.streaming import ingest


def test_conform_weather_history_rules(spark):
    df = spark.createDataFrame([
        (datetime(2024, 1, 1), 20.0, 50.0, 10.0, 361.0, 50.0),
        (datetime(2024, 1, 1), None, 50.0, 0.0, 10.0, 50.0),
        (datetime(2024, 1, 1), 20.0, 101.0, 0.0, 10.0, 50.0),
        (datetime(2024, 1, 1), 20.0, None, None, None, None),
    ], "recorded_at timestamp_ntz, temp_c double, humidity double, precip_mm double, wind_dir_deg double, "
       "cloud_cover_pct double")
    out = tables.conform_weather_history(df).collect()
    assert [r.rejection for r in out] == ["wind_dir_deg out of range", "temp_c missing", "humidity out of range", None]
    assert out[3].precip_mm == 0 and out[3].location == tables.DEFAULT_LOCATION
    assert str(tables.conform_weather_history(df).schema["temp_c"].dataType) == "DecimalType(5,2)"


def test_conform_forecasts_horizons(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), h, 20.0) for h in (1, 2, 24, 48)],
                               "forecast_for timestamp_ntz, horizon_hours int, temp_predicted double")
    out = tables.conform_forecasts(df).collect()
    assert [r.rejection is None for r in out] == [True, False, True, False]
    assert {r.model_version for r in out} == {tables.DEFAULT_MODEL_VERSION}


def test_metrics_frame_and_logs(spark):
    m = tables.metrics_frame(spark)
    assert m.count() == 13 and str(m.schema["metric_value"].dataType) == "DecimalType(10,6)"
    scored = spark.createDataFrame([(1, 20.04, 21.0, 33.3, 1.5, 2.0)],
                                   "horizon_hours int, temperature double, feels_like double, "
                                   "rain_probability double, f1 double, f2 double")
    log = tables.prediction_logs(scored, ["f1", "f2"]).collect()[0]
    assert json.loads(log.input_features) == {"f1": 1.5, "f2": 2.0} and log.status == "success"


def test_csv_source_casts_by_header(spark):
    d = tempfile.mkdtemp(prefix="stratus-csv-")
    path = os.path.join(d, "raw.csv")
    with open(path, "w") as f:
        f.write("tempC,date_time,precipMM,location\n25,2022-03-11 23:00:00,0.5,x\nbad,2022-03-11 22:00:00,,x\n")
    df = observations.read_observations(spark, path)
    rows = df.orderBy("date_time").collect()
    assert rows[1].tempC == 25 and rows[0].tempC is None and rows[1].precipMM == 0.5
    assert df.schema["date_time"].dataType.typeName() == "timestamp_ntz"
    out = os.path.join(d, "eng")
    feats = df.withColumn("year", F.year("date_time")).withColumn("month", F.month("date_time"))
    observations.write_engineered(feats, out)
    assert os.path.isdir(os.path.join(out, "year=2022", "month=3"))
    assert observations.load_observations(spark, d, engineered="eng").count() == 2


def test_streaming_load_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="stratus-stream-")
    src = os.path.join(d, "in")
    df = spark.createDataFrame([(datetime(2024, 1, 1, h), 20.0 + h, float(h * 10), 0.0) for h in range(12)],
                               "recorded_at timestamp_ntz, temp_c double, humidity double, precip_mm double")
    df.write.parquet(src)
    q = ingest.load_weather_history(spark, src, df.schema, os.path.join(d, "ok"), os.path.join(d, "bad"),
                                    os.path.join(d, "ckpt"))
    q.awaitTermination(120)
    ok = spark.read.parquet(os.path.join(d, "ok")).count()
    bad = spark.read.parquet(os.path.join(d, "bad")).count()
    assert (ok, bad) == (11, 1)  # humidity 110 violates the 0-100 check


def test_replayed_batch_is_not_loaded_twice(spark):
    d = tempfile.mkdtemp(prefix="stratus-replay-")
    df = spark.createDataFrame([(datetime(2024, 1, 1, h), 20.0 + h, float(h * 10), 0.0) for h in range(12)],
                               "recorded_at timestamp_ntz, temp_c double, humidity double, precip_mm double")
    batch = tables.conform_weather_history(df, "here")
    ok, bad = os.path.join(d, "ok"), os.path.join(d, "bad")
    for epoch in (0, 0, 1):  # batch 0 replayed after a failure, then batch 1
        ingest.write_split(batch, epoch, ok, bad)
    counts = {r.load_batch: r["count"] for r in spark.read.parquet(ok).groupBy("load_batch").count().collect()}
    assert counts == {0: 11, 1: 11}
    assert spark.read.parquet(bad).count() == 2


def test_materialize_and_cleanup(spark):
    from stratus.sources.materialize import cleanup, materialize
    df = materialize(spark.range(5), "unit")
    assert df.count() == 5
    assert cleanup(spark) >= 1
