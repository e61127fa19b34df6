"""Model plan (F1-F16), batch forecasts (G1-G7) and monitoring (H1-H3)."""

import tempfile

import pytest
from pyspark.sql import functions as F

from scales import SF_SMALL
from stratus.catalog import hourly_features
from stratus.operators import evaluate, monitor
from stratus.plans import forecast as fc
from stratus.plans import training as T
from stratus.plans.features import model_features
from stratus.sources import adapters as A


@pytest.fixture(scope="module")
def prepared(spark):
    feats = hourly_features(spark, SF_SMALL)
    cfg = T.TrainConfig(features=model_features(feats), baseline_iters=3, final_iters=3, rf_trees=5)
    return feats, cfg, T.prepare(feats, cfg)


def test_split_sizes(prepared):
    feats, cfg, data = prepared
    n = feats.count()
    assert data.filter("is_train").count() == int(n * 0.8)


def test_baselines_beat_the_mean(prepared):
    feats, cfg, data = prepared
    models = T.fit_baselines(data, cfg)
    metrics = {r.model: r for r in T.baseline_metrics(models, data, cfg.temp).collect()}
    assert set(metrics) == {"LinearRegression", "RandomForest", "GBT", "GBTLeafwise"}
    test = data.filter(~F.col("is_train"))
    mean = data.filter("is_train").agg(F.avg(cfg.temp)).first()[0]
    base = evaluate.regression_metrics(test.withColumn("p", F.lit(mean)), cfg.temp, "p").first().rmse
    assert all(m.rmse <= base for m in metrics.values())


def test_final_models_forecast_and_reload(spark, prepared):
    feats, cfg, data = prepared
    models = T.fit_final(data, cfg)
    out = fc.forecast(feats, models, cfg.features, fc.standard_horizons())
    rows = out.orderBy("horizon_hours").collect()
    assert [r.horizon_hours for r in rows] == [1, 3, 6]
    assert all(0.0 <= r.rain_probability <= 100.0 for r in rows)
    with pytest.raises(ValueError, match="rain"):
        fc.forecast(feats, {k: m for k, m in models.items() if k != "rain"}, cfg.features, [1])
    hourly = fc.forecast(feats, models, cfg.features, fc.hourly_horizons(24))
    assert hourly.count() == 24
    path = tempfile.mkdtemp(prefix="stratus-models-")
    T.save(models, path, cfg.features)
    assert T.load_features(path) == list(cfg.features)
    again = fc.forecast(feats, T.load(path), T.load_features(path), fc.standard_horizons())
    assert [r.temperature for r in again.orderBy("horizon_hours").collect()] == [r.temperature for r in rows]
    imp = T.feature_importance(models["temp"], cfg.features, 20)
    assert imp.count() == 20
    scored = T.score(models, data.filter(~F.col("is_train")))
    cls = evaluate.classification_metrics(scored, cfg.rain, "rain_pred").first()
    assert 0.0 <= cls.f1 <= 1.0


def test_horizon_validation():
    assert fc.standard_horizons(48) == [1, 3, 6]
    assert fc.custom_horizon(12) == [12]
    with pytest.raises(ValueError):
        fc.custom_horizon(2)
    with pytest.raises(ValueError):
        fc.hourly_horizons(49)


def test_future_rows_move_only_calendar_fields(spark):
    feats = hourly_features(spark, SF_SMALL)
    rows = fc.future_rows(feats, [1, 24]).orderBy("horizon_hours").collect()
    last = feats.orderBy(F.col("date_time").desc()).first()
    assert rows[0].temp_lag_1 == last.temp_lag_1 and rows[0].year == last.year
    assert rows[0].day_sin == last.day_sin
    assert rows[1].hour == last.hour  # +24h: same hour of day


def test_fallback_is_explicit(spark):
    out = fc.fallback([1, 3], "2024-01-01 00:00:00").collect()
    assert [r.temperature for r in out] == [26.0, 26.0] and out[1].timestamp == "2024-01-01 03:00:00"


def test_drift_flags(spark):
    h = A.obs_hourly(spark, SF_SMALL)
    filled = monitor.backfill_actuals(A.persistence_forecasts(h), h)
    drift = monitor.weekly_drift(filled, 0.0).collect()
    assert drift and all(r.drift for r in drift if r.mae > 0)
    pending = filled.filter(F.col("forecast_for") > h.agg(F.max("date_time")).first()[0])
    assert pending.filter(F.col("temp_actual").isNotNull()).count() == 0
