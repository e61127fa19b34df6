"""Distributed exact quantiles against numpy / Spark's single-task percentile."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.operators import eda
from stratus.operators.quantiles import exact_quantiles

QS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)


def _frame(spark, values, parts):
    rows = [(float(v),) for v in values]
    return spark.createDataFrame(rows, "x double").repartition(parts)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_matches_numpy_with_hot_value_and_ties(spark, parts):
    rng = np.random.default_rng(7)
    # a third of all rows share one value; the rest has many ties
    vals = np.concatenate([np.full(700, 12.5), rng.integers(0, 300, 1400) / 4.0])
    df = _frame(spark, vals, parts)
    got = {r.q: r.value for r in exact_quantiles(df, ["x"], QS).collect()}
    for q in QS:
        assert got[q] == pytest.approx(np.quantile(vals, q, method="linear"), abs=1e-9)


def test_equals_spark_percentile_on_several_columns(spark):
    df = spark.range(0, 5003, numPartitions=7).select(
        (F.col("id") % 97 / 3).alias("a"), (F.col("id") * 7 % 1013).cast("double").alias("b"))
    got = {(r.column, r.q): r.value for r in exact_quantiles(df, ["a", "b"], (0.25, 0.5, 0.9)).collect()}
    ref = df.agg(*[F.percentile(c, q).alias(f"{c}_{q}") for c in "ab" for q in (0.25, 0.5, 0.9)]).first()
    for c in "ab":
        for q in (0.25, 0.5, 0.9):
            assert got[(c, q)] == pytest.approx(ref[f"{c}_{q}"], abs=1e-9)


def test_nulls_nan_single_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), None), (3.0, None)], "x double, y double")
    got = {(r.column, r.q): r.value for r in exact_quantiles(df, ["x", "y"], (0.5,)).collect()}
    assert got == {("x", 0.5): 2.0}  # y has no values: no row
    assert eda.quantile(df, "y", 0.5).first()[0] is None
    one = spark.createDataFrame([(4.0,)], "x double")
    assert eda.quantile(one, "x", 0.99).first()[0] == 4.0
