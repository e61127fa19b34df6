"""Rounding in doubles gives what the decimal gives."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.functions import rounding


@pytest.mark.parametrize("digits", [0, 1, 2, 6, 8])
def test_every_value_as_the_decimal_rounds_it(spark, digits):
    rng = np.random.default_rng(digits)
    unit = 10.0 ** -digits
    whole = rng.integers(-10**6, 10**6, 3000) * unit
    x = np.concatenate([whole, whole + 0.5 * unit, whole + 0.49999 * unit, whole + 0.500001 * unit, rng.normal(size=5000),
                        rng.normal(size=2000) * 1e7, [0.0, -0.0, 0.285, -0.285, 0.49999999996, 1e6, 999999.9999995, 1e15, -3e-7, 5e-324]])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    for ours, theirs in ((rounding.half_up, F.round), (rounding.half_even, F.bround)):
        want = theirs(F.col("x").cast("decimal(38,10)"), digits).cast("double")
        rows = df.select("x", ours("x", digits).alias("got"), want.alias("want")).collect()
        assert [r for r in rows if str(r["got"]) != str(r["want"])] == []


def test_other_types(spark):
    df = spark.sql("SELECT 7L AS a, cast(1.005 AS decimal(10,3)) AS b, 2.5f AS c, cast(NULL AS int) AS d")
    assert tuple(df.select(rounding.half_up("a", 1), rounding.half_up("b", 2), rounding.half_even("c", 0), rounding.half_up("d", 1)).first()) \
        == (7.0, 1.01, 2.0, None)


def test_most_values_stay_doubles(spark):
    """the decimal is only a branch."""
    plan = spark.range(1).select((F.col("id") / 3).alias("x")).select(rounding.half_up("x", 6))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and "decimal(38,10)" in plan
