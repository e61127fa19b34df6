"""Operators that moved to less data: brackets for quantiles, hashes for duplicates, one co-moment matrix, latest row without a sort."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratus.operators import eda, index, moments, quantiles
from stratus.operators.quantiles import brackets, exact_quantiles


@pytest.mark.parametrize("sketch", [10_000, 100])
def test_bracketed_quantiles_are_exact(spark, monkeypatch, sketch):
    monkeypatch.setattr(quantiles, "SKETCH", sketch)
    monkeypatch.setattr(quantiles, "MARGIN", 3 / sketch)
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=30_000), np.full(9_000, 0.25), rng.integers(0, 5, 2_000)])
    y = rng.exponential(size=len(x)).round(3)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y})).repartition(5)
    qs = (0.0, 0.0001, 0.01, 0.25, 0.5, 0.75, 0.99, 0.9999, 1.0)
    got = {(r.column, r.q): r.value for r in exact_quantiles(df, ["x", "y"], qs).collect()}
    for c, v in (("x", x), ("y", y)):
        for q in qs:
            assert got[c, q] == pytest.approx(np.quantile(v, q), abs=1e-12)
    each = np.unique(x)  # ties are one row
    inside = [np.mean((each >= low) & (each <= high)) for c, q, _, low, high in brackets(df, ["x"], [0.01, 0.99])]
    assert max(inside) < 10 / sketch


def test_duplicates_compare_by_value(spark):
    nan = float("nan")
    rows = [(1, None, nan, "a"), (1, None, nan, "a"), (None, 1, nan, "a"), (None, None, 0.0, ""), (None, None, -0.0, ""),
            (None, None, 0.0, None), (2, 2, 1.0, "b"), (2, 2, 1.0, "b"), (2, 2, 1.0, "b")]
    df = spark.createDataFrame(rows, "a int, b int, _hash_a double, d string")
    want = df.groupBy(*df.columns).count().agg(F.sum(F.col("count") - 1)).first()[0]
    assert eda.duplicate_count(df).first()[0] == want == 4
    assert eda.duplicate_count(df.limit(0)).first()[0] == 0
    assert eda.duplicate_count(df.distinct()).first()[0] == 0


def test_wide_correlations_equal_pandas(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 50)) @ rng.normal(size=(50, 50)) + 1e6 * rng.normal(size=50)
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 7], x[:, 9] = 0.1, np.nan
    frame = pd.DataFrame(x, columns=[f"c{i}" for i in range(50)])
    df = spark.createDataFrame(frame).repartition(7)
    got = {(r.x, r.y): (r.n, r.r) for r in moments.pairwise_correlations(df, df.columns).collect()}
    want = frame.corr()
    assert len(got) == 2500
    for (a, b), (n, r) in got.items():
        assert n == (frame[a].notna() & frame[b].notna()).sum()
        if {a, b} & {"c7", "c9"}:
            assert r is None
        else:
            assert r == pytest.approx(want.loc[a, b], abs=1e-9)
    none = eda.correlation_matrix(df.limit(0), ("c0", "c1", "c2"))
    assert [r.r for r in none.collect()] == [None] * 3


def test_latest_by_key_without_sorting_all_rows(spark):
    rows = [("a", 1, 1, "old"), ("a", 5, 1, "x"), ("a", 5, 2, "last"), ("b", None, 1, "p"), ("b", None, 3, "q"), (None, 2, 1, "n"),
            (None, 3, 0, "m"), ("c", 9, None, "only")]
    df = spark.createDataFrame(rows, "k string, ts int, tie int, _nth string")
    out = index.latest(df, "ts", "k", "tie")
    assert sorted(((r["k"] or "", r["_nth"]) for r in out.collect())) == [("", "m"), ("a", "last"), ("b", "q"), ("c", "only")]
    plan = out._jdf.queryExecution().toString()  # the query execution that collect() ran
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert index.latest(df, "ts", None, "tie").first()["_nth"] == "only"
