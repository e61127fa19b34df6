"""The boosting learner against a plain-Python build, and least squares against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.operators import boosting as B
from stratus.operators import least_squares as LS

FEATURES = ["a", "b", "c", "d"]


def rows_of(n, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 2)
    x[:, 3] = rng.integers(0, 3, n)
    y = 3 * np.sin(2 * x[:, 0]) + x[:, 1] * x[:, 3] + rng.normal(scale=0.1, size=n)
    return x, y


@pytest.fixture(scope="module")
def table(spark):
    x, y = rows_of(700)
    rows = [(*map(float, r), float(v), int(v > 0.5), 1.0 + (i % 3)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y double, k int, w double").repartition(3)


def plain_tree(x, g, h, cuts, cfg):
    """(leaf value of each row, splits as (rows, feature, threshold) in the order taken), one leaf at a time."""
    def best(rows):
        base = g[rows].sum() ** 2 / (h[rows].sum() + cfg.l2)
        found = None
        for f in range(x.shape[1]):
            for c in cuts[f]:
                low = x[rows, f] < c
                gl, hl, gr, hr = g[rows][low].sum(), h[rows][low].sum(), g[rows][~low].sum(), h[rows][~low].sum()
                if min(hl, hr) < cfg.min_hessian:
                    continue
                gain = gl * gl / (hl + cfg.l2) + gr * gr / (hr + cfg.l2) - base
                if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                    found = gain, f, float(c), rows[low], rows[~low]
        return found

    leaves = [(0, np.arange(len(g)))]
    splits, final = [], []
    while leaves and (cfg.leaves is None or len(leaves) + len(final) < cfg.leaves):
        options = [(i, best(rows)) for i, (d, rows) in enumerate(leaves) if d < cfg.depth]
        options = [(i, s) for i, s in options if s]
        if not options:
            break
        i, s = options[0] if cfg.leaves is None else max(options, key=lambda o: o[1][0])
        d, rows = leaves.pop(i)
        splits.append((len(rows), s[1], s[2]))
        if cfg.leaves is None:  # breadth first
            leaves += [(d + 1, s[3]), (d + 1, s[4])]
            while leaves and (leaves[0][0] >= cfg.depth or not best(leaves[0][1])):
                final.append(leaves.pop(0))
        else:
            leaves += [(d + 1, s[3]), (d + 1, s[4])]
    value = np.zeros(len(g))
    for _, rows in leaves + final:
        value[rows] = -g[rows].sum() / (h[rows].sum() + cfg.l2) * cfg.rate
    return value, splits


@pytest.mark.parametrize("cfg", [
    B.BoostConfig(rounds=3, depth=3, rate=0.3, subsample=1.0, colsample=1.0),
    B.BoostConfig(rounds=3, depth=5, rate=0.3, subsample=1.0, colsample=1.0, leaves=7, l2=0.0, min_hessian=20.0),
    B.BoostConfig(rounds=2, depth=3, rate=0.5, subsample=1.0, colsample=1.0, objective="logistic", l2=1.0)])
def test_trees_equal_a_plain_build(table, cfg):
    logistic = cfg.objective == "logistic"
    model = B.fit(table, FEATURES, "k" if logistic else "y", cfg, "w" if logistic else None, probability="p")
    got = model.transform(table).collect()
    x = np.array([[r[c] for c in FEATURES] for r in got])
    y = np.array([r["k" if logistic else "y"] for r in got], dtype=float)
    w = np.array([r["w"] for r in got]) if logistic else np.ones(len(y))
    cuts = B.cut_points(table, FEATURES)
    margin = np.full(len(y), model.base)
    for t in model.trees:
        p = 1 / (1 + np.exp(-margin))
        g, h = (w * (p - y), w * p * (1 - p)) if logistic else (margin - y, np.ones(len(y)))
        value, splits = plain_tree(x, g, h, cuts, cfg)
        mine = [(f, c) for f, c in zip(t.feature, t.threshold) if f >= 0]
        assert sorted(mine) == sorted((f, c) for _, f, c in splits)
        margin += value
    want = 1 / (1 + np.exp(-margin)) if logistic else margin
    assert np.allclose([r["p" if logistic else "prediction"] for r in got], want, atol=1e-9)
    if cfg.leaves:
        assert all(sum(f < 0 for f in t.feature) <= cfg.leaves for t in model.trees)


def test_growth_rules_differ_and_folding_changes_nothing(table, monkeypatch):
    base = dict(rounds=5, depth=4, rate=0.3, subsample=0.7, colsample=0.5)
    level = B.fit(table, FEATURES, "y", B.BoostConfig(**base))
    first = B.fit(table, FEATURES, "y", B.BoostConfig(**base, leaves=5))
    assert [t.feature for t in level.trees] != [t.feature for t in first.trees]
    assert all(len({f for f in t.feature if f >= 0}) <= 2 for t in level.trees)  # half of the four columns
    monkeypatch.setattr(B, "FOLD", 2)
    again = B.fit(table, FEATURES, "y", B.BoostConfig(**base))
    assert [(t.feature, t.cut) for t in again.trees] == [(t.feature, t.cut) for t in level.trees]
    assert np.allclose(again.trees[-1].value, level.trees[-1].value)


def test_cuts_missing_values_and_reload(spark, table, tmp_path):
    rows = table.withColumn("a", F.when(F.col("c") > 1, None).when(F.col("c") < -1, float("nan")).otherwise(F.col("a")))
    rows = rows.withColumn("y", F.when(F.col("b") > 1.5, None).otherwise(F.col("y"))).withColumn("flat", F.lit(1.0))
    model = B.fit(rows, [*FEATURES, "flat"], "y", B.BoostConfig(rounds=4, depth=3, rate=0.5))
    model.save(spark, str(tmp_path / "m"))
    again = B.BoostedModel.load(spark, str(tmp_path / "m"))
    want = [r["prediction"] for r in model.transform(rows).orderBy("a", "b", "c").collect()]
    assert want == [r["prediction"] for r in again.transform(rows).orderBy("a", "b", "c").collect()]
    share = model.importances()
    assert share[4] == 0 and abs(sum(share) - 1) < 1e-9 and max(share) == max(share[0], share[1], share[3])
    with pytest.raises(ValueError):
        B.fit(rows.limit(0), FEATURES, "y", B.BoostConfig(rounds=1))


def test_least_squares_on_collinear_inputs(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 3)) * [1, 50, 0.01] + [1e4, -300, 0]
    x = np.column_stack([x, x[:, 0] + x[:, 1], 3 * x[:, 2], np.ones(300)])
    y = x[:, 0] - 0.2 * x[:, 1] + 40 * x[:, 2] + rng.normal(size=300)
    names = [f"x{i}" for i in range(6)]
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], ", ".join(f"{n} double" for n in [*names, "y"]))
    model = LS.fit(df, names, "y")
    centred = x - x.mean(axis=0)
    scale = np.where(centred.std(axis=0) > 1e-9, centred.std(axis=0), 1)
    beta = np.linalg.lstsq(centred / scale, y - y.mean(), rcond=1e-8)[0]
    got = np.array([[r["y"], r["prediction"]] for r in model.transform(df).collect()])
    assert model.rank == 3
    assert np.allclose(got[:, 1], y.mean() + centred / scale @ beta, atol=1e-6)
    assert np.allclose(np.array(model.coefficients) * scale, beta, atol=1e-6)
