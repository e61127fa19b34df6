"""Operator 12 against exhaustive search."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=100, positives=5, negatives=10):
    ok = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows
          if i is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, (a, q, label) in enumerate(ok):
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, v)), i, lab) for j, (i, v, lab) in enumerate(ok) if j != k and len(v) == len(q)]
        scored.sort(key=lambda t: t[:2])
        for ps, p, _ in [t for t in scored if t[2] == label][:positives]:
            near = [(s, i) for s, i, lab in scored if lab != label and -30 * ps <= -100 * s <= -90 * ps][:negatives]
            out += [(a, p, r + 1, i, -ps, -s) for r, (s, i) in enumerate(near)]
    return sorted(out)


def clustered(n, d, seed, labels=3, spread=0.35):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, d)) + 0.6
    out = []
    for i in range(n):
        y = int(rng.integers(labels))
        v = centres[y] + spread * rng.normal(size=d)
        out.append((i, (v / np.linalg.norm(v) * float(rng.choice([0.5, 1, 1, 3]))).tolist(), y))
    return out


def got(df, **kw):
    return sorted(tuple(r) for r in hn.hard_negatives(df, **kw).select(*COLUMNS).collect())


@pytest.mark.parametrize("seed,group_rows,bucket", [(1, 10_000, 64), (2, 150, 16), (3, 97, 2048)])
def test_equals_exhaustive_search(spark, monkeypatch, seed, group_rows, bucket):
    monkeypatch.setattr(hn, "BUCKET", bucket)
    monkeypatch.setattr(hn, "SAMPLE", 40)
    rows = clustered(900, 12, seed)
    assert got(spark.createDataFrame(rows, SCHEMA), every=50, group_rows=group_rows) == brute(rows, every=50)


def test_ties_copies_and_rows_without_part(spark):
    nan, inf = float("nan"), float("inf")
    same = [0.5, 0.25, -0.125, 0.75]
    rows = [(i, same, i % 2) for i in range(60)]                       # one vector, two labels: only ties
    rows += [(100 + i, [0.3, 0.2, 0.1 * (i % 4), 0.6], i % 3) for i in range(30)]
    rows += [(200, same, 1)] * 3 + [(None, same, 1), (300, same, None), (400, None, 0), (500, [0.1, None, 0.2, 0.3], 0),
             (600, [nan, 0.1, 0.2, 0.3], 0), (700, [0.1, inf, 0.2, 0.3], 0), (800, [0.5, 0.5], 0), (801, [0.5, 0.4], 0),
             (802, [0.5, 0.3], 1), (900, [], 0), (901, [], 0), (902, [], 1), (1000, [0.0] * 4, 0), (-100, [-0.5] * 4, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = {c: F.lit("x") for c in ("id", "row", "v", "grp", "asks", "rank", "anchor_id", "length2", "scores")}
    want = brute(rows, every=100)
    assert want and got(df.withColumns(clash)) == want
    assert got(df.limit(0)) == []


def test_scores_beyond_doubles_are_exact(spark):
    big = float(2**21)
    rows = [(i, [big + i / 256, -big, 3.0, 0.5 * i], i % 2) for i in range(40)]
    assert got(spark.createDataFrame(rows, SCHEMA), every=10) == brute(rows, every=10)


def test_coordinate_ranges_leave_out_rows_but_none_that_counts():
    rng = np.random.default_rng(5)
    v = rng.integers(-200, 200, size=(4000, 8))
    buckets = hn.buckets_of(np.arange(4000), np.arange(4000), hn.label_array([0] * 4000), list(v))[8]
    scored = whole = 0
    for q in rng.integers(-200, 200, size=(40, 8)):
        a, scores = hn.Anchor(q.tolist()), v @ q
        reach = int(np.sort(scores)[-10])
        found = []
        for b in buckets:
            rows = b.candidates(a.unit, a.focus, reach / (a.length * b.longest))
            scored, whole = scored + len(b.ids[rows]), whole + len(b.ids)
            found += b.ids[rows][b.scores(rows, a) >= reach].tolist()
        assert sorted(found) == np.flatnonzero(scores >= reach).tolist()
    assert scored < whole / 3


def test_query_equals_brute_force_and_sql(spark):
    import duckdb
    path = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
            for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    found = hn.op12_hard_negatives(spark, path)
    mine = sorted(tuple(r) for r in found.select(*COLUMNS).collect())
    assert mine == brute(rows)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet'")
    assert mine == sorted(con.sql(hn.OP12_SQL).select(*COLUMNS).fetchall())
