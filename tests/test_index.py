"""Row index, chronological split and positional helpers."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from stratus.operators import index


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, tb long, v double")


def test_index_is_a_permutation_in_sort_order(spark):
    base = datetime(2024, 1, 1)
    rows = [("a", base + timedelta(hours=i % 50), i, float(i)) for i in range(1000)]
    df = _frame(spark, rows)
    out = index.with_row_index(df, "t", key="k", tiebreak="tb", num_partitions=7, key_index_col="series_idx")
    got = [r.tb for r in out.orderBy("row_idx").collect()]
    expect = [r[2] for r in sorted(rows, key=lambda r: (r[0], r[1], r[2]))]
    assert got == expect
    idx = sorted(r.row_idx for r in out.collect())
    assert idx == list(range(1000))


def test_hot_key_is_split_across_partitions(spark):
    """One key holds most rows; the range partitioner still balances them and
    per-key positions restart at 0 for every key."""
    base = datetime(2024, 1, 1)
    rows = [("hot", base + timedelta(minutes=i), i, 0.0) for i in range(3000)]
    rows += [(f"k{j}", base + timedelta(minutes=i), i, 0.0) for j in range(5) for i in range(20)]
    df = _frame(spark, rows)
    out = index.with_row_index(df, "t", key="k", tiebreak="tb", num_partitions=8, key_index_col="series_idx")
    per_key = {r.k: (r.lo, r.hi, r.n) for r in
               out.groupBy("k").agg(F.min("series_idx").alias("lo"), F.max("series_idx").alias("hi"),
                                    F.count("*").alias("n")).collect()}
    assert per_key["hot"] == (0, 2999, 3000)
    assert all(v == (0, 19, 20) for k, v in per_key.items() if k != "hot")


def test_chrono_split_fractional(spark):
    df = spark.range(13).select(F.col("id").alias("series_idx"))
    out = index.chrono_split(df, 0.8)
    assert out.filter("is_train").count() == 10  # int(13 * 0.8)


def test_chrono_split_per_key(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", i) for i in range(5)],
                               "k string, series_idx long")
    out = {r.k: r.n for r in index.chrono_split(df, 0.8, key="k").filter("is_train").groupBy("k").count()
           .withColumnRenamed("count", "n").collect()}
    assert out == {"a": 8, "b": 4}


def test_latest_and_recent(spark):
    base = datetime(2024, 1, 1)
    rows = [("a", base + timedelta(hours=i), i, float(i)) for i in range(100)]
    df = _frame(spark, rows)
    last = index.latest(df, "t", key="k").collect()[0]
    assert last.v == 99.0
    rec = index.recent(df, 72, "t").collect()
    assert len(rec) == 72 and min(r.v for r in rec) == 28.0


def test_empty_and_single_row(spark):
    df = _frame(spark, [])
    assert index.with_row_index(df, "t").count() == 0
    one = _frame(spark, [("a", datetime(2024, 1, 1), 1, 1.0)])
    assert index.with_row_index(one, "t").collect()[0].row_idx == 0


def test_shuffle_partitions_follow_input_size(spark):
    from stratus.session import scale_shuffle_partitions, shuffle_partitions
    before = shuffle_partitions(spark)
    try:
        small = spark.range(10)
        assert scale_shuffle_partitions(small) == before          # never lowered
        big = spark.range(0, 2_000_000_000)                       # 16 GB by the optimizer's estimate
        assert scale_shuffle_partitions(big, 64 * 1024 * 1024) == 239
        assert shuffle_partitions(spark) == 239
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(before))
