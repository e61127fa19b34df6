"""Plan-shape checks: the properties the scale design relies on."""

import re

from scales import SF_SMALL
from stratus.catalog import QUERIES, hourly_features
from stratus.sources import adapters as A


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()   # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plan_has_one_row_scale_exchange_and_no_single_partition_data(spark):
    plan = _plan(hourly_features(spark, SF_SMALL))
    # the only SinglePartition exchange feeds the per-partition offset table,
    # which sits under the broadcast
    singles = [m.start() for m in re.finditer("SinglePartition", plan)]
    broadcast = plan.find("BroadcastExchange")
    assert broadcast >= 0 and all(pos > broadcast for pos in singles)
    assert len(re.findall(r"Exchange hashpartitioning\(_chunk", plan)) == 1


def test_scans_are_pruned(spark):
    df = QUERIES["e18_monthly_weather_summary"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    read = re.search(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    cols = {c.split(":")[0] for c in read.group(1).split(",")}
    assert cols == {"l_shipdate", "l_quantity", "l_discount", "l_tax"}
    assert "Window" not in plan


def test_latest_row_is_an_aggregate_not_a_sort(spark):
    from stratus.operators.index import latest
    plan = _plan(latest(A.obs_hourly(spark, SF_SMALL)))
    assert "max_by" in plan and "Sort " not in plan


def test_month_means_are_broadcast_without_station_key(spark):
    from pyspark.sql import functions as F

    from stratus.operators.windows import anomaly
    h = A.obs_hourly(spark, SF_SMALL).withColumn("month", F.month("date_time"))
    plan = _plan(anomaly(h, {"temp_anomaly": "tempC"}, "month"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_exact_quantiles_plan_has_no_single_task_distinct_map(spark):
    from stratus.operators.eda import describe
    plan = _plan(describe(A.obs_hourly(spark, SF_SMALL), ["tempC", "precipMM"]))
    # no percentile aggregate (one map of all distinct values in one task),
    # no all-pairs join: targets and offsets are broadcast hash joins
    assert "percentile" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 2
