"""Model evaluation as aggregations.

Metrics are computed in one ``agg`` over (label, prediction) pairs instead of
collecting predictions; ``group_by`` evaluates many models or horizons in the
same pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import half_even
from ..operators.eda import histogram

# Fixed values that must equal the reference's results.
METRIC_DIGITS = 4
RESIDUAL_BINS = 60
CLASS_NAMES = ("No Rain", "Rain")


def _keys(group_by):
    return [group_by] if isinstance(group_by, str) else list(group_by or [])


def regression_metrics(df: DataFrame, label: str, prediction: str, group_by=None,
                       digits: int | None = METRIC_DIGITS) -> DataFrame:
    """MAE, RMSE and R^2 = 1 - SSE/SST (NULL when the label is constant)."""
    keys = _keys(group_by)
    src = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    e = F.col(label).cast("double") - F.col(prediction).cast("double")
    stats = [F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
             F.sum(e * e).alias("_sse"), F.variance(label).alias("_var"), F.count(F.lit(1)).alias("n")]
    agg = src.groupBy(*keys).agg(*stats) if keys else src.agg(*stats)
    sst = F.col("_var") * (F.col("n") - 1)
    r2 = F.when(sst > 0, 1 - F.try_divide(F.col("_sse"), sst))
    out = agg.select(*keys, "mae", "rmse", r2.alias("r2"), "n")
    if digits is not None:
        out = out.withColumns({c: half_even(c, digits) for c in ("mae", "rmse", "r2")})
    return out


def confusion_counts(df: DataFrame, label: str, prediction: str, group_by=None) -> DataFrame:
    keys = _keys(group_by)
    y, p = F.col(label), F.col(prediction)
    stats = [F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
             F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn")]
    return df.groupBy(*keys).agg(*stats) if keys else df.agg(*stats)


def _safe(num, den):
    return F.coalesce(F.try_divide(num.cast("double"), den), F.lit(0.0))


def classification_metrics(df: DataFrame, label: str, prediction: str, group_by=None,
                           digits: int | None = METRIC_DIGITS) -> DataFrame:
    """Accuracy, precision, recall, F1 of the positive class; 0 when a
    denominator is empty (scikit-learn's ``zero_division`` default)."""
    keys = _keys(group_by)
    c = confusion_counts(df, label, prediction, group_by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    out = c.select(*keys,
                   _safe(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                   _safe(tp, tp + fp).alias("precision"),
                   _safe(tp, tp + fn).alias("recall"),
                   _safe(2 * tp, 2 * tp + fp + fn).alias("f1"),
                   "tp", "fp", "fn", "tn")
    if digits is not None:
        out = out.withColumns({m: half_even(m, digits) for m in ("accuracy", "precision", "recall", "f1")})
    return out


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """per-class precision/recall/F1/support plus macro and weighted
    averages, from one pass of confusion counts."""
    c = confusion_counts(df, label, prediction)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    neg, pos = CLASS_NAMES
    per_class = c.select(F.explode(F.array(
        F.struct(F.lit(neg).alias("class"), _safe(tn, tn + fn).alias("precision"), _safe(tn, tn + fp).alias("recall"),
                 _safe(2 * tn, 2 * tn + fn + fp).alias("f1"), (tn + fp).alias("support")),
        F.struct(F.lit(pos).alias("class"), _safe(tp, tp + fp).alias("precision"), _safe(tp, tp + fn).alias("recall"),
                 _safe(2 * tp, 2 * tp + fp + fn).alias("f1"), (tp + fn).alias("support")))).alias("r")).select("r.*")
    totals = per_class.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        _safe(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("wp"),
        _safe(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("wr"),
        _safe(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("wf"),
        F.sum("support").alias("n"))
    averages = totals.select(F.explode(F.array(
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"), F.col("wr").alias("recall"),
                 F.col("wf").alias("f1"), F.col("n").alias("support")))).alias("r")).select("r.*")
    return per_class.unionByName(averages)


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """2x2 matrix, rows = actual class, columns = predicted class."""
    c = confusion_counts(df, label, prediction)
    return c.select(F.explode(F.array(
        F.struct(F.lit(0).alias("actual"), F.col("tn").alias("pred_0"), F.col("fp").alias("pred_1")),
        F.struct(F.lit(1).alias("actual"), F.col("fn").alias("pred_0"), F.col("tp").alias("pred_1")))).alias("r")
    ).select("r.*")


def residuals(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """residual = actual - predicted, next to the prediction."""
    return df.select("*", (F.col(label).cast("double") - F.col(prediction).cast("double")).alias("residual"))


def residual_histogram(df: DataFrame, label: str, prediction: str, bins: int = RESIDUAL_BINS) -> DataFrame:
    return histogram(residuals(df, label, prediction), "residual", bins)
