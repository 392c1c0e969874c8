"""Model quality metrics, each from a single aggregation."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TARGET = "actionable_delay_risk"


def _safe(numerator: Column, denominator: Column) -> Column:
    """Ratio with zero for an empty denominator."""
    return F.coalesce(numerator / F.nullif(denominator, F.lit(0)), F.lit(0.0))


def classification_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Accuracy, precision, recall, three F1 variants and the confusion counts, as one row."""
    y, p = F.col(actual), F.col(predicted)
    counts = df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )
    tn, fp, fn, tp = (F.col(name) for name in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp
    f1 = _safe(2 * tp, 2 * tp + fp + fn)
    f0 = _safe(2 * tn, 2 * tn + fp + fn)
    return counts.select(
        _safe(tp + tn, total).alias("accuracy"),
        _safe(tp, tp + fp).alias("precision"),
        _safe(tp, tp + fn).alias("recall"),
        f1.alias("f1"),
        ((f0 + f1) / 2).alias("macro_f1"),
        _safe(f0 * (tn + fp) + f1 * (fn + tp), total).alias("weighted_f1"),
        tn.alias("true_negative_low"),
        fp.alias("false_positive_actionable"),
        fn.alias("false_negative_actionable"),
        tp.alias("true_positive_actionable"),
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, MSE, RMSE and R2, as one row."""
    pair = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    error = F.col(actual) - F.col(predicted)
    one = df.filter(pair).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(actual).alias("_spread"),
    )
    return one.select(
        "mae", "mse", F.sqrt("mse").alias("rmse"), (1 - F.col("mse") / F.nullif("_spread", F.lit(0.0))).alias("r2")
    )


def metric_rows(one: DataFrame, model: str, target_type: str, target: str, notes: str = "") -> DataFrame:
    """A row of metrics in long form, six decimals; not-a-number and infinite values become null."""
    def clean(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), F.round(value, 6))

    pairs = [F.struct(F.lit(name).alias("metric"), clean(name).alias("value")) for name in one.columns]
    return one.select(F.inline(F.array(*pairs))).select(
        F.lit(model).alias("model"), F.lit(target_type).alias("target_type"), F.lit(target).alias("target"),
        "metric", "value", F.lit(notes).alias("notes"),
    )


def split_metrics(full: DataFrame, sample: DataFrame, train: DataFrame, test: DataFrame, target: str = TARGET) -> DataFrame:
    """Row counts of every stage and positive shares of both sides, in long form."""
    def count(df: DataFrame, group: str, target_name: str, metric: str) -> DataFrame:
        return metric_rows(df.agg(F.count(F.lit(1)).alias(metric)), group, "data", target_name)

    def share(df: DataFrame, metric: str) -> DataFrame:
        return metric_rows(df.agg(F.avg(target).alias(metric)), "Target distribution", "classification", target)

    frames = [
        count(full, "Input", "decision_engine_output", "full_rows"),
        count(sample, "Input", "modeling_sample", "rows"),
        count(train, "Split", "time_based", "train_rows"),
        count(test, "Split", "time_based", "test_rows"),
        share(train, "train_positive_share"),
        share(test, "test_positive_share"),
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def forecast_metrics(forecasts: DataFrame, columns: Mapping[str, str], target: str = "hourly_avg_delay_minutes") -> DataFrame:
    """Long metrics of several forecast columns; ``columns`` maps model names to columns."""
    frames = [
        metric_rows(
            regression_metrics(forecasts, "mean_delay", column), model, "regression", target,
            "Hourly average delay baseline, not row-level prediction",
        )
        for model, column in columns.items()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
