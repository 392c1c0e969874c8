"""From the decision table to models, metrics, importances and predictions."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayloom.operators import cleaning, explain, metrics, model_prep, models, timeseries
from delayloom.session import at_once
from delayloom.sources import writers

CLASSIFIER_NAME = "GBT classifier"
REGRESSOR_NAME = "GBT regressor"


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def evaluate(
    classifier: models.TrainedModel, regressor: models.TrainedModel, train: DataFrame, test: DataFrame
) -> DataFrame:
    """Long metrics of both models and of the baselines they have to beat."""
    base = model_prep.baselines(train).first()
    scored = models.score(classifier, regressor, test).withColumns(
        {"_majority": F.lit(base.majority_class), "_median": F.lit(float(base.median_value))}
    )
    target = models.TARGET

    def classes(name: str, column: str) -> DataFrame:
        one = metrics.classification_metrics(scored, target, column)
        return metrics.metric_rows(one, name, "classification", target)

    def delays(name: str, column: str) -> DataFrame:
        one = metrics.regression_metrics(scored, "delay_minutes", column)
        return metrics.metric_rows(one, name, "regression", "delay_minutes")

    return _union(
        [
            classes("Most frequent baseline", "_majority"),
            classes(CLASSIFIER_NAME, "predicted_actionable_delay_risk"),
            metrics.metric_rows(model_prep.scale_pos_weight(train), CLASSIFIER_NAME, "classification", target),
            delays("Median baseline", "_median"),
            delays(REGRESSOR_NAME, "predicted_delay_minutes"),
        ]
    )


def hourly_baseline_metrics(decisions: DataFrame) -> DataFrame:
    """Metrics of the hourly forecasts, or a single ``status`` row when the series is too short."""
    series = timeseries.hourly_series(decisions)
    hours = series.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_train").alias("t")).first()
    if hours.n < timeseries.MIN_HOURS or hours.t == hours.n:
        row = series.sparkSession.range(1).select(F.lit(None).cast("double").alias("status"))
        return metrics.metric_rows(
            row, "Hourly baselines", "regression", "hourly_avg_delay_minutes", "too few hourly points"
        )
    forecasts = timeseries.hourly_forecasts(series)
    return metrics.forecast_metrics(
        forecasts,
        {
            "AR(1) baseline": "ar1_forecast",
            "Last value baseline": "last_value_forecast",
            "Hour of week baseline": "seasonal_forecast",
        },
    )


def train_and_publish(
    decisions: DataFrame,
    out_dir: str,
    key: Sequence[str] = ("collection_time_utc", "route_id", "trip_id"),
    classifier_settings: models.TreeSettings = models.CLASSIFIER,
    regressor_settings: models.TreeSettings = models.REGRESSOR,
    max_rows: int = model_prep.MAX_MODEL_ROWS,
) -> DataFrame:
    """Train both models, write every output, return the metrics.

    The split comes first: metrics and explanations cover all test rows, and encoding, baselines and the regressor
    all training rows.  Only the classifier is fitted on a stratified sample of at most ``max_rows`` training rows.
    """
    spark = decisions.sparkSession
    cleaning.model_input(decisions).write.mode("overwrite").parquet(f"{out_dir}/modeling_input")
    full = spark.read.parquet(f"{out_dir}/modeling_input")
    train, test = model_prep.time_split(full)
    model_prep.stratified_sample(train, key, max_rows).write.mode("overwrite").parquet(f"{out_dir}/modeling_sample")
    sample = spark.read.parquet(f"{out_dir}/modeling_sample")
    encoding = model_prep.fit_encoding(train)
    classifier, regressor = at_once(
        spark,
        lambda: models.train_classifier(sample, classifier_settings, encoding),
        lambda: models.train_regressor(train, regressor_settings, encoding),
    )
    _union(
        [
            metrics.split_metrics(full, sample, train, test),
            evaluate(classifier, regressor, train, test),
            hourly_baseline_metrics(decisions),
        ]
    ).write.mode("overwrite").parquet(f"{out_dir}/model_metrics")
    contributions = explain.contribution_rows(classifier, test)
    _union(
        [
            models.model_importance(classifier, train, CLASSIFIER_NAME),
            models.model_importance(regressor, train, REGRESSOR_NAME),
            explain.permutation_importance(classifier, test, key),
            explain.contribution_importance(contributions, CLASSIFIER_NAME),
        ]
    ).write.mode("overwrite").parquet(f"{out_dir}/feature_importance")
    explain.contribution_points(contributions).write.mode("overwrite").parquet(
        f"{out_dir}/contribution_points"
    )
    predicted = cleaning.prediction_frame(models.score(classifier, regressor, full))
    held_out = cleaning.prediction_frame(models.score(classifier, regressor, test))
    writers.write_predictions(predicted, held_out, f"{out_dir}/predictions", f"{out_dir}/predictions_test")
    writers.write_sample(held_out, f"{out_dir}/prediction_sample")
    return spark.read.parquet(f"{out_dir}/model_metrics")
