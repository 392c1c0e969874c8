"""Boosted-tree models of Spark ML, trained over category codes and scored on the cluster."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayloom import schemas
from delayloom.operators import boosting
from delayloom.operators.model_prep import SEED, FittedEncoding, fit_encoding, scale_pos_weight
from delayloom.session import ensure_checkpoint_dir

TARGET = "actionable_delay_risk"


@dataclass(frozen=True)
class TreeSettings:
    """Boosting settings shared by both models; only the number of trees differs."""

    trees: int
    depth: int = 5
    step: float = 0.08
    row_share: float = 0.85
    column_share: float = 0.85
    seed: int = SEED


CLASSIFIER = TreeSettings(trees=160)
REGRESSOR = TreeSettings(trees=180)


@dataclass(frozen=True)
class TrainedModel:
    """A fitted encoding and the trees behind it."""

    encoding: FittedEncoding
    trees: Model

    def transform(self, df: DataFrame) -> DataFrame:
        return self.trees.transform(self.encoding.encode(df))


def _booster(kind, settings: TreeSettings, **columns):
    return kind(
        featuresCol="features",
        maxIter=settings.trees,
        maxDepth=settings.depth,
        stepSize=settings.step,
        subsamplingRate=settings.row_share,
        featureSubsetStrategy=str(settings.column_share),
        seed=settings.seed,
        **columns,
    )


def _fit(prepared: DataFrame, encoding: FittedEncoding, settings: TreeSettings, booster) -> TrainedModel:
    """Fit the trees to codes of the buckets, and keep them as the model of one-hot features that ``booster`` makes."""
    indexed, places = encoding.index(prepared)
    layout, trees = boosting.fit(indexed, encoding.numbers, places, settings, logistic=isinstance(booster, GBTClassifier))
    two = prepared.sparkSession.createDataFrame(
        [(Vectors.dense([0.0]), 0.0, 1.0), (Vectors.dense([1.0]), 1.0, 1.0)], ["features", "label", "weight"])
    return TrainedModel(encoding, boosting.spark_model(booster, layout, trees, settings.step, two))


def train_classifier(
    train: DataFrame, settings: TreeSettings = CLASSIFIER, encoding: FittedEncoding | None = None, target: str = TARGET
) -> TrainedModel:
    """Boosted trees on the binary target, positives weighted by the class ratio."""
    ensure_checkpoint_dir(train.sparkSession)
    encoding = encoding or fit_encoding(train)
    weight = scale_pos_weight(train, target).first().scale_pos_weight
    prepared = encoding.apply(train).withColumns(
        {
            "label": F.col(target).cast("double"),
            "weight": F.when(F.col(target) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)),
        }
    )
    return _fit(prepared, encoding, settings, _booster(GBTClassifier, settings, labelCol="label", weightCol="weight"))


def train_regressor(
    train: DataFrame, settings: TreeSettings = REGRESSOR, encoding: FittedEncoding | None = None, value: str = "delay_minutes"
) -> TrainedModel:
    ensure_checkpoint_dir(train.sparkSession)
    encoding = encoding or fit_encoding(train)
    prepared = encoding.apply(train).withColumn("label", F.col(value).cast("double"))
    return _fit(prepared, encoding, settings, _booster(GBTRegressor, settings, labelCol="label"))


def _with_class(model: TrainedModel, encoded: DataFrame) -> DataFrame:
    return (
        model.trees.transform(encoded)
        .withColumn("predicted_actionable_delay_risk", F.col("prediction").cast("int"))
        .withColumn("predicted_actionable_probability", vector_to_array("probability")[1])
        .drop("rawPrediction", "probability", "prediction")
    )


def _with_delay(model: TrainedModel, encoded: DataFrame) -> DataFrame:
    return model.trees.transform(encoded).withColumnRenamed("prediction", "predicted_delay_minutes")


def score_class(model: TrainedModel, df: DataFrame) -> DataFrame:
    """Add the predicted class and the probability of the actionable class; keep the input columns."""
    scored = _with_class(model, model.encoding.encode(df))
    return scored.select(*df.columns, "predicted_actionable_delay_risk", "predicted_actionable_probability")


def score_delay(model: TrainedModel, df: DataFrame) -> DataFrame:
    return _with_delay(model, model.encoding.encode(df)).select(*df.columns, "predicted_delay_minutes")


def score(classifier: TrainedModel, regressor: TrainedModel, df: DataFrame) -> DataFrame:
    """Class, probability and delay for every row; models with one encoding share the encoded row."""
    if classifier.encoding is not regressor.encoding:
        return score_delay(regressor, score_class(classifier, df))
    scored = _with_delay(regressor, _with_class(classifier, classifier.encoding.encode(df)))
    outputs = [name for name in schemas.PREDICTION_OUTPUTS if name.startswith("predicted_")]
    return scored.select(*df.columns, *outputs)


def model_importance(model: TrainedModel, sample: DataFrame, source: str) -> DataFrame:
    """Gain importance of every encoded feature, in long form."""
    names = model.encoding.feature_names()
    values = model.trees.featureImportances.toArray()
    rows = [
        (source, "gbt_feature_importance", name, float(value),
         "Gain of the splits on this feature, summed over all trees.")
        for name, value in zip(names, values)
    ]
    return sample.sparkSession.createDataFrame(rows, schemas.IMPORTANCE_LONG)
