"""Tables about model features: lookups, rankings and category shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayloom.functions import labels
from delayloom.functions.lookups import SALT, salt_of, salted
from delayloom.functions.measures import with_share
from delayloom.functions.parsing import to_double

CONTRIBUTION_TYPE = "mean_abs_shap"


def feature_explanation_lookup(importance: DataFrame) -> DataFrame:
    feature = F.col("feature")
    return importance.select(
        "source",
        "explainability_type",
        "feature",
        "importance",
        labels.feature_operator_category(feature).alias("operator_category"),
        labels.feature_operator_explanation(feature).alias("operator_explanation"),
        "notes",
    ).orderBy(F.desc("importance"), "source", "explainability_type", "feature")


def ordered_importance(importance: DataFrame) -> DataFrame:
    return importance.orderBy("source", "explainability_type", F.desc("importance"), "feature")


def top_features(importance: DataFrame, limit: int = 10, explainability_type: str = CONTRIBUTION_TYPE) -> DataFrame:
    chosen = importance.filter(F.col("explainability_type") == explainability_type)
    return (
        chosen.withColumn("importance", to_double(F.col("importance")))
        .orderBy(F.desc_nulls_last("importance"), "feature", "source", "notes")
        .limit(limit)
        .withColumn("feature", labels.feature_display_label(F.col("feature")))
    )


def prepare_features(features: DataFrame) -> DataFrame:
    """Display name, category and three-decimal label of every feature, most important first."""
    value = F.coalesce(to_double(F.col("importance")), F.lit(0.0)) if "importance" in features.columns else F.lit(0.0)
    shown = features.withColumn("importance", value).withColumn("display_feature", labels.feature_text(F.col("feature")))
    return shown.withColumns(
        {
            "category": labels.feature_category(F.col("display_feature")),
            "importance_label": F.format_string("%.3f", "importance"),
        }
    ).orderBy(F.desc("importance"), "feature")


def importance_by_category(features: DataFrame, chart: bool = False) -> DataFrame:
    """Importance, features and share (one decimal) per category; sums are exact decimals.

    ``chart`` takes the narrower groups of the importance chart.
    """
    grouping = labels.feature_chart_group if chart else labels.feature_category
    category = F.col("category") if "category" in features.columns else grouping(F.col("feature"))
    value = F.coalesce(to_double(F.col("importance")), F.lit(0.0)).cast("decimal(18,6)")
    grouped = features.groupBy(category.alias("category")).agg(
        F.sum(value).cast("double").alias("importance"), F.count(F.lit(1)).alias("feature_count")
    )
    return with_share(grouped, digits=1, count="importance").withColumn(
        "share_pct", F.coalesce("share_pct", F.lit(0.0))
    ).orderBy(F.desc("importance"), "category")


def mean_abs_contribution(contributions: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature of a long contribution table."""
    size = F.abs(F.col("shap_value")).cast("decimal(18,6)")
    return contributions.groupBy("feature").agg(
        F.round(F.sum(size).cast("double") / F.nullif(F.count("shap_value"), F.lit(0)), 6).alias("importance")
    )


def min_max_normalise(
    points: DataFrame, value: str = "value", key: str = "feature", name: str = "value_norm", salts: int = 1
) -> DataFrame:
    """Scale a value to 0..1 within each feature; a constant feature gets 0.

    ``salts`` spreads the points of a large feature over several tasks.
    """
    bounds = points.groupBy(key).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    spread = points.withColumn(SALT, salt_of(points, salts, points.columns))
    span = F.col("_hi") - F.col("_lo")
    scaled = (F.col(value) - F.col("_lo")) / F.when(span == 0, F.lit(1.0)).otherwise(span)
    return spread.join(salted(bounds, salts), [key, SALT]).withColumn(name, scaled).drop("_lo", "_hi", SALT)
