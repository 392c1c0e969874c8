"""Prediction dashboard queries over the AI decision table."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayloom import rules
from delayloom.functions import labels
from delayloom.functions.measures import mean_six_decimals, modal, rule_rows, with_share
from delayloom.operators.enrich import first_per_key
from delayloom.operators.filters import DEFAULT, DashboardFilter
from delayloom.operators.network import actionable


def actionable_comparison(ai: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Observed and predicted actionable records, as two rows."""
    one = where.apply(ai).agg(
        F.coalesce(F.sum(actionable("actual_actionable_delay_risk")), F.lit(0)).alias("observed"),
        F.coalesce(F.sum(actionable("predicted_actionable_delay_risk")), F.lit(0)).alias("predicted"),
    )
    pairs = (("Observed actionable records", "observed"), ("AI-predicted actionable records", "predicted"))
    rows = [F.struct(F.lit(signal).alias("signal"), F.col(name).alias("records")) for signal, name in pairs]
    return one.select(F.inline(F.array(*rows)))


def prediction_summary(ai: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    return where.apply(ai).agg(
        F.count(F.lit(1)).alias("records"),
        F.round(mean_six_decimals(F.col("predicted_actionable_probability")), 6).alias("avg_probability"),
        F.round(mean_six_decimals(F.col("predicted_delay_minutes")), 6).alias("avg_predicted_delay"),
        F.coalesce(F.sum(actionable("predicted_actionable_delay_risk")), F.lit(0)).alias("predicted_actionable"),
        F.coalesce(F.sum(actionable("actual_actionable_delay_risk")), F.lit(0)).alias("actual_actionable"),
    )


def risk_category_cards(ai: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Per predicted risk: modal action, records and share."""
    action = F.col("ai_recommended_action")
    counted = (
        where.apply(ai)
        .groupBy(labels.ai_risk_or_unknown().alias("ai_delay_risk"), action)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cards = counted.groupBy("ai_delay_risk").agg(
        F.coalesce(modal(action, F.col("n")), F.lit(rules.UNAVAILABLE)).alias("recommended_action"),
        F.sum("n").alias("records"),
    )
    return with_share(cards).orderBy(labels.rank_of(F.col("ai_delay_risk"), rules.RISK_ORDER), "ai_delay_risk")


def _timing_counts(source: DataFrame) -> DataFrame:
    minutes = F.col("delay_minutes")
    grouped = (
        source.filter(minutes.isNotNull())
        .groupBy(labels.timing_band(minutes).alias("timing_band"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
    return with_share(grouped)


def timing_mix(ai: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Early, near and late shares; three zero rows when nothing passes the filter."""
    ranked = [(name, place) for place, name in enumerate(rules.TIMING_ORDER)]
    bands = rule_rows(ai.sparkSession, ["timing_band", "place"], ranked)
    counts = _timing_counts(where.apply(ai))
    anything = F.coalesce(counts.agg(F.sum("records").alias("n")).scalar(), F.lit(0)) > 0
    return (
        bands.join(counts, "timing_band", "left")
        .filter(F.col("records").isNotNull() | ~anything)
        .orderBy("place")
        .select(
            "timing_band",
            F.coalesce("records", F.lit(0)).alias("records"),
            F.coalesce("share_pct", F.lit(0.0)).alias("share_pct"),
        )
    )


def route_timing_mix(ai: DataFrame, route_id: str, where: DashboardFilter = DEFAULT) -> DataFrame:
    route = where.apply(ai).filter(F.col("route_id") == route_id)
    return _timing_counts(route).orderBy(labels.rank_of(F.col("timing_band"), rules.TIMING_ORDER))


def _example_columns(corridor: Column) -> list[Column]:
    return [
        F.col("collection_date").cast("string").alias("collection_date"),
        F.col("route_id"),
        corridor.alias("corridor_name"),
        F.round("delay_minutes", 3).alias("observed_delay"),
        F.round("predicted_delay_minutes", 3).alias("predicted_delay"),
        F.round("predicted_actionable_probability", 3).alias("ai_probability"),
        labels.ai_risk_or_unknown().alias("ai_delay_risk"),
        labels.ai_action_or_unavailable().alias("ai_recommended_action"),
    ]


def _example_order() -> list:
    """Highest shown probability first; ties on it are settled by everything else an example shows.

    The order only needs stored columns, so examples are picked first and the
    texts and rounded values are made for the picked rows alone.
    """
    others = ("route_id", "collection_date", "delay_minutes", "predicted_delay_minutes", "route_corridor_name",
              "route_display_name")
    return [F.round("predicted_actionable_probability", 3).desc_nulls_last(), *others]


def prediction_examples(ai: DataFrame, limit: int = 10, where: DashboardFilter = DEFAULT) -> DataFrame:
    picked = where.apply(ai).orderBy(*_example_order()).limit(limit)
    return picked.select(*_example_columns(labels.corridor_or_route()))


def route_prediction_examples(
    ai: DataFrame, route_id: str, limit: int = 10, where: DashboardFilter = DEFAULT
) -> DataFrame:
    """Examples of one route, from the latest day of the filtered table unless a day is chosen."""
    base = where.apply(ai)
    source = base.filter(F.col("route_id") == route_id)
    if where.day == rules.ALL_DAYS:
        latest = base.agg(F.max("collection_date").alias("day")).scalar()
        source = source.filter(F.col("collection_date") == latest)
    shown = _example_columns(labels.corridor_name())
    service = labels.known_service(rules.UNMATCHED_SERVICE).alias("service_type")
    return source.orderBy(*_example_order()).limit(limit).select(*shown[:2], service, *shown[2:])


def balanced_examples(ai: DataFrame, where: DashboardFilter = DEFAULT, limit: int = 12) -> DataFrame:
    """The most probable example of every predicted risk and timing band."""
    source = where.apply(ai).filter(F.col("delay_minutes").isNotNull())
    banded = source.filter(F.col("ai_delay_risk").isin(*rules.RISK_ORDER)).withColumn(
        "timing_band", labels.timing_band(F.col("delay_minutes"))
    )
    picked = first_per_key(banded, ["ai_delay_risk", "timing_band"], _example_order())
    return picked.select(*_example_columns(labels.corridor_name()), "timing_band").orderBy(
        labels.rank_of(F.col("ai_delay_risk"), rules.RISK_ORDER),
        labels.rank_of(F.col("timing_band"), rules.TIMING_ORDER),
    ).limit(limit)


def risk_probability_text(risk: Column, probability: Column) -> Column:
    """Risk with its probability in whole percent; the risk alone when there is no probability."""
    known = F.coalesce(risk, F.lit(rules.UNKNOWN))
    shown = F.concat(known, F.lit(" · "), F.bround(probability * 100, 0).cast("int").cast("string"), F.lit("%"))
    return F.coalesce(shown, known)


def metric_lookup(metrics: DataFrame, wanted: Sequence[tuple[str, str, str]], exact: bool = True) -> DataFrame:
    """Pick values from a long metric table into one row: ``wanted`` holds (output, model, metric).

    With ``exact=False`` the model text may appear anywhere in the model name,
    in any case.
    """
    def matches(model: str, metric: str) -> Column:
        if exact:
            return (F.col("model") == model) & (F.col("metric") == metric)
        return F.contains(F.lower("model"), F.lit(model.lower())) & (F.lower("metric") == metric.lower())

    return metrics.agg(
        *(F.max(F.when(matches(model, metric), F.col("value"))).alias(name) for name, model, metric in wanted)
    )


def model_evidence(metrics: DataFrame, classifier: str, regressor: str) -> DataFrame:
    """Recall and F1 next to the baseline, and the relative RMSE gain over the median."""
    picked = metric_lookup(
        metrics,
        [
            ("baseline_recall", "Most frequent baseline", "recall"),
            ("classifier_recall", classifier, "recall"),
            ("classifier_f1", classifier, "f1"),
            ("baseline_rmse", "Median baseline", "rmse"),
            ("regressor_rmse", regressor, "rmse"),
        ],
    )
    gain = (F.col("baseline_rmse") - F.col("regressor_rmse")) / F.nullif("baseline_rmse", F.lit(0.0)) * 100
    return picked.withColumn("rmse_improvement_pct", F.round(gain, 1))
