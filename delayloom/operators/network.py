"""Network-wide indicators over the AI decision table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayloom import rules
from delayloom.functions import labels
from delayloom.functions.measures import (
    average_minutes,
    modal,
    observed_seconds,
    one_row,
    percent,
    rows,
    tally,
    total,
    two_step,
    with_share,
)
from delayloom.functions.parsing import hour_label
from delayloom.operators.filters import DEFAULT, DashboardFilter
from delayloom.operators.summaries import risk_classes


def actionable(column: str) -> Column:
    """A 0/1 flag column as bigint, nulls as zero."""
    return F.coalesce(F.col(column).try_cast("bigint"), F.lit(0))


def decision_summary(ai: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Records and share per predicted risk and action, in risk order."""
    grouped = (
        where.apply(ai)
        .groupBy(
            labels.ai_risk_or_unknown().alias("delay_risk"),
            labels.ai_action_or_unavailable().alias("recommended_action"),
        )
        .agg(F.count(F.lit(1)).alias("records"))
    )
    return with_share(grouped).orderBy(
        labels.rank_of(F.col("delay_risk"), rules.RISK_ORDER), F.desc("records"), "recommended_action"
    )


def _risk_tally(name: str, *risks: str):
    return tally(name, F.coalesce(labels.ai_risk_or_unknown().isin(*risks), F.lit(False)))


def risk_percentages(ai: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Share of each of the four classes, absent ones as zero."""
    grouped = (
        where.apply(ai)
        .groupBy(labels.ai_risk_or_unknown().alias("delay_risk"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
    return (
        risk_classes(ai.sparkSession)
        .join(with_share(grouped), "delay_risk", "left")
        .orderBy("risk_rank")
        .select("delay_risk", F.coalesce("share_pct", F.lit(0.0)).alias("share_pct"))
    )


def high_severe_share(ai: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """High + Severe share from the counts, and as the sum of the two rounded shares."""
    one = where.apply(ai).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(labels.ai_risk_or_unknown() == "High").alias("high"),
        F.count_if(labels.ai_risk_or_unknown() == "Severe").alias("severe"),
    )
    whole = F.col("records")
    rounded = F.coalesce(percent(F.col("high"), whole), F.lit(0.0)) + F.coalesce(
        percent(F.col("severe"), whole), F.lit(0.0)
    )
    return one.select(
        F.coalesce(percent(F.col("high") + F.col("severe"), whole), F.lit(0.0)).alias("share_from_counts_pct"),
        F.round(rounded, 2).alias("share_from_rounded_pct"),
    )


def network_kpis(ai: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Records, mean observed delay, actionable records and share, modal action."""
    source = where.apply(ai).withColumn("action", labels.ai_action_or_unavailable())
    one = two_step(
        source,
        [],
        ["action"],
        [
            rows("total_records"),
            average_minutes("avg_delay_minutes", observed_seconds(source), 3),
            total("actionable_records", actionable("predicted_actionable_delay_risk")),
        ],
        [modal(F.col("action"), F.col("group_rows")).alias("most_common_recommendation")],
    )
    return one.select(
        F.coalesce("total_records", F.lit(0)).alias("total_records"),
        "avg_delay_minutes",
        F.coalesce("actionable_records", F.lit(0)).alias("actionable_records"),
        F.coalesce(percent(F.col("actionable_records"), F.col("total_records")), F.lit(0.0)).alias("actionable_pct"),
        labels.short_action(F.coalesce("most_common_recommendation", F.lit(rules.UNAVAILABLE))).alias(
            "most_common_recommendation"
        ),
    )


def attention_summary(ai: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """The route needing most attention, with network counts of High, Severe and actionable records."""
    from delayloom.operators.routes import top_routes

    top = one_row(top_routes(ai, 1, where).select("route_id", "route_display_name"))
    source = where.apply(ai).withColumn("action", labels.ai_action_or_unavailable())
    one = two_step(
        source,
        [],
        ["action"],
        [
            rows("total_records"),
            _risk_tally("high_count", "High"),
            _risk_tally("severe_count", "Severe"),
            total("actionable_records", actionable("predicted_actionable_delay_risk")),
        ],
        [modal(F.col("action"), F.col("group_rows")).alias("primary_action")],
    )
    zero = F.lit(0)
    return one.select(
        F.coalesce(top["route_display_name"], F.lit(rules.UNAVAILABLE)).alias("route"),
        F.coalesce(top["route_id"], F.lit(rules.UNAVAILABLE)).alias("route_id"),
        F.coalesce("high_count", zero).alias("high_count"),
        F.coalesce("severe_count", zero).alias("severe_count"),
        F.coalesce("actionable_records", zero).alias("actionable_records"),
        F.coalesce(percent(F.col("actionable_records"), F.col("total_records")), F.lit(0.0)).alias("actionable_pct"),
        labels.short_action(F.coalesce("primary_action", F.lit(rules.UNAVAILABLE))).alias("primary_action"),
    )


def action_summary(ai: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Modal action, Severe count and High + Severe percentage (one decimal)."""
    source = where.apply(ai).withColumn("action", labels.ai_action_or_unavailable())
    one = two_step(
        source,
        [],
        ["action"],
        [rows(), _risk_tally("severe", "Severe"), _risk_tally("risky", *rules.ACTIONABLE_RISKS)],
        [modal(F.col("action"), F.col("group_rows")).alias("common")],
    )
    return one.select(
        labels.short_action(F.coalesce("common", F.lit(rules.UNAVAILABLE))).alias("common"),
        F.coalesce("severe", F.lit(0)).alias("severe"),
        F.coalesce(percent(F.col("risky"), F.col("records"), 1), F.lit(0.0)).alias("risk_pct"),
    )


def available_days(facts: DataFrame) -> DataFrame:
    return (
        facts.filter(F.col("collection_date").isNotNull())
        .select(F.col("collection_date").cast("string").alias("day"))
        .distinct()
        .orderBy(F.desc("day"))
    )


def available_hours(facts: DataFrame) -> DataFrame:
    hours = facts.select(F.col("trip_hour").try_cast("int").alias("hour_value")).distinct()
    return (
        hours.filter(F.col("hour_value").isNotNull())
        .orderBy("hour_value")
        .select(hour_label(F.col("hour_value")).alias("hour"))
    )
