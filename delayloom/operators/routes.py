"""Route rankings and single-route views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayloom import rules
from delayloom.functions import labels
from delayloom.functions.measures import (
    average,
    average_minutes,
    derived,
    largest,
    largest_minutes,
    modal,
    observed_seconds,
    rows,
    smallest,
    tally,
    total,
    two_step,
    with_share,
)
from delayloom.functions.parsing import blank_to_null
from delayloom.operators.filters import DEFAULT, DashboardFilter, exclude_special
from delayloom.operators.network import actionable

_PROBABILITY = "predicted_actionable_probability"


def _modal_action(alias: str):
    action = modal(F.col("ai_recommended_action"), F.col("group_rows"))
    return F.coalesce(action, F.lit(rules.UNAVAILABLE)).alias(alias)


def top_routes(ai: DataFrame, limit: int | None = 10, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Routes with the most predicted actionable records, then the longest predicted delay; all without a limit."""
    source = where.apply(ai)
    special = labels.is_special(source)
    source = source.withColumns(
        {
            "service_type": F.when(special, rules.SPECIAL_SERVICE).otherwise(
                labels.known_service(rules.SPECIAL_SERVICE)
            ),
            "route_corridor_name": labels.corridor_name(),
            "route_display_name": F.coalesce(
                blank_to_null(F.col("route_display_name")), "route_short_name", "route_id"
            ),
            "is_special_route": special,
        }
    )
    keys = ["service_type", "route_display_name", "route_corridor_name", "route_id", "is_special_route"]
    delay = F.col("predicted_delay_minutes")
    ranked = (
        two_step(
            source,
            keys,
            ["ai_recommended_action"],
            [
                rows(),
                total("actionable_records", actionable("predicted_actionable_delay_risk")),
                average("avg_delay_minutes", delay, 3),
                largest("max_delay_minutes", delay, lambda c: F.round(c, 3)),
                average("avg_prediction_probability", F.col(_PROBABILITY), 3),
            ],
            [_modal_action("recommended_action")],
        )
        .orderBy(F.desc("actionable_records"), F.desc_nulls_last("avg_delay_minutes"), *keys)
    )
    return ranked if limit is None else ranked.limit(limit)


def route_options(ai: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    return top_routes(ai, 100, where)


def route_options_by_risk(ai: DataFrame, risk: str = "All", where: DashboardFilter = DEFAULT) -> DataFrame:
    """Up to 100 routes with records of one predicted risk; ``All`` is the general ranking."""
    if risk in ("", "All"):
        return route_options(ai, where)
    source = where.apply(ai).filter(F.col("ai_delay_risk") == risk)
    source = source.withColumns(
        {
            "service_type": labels.known_service(rules.UNMATCHED_SERVICE),
            "route_corridor_name": labels.corridor_name(),
        }
    )
    keys = ["service_type", "route_id", "route_corridor_name"]
    return (
        two_step(
            source,
            keys,
            ["ai_recommended_action"],
            [
                rows(),
                average("avg_delay_minutes", F.col("predicted_delay_minutes"), 2),
                average("avg_prediction_probability", F.col(_PROBABILITY), 2, scale=100),
            ],
            [_modal_action("recommended_action")],
        )
        .orderBy(F.desc("records"), F.desc_nulls_last("avg_prediction_probability"), *keys)
        .limit(100)
    )


def route_signal_scatter(ai: DataFrame, limit: int = 60, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Observed against predicted actionable records of the routes that have either."""
    grouped = (
        where.apply(ai)
        .groupBy("route_id", labels.corridor_or_route().alias("corridor_name"))
        .agg(
            F.sum(actionable("actual_actionable_delay_risk")).alias("observed_records"),
            F.sum(actionable("predicted_actionable_delay_risk")).alias("ai_records"),
        )
    )
    return (
        grouped.filter((F.col("observed_records") > 0) | (F.col("ai_records") > 0))
        .orderBy(F.desc(F.greatest("observed_records", "ai_records")), "route_id", "corridor_name")
        .limit(limit)
    )


def route_focus(ai: DataFrame, route_id: str, where: DashboardFilter = DEFAULT) -> DataFrame:
    """One row about one route; where it has several corridors or types, the most frequent."""
    source = where.apply(ai).filter(F.col("route_id") == route_id)
    source = source.withColumns(
        {"corridor_name": labels.corridor_name(), "service_type": blank_to_null(F.col("service_type"))}
    )
    wet_share = derived(
        "avg_rain_pct",
        [tally("wet", F.coalesce(F.col("rain"), F.lit(0.0)) > 0), rows("all")],
        lambda wet, all_rows: F.round(wet * F.lit(100.0) / all_rows, 1),
    )
    measures = [
        rows(),
        average_minutes("avg_observed_delay", observed_seconds(source), 3),
        average("avg_predicted_delay", F.col("predicted_delay_minutes"), 3),
        average("avg_ai_probability_pct", F.col(_PROBABILITY), 2, scale=100),
        tally("ai_high_severe_cases", F.coalesce(F.col("ai_delay_risk").isin(*rules.ACTIONABLE_RISKS), F.lit(False))),
        wet_share,
        largest("max_wind_speed", F.col("wind_speed_10m"), lambda c: F.round(c, 1)),
        average("avg_precipitation", F.col("precipitation"), 2),
    ]
    # One group, and each mode only keeps a count per distinct name of this route.
    modes = {name: F.mode(F.col(name), True) for name in ("corridor_name", "service_type", "ai_recommended_action")}
    partials = [column for measure in measures for column in measure.partial_columns()]
    one = source.groupBy("route_id").agg(*partials, *(mode.alias(name) for name, mode in modes.items()))
    return one.groupBy("route_id", *modes).agg(*(measure.final_column() for measure in measures)).select(
        "route_id",
        "corridor_name",
        F.coalesce("service_type", F.lit(rules.UNMATCHED_SERVICE)).alias("service_type"),
        "records", "avg_observed_delay", "avg_predicted_delay", "avg_ai_probability_pct", "ai_high_severe_cases",
        F.coalesce("ai_recommended_action", F.lit(rules.UNAVAILABLE)).alias("recommended_action"),
        "avg_rain_pct", "max_wind_speed", "avg_precipitation",
    )


def route_action_mix(ai: DataFrame, route_id: str, where: DashboardFilter = DEFAULT) -> DataFrame:
    grouped = (
        where.apply(ai)
        .filter(F.col("route_id") == route_id)
        .groupBy(
            labels.ai_action_or_unavailable().alias("recommended_action"),
            labels.ai_risk_or_unknown().alias("ai_delay_risk"),
        )
        .agg(F.count(F.lit(1)).alias("records"))
    )
    return with_share(grouped).orderBy(F.desc("records"), "recommended_action", "ai_delay_risk")


def _evidence(decisions: DataFrame, keys, names: dict[str, str]) -> DataFrame:
    seconds = observed_seconds(decisions)
    return two_step(
        decisions,
        keys,
        ["trip_id"],
        [
            *(smallest(name, F.col(name)) for name in ("service_type", "route_display_name", "route_corridor_name")),
            smallest("route_type", F.col("route_type")),
            rows(),
            average_minutes("avg_delay_min", seconds, 2),
            average_minutes(names["abs"], F.abs(seconds), 2),
            largest_minutes("max_delay_min", seconds, 2),
            tally("severe_records", F.col("delay_risk") == "Severe"),
            tally("high_records", F.col("delay_risk") == "High"),
            tally("standby_records", F.col("recommended_action") == rules.STANDBY_ACTION),
            smallest(names["first"], F.col("collection_date")),
            largest(names["last"], F.col("collection_date")),
        ],
        [F.countDistinct("trip_id").alias("unique_trips")],
    )


def route_stats_ranked(
    decisions: DataFrame, min_records: int = 100, limit: int = 20, route_type: int = 3
) -> DataFrame:
    """Most delayed non-special routes of one mode (bus by default) with enough records."""
    source = exclude_special(decisions).filter(
        (F.col("route_type") == route_type) & ~F.startswith("route_id", F.lit(rules.SPECIAL_PREFIX))
    )
    ranked = _evidence(source, ["route_id"], {"abs": "avg_abs_delay_min", "first": "first_date", "last": "last_date"})
    return (
        ranked.filter(F.col("records") >= min_records)
        .orderBy(F.desc("avg_delay_min"), F.desc("severe_records"), F.desc("records"), "route_id")
        .limit(limit)
    )


def route_evidence(decisions: DataFrame, route_id: str) -> DataFrame:
    """The same measures for one route, over its whole period."""
    source = decisions.filter(F.col("route_id") == route_id)
    one = _evidence(
        source,
        ["route_id"],
        {"abs": "avg_absolute_delay_min", "first": "evidence_period_start", "last": "evidence_period_end"},
    )
    return one.withColumnRenamed("route_id", "selected_route").drop("route_type")


def route_risk_action_share(decisions: DataFrame, route_id: str) -> DataFrame:
    grouped = (
        decisions.filter(F.col("route_id") == route_id)
        .groupBy("delay_risk", "recommended_action")
        .agg(F.count(F.lit(1)).alias("records"))
    )
    return with_share(grouped).orderBy(labels.rank_of(F.col("delay_risk"), rules.RISK_ORDER), "recommended_action")
