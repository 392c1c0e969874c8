"""Weather context queries; weather is shown as context, never as a cause."""

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
    modal,
    observed_seconds,
    one_step,
    percent,
    rows,
    tally,
    two_step,
    with_share,
)
from delayloom.operators.filters import DEFAULT, DashboardFilter

_PROBABILITY = "predicted_actionable_probability"


def _probability_pct():
    return average("avg_ai_probability_pct", F.col(_PROBABILITY), 2, scale=100)


def weather_context(ai: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Records, probability, delays, wind and precipitation with and without rain."""
    source = where.apply(ai).withColumn("weather_condition", labels.rain_detected(F.col("rain")))
    return one_step(
        source,
        ["weather_condition"],
        [
            rows(),
            _probability_pct(),
            average_minutes("avg_observed_delay", observed_seconds(source), 3),
            average("avg_predicted_delay", F.col("predicted_delay_minutes"), 3),
            average("avg_wind_speed", F.col("wind_speed_10m"), 2),
            average("avg_precipitation", F.col("precipitation"), 2),
        ],
    ).orderBy(F.desc("records"), "weather_condition")


def weather_integration_summary(ai: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """How much of the table carries all five weather fields, and the period it covers."""
    complete = F.lit(True)
    for name in rules.WEATHER_COLUMNS:
        complete = complete & F.col(name).isNotNull()
    one = two_step(
        where.apply(ai),
        [],
        ["collection_date"],
        [rows(), tally("complete", complete)],
        [
            F.countDistinct("collection_date").alias("days"),
            F.min("collection_date").alias("start_date"),
            F.max("collection_date").alias("end_date"),
        ],
    )
    return one.select(
        F.coalesce("records", F.lit(0)).alias("records"), "days", "start_date", "end_date",
        percent(F.col("complete"), F.col("records")).alias("match_pct"),
    )


def rain_severity_breakdown(ai: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    source = where.apply(ai).withColumn("rain_band", labels.rain_band(F.col("rain")))
    grouped = one_step(
        source,
        ["rain_band"],
        [rows(), average_minutes("avg_observed_delay", observed_seconds(source), 3), _probability_pct()],
    )
    return with_share(grouped, "record_pct").orderBy(labels.rank_of(F.col("rain_band"), rules.RAIN_ORDER))


def daily_weather_events(ai: DataFrame, limit: int = 10, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Days with the most precipitation, then wind."""
    source = where.apply(ai)

    def two_decimals(column):
        return F.round(column, 2)

    return (
        one_step(
            source,
            ["collection_date"],
            [
                rows(),
                average_minutes("avg_observed_delay", observed_seconds(source), 2),
                average("avg_predicted_delay", F.col("predicted_delay_minutes"), 2),
                _probability_pct(),
                largest("max_rain", F.col("rain"), two_decimals),
                largest("max_precipitation", F.col("precipitation"), two_decimals),
                largest("max_wind_speed", F.col("wind_speed_10m"), two_decimals),
                average("avg_wind_speed", F.col("wind_speed_10m"), 2),
            ],
        )
        .orderBy(F.desc_nulls_last("max_precipitation"), F.desc_nulls_last("max_wind_speed"), "collection_date")
        .limit(limit)
    )


def service_type_weather_view(ai: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    source = where.apply(ai).withColumns(
        {
            "service_type": labels.known_service(rules.UNMATCHED_SERVICE),
            "weather_condition": labels.rain_detected(F.col("rain")),
        }
    )
    return one_step(
        source,
        ["service_type", "weather_condition"],
        [
            rows(),
            average_minutes("avg_observed_delay", observed_seconds(source), 3),
            _probability_pct(),
            average("avg_wind_speed", F.col("wind_speed_10m"), 2),
        ],
    ).orderBy("service_type", "weather_condition")


def weather_route_examples(ai: DataFrame, limit: int = 10, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Routes whose delays differ most between weather-exposed and dry records."""
    source = where.apply(ai)
    source = source.withColumns(
        {
            "service_type": labels.known_service(rules.UNMATCHED_SERVICE),
            "corridor_name": labels.corridor_name(),
            "exposed": labels.weather_exposed(F.col("rain"), F.col("wind_speed_10m")),
            "seconds": observed_seconds(source),
        }
    )
    exposed = F.col("exposed")

    def wet(name: str):
        return F.when(exposed, F.col(name))

    dry_seconds = F.when(~exposed, F.col("seconds"))
    delta = derived(
        "weather_delay_delta",
        [average_minutes("wet", wet("seconds"), None), average_minutes("dry", dry_seconds, None)],
        lambda wet_mean, dry_mean: F.round(wet_mean - dry_mean, 2),
    )
    action = F.col("ai_recommended_action")
    keys = ["route_id", "service_type", "corridor_name"]
    grouped = two_step(
        source,
        keys,
        ["ai_recommended_action"],
        [
            tally("weather_context_records", exposed),
            average_minutes("avg_observed_delay", wet("seconds"), 2),
            average_minutes("avg_dry_delay", dry_seconds, 2),
            delta,
            average("avg_predicted_delay", wet("predicted_delay_minutes"), 2),
            average("avg_ai_probability_pct", wet(_PROBABILITY), 2, scale=100),
            largest("max_rain", wet("rain"), lambda c: F.round(c, 2)),
            largest("max_wind_speed", wet("wind_speed_10m"), lambda c: F.round(c, 2)),
        ],
        [
            F.coalesce(modal(action, F.col("weather_context_records__n")), F.lit(rules.UNAVAILABLE)).alias(
                "common_ai_action"
            )
        ],
    )
    return (
        grouped.filter(F.col("weather_context_records") >= rules.MIN_WEATHER_EXPOSED_RECORDS)
        .orderBy(F.desc_nulls_last("weather_delay_delta"), F.desc("weather_context_records"), *keys)
        .limit(limit)
    )


def weather_features(lookup: DataFrame, explainability_type: str = "mean_abs_shap", limit: int = 8) -> DataFrame:
    """Weather features of an explanation lookup, most important first."""
    return (
        lookup.filter(
            F.col("feature").isin(*rules.WEATHER_COLUMNS) & (F.col("explainability_type") == explainability_type)
        )
        .orderBy(F.desc("importance"), "feature")
        .limit(limit)
        .select("feature", "importance", "operator_explanation")
    )
