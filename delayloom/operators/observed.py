"""Observed-delay dashboard queries (never mixed with predicted risk)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayloom import rules
from delayloom.functions import labels
from delayloom.functions.measures import (
    average_minutes,
    largest_minutes,
    observed_seconds,
    one_step,
    rows,
    tally,
)
from delayloom.functions.parsing import blank_to_null
from delayloom.operators.filters import DEFAULT, DashboardFilter, summary_filter
from delayloom.operators.summaries import weighted_mean


def _observed_measures(df: DataFrame):
    seconds = observed_seconds(df)
    return [
        rows(),
        average_minutes("avg_observed_delay", seconds, 3),
        largest_minutes("max_observed_delay", seconds, 3),
        tally("high_severe_cases", F.col("delay_risk").isin(*rules.ACTIONABLE_RISKS)),
    ]


def observed_daily_records(facts: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Per day over the records themselves."""
    source = where.apply(facts)
    return one_step(source, ["collection_date"], _observed_measures(source)).orderBy("collection_date")


def observed_daily_rollup(route_daily: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Per day rebuilt from the route-day summary, weighting each mean by its records."""
    source = summary_filter(route_daily, where).dropna(subset=["collection_date"])
    return (
        source.groupBy("collection_date")
        .agg(
            F.sum("records").alias("records"),
            weighted_mean("avg_delay_minutes", "records", 3).alias("avg_observed_delay"),
            F.max("max_delay_minutes").alias("max_observed_delay"),
        )
        .orderBy("collection_date")
    )


def top_observed_routes_records(facts: DataFrame, limit: int = 10, where: DashboardFilter = DEFAULT) -> DataFrame:
    source = where.apply(facts).withColumns(
        {
            "corridor_name": labels.corridor_name(),
            "route_name": F.coalesce(blank_to_null(F.col("route_display_name")), "route_short_name", "route_id"),
            "service_type": labels.known_service(rules.UNKNOWN_SERVICE),
        }
    )
    keys = ["route_id", "service_type", "corridor_name", "route_name"]
    return (
        one_step(source, keys, _observed_measures(source))
        .orderBy(F.desc("avg_observed_delay"), F.desc("high_severe_cases"), *keys)
        .limit(limit)
    )


def top_observed_routes_rollup(
    route_daily: DataFrame, corridors: DataFrame, limit: int = 10, where: DashboardFilter = DEFAULT
) -> DataFrame:
    """The same ranking from the route-day summary; ``corridors`` is (route_id, corridor_name)."""
    keys = ["route_id", "service_type", "route_display_name", "is_special_route"]
    grouped = (
        summary_filter(route_daily, where)
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.sum("records").alias("records"),
            weighted_mean("avg_delay_minutes", "records", 3).alias("avg_observed_delay"),
            F.max("max_delay_minutes").alias("max_observed_delay"),
        )
    )
    # The corridor does not take part in the ranking, so only the top rows are joined.
    top = grouped.orderBy(F.desc("avg_observed_delay"), F.desc("max_observed_delay"), *keys).limit(limit)
    named = top.join(corridors, "route_id", "left").withColumn(
        "corridor_name", F.coalesce("corridor_name", "route_display_name")
    )
    return named.orderBy(F.desc("avg_observed_delay"), F.desc("max_observed_delay"), *keys).select(
        "route_id", "service_type", "corridor_name", "route_display_name", "is_special_route", "records",
        "avg_observed_delay", "max_observed_delay",
    )


def _bin_mid(minutes):
    limit, width = rules.HISTOGRAM_LIMIT_MINUTES, rules.HISTOGRAM_BIN_MINUTES
    clipped = F.greatest(F.least(minutes, F.lit(float(limit))), F.lit(-float(limit)))
    return (F.floor(clipped / width) * width + 1).cast("bigint")


def delay_histogram_records(facts: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Two-minute bins of the clipped record delays; +30 and above fall in the bin centred on 31."""
    minutes = F.col("delay_minutes")
    source = where.apply(facts).filter(minutes.isNotNull())
    return (
        source.groupBy(_bin_mid(minutes).alias("bin_mid"))
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("band", labels.timing_band(F.col("bin_mid")))
        .orderBy("bin_mid")
    )


def delay_histogram_route_days(route_daily: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """Bins of the route-day means, empty bins included; +30 lies outside the right-open last bin."""
    limit, width = rules.HISTOGRAM_LIMIT_MINUTES, rules.HISTOGRAM_BIN_MINUTES
    value = F.col("avg_delay_minutes")
    counts = (
        summary_filter(route_daily, where)
        .filter(value.isNotNull() & (value < limit))
        .groupBy(_bin_mid(value).alias("bin_mid"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    grid = route_daily.sparkSession.range(-limit + 1, limit, width).select(F.col("id").alias("bin_mid"))
    return (
        grid.join(counts, "bin_mid", "left")
        .select("bin_mid", F.coalesce("count", F.lit(0)).alias("count"))
        .withColumn("band", labels.timing_band(F.col("bin_mid")))
        .orderBy("bin_mid")
    )
