"""Comparison of saved traffic-simulation scenarios."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayloom import rules
from delayloom.functions.measures import rule_rows


def scenario_trip_metrics(trips: DataFrame, scenarios: Sequence[str] = ()) -> DataFrame:
    """Completed trips and their durations per scenario; a listed scenario without trips has zeros."""
    measured = {
        "avg_duration_sec": F.avg("duration_sec"),
        "max_duration_sec": F.max("duration_sec"),
        "avg_time_loss_sec": F.avg("time_loss_sec"),
        "max_time_loss_sec": F.max("time_loss_sec"),
        "avg_waiting_time_sec": F.avg("waiting_time_sec"),
    }
    metrics = trips.groupBy("scenario_name").agg(
        F.count("duration_sec").alias("completed_trips"),
        *(F.round(aggregate, 2).alias(name) for name, aggregate in measured.items()),
    )
    if scenarios:
        listed = rule_rows(trips.sparkSession, ["scenario_name"], [(name,) for name in scenarios])
        metrics = listed.join(metrics, "scenario_name", "full")
    return metrics.select(
        "scenario_name",
        F.coalesce("completed_trips", F.lit(0)).alias("completed_trips"),
        *(F.coalesce(name, F.lit(0.0)).alias(name) for name in measured),
    )


STEP_VALUES = (
    "loaded", "inserted", "ended", "arrived", "halting", "mean_travel_time_sec", "mean_speed",
)


def scenario_last_step(steps: DataFrame) -> DataFrame:
    """Number of steps and the values of the last one, per scenario."""
    last = F.max_by(F.struct(*STEP_VALUES), "time_sec")
    return steps.groupBy("scenario_name").agg(
        F.count(F.lit(1)).alias("summary_steps"),
        F.max("time_sec").alias("last_time_sec"),
        last.alias("last"),
    ).select("scenario_name", "summary_steps", "last_time_sec", *(F.col(f"last.{name}") for name in STEP_VALUES))


def scenario_compare(trip_metrics: DataFrame, last_steps: DataFrame) -> DataFrame:
    return trip_metrics.join(last_steps, "scenario_name", "left")


def _value_of(scenario: str, column: str):
    return F.max(F.when(F.col("scenario_name") == scenario, F.col(column)))


def scenario_improvement(comparison: DataFrame, column: str = "avg_time_loss_sec") -> DataFrame:
    """Relative gain of the intervention over the disruption, in percent (0 without a disruption)."""
    one = comparison.agg(
        _value_of(rules.SCENARIO_DISRUPTION, column).alias("disruption"),
        _value_of(rules.SCENARIO_INTERVENTION, column).alias("intervention"),
    )
    gain = (F.col("disruption") - F.col("intervention")) / F.nullif("disruption", F.lit(0.0)) * 100
    return one.withColumn("improvement_pct", F.round(F.coalesce(gain, F.lit(0.0)), 1))


def scenario_results(comparison: DataFrame) -> DataFrame:
    """Delays in minutes and a congestion index relative to the baseline scenario."""
    baseline = comparison.agg(_value_of(rules.SCENARIO_BASELINE, "avg_duration_sec").alias("d")).scalar()
    index = F.col("avg_duration_sec") / F.nullif(baseline, F.lit(0.0)) * rules.CONGESTION_BASE_INDEX
    return comparison.select(
        "scenario_name",
        F.round(F.col("avg_time_loss_sec") / 60, 2).alias("avg_delay_min"),
        F.round(F.col("max_time_loss_sec") / 60, 2).alias("max_delay_min"),
        F.coalesce(F.round(index, 2), F.lit(0.0)).alias("congestion_index"),
    )


def scenario_report(results: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Selected route, scenario date and improvement, as stated in the texts or else computed."""
    facts = results.agg(
        F.min("selected_route").alias("route_id"),
        _value_of(rules.SCENARIO_DISRUPTION, "avg_delay_min").alias("disruption"),
        _value_of(rules.SCENARIO_INTERVENTION, "avg_delay_min").alias("intervention"),
        F.max(F.regexp_extract("validation_interpretation", r"(?i)(\d+(?:\.\d+)?)\s*percent\s+lower", 1)).alias("stated"),
    )
    date = scenarios.agg(F.max(F.regexp_extract("description", r"20\d{2}-\d{2}-\d{2}", 0)).alias("d")).scalar()
    gain = (F.col("disruption") - F.col("intervention")) / F.nullif("disruption", F.lit(0.0)) * 100
    return facts.select(
        F.coalesce("route_id", F.lit(rules.UNAVAILABLE)).alias("route_id"),
        F.coalesce(F.nullif(date, F.lit("")), F.lit("Documented in SUMO output")).alias("scenario_date"),
        F.coalesce(
            F.concat(F.nullif("stated", F.lit("")), F.lit("%")),
            F.concat(F.format_number(gain, 1), F.lit("%")),
            F.lit(rules.UNAVAILABLE),
        ).alias("improvement"),
    )
