"""From observations to the published decision table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from delayloom import rules
from delayloom.functions.measures import rule_rows
from delayloom.operators import cleaning, enrich, summaries
from delayloom.plans.storage_build import SALTS
from delayloom.sources import writers


def integrate(
    obs: DataFrame,
    routes: DataFrame,
    trips: DataFrame,
    weather: DataFrame,
    lo: float = rules.MIN_REASONABLE_DELAY_MINUTES,
    hi: float = rules.MAX_REASONABLE_DELAY_MINUTES,
    salts: int = SALTS,
) -> DataFrame:
    """Outlier filter, time features, route names, weather, risk and action; a route named twice is an error."""
    routes = enrich.require_unique(routes, ["route_id"])
    timed = cleaning.add_time_features(cleaning.filter_outliers(cleaning.drop_incomplete(obs), lo, hi))
    if "service_type" not in timed.columns:
        timed = enrich.attach_routes(timed, enrich.route_metadata(routes), salts)
    corridors = enrich.corridor_lookup(routes, enrich.corridor_labels(trips, routes))
    named = enrich.attach_corridors(timed.drop("route_corridor_name"), corridors, salts)
    return cleaning.decision_table(cleaning.label_decisions(enrich.attach_weather(named, weather)))


def publish_decisions(decisions: DataFrame, out_dir: str) -> DataFrame:
    """Write the decision table by day and its three summaries; returns the stored table."""
    writers.write_daily_table(decisions, f"{out_dir}/decisions")
    stored = writers.read_daily_table(decisions.sparkSession, f"{out_dir}/decisions", decisions.columns)
    small = {
        "daily_summary_weather": summaries.daily_summary_with_weather(stored),
        "route_daily_named": summaries.route_daily_summary_named(stored),
        "top_delayed_record_mean": summaries.top_delayed_routes_by_record_mean(stored),
        "route_delay_risk": summaries.route_delay_risk_summary(stored),
        "service_type_delay": summaries.service_type_delay_summary(stored),
        "weather_delay_risk": summaries.weather_delay_risk_summary(stored),
        "intervention_logic": intervention_logic(decisions.sparkSession),
    }
    for name, table in small.items():
        table.write.mode("overwrite").parquet(f"{out_dir}/{name}")
    return stored


def intervention_logic(spark: SparkSession) -> DataFrame:
    """The rule table behind observed risk and action, as data."""
    rows = [
        (risk, rule, rules.ACTION_BY_RISK[risk], meaning) for risk, rule, meaning in rules.INTERVENTION_LOGIC
    ]
    return rule_rows(spark, ["delay_risk", "delay_minutes_rule", "recommended_action", "operational_meaning"], rows)
