"""Several results of one dashboard page from one filtered scan."""

from __future__ import annotations

from contextlib import contextmanager
from typing import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from delayloom.operators import network, observed, prediction, routes, weather
from delayloom.operators.filters import DEFAULT, EVERYTHING, DashboardFilter

PAGE_COLUMNS = (
    "collection_date", "trip_hour", "route_id", "route_short_name", "route_display_name", "route_corridor_name",
    "service_type", "is_special_route", "delay_seconds", "delay_minutes", "delay_risk", "rain", "precipitation",
    "wind_speed_10m", "actual_actionable_delay_risk", "predicted_actionable_delay_risk",
    "predicted_actionable_probability", "predicted_delay_minutes", "ai_delay_risk", "ai_recommended_action",
)


@contextmanager
def page_bundle(ai: DataFrame, where: DashboardFilter = DEFAULT) -> Iterator[dict[str, DataFrame]]:
    """The overview page's tables over one cached, filtered and column-pruned fact.

    The cache spills to disk and can be rebuilt from the scan; it is released
    on leaving the block.
    """
    columns = [name for name in PAGE_COLUMNS if name in ai.columns]
    facts = where.apply(ai).select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield {
            "network_kpis": network.network_kpis(facts, EVERYTHING),
            "decision_summary": network.decision_summary(facts, EVERYTHING),
            "attention_summary": network.attention_summary(facts, EVERYTHING),
            "top_routes": routes.top_routes(facts, 10, EVERYTHING),
            "timing_mix": prediction.timing_mix(facts, EVERYTHING),
            "weather_context": weather.weather_context(facts, EVERYTHING),
            "delay_histogram": observed.delay_histogram_records(facts, EVERYTHING),
        }
    finally:
        facts.unpersist()
