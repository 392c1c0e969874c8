import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from delayloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
           "spark.sql.maxMetadataStringLength": "5000"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def rows():
    """Collected rows as sorted plain tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in picked.collect()), key=lambda row: tuple(str(v) for v in row))

    return collect


FACT_DDL = """collection_time_utc timestamp, collection_date string, route_id string, route_short_name string,
    route_display_name string, route_corridor_name string, service_type string, is_special_route boolean,
    trip_id string, trip_hour int, delay_seconds bigint, delay_minutes double, delay_risk string,
    recommended_action string, rain double, precipitation double, wind_speed_10m double,
    actual_actionable_delay_risk int, predicted_actionable_delay_risk int, predicted_actionable_probability double,
    predicted_delay_minutes double, ai_delay_risk string, ai_recommended_action string"""


@pytest.fixture
def facts(spark):
    """Build AI decision rows from partial dictionaries; unnamed columns take plain defaults."""
    from datetime import datetime

    names = [part.split()[0] for part in FACT_DDL.replace("\n", " ").split(",")]
    defaults = {
        "collection_time_utc": datetime(2026, 5, 11, 8), "collection_date": "2026-05-11", "route_id": "10-1",
        "route_short_name": "10", "route_display_name": "10 - Ten", "route_corridor_name": "10 - A / B",
        "service_type": "Bus", "is_special_route": False, "trip_id": "t1", "trip_hour": 8, "delay_seconds": 60,
        "delay_risk": "Low", "recommended_action": "No operational action required", "rain": 0.0,
        "precipitation": 0.0, "wind_speed_10m": 5.0, "actual_actionable_delay_risk": 0,
        "predicted_actionable_delay_risk": 0, "predicted_actionable_probability": 0.2,
        "predicted_delay_minutes": 1.0, "ai_delay_risk": "Low",
        "ai_recommended_action": "No operational action required",
    }

    def build(*records):
        data = []
        for record in records:
            row = {**defaults, **record}
            if "delay_minutes" not in row:
                row["delay_minutes"] = None if row["delay_seconds"] is None else row["delay_seconds"] / 60
            data.append(tuple(row[name] for name in names))
        return spark.createDataFrame(data, FACT_DDL)

    return build
