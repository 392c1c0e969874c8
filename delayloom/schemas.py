"""Column contracts of the landed files and published tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(), "BIGINT": T.LongType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(), "TIMESTAMP": T.TimestampType(),
}


def _fields(spec: str) -> T.StructType:
    """A flat schema from ``name TYPE`` pairs (usable before any session exists)."""
    pairs = (part.split() for part in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_COLUMNS = (
    "collection_time_utc", "entity_id", "trip_id", "route_id", "direction_id", "start_time",
    "start_date", "timestamp", "delay_seconds", "is_deleted", "delay_minutes",
)
RAW_OBSERVATION = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

_TRIP = _fields("trip_id STRING, route_id STRING, direction_id INT, start_time STRING, start_date STRING")
_UPDATE = _fields("timestamp BIGINT, delay DOUBLE").add("trip", _TRIP)
_ENTITY = _fields("id STRING, is_deleted BOOLEAN").add("trip_update", _UPDATE)
SNAPSHOT = _fields("collection_time_utc STRING").add(
    "response", T.StructType([T.StructField("entity", T.ArrayType(_ENTITY))])
)

DERIVED_COLUMNS = (
    "collection_date", "source_file", "collection_day_status", "collection_coverage_hours",
    "is_partial_day", "is_model_baseline_day", "agency_id", "route_short_name", "route_long_name",
    "route_type", "service_type", "route_display_name", "is_special_route",
)
CLEAN_COLUMNS = RAW_COLUMNS + DERIVED_COLUMNS
CLEAN_OBSERVATION = _fields("""
    collection_time_utc TIMESTAMP, entity_id STRING, trip_id STRING, route_id STRING, direction_id BIGINT,
    start_time STRING, start_date BIGINT, timestamp BIGINT, delay_seconds DOUBLE, is_deleted BOOLEAN,
    delay_minutes DOUBLE, collection_date STRING, source_file STRING, collection_day_status STRING,
    collection_coverage_hours DOUBLE, is_partial_day BOOLEAN, is_model_baseline_day BOOLEAN, agency_id STRING,
    route_short_name STRING, route_long_name STRING, route_type INT, service_type STRING,
    route_display_name STRING, is_special_route BOOLEAN
""")

ROUTE_METADATA_COLUMNS = (
    "route_id", "agency_id", "route_short_name", "route_long_name", "route_type", "service_type",
    "route_display_name",
)

DECISION = _fields("""
    collection_time_utc TIMESTAMP, collection_date STRING, collection_day_status STRING,
    collection_coverage_hours DOUBLE, is_partial_day BOOLEAN, is_model_baseline_day BOOLEAN,
    route_id STRING, route_short_name STRING, route_long_name STRING, route_type BIGINT, agency_id STRING,
    service_type STRING, route_display_name STRING, route_corridor_name STRING, is_special_route BOOLEAN,
    trip_id STRING, direction_id BIGINT, delay_seconds DOUBLE, delay_minutes DOUBLE, delay_risk STRING,
    recommended_action STRING, trip_hour BIGINT, weekday BIGINT, day_of_month BIGINT,
    temperature_2m DOUBLE, precipitation DOUBLE, rain DOUBLE, relative_humidity_2m DOUBLE,
    wind_speed_10m DOUBLE, source_file STRING
""")
DECISION_COLUMNS = tuple(DECISION.names)

DASHBOARD_REQUIRED = (
    "delay_risk", "recommended_action", "route_corridor_name", "service_type", "route_display_name",
    "is_special_route", "temperature_2m", "precipitation", "rain", "relative_humidity_2m", "wind_speed_10m",
    "collection_day_status", "collection_coverage_hours", "is_partial_day", "is_model_baseline_day",
)

CATEGORICAL_FEATURES = (
    "route_id", "route_display_name", "route_corridor_name", "service_type", "route_type", "direction_id",
    "is_special_route",
)
NUMERIC_FEATURES = (
    "trip_hour", "weekday", "day_of_month", "temperature_2m", "precipitation", "rain",
    "relative_humidity_2m", "wind_speed_10m",
)
FEATURES = CATEGORICAL_FEATURES + NUMERIC_FEATURES

PREDICTION_CONTEXT = (
    "collection_time_utc", "collection_date", "route_id", "route_short_name", "route_display_name",
    "route_corridor_name", "service_type", "route_type", "direction_id", "is_special_route", "delay_minutes",
    "delay_risk", "recommended_action", "trip_hour", "weekday", "day_of_month", "temperature_2m",
    "precipitation", "rain", "relative_humidity_2m", "wind_speed_10m", "collection_day_status",
    "collection_coverage_hours", "is_partial_day", "is_model_baseline_day",
)
MODEL_INPUT_COLUMNS = PREDICTION_CONTEXT
PREDICTION_OUTPUTS = (
    "actual_actionable_delay_risk", "predicted_actionable_delay_risk", "predicted_actionable_probability",
    "predicted_delay_minutes",
)
AI_REQUIRED = PREDICTION_CONTEXT + PREDICTION_OUTPUTS
AI_ADDED = ("ai_delay_risk", "ai_recommended_action", "ai_confidence_band", "ai_decision_basis")

MANIFEST_COLUMNS = (
    "collection_date", "collection_day_status", "collection_note", "is_model_baseline_day", "is_partial_day",
    "collection_coverage_hours", "raw_csv_rows", "cleaned_rows", "duplicate_header_rows", "unique_routes",
    "unique_trips", "first_collection_time_utc", "last_collection_time_utc", "delay_outliers_abs_gt_120",
    "source_file",
)

ROUTES = _fields("route_id STRING, agency_id STRING, route_short_name STRING, route_long_name STRING, route_type STRING")
TRIPS = _fields("route_id STRING, trip_id STRING, direction_id STRING, trip_headsign STRING, shape_id STRING")
SHAPES = _fields("shape_id STRING, shape_pt_lat DOUBLE, shape_pt_lon DOUBLE, shape_pt_sequence INT")
STOPS = _fields("stop_id STRING, stop_name STRING, stop_lat DOUBLE, stop_lon DOUBLE")
STOP_TIMES = _fields("trip_id STRING, stop_id STRING, stop_sequence INT")
CALENDAR = _fields("""service_id STRING, monday INT, tuesday INT, wednesday INT, thursday INT, friday INT,
    saturday INT, sunday INT, start_date STRING, end_date STRING""")
CALENDAR_DATES = _fields("service_id STRING, date STRING, exception_type INT")
STATIC_TABLES = {
    "routes": ROUTES, "trips": TRIPS, "shapes": SHAPES, "stops": STOPS, "stop_times": STOP_TIMES,
    "calendar": CALENDAR, "calendar_dates": CALENDAR_DATES,
}

_HOURLY_VALUES = (
    "temperature_2m", "precipitation", "rain", "relative_humidity_2m", "wind_speed_10m", "surface_pressure",
)
WEATHER_JSON = T.StructType().add(
    "hourly",
    T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(name, T.ArrayType(T.DoubleType())) for name in _HOURLY_VALUES]
    ),
)

METRIC_LONG = _fields("model STRING, target_type STRING, target STRING, metric STRING, value DOUBLE, notes STRING")
IMPORTANCE_LONG = _fields("source STRING, explainability_type STRING, feature STRING, importance DOUBLE, notes STRING")
CONTRIBUTION_LONG = _fields("feature STRING, shap_value DOUBLE, value_norm DOUBLE, mean_abs DOUBLE, row_id INT")
