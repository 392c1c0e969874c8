"""Rule tables, thresholds and labels, one place each."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Labels, bands and texts that published results must carry.
# ---------------------------------------------------------------------------

RISK_ORDER = ("Low", "Medium", "High", "Severe")
ACTIONABLE_RISKS = ("High", "Severe")

# Absolute observed delay in minutes, right-closed upper bounds.
DELAY_RISK_UPPER_MINUTES = (("Low", 5), ("Medium", 15), ("High", 25))
# Predicted probability, right-open upper bounds.
AI_RISK_UPPER_PROBABILITY = (("Low", 0.50), ("Medium", 0.70), ("High", 0.85))

ACTION_BY_RISK = {
    "Low": "No operational action required",
    "Medium": "Monitor route conditions",
    "High": "Adjust service headway",
    "Severe": "Deploy standby bus or supervisor review",
}
# The first prototype used a shorter last action.
PROTOTYPE_ACTION_BY_RISK = {**ACTION_BY_RISK, "Severe": "Deploy standby bus"}
INTERVENTION_ACTIONS = ("Adjust service headway", "Deploy standby bus")
STANDBY_ACTION = ACTION_BY_RISK["Severe"]

CONFIDENCE_BY_RISK = {
    "Low": "Low action probability",
    "Medium": "Moderate action probability",
    "High": "High action probability",
    "Severe": "Severe action probability",
}
AI_DECISION_BASIS = "AI actionable-risk probability mapped to operational recommendation."

INTERVENTION_LOGIC = (
    ("Low", "0 to 5 minutes absolute delay", "Service is operating within an acceptable tolerance."),
    ("Medium", "More than 5 and up to 15 minutes absolute delay",
     "Route should be watched for emerging disruption patterns."),
    ("High", "More than 15 and up to 25 minutes absolute delay",
     "Operations may need spacing or dispatch adjustments."),
    ("Severe", "More than 25 minutes absolute delay",
     "High disruption risk that may need active intervention."),
)

SERVICE_TYPE_BY_ROUTE_TYPE = {2: "Train / Rail", 3: "Bus", 4: "Ferry"}
TRANSPORT_MODE_BY_ROUTE_TYPE = {2: "Train", 3: "Bus", 4: "Ferry"}
UNKNOWN_SERVICE = "Unknown / unmatched route"
SPECIAL_SERVICE = "School/Special Services"
UNMATCHED_SERVICE = "School/Special or unmatched services"
UNAVAILABLE = "Unavailable"
UNKNOWN = "Unknown"
ALL_SERVICES = "All"
ALL_DAYS = "All days"
ALL_HOURS = "All hours"
SPECIAL_PREFIX = "S"

DAY_COMPLETE = "likely_complete"
DAY_PARTIAL = "partial_or_interrupted"

MIN_REASONABLE_DELAY_MINUTES = -60
MAX_REASONABLE_DELAY_MINUTES = 120
OUTLIER_MINUTES = 120

TIMING_ORDER = ("Early-running", "Near on-time", "Late-running")
TIMING_TOLERANCE_MINUTES = 1

RAIN_ORDER = ("No rain", "Light rain", "Moderate rain", "Heavier rain")
RAIN_UPPER_MM = (("Light rain", 0.5), ("Moderate rain", 2.0))
RAIN_DETECTED = "Rain detected"
NO_RAIN_DETECTED = "No rain detected"
HIGH_WIND_KMH = 30
ADVERSE_WEATHER = "Adverse weather context"
NORMAL_WEATHER = "Normal / no adverse weather flag"
RULE_RAIN = "Rain / precipitation"
RULE_WIND = "High wind"
RULE_NONE = "No adverse weather flag"
MIN_WEATHER_EXPOSED_RECORDS = 50

HISTOGRAM_LIMIT_MINUTES = 30
HISTOGRAM_BIN_MINUTES = 2

WEATHER_COLUMNS = (
    "temperature_2m", "precipitation", "rain", "relative_humidity_2m", "wind_speed_10m",
)
TIME_FEATURES = ("trip_hour", "weekday", "day_of_month")

FEATURE_CATEGORY_TEXT = {
    "Route pattern": "Specific routes or grouped route patterns contributed to the model signal.",
    "Service type / mode": "The type of public transport service contributed to the model signal.",
    "Time pattern": "Time-based operating patterns contributed to the model signal.",
    "Weather context": "Weather is treated as contextual evidence, not proof of delay causation.",
    "Operational / encoded model feature": "Encoded feature retained for technical traceability.",
}
FEATURE_DISPLAY_LABELS = {
    "route_id_infrequent_sklearn": "Low-frequency routes (grouped)",
    "service_type_Train / Rail": "Service type: Train / Rail",
}
# Applied in this order.
FEATURE_TEXT_REPLACEMENTS = (
    ("trip_hour", "Time of day"),
    ("weekday", "Day of week"),
    ("day of month", "Date pattern"),
    ("direction_id_0", "Direction of travel"),
    ("direction_id 0", "Direction of travel"),
    ("route_id_", "Route "),
    ("route id ", "Route "),
    ("service_type_", "Service type: "),
    ("_", " "),
)
INFREQUENT_CATEGORY = "infrequent_sklearn"

ACTION_SHORT_LABELS = {"No operational action required": "No action required"}
ACTION_CHART_LABELS = {
    **ACTION_SHORT_LABELS,
    "Deploy standby bus or supervisor review": "Deploy standby bus / supervisor review",
}

SCENARIO_BASELINE = "Baseline Operations"
SCENARIO_DISRUPTION = "Disruption Scenario"
SCENARIO_INTERVENTION = "Intervention Scenario"
CONGESTION_BASE_INDEX = 35
