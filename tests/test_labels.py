"""Parsing and labels on boundary values."""

import pytest
from pyspark.sql import functions as F

from delayloom.functions import labels, parsing


def values(spark, expression, data, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_delay_risk_bounds_are_right_closed_on_the_absolute_delay(spark):
    data = [0.0, 5.0, -5.0, 5.01, 15.0, -15.0, 25.0, 25.5, -60.0, None]
    assert values(spark, labels.delay_risk, data, "double") == [
        "Low", "Low", "Low", "Medium", "Medium", "Medium", "High", "Severe", "Severe", None]


def test_signed_risk_keeps_early_running_low(spark):
    assert values(spark, lambda c: labels.delay_risk(c, signed=True), [-60.0, 26.0], "double") == ["Low", "Severe"]


def test_probability_bands_are_left_closed(spark):
    data = [0.0, 0.499999, 0.5, 0.7, 0.85, 1.0]
    assert values(spark, labels.ai_delay_risk, data, "double") == ["Low", "Low", "Medium", "High", "Severe", "Severe"]


def test_timing_rain_and_exposure(spark):
    assert values(spark, labels.timing_band, [-1.01, -1.0, 1.0, 1.01], "double") == [
        "Early-running", "Near on-time", "Near on-time", "Late-running"]
    assert values(spark, labels.rain_band, [None, 0.0, 0.5, 2.0, 2.1], "double") == [
        "No rain", "No rain", "Light rain", "Moderate rain", "Heavier rain"]
    assert values(spark, lambda c: labels.weather_exposed(F.lit(0.0), c), [29.9, 30.0, None], "double") == [
        False, True, False]


def test_weather_rule_prefers_rain_over_wind(spark):
    assert values(spark, lambda c: labels.weather_rule(F.lit(0.0), F.lit(0.1), c), [40.0], "double") == [
        "Rain / precipitation"]
    assert values(spark, lambda c: labels.weather_context(F.lit(None).cast("double"), F.lit(0.0), c), [40.0, 3.0],
                  "double") == ["Adverse weather context", "Normal / no adverse weather flag"]


@pytest.mark.parametrize("short,long,route,expected", [
    ("10", "Ten", "r", "10 - Ten"), ("10", "10", "r", "10"), (None, "Ten", "r", "Ten"), (" 10 ", None, "r", "10"),
    ("", " ", "r", "r"), (None, None, "r", "r")])
def test_route_display_name(spark, short, long, route, expected):
    df = spark.createDataFrame([(short, long, route)], "s string, l string, r string")
    assert df.select(labels.route_display_name(F.col("s"), F.col("l"), F.col("r"))).first()[0] == expected


def test_service_type_and_prefix(spark):
    assert values(spark, labels.service_type, [2, 3, 4, 5, None], "int") == [
        "Train / Rail", "Bus", "Ferry", "Unknown / unmatched route", "Unknown / unmatched route"]
    assert values(spark, labels.transport_mode, [2, 3, 4, 712], "int") == ["Train", "Bus", "Ferry", "Other"]
    assert values(spark, labels.route_prefix, ["NX1-203", "128-202", "s042"], "string") == ["NX", "numeric_or_other", "s"]
    assert values(spark, labels.has_special_prefix, ["s042", "S1", "NX1"], "string") == [True, True, False]


def test_feature_texts(spark):
    data = ["route_id_12", "route_type_3", "trip_hour", "rain", "direction_id_0"]
    assert values(spark, labels.feature_operator_category, data, "string") == [
        "Route pattern", "Service type / mode", "Time pattern", "Weather context",
        "Operational / encoded model feature"]
    assert values(spark, labels.feature_text, data, "string") == [
        "Route 12", "route type 3", "Time of day", "rain", "Direction of travel"]
    assert values(spark, labels.feature_category, ["Low-frequency routes", "Service x", "weekday", "rain", "direction_id", "q"],
                  "string") == ["Route", "Service", "Time", "Weather", "Direction", "Other"]
    assert values(spark, labels.readable_corridor, ["10 - A / B - C", "plain"], "string") == ["A / B - C", "plain"]
    assert values(spark, labels.short_action, ["No operational action required", "Other"], "string") == [
        "No action required", "Other"]


def test_tolerant_numbers_flags_and_times(spark):
    assert values(spark, parsing.to_double, ["1.5", " 2 ", "x", "1d", "nan", None], "string") == [
        1.5, 2.0, None, None, None, None]
    assert values(spark, parsing.to_long, ["3", "3.0", "1e3", "x"], "string") == [3, 3, 1000, None]
    assert values(spark, parsing.to_flag, ["TRUE", "1", "False", "0", "x", None], "string") == [
        True, True, False, False, None, None]
    times = values(spark, lambda c: parsing.to_utc_timestamp(c).cast("string"),
                   ["2026-05-06T01:02:03+00:00", "2026-05-06 01:02:03", "2026-05-06T13:02:03+12:00", "12:30", "soon"],
                   "string")
    assert times == ["2026-05-06 01:02:03"] * 3 + [None, None]
    assert parsing.hour_of_label("08:00") == 8
    assert values(spark, parsing.hour_label, [8], "int") == ["08:00"]
    assert values(spark, parsing.clock_hour, ["25:10:00", "bad"], "string") == [25, None]
    assert values(spark, lambda c: parsing.local_wall_clock(c).cast("string"), [0], "bigint") == ["1970-01-01 12:00:00"]
