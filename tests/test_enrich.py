"""Joins, corridors, endpoints and paths."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from delayloom.operators import enrich

ROUTES = "route_id string, agency_id string, route_short_name string, route_long_name string, route_type string"
TRIPS = "route_id string, trip_id string, direction_id string, trip_headsign string, shape_id string"


def test_routes_fill_unmatched_and_flag_special(spark):
    obs = spark.createDataFrame([("a",), ("s9",), (None,)], "route_id string")
    routes = enrich.route_metadata(spark.createDataFrame([("a", "g", "1", "One", "3"), ("a", "g", "1", "One", "3")], ROUTES))
    out = {r.route_id: r for r in enrich.attach_routes(obs, routes).collect()}
    assert len(out) == 3
    assert (out["a"].service_type, out["a"].route_display_name, out["a"].is_special_route) == ("Bus", "1 - One", False)
    assert (out["s9"].service_type, out["s9"].route_display_name, out["s9"].is_special_route) == (
        "Unknown / unmatched route", "s9", True)
    assert out[None].is_special_route is False


def test_checked_join_rejects_repeated_keys(spark):
    facts = spark.createDataFrame([("a",)], "route_id string")
    good = spark.createDataFrame([("a", 1)], "route_id string, x int")
    assert enrich.attach_checked(facts, good, ["route_id"]).first().x == 1
    with pytest.raises(ValueError, match="not unique"):
        enrich.attach_checked(facts, good.union(good), ["route_id"])


def test_weather_joins_on_the_utc_hour(spark):
    obs = spark.createDataFrame([(datetime(2026, 5, 11, 8, 59),), (datetime(2026, 5, 11, 9, 0),)], "collection_time_utc timestamp")
    weather = spark.createDataFrame([(datetime(2026, 5, 11, 8), 1.0, 2.0, 3.0, 4.0, 5.0)] * 2,
                                    "weather_hour timestamp, temperature_2m double, precipitation double, rain double, relative_humidity_2m double, wind_speed_10m double")
    out = enrich.attach_weather(obs, weather).orderBy("collection_time_utc").collect()
    assert [r.rain for r in out] == [3.0, None]


def test_weather_recovered_from_decisions_takes_the_first_record(spark):
    ddl = "collection_time_utc string, temperature_2m double, precipitation double, rain double, relative_humidity_2m double, wind_speed_10m double"
    df = spark.createDataFrame([("2026-05-11T08:30:00Z", 9.0, 0.0, 0.0, 0.0, 0.0), ("2026-05-11T08:10:00Z", 7.0, 0.0, 0.0, 0.0, 0.0),
                                ("never", 1.0, 0.0, 0.0, 0.0, 0.0)], ddl)
    assert [r.temperature_2m for r in enrich.weather_from_decision_table(df).collect()] == [7.0]


def test_local_weather_key(spark):
    obs = spark.createDataFrame([(0,)], "timestamp bigint").withColumn("collection_time_utc", F.lit(None).cast("timestamp"))
    weather = spark.createDataFrame([("1970-01-01 12:00:00", 1.5)], "t string, rain double").select(
        F.col("t").cast("timestamp_ntz").alias("weather_hour"), "rain")
    assert enrich.attach_weather_local(obs, weather, columns=["rain"]).first().rain == 1.5


def test_corridor_labels_keep_order_and_drop_blanks(spark):
    trips = spark.createDataFrame(
        [("a", "t2", "0", "Harbour To City", "s"), ("a", "t1", "0", " City to Airport ", "s"), ("a", "t3", "0", "  ", "s"),
         ("b", "t1", "0", "Loop", "s"), ("c", "t1", "0", None, "s"), ("d", "t1", "0", "12", "s"), ("e", "t1", "0", "A To B To C", "s")], TRIPS)
    routes = spark.createDataFrame([("a", "g", "10", "", "3"), ("d", "g", "12", "", "3")], ROUTES)
    out = {r.route_id: r.route_corridor_name for r in enrich.corridor_labels(trips, routes).collect()}
    assert out == {"a": "10 - City / Airport", "b": "b - Loop", "c": "c", "d": "12", "e": "e - A / B To C"}
    looked = {r.route_id: r.route_corridor_name for r in enrich.corridor_lookup(
        routes.union(spark.createDataFrame([("z", "g", None, "", "3")], ROUTES)), enrich.corridor_labels(trips, routes)).collect()}
    assert looked == {"a": "10 - City / Airport", "d": "12", "z": "z"}


def test_route_endpoints(spark):
    trips = spark.createDataFrame([("a", "t2", "0", "h", "s"), ("a", "t1", "0", "first", "s"), ("b", "t9", "1", "x", "s")], TRIPS)
    calls = spark.createDataFrame([("t1", "p", 2), ("t1", "q", 1), ("t1", "r", 10), ("t9", "p", 1)], "trip_id string, stop_id string, stop_sequence int")
    stops = spark.createDataFrame([(s, s.upper(), 1.0, 2.0) for s in "pqr"], "stop_id string, stop_name string, stop_lat double, stop_lon double")
    out = enrich.route_endpoints(trips, calls, stops, "a").collect()
    assert {(r.role, r.stop_name, r.trip_headsign) for r in out} == {("start", "Q", "first"), ("end", "R", "first")}


def test_route_path_takes_the_most_used_shape_in_sequence(spark):
    trips = spark.createDataFrame([("a", f"t{i}", "0", "h", s) for i, s in enumerate(["s1", "s2", "s2", None])], TRIPS)
    shapes = spark.createDataFrame([("s2", 1.0, 10.0, 2), ("s2", 3.0, 30.0, 1), ("s1", 0.0, 0.0, 1)],
                                   "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int")
    row = enrich.route_path(trips, shapes, "a").first()
    assert row.shape_id == "s2" and row.path == [[30.0, 3.0], [10.0, 1.0]] and (row.latitude, row.longitude) == (2.0, 20.0)
    assert enrich.busiest_routes(trips).first().trips == 4


def test_corridor_lookup_from_summary_prefers_most_records(spark):
    df = spark.createDataFrame([("a", "X", 1), ("a", "Y", 5), ("a", " ", 9), ("b", None, 2)], "route_id string, route_corridor_name string, records int")
    assert [tuple(r) for r in enrich.route_corridor_lookup(df).collect()] == [("a", "Y")]


def test_completeness_join_cannot_fan_out(spark):
    obs = spark.createDataFrame([("2026-05-11",)], "collection_date string")
    manifest = spark.createDataFrame([("2026-05-11", "likely_complete", 24.0, False, True)] * 2,
                                     "collection_date string, collection_day_status string, collection_coverage_hours double, is_partial_day boolean, is_model_baseline_day boolean")
    assert enrich.attach_completeness(obs, manifest).count() == 1
