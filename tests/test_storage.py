"""Readers, writers and the storage build, from landed files to published tables."""

import json

import pytest
from pyspark.sql import functions as F

from delayloom import schemas
from delayloom.operators import scenario, summaries
from delayloom.plans import decision_support, integration
from delayloom.plans.storage_build import build_storage
from delayloom.sources import readers, views, writers

HEADER = ",".join(schemas.RAW_COLUMNS)


def line(day, hour, route="10-1", trip="t1", seconds="120", minutes="2.0"):
    return f"{day}T{hour}:00:00+00:00,e,{trip},{route},1,08:00:00,20260511,1778486400,{seconds},False,{minutes}"


@pytest.fixture
def landed(tmp_path):
    daily, static = tmp_path / "daily", tmp_path / "static"
    daily.mkdir()
    static.mkdir()
    (daily / "gtfs_realtime_2026-05-11.csv").write_text("\n".join(
        [HEADER, line("2026-05-11", "00"), HEADER, line("2026-05-11", "23", "S1", "t2", "9000", "150.0"), "", "broken line"]) + "\n")
    (daily / "gtfs_realtime_2026-05-12.csv").write_text("\n".join(
        [HEADER, line("2026-05-12", "08"), line("2026-05-12", "09", seconds="x", minutes="x")]) + "\n")
    (daily / "other.csv").write_text("ignored\n")
    (static / "routes.txt").write_text("route_id,agency_id,route_short_name,route_long_name,route_type\n10-1,A,10,Ten,3\n")
    (static / "trips.txt").write_text("route_id,service_id,trip_id,trip_headsign,direction_id,shape_id\n10-1,x,t1,City To Harbour,0,s\n")
    return daily, static


def test_file_stats_count_every_line(spark, landed, rows):
    stats = readers.file_row_stats(spark, str(landed[0]))
    assert rows(stats) == [("2026-05-11", "gtfs_realtime_2026-05-11.csv", 5, 1), ("2026-05-12", "gtfs_realtime_2026-05-12.csv", 2, 0)]


def test_build_storage_publishes_consistent_tables(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    checks = build_storage(spark, str(landed[0]), str(landed[1]), out, complete_days=["2026-05-11"], notes={"2026-05-12": "cut short"})
    assert [r.check_name for r in checks.filter("NOT ok").collect()] == []
    manifest = {r.collection_date: r for r in spark.read.parquet(f"{out}/completeness").collect()}
    first = manifest["2026-05-11"]
    assert (first.cleaned_rows, first.raw_csv_rows, first.duplicate_header_rows, first.collection_coverage_hours,
            first.delay_outliers_abs_gt_120, first.is_model_baseline_day) == (2, 5, 1, 23.0, 1, True)
    assert manifest["2026-05-12"].collection_note == "cut short"
    stored = writers.read_daily_table(spark, f"{out}/observations", schemas.CLEAN_COLUMNS)
    assert dict(stored.dtypes)["collection_date"] == "string" and stored.count() == 3
    assert spark.read.parquet(f"{out}/observations_baseline").count() == 2
    assert stored.filter("collection_date = '2026-05-12'").first().source_file == "gtfs_realtime_2026-05-12.csv"

    weather = spark.createDataFrame([("2026-05-11 00:00:00", 10.0, 0.0, 0.5, 80.0, 31.0)],
                                    "t string, temperature_2m double, precipitation double, rain double, relative_humidity_2m double, wind_speed_10m double"
                                    ).withColumn("weather_hour", F.col("t").cast("timestamp"))
    routes, trips = (readers.read_dimension(spark, str(landed[1]), name) for name in ("routes", "trips"))
    decisions = integration.integrate(stored, routes, trips, weather)
    assert decisions.columns == list(schemas.DECISION_COLUMNS) and decisions.dtypes == spark.createDataFrame([], schemas.DECISION).dtypes
    published = integration.publish_decisions(decisions, out)
    assert published.count() == 2
    row = published.filter("collection_date = '2026-05-11'").first()
    assert (row.route_corridor_name, row.delay_risk, row.rain) == ("10 - City / Harbour", "Low", 0.5)
    assert spark.read.parquet(f"{out}/intervention_logic").count() == 4

    predictions = published.withColumns({"actual_actionable_delay_risk": F.lit(0), "predicted_actionable_delay_risk": F.lit(1),
                                         "predicted_actionable_probability": F.lit(0.9), "predicted_delay_minutes": F.lit(1.0)})
    stored_ai = decision_support.publish_ai_decisions(predictions, out)
    assert {r.ai_delay_risk for r in stored_ai.collect()} == {"Severe"}


def test_repeated_routes_stop_the_build(spark, landed, tmp_path):
    schedule = landed[1] / "routes.txt"
    schedule.write_text(schedule.read_text() + "10-1,A,10,Ten again,3\n")
    with pytest.raises(ValueError, match="not unique"):
        build_storage(spark, str(landed[0]), str(landed[1]), str(tmp_path / "out"))


def test_overwriting_one_day_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    two = spark.createDataFrame([("a", 1), ("b", 2)], "collection_date string, x int")
    writers.write_daily_table(two, path)
    writers.write_daily_table(two.filter("collection_date = 'b'").withColumn("x", F.lit(9)), path)
    assert sorted((r.collection_date, r.x) for r in writers.read_daily_table(spark, path).collect()) == [("a", 1), ("b", 9)]


def snapshot(stamp, *entities):
    return json.dumps({"collection_time_utc": stamp, "response": {"entity": list(entities)}}, indent=1)


def entity(i, delay=60, **extra):
    return {"id": str(i), "is_deleted": False, "trip_update": {"timestamp": 1, "delay": delay, "trip": {"trip_id": f"t{i}", "route_id": "r", **extra}}}


def test_snapshots_flatten_with_missing_keys(spark, tmp_path):
    (tmp_path / "a.json").write_text(snapshot("2026-05-11T08:00:00+00:00", entity(1), {"id": "2"}))
    (tmp_path / "b.json").write_text(snapshot("2026-05-11T08:10:00+00:00"))
    out = readers.read_snapshots(spark, str(tmp_path)).orderBy("entity_id").collect()
    assert len(out) == 2
    assert (out[0].trip_id, out[0].delay_minutes, out[0].direction_id) == ("t1", 1.0, None)
    assert (out[1].trip_id, out[1].delay_minutes) == (None, None)


def test_append_and_split_by_day(spark, tmp_path, landed):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.json").write_text(snapshot("2026-05-11T08:00:00+00:00", entity(1)))
    flat, target = readers.read_snapshots(spark, str(tmp_path / "s")), str(tmp_path / "daily_out")
    writers.append_daily(flat, target)
    writers.append_daily(flat, target)
    again = readers.read_daily_logs(spark, target)
    assert again.count() == 2 and again.first().collection_date == "2026-05-11"
    precise = flat.withColumn("collection_time_utc", F.lit("2026-05-11 08:00:00.123456").cast("timestamp"))
    writers.append_daily(precise, str(tmp_path / "precise"))
    assert readers.read_daily_logs(spark, str(tmp_path / "precise")).first().collection_time_utc.microsecond == 123456
    writers.split_log_by_day(spark, str(landed[0] / "gtfs_realtime_2026-05-11.csv"), str(tmp_path / "split"))
    assert readers.read_daily_logs(spark, str(tmp_path / "split")).count() == 2
    stats = readers.file_row_stats(spark, target)
    assert [(r.collection_date, r.raw_csv_rows) for r in stats.collect()] == [("2026-05-11", 1)] * 2
    manifest = summaries.completeness_manifest(again, stats).collect()
    assert [(m.cleaned_rows, m.raw_csv_rows, m.duplicate_header_rows) for m in manifest] == [(2, 2, 0)]
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        readers.read_daily_logs(spark, str(tmp_path / "empty"))


def test_csv_parquet_and_projection(spark, tmp_path, facts):
    df = facts({}, {"route_id": "S1", "is_special_route": True})
    wide = df.withColumns({name: F.lit("true").alias(name) for name in schemas.DASHBOARD_REQUIRED if name not in df.columns})
    csv, parquet = str(tmp_path / "c"), str(tmp_path / "p")
    assert writers.write_csv(wide, csv, single_file=True) == 2
    assert writers.csv_to_parquet(spark, csv, parquet) == 2
    typed = dict(spark.read.parquet(parquet).dtypes)
    assert (typed["is_special_route"], typed["delay_seconds"], typed["rain"]) == ("boolean", "double", "double")
    assert readers.read_csv_projected(spark, csv, ["route_id"], ["rain", "absent"]).columns == ["route_id", "rain"]
    with pytest.raises(ValueError, match="absent"):
        readers.read_parquet_projected(spark, parquet, ["absent"])
    assert writers.write_sample(df, str(tmp_path / "sample"), limit=1) == 1
    assert writers.export_head(df, str(tmp_path / "head")) == 2


def test_source_choice(spark, landed, tmp_path):
    paths = {"model_baseline": str(tmp_path / "none"), "daily": str(landed[0])}
    assert readers.choose_source(spark, paths)[0] == "daily"
    assert readers.read_source(spark, paths).count() == 3
    log = {"validation_log": str(landed[0] / "gtfs_realtime_2026-05-11.csv")}
    assert readers.read_source(spark, log, "validation_log").count() == 2
    with pytest.raises(FileNotFoundError):
        readers.choose_source(spark, paths, "model_baseline")
    with pytest.raises(ValueError):
        readers.choose_source(spark, paths, "guess")


def test_weather_json(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps({"hourly": {"time": ["2026-05-11T08:00", "2026-05-11T08:00", "bad"], "temperature_2m": [1.0, 2.0, 3.0],
                                                            "rain": [0.1, 0.2, 0.3]}}))
    out = readers.read_weather(spark, str(tmp_path / "w.json")).collect()
    assert [(str(r.weather_hour), r.temperature_2m, r.rain, r.precipitation) for r in out] == [("2026-05-11 08:00:00", 1.0, 0.1, None)]
    assert "temp" in readers.read_weather(spark, str(tmp_path / "w.json"), prototype_names=True).columns


def test_views(spark, tmp_path, facts):
    from delayloom.operators import quality

    paths = {}
    for name, kind in views.VIEW_FORMATS.items():
        paths[name] = str(tmp_path / name)
        getattr(facts({}).write.option("header", True), kind)(paths[name])
    frames = views.register_views(spark, paths)
    checks = quality.view_validation(spark, frames, {"realtime_all": ["route_id", "nowhere"]}).collect()
    assert {r.view_name for r in checks if not r.ok} == {"realtime_all"}
    with pytest.raises(FileNotFoundError, match="realtime_all"):
        views.register_views(spark, {})


def test_scenarios_from_xml(spark, tmp_path):
    def write(name, trips, steps):
        (tmp_path / f"{name}-trips.xml").write_text("<tripinfos>" + "".join(trips) + "</tripinfos>")
        (tmp_path / f"{name}-steps.xml").write_text("<summary>" + "".join(steps) + "</summary>")

    write("base", ['<tripinfo id="a" vType="bus" duration="100" timeLoss="10" waitingTime="1" routeLength="5"/>'], ['<step time="0" loaded="1"/>', '<step time="9" loaded="3" meanSpeed="2.5"/>'])
    write("dis", ['<tripinfo id="a" duration="200" timeLoss="20"/>', '<tripinfo id="b" duration="300" timeLoss="40"/>'], ['<step time="5" loaded="2"/>'])
    write("int", ['<tripinfo id="a" duration="150" timeLoss="15"/>'], [])
    names = {"Baseline Operations": "base", "Disruption Scenario": "dis", "Intervention Scenario": "int"}
    trips = readers.read_scenarios(spark, {n: str(tmp_path / f"{f}-trips.xml") for n, f in names.items()}, "trips")
    steps = readers.read_scenarios(spark, {n: str(tmp_path / f"{f}-steps.xml") for n, f in names.items()}, "steps")
    compared = scenario.scenario_compare(scenario.scenario_trip_metrics(trips), scenario.scenario_last_step(steps))
    by_name = {r.scenario_name: r for r in compared.collect()}
    assert (by_name["Disruption Scenario"].completed_trips, by_name["Disruption Scenario"].avg_time_loss_sec) == (2, 30.0)
    assert (by_name["Baseline Operations"].summary_steps, by_name["Baseline Operations"].loaded, by_name["Baseline Operations"].mean_speed) == (2, 3, 2.5)
    assert by_name["Disruption Scenario"].mean_speed == -1.0 and by_name["Intervention Scenario"].summary_steps is None
    assert scenario.scenario_improvement(compared).first().improvement_pct == 50.0
    results = {r.scenario_name: r for r in scenario.scenario_results(compared).collect()}
    assert results["Disruption Scenario"].congestion_index == 87.5 and results["Baseline Operations"].avg_delay_min == 0.17


def test_listed_scenario_without_trips_has_zeros(spark):
    none = spark.createDataFrame([], "scenario_name string, duration_sec double, time_loss_sec double, waiting_time_sec double")
    assert tuple(scenario.scenario_trip_metrics(none, ["Baseline Operations"]).first()) == ("Baseline Operations", 0, 0.0, 0.0, 0.0, 0.0, 0.0)


def test_foreign_header_is_an_error(spark, tmp_path):
    (tmp_path / "gtfs_realtime_2026-05-11.csv").write_text("a," + HEADER[2:] + "\n" + line("2026-05-11", "08") + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_daily_logs(spark, str(tmp_path)).select(*schemas.RAW_COLUMNS).collect()


def test_scenario_report_prefers_the_stated_improvement(spark):
    ddl = "scenario_name string, selected_route string, avg_delay_min double, validation_interpretation string"
    data = [("Disruption Scenario", "128-202", 0.2, "high"), ("Intervention Scenario", "128-202", 0.1, "about 45.6 Percent lower loss")]
    texts = spark.createDataFrame([("evidence of 2026-05-09 to 2026-06-04",)], "description string")
    row = scenario.scenario_report(spark.createDataFrame(data, ddl), texts).first()
    assert tuple(row) == ("128-202", "2026-05-09", "45.6%")
    plain = spark.createDataFrame([r[:3] + ("none",) for r in data], ddl)
    assert scenario.scenario_report(plain, texts).first().improvement == "50.0%"
