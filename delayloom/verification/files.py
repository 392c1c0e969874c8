"""Queries that write driver rows as files, read them back with the library's readers and go on from there.

Every query writes to a new folder under the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayloom import rules, schemas
from delayloom.functions import labels
from delayloom.operators import enrich, model_prep, quality, scenario, summaries
from delayloom.plans.storage_build import build_storage
from delayloom.session import ensure_checkpoint_dir
from delayloom.sources import readers, views, writers
from delayloom.streaming import feeds
from delayloom.verification.fixtures import COMPLETE_DAYS, PARTIAL_DAY_NOTES, DriverTables, scenario_steps, scenario_trips

_EXPORTED = ("route_id", "trip_id", "trip_hour", *schemas.DASHBOARD_REQUIRED)


def new_folder(d: DriverTables, name: str) -> str:
    return f"{ensure_checkpoint_dir(d.spark)}/{name}-{uuid.uuid4().hex}"


def _is_header() -> Column:
    return F.substring("entity_id", 2, 20).cast("bigint") % 251 == 0


def _landed(d: DriverTables) -> DataFrame:
    """Observations as landed text: every 251st one is a repeated header line instead."""
    text = F.date_format("collection_time_utc", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    value = lambda name: text if name == "collection_time_utc" else F.col(name).cast("string")
    return d.observations.select(
        *(F.when(_is_header(), F.lit(name)).otherwise(value(name)).alias(name) for name in schemas.RAW_COLUMNS),
        "collection_date",
    )


def _landed_folder(d: DriverTables) -> str:
    """Daily folders of CSV part files, several per day where a day is large."""
    folder = new_folder(d, "landed")
    _landed(d).write.option("header", True).partitionBy("collection_date").csv(folder)
    return folder


def _records(df: DataFrame) -> DataFrame:
    when = F.date_format("collection_time_utc", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return df.select(
        when.alias("collection_time_utc"), "entity_id", "trip_id", "route_id", "direction_id", "start_time",
        "start_date", "timestamp", "delay_seconds", "is_deleted", F.round("delay_minutes", 6).alias("delay_minutes"),
        "collection_date",
    )


def append_daily(d: DriverTables) -> DataFrame:
    """Flattened rows appended in two runs, read back as daily logs."""
    folder = new_folder(d, "appended")
    rows = d.observations.select(*schemas.RAW_COLUMNS)
    for even in (True, False):
        writers.append_daily(rows.filter((F.col("direction_id") == 0) == F.lit(even)), folder)
    return _records(readers.read_daily_logs(d.spark, folder))


def daily_logs(d: DriverTables) -> DataFrame:
    return _records(readers.read_daily_logs(d.spark, _landed_folder(d)))


def split_log(d: DriverTables) -> DataFrame:
    """One long log split by day, read back as daily logs."""
    source, target = new_folder(d, "log"), new_folder(d, "split")
    _landed(d).drop("collection_date").write.option("header", True).csv(source)
    writers.split_log_by_day(d.spark, source, target)
    return _records(readers.read_daily_logs(d.spark, target))


def file_row_stats(d: DriverTables) -> DataFrame:
    """Line counters of the landed files, added up per day: how many files a day has depends on the writer."""
    stats = readers.file_row_stats(d.spark, _landed_folder(d))
    return stats.groupBy("collection_date").agg(
        F.sum("raw_csv_rows").alias("raw_csv_rows"), F.sum("duplicate_header_rows").alias("duplicate_header_rows")
    )


def manifest_of_files(d: DriverTables) -> DataFrame:
    """The manifest of days with several files: one row per day."""
    folder = new_folder(d, "two-files")
    for part in (0, 1):
        half = _landed(d).filter(F.pmod(F.hash("entity_id", "timestamp"), F.lit(2)) == part)
        half.write.mode("append").option("header", True).partitionBy("collection_date").csv(folder)
    manifest = summaries.completeness_manifest(
        readers.read_daily_logs(d.spark, folder), readers.file_row_stats(d.spark, folder), COMPLETE_DAYS,
        PARTIAL_DAY_NOTES,
    )
    return manifest.select(
        "collection_date", "collection_day_status", "is_model_baseline_day", "raw_csv_rows", "cleaned_rows",
        "duplicate_header_rows", "unique_routes", "unique_trips", "delay_outliers_abs_gt_120",
    )


def baseline_tables(d: DriverTables) -> DataFrame:
    """Rows of the all-file table and of its baseline subset, as stored."""
    everything, baseline = new_folder(d, "all-file"), new_folder(d, "baseline")
    writers.write_baseline_tables(d.storage, everything, baseline)
    stored = [
        writers.read_daily_table(d.spark, path, schemas.CLEAN_COLUMNS).select(
            F.lit(name).alias("stored"), "collection_date", "entity_id", "route_id", "service_type",
            F.round("delay_minutes", 6).alias("delay_minutes"),
        )
        for name, path in (("all_file", everything), ("model_baseline", baseline))
    ]
    return stored[0].unionByName(stored[1])


def csv_to_parquet(d: DriverTables) -> DataFrame:
    """The decision table exported as CSV, converted to typed Parquet and read by columns."""
    text, typed = new_folder(d, "export"), new_folder(d, "converted")
    writers.write_csv(d.decisions.select("collection_time_utc", *_EXPORTED), text)
    writers.csv_to_parquet(d.spark, text, typed)
    rows = readers.read_parquet_projected(
        d.spark, typed, ["collection_time_utc", "route_id", "trip_id", "delay_risk", "trip_hour", "rain",
                         "is_partial_day", "wind_speed_10m"],
    )
    when = F.date_format("collection_time_utc", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return rows.withColumns({"collection_time_utc": when, "trip_hour": F.col("trip_hour").cast("bigint")})


def csv_projected(d: DriverTables) -> DataFrame:
    text = new_folder(d, "export")
    writers.write_csv(d.decisions.select(*_EXPORTED), text)
    return readers.read_csv_projected(d.spark, text, ["route_id", "delay_risk"], ["service_type", "not_there"])


def read_dimension(d: DriverTables) -> DataFrame:
    """The route table written as a schedule file, read as text by its contract and typed as route metadata."""
    folder = new_folder(d, "schedule")
    d.routes.write.option("header", True).csv(f"{folder}/routes.txt")
    return enrich.route_metadata(readers.read_dimension(d.spark, folder, "routes"))


def chosen_source(d: DriverTables) -> DataFrame:
    """Rows per day of the source that ``auto`` takes when both stored tables and the logs are there."""
    everything, baseline = new_folder(d, "all-file"), new_folder(d, "baseline")
    writers.write_baseline_tables(d.storage, everything, baseline)
    paths = {"daily": _landed_folder(d), "all_file": everything, "model_baseline": baseline}
    name, _ = readers.choose_source(d.spark, paths)
    rows = readers.read_source(d.spark, paths)
    return rows.groupBy(F.col("collection_date").cast("string").alias("collection_date")).agg(
        F.count(F.lit(1)).alias("records")
    ).withColumn("chosen", F.lit(name))


def attach_checked(d: DriverTables) -> DataFrame:
    """Observations with the manifest row of their day, which must be unique."""
    days = d.manifest.select("collection_date", "collection_day_status", "collection_coverage_hours", "raw_csv_rows")
    return enrich.attach_checked(d.observations.select("entity_id", "collection_date"), days, ["collection_date"])


def stream_append(d: DriverTables) -> DataFrame:
    """The observation stream appended by day and read back."""
    folder = new_folder(d, "stream-append")
    rows = d.observation_stream.select(*schemas.RAW_COLUMNS)
    feeds.append_by_day(rows, f"{folder}/rows", f"{folder}/state").awaitTermination()
    return _records(writers.read_daily_table(d.spark, f"{folder}/rows"))


def stream_dedupe(d: DriverTables) -> DataFrame:
    """Every report polled twice within the watermark; each entity and feed time stays once."""
    folder = new_folder(d, "stream-dedupe")
    polls = F.explode(F.array(F.lit(0), F.lit(1))).alias("poll")
    twice = d.observation_stream.select(*schemas.RAW_COLUMNS, polls)
    once = feeds.deduplicate(twice).drop("poll")
    feeds.append_by_day(once, f"{folder}/rows", f"{folder}/state").awaitTermination()
    return _records(writers.read_daily_table(d.spark, f"{folder}/rows"))


def stream_labels(d: DriverTables) -> DataFrame:
    """The observation stream with risk, action and the weather of its hour."""
    folder = new_folder(d, "stream-labels")
    named = d.observation_stream.withColumn(
        "is_special_route", F.coalesce(labels.has_special_prefix(F.col("route_id")), F.lit(False))
    )
    rows = feeds.label_stream(named, d.weather)
    rows = rows.select("collection_time_utc", "entity_id", "delay_risk", "recommended_action", "trip_hour", "rain")
    feeds.append_by_day(rows, f"{folder}/rows", f"{folder}/state").awaitTermination()
    return d.spark.read.schema(rows.schema).parquet(f"{folder}/rows").drop("collection_time_utc")


def _view_sources(d: DriverTables) -> dict[str, DataFrame]:
    baseline = d.storage.filter("is_model_baseline_day")
    return {
        "realtime_all": d.storage,
        "realtime_model_baseline": baseline,
        "decision_engine_model_baseline": d.decisions.filter("is_model_baseline_day"),
        "decision_engine_all_file": d.decisions,
        "route_daily_summary": d.route_daily,
        "collection_completeness": d.manifest,
    }


def _registered(d: DriverTables) -> dict[str, DataFrame]:
    """The published tables written as files and registered as views of the session."""
    folder = new_folder(d, "views")
    for name, source in _view_sources(d).items():
        writer = source.write.option("header", True).options(**writers.CSV_OPTIONS)
        getattr(writer, views.VIEW_FORMATS[name])(f"{folder}/{name}")
    return views.register_views(d.spark, {name: f"{folder}/{name}" for name in views.VIEW_FORMATS})


def view_validation(d: DriverTables) -> DataFrame:
    """Every view against the table it was written from; two columns that no view has are asked for."""
    _registered(d)
    required = {"realtime_all": ["route_id", "platform"], "collection_completeness": ["collection_date", "weekday"]}
    return quality.view_validation(d.spark, _view_sources(d), required)


def view_records(d: DriverTables) -> DataFrame:
    """The registered views joined in SQL: records of each complete day in three of them."""
    _registered(d)
    return d.spark.sql("""
        SELECT CAST(c.collection_date AS STRING) AS collection_date, c.cleaned_rows, r.records, b.baseline_rows
        FROM collection_completeness c
        JOIN (SELECT collection_date, SUM(records) AS records FROM route_daily_summary GROUP BY collection_date) r
            ON r.collection_date = c.collection_date
        LEFT JOIN (SELECT collection_date, COUNT(*) AS baseline_rows FROM realtime_model_baseline GROUP BY collection_date) b
            ON b.collection_date = c.collection_date""")


def weather_file(d: DriverTables) -> DataFrame:
    """Hourly weather landed as one document of column arrays and read back."""
    folder = new_folder(d, "weather")
    hour = F.date_format("weather_hour", "yyyy-MM-dd'T'HH:mm").alias("time")
    hours = F.sort_array(F.collect_list(F.struct(hour, *rules.WEATHER_COLUMNS)))  # one entry per calendar hour
    arrays = [F.col(f"hours.{name}").alias(name) for name in ("time", *rules.WEATHER_COLUMNS)]
    document = d.weather.agg(hours.alias("hours")).select(F.to_json(F.struct(F.struct(*arrays).alias("hourly"))).alias("value"))
    document.write.text(folder)
    rows = readers.read_weather_source(d.spark, folder)
    return rows.select(F.date_format("weather_hour", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("weather_hour"), *rules.WEATHER_COLUMNS)


def _scenario_files(d: DriverTables, rows: DataFrame, tags: tuple[str, str], attributes: dict[str, str]) -> dict[str, str]:
    """Rows of each scenario as the attributes of XML elements; the folder of each."""
    folder = new_folder(d, tags[0])
    names = [rules.SCENARIO_BASELINE, rules.SCENARIO_DISRUPTION, rules.SCENARIO_INTERVENTION]
    for k, name in enumerate(names):
        own = rows.filter(F.col("scenario_name") == name).select(
            *(F.col(column).cast("string").alias(f"_{attribute}") for attribute, column in attributes.items()))
        own.write.format("xml").option("rootTag", tags[0]).option("rowTag", tags[1]).save(f"{folder}/{k}")
    return {name: f"{folder}/{k}" for k, name in enumerate(names)}


def scenario_trips_file(d: DriverTables) -> DataFrame:
    """Metrics over scenario trips read from XML."""
    trips = scenario_trips(d)
    paths = _scenario_files(d, trips, ("tripinfos", "tripinfo"), {
        "duration": "duration_sec", "timeLoss": "time_loss_sec", "waitingTime": "waiting_time_sec"})
    return scenario.scenario_trip_metrics(readers.read_scenarios(d.spark, paths, "trips"))


def scenario_steps_file(d: DriverTables) -> DataFrame:
    """The last step of each scenario read from XML."""
    paths = _scenario_files(d, scenario_steps(d), ("summary", "step"), {
        "time": "time_sec", "loaded": "loaded", "inserted": "inserted", "ended": "ended", "arrived": "arrived",
        "halting": "halting", "meanTravelTime": "mean_travel_time_sec", "meanSpeed": "mean_speed"})
    return scenario.scenario_last_step(readers.read_scenarios(d.spark, paths, "steps"))


def stored_predictions(d: DriverTables) -> DataFrame:
    """All predictions and those of the test days, as stored by day: records and probability per day."""
    full, test = new_folder(d, "predictions"), new_folder(d, "predictions-test")
    test_days = model_prep.split_dates(d.ai).filter("is_test")
    writers.write_predictions(d.ai, enrich.semi_by_dates(d.ai, test_days), full, test)
    stored = [
        writers.read_daily_table(d.spark, path).groupBy("collection_date").agg(
            F.count(F.lit(1)).alias("records"),
            F.sum(F.col("predicted_actionable_probability").cast("decimal(18,3)")).cast("double").alias("probability"),
        ).withColumn("stored", F.lit(name))
        for name, path in (("full", full), ("test", test))
    ]
    return stored[0].unionByName(stored[1])


def stored_samples(d: DriverTables) -> DataFrame:
    """The earliest rows exported as one CSV, twice: the sample of predictions and the head of the decisions."""
    frames = []
    for name, write in (("sample", writers.write_sample), ("head", writers.export_head)):
        folder = new_folder(d, name)
        rows = d.integrated.select("collection_time_utc", "route_id", "trip_id", "entity_id")
        written = write(rows, folder)
        back = d.spark.read.option("header", True).csv(folder)
        when = F.date_format(F.col("collection_time_utc").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        frames.append(back.select(F.lit(name).alias("stored"), when.alias("collection_time_utc"), "route_id", "trip_id",
                                  "entity_id", F.lit(written).cast("bigint").alias("written")))
    return frames[0].unionByName(frames[1])


def storage_build(d: DriverTables) -> DataFrame:
    """The whole storage build over landed logs, two files a day, and its validation."""
    folder = new_folder(d, "build")
    for part in (0, 1):
        half = _landed(d).filter(F.pmod(F.hash("entity_id", "timestamp"), F.lit(2)) == part)
        half.repartition("collection_date").write.mode("append").option("header", True).partitionBy("collection_date").csv(
            f"{folder}/logs")
    d.routes.write.option("header", True).csv(f"{folder}/schedule/routes.txt")
    checks = build_storage(d.spark, f"{folder}/logs", f"{folder}/schedule", f"{folder}/tables", COMPLETE_DAYS, PARTIAL_DAY_NOTES)
    return checks


FILE_QUERIES = {
    "append_daily": append_daily,
    "daily_logs": daily_logs,
    "split_log": split_log,
    "file_row_stats": file_row_stats,
    "manifest_of_files": manifest_of_files,
    "baseline_tables": baseline_tables,
    "csv_to_parquet": csv_to_parquet,
    "csv_projected": csv_projected,
    "read_dimension": read_dimension,
    "chosen_source": chosen_source,
    "attach_checked": attach_checked,
    "stream_append": stream_append,
    "stream_dedupe": stream_dedupe,
    "stream_labels": stream_labels,
    "view_validation": view_validation,
    "view_records": view_records,
    "weather_file": weather_file,
    "scenario_trips_file": scenario_trips_file,
    "scenario_steps_file": scenario_steps_file,
    "stored_predictions": stored_predictions,
    "stored_samples": stored_samples,
    "storage_build": storage_build,
}
