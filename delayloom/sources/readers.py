"""Readers for landed files: explicit schemas, no inference, one scan each."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delayloom import schemas
from delayloom.functions.parsing import to_double, to_long, to_utc_timestamp
from delayloom.operators.cleaning import clean_column_names, clean_observations, remove_header_rows, require_columns
from delayloom.operators.enrich import first_per_key

# Landed daily files, and the part files that writers.append_daily and writers.split_log_by_day put in day folders.
DAILY_GLOB = "{gtfs_realtime_*,part-*}.csv"
_DAY_IN_NAME = r"(\d{4}-\d{2}-\d{2})"


def _source_file() -> Column:
    """Name of the file a row comes from, with its day folder if it lies in one."""
    path = F.col("_metadata.file_path")
    folder = F.regexp_extract(path, r"(collection_date=[^/]+/)[^/]+$", 1)
    return F.concat(folder, F.col("_metadata.file_name"))


def _files_found(df: DataFrame, directory: str, pattern: str) -> DataFrame:
    if not df.inputFiles():
        raise FileNotFoundError(f"no daily logs match {pattern} in {directory}")
    return df


def flatten_snapshots(documents: DataFrame) -> DataFrame:
    """One row per entity of every trip-update document; absent keys are null.

    ``collection_time_utc`` must be a column of the documents.  A document
    without entities gives no rows.
    """
    entity = F.explode("response.entity").alias("entity")
    update, trip = F.col("entity.trip_update"), F.col("entity.trip_update.trip")
    return documents.select("collection_time_utc", entity).select(
        "collection_time_utc",
        F.col("entity.id").alias("entity_id"),
        trip["trip_id"].alias("trip_id"),
        trip["route_id"].alias("route_id"),
        trip["direction_id"].cast("bigint").alias("direction_id"),
        trip["start_time"].alias("start_time"),
        trip["start_date"].alias("start_date"),
        update["timestamp"].alias("timestamp"),
        update["delay"].alias("delay_seconds"),
        F.col("entity.is_deleted").alias("is_deleted"),
        (update["delay"] / 60).alias("delay_minutes"),
    )


def read_snapshots(spark: SparkSession, path: str, collected_at: Column | None = None) -> DataFrame:
    """Flatten landed snapshot files (one JSON document each).

    The collection time is the document's own ``collection_time_utc`` when it
    has one, else ``collected_at``, else the time the file landed.
    """
    documents = spark.read.schema(schemas.SNAPSHOT).option("multiLine", True).json(path)
    landed = F.col("_metadata.file_modification_time") if collected_at is None else collected_at
    stamped = documents.select(
        F.coalesce(to_utc_timestamp(F.col("collection_time_utc")), landed).alias("collection_time_utc"), "response"
    )
    return flatten_snapshots(stamped)


def read_daily_logs(spark: SparkSession, directory: str, pattern: str = DAILY_GLOB) -> DataFrame:
    """All daily CSV logs in one scan, cleaned and tagged with their file name; no file at all is an error."""
    raw = (
        spark.read.schema(schemas.RAW_OBSERVATION)
        .option("header", True)
        .option("enforceSchema", False)  # a header that does not match the contract is an error
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .csv(directory)
    )
    found = _files_found(raw, directory, pattern)
    return clean_observations(found.select("*", _source_file().alias("source_file")))


def file_row_stats(spark: SparkSession, directory: str, pattern: str = DAILY_GLOB) -> DataFrame:
    """Data lines and repeated header lines of every file, blank lines included.

    A file's header line is the one its name-independent contract gives: the
    raw column list.  Files count lines without parsing them.
    """
    header = ",".join(schemas.RAW_COLUMNS)
    found = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(directory)
    lines = _files_found(found, directory, pattern).select("value", _source_file().alias("source_file"))
    is_header = F.rtrim(F.regexp_replace("value", "^﻿", "")) == header
    return (
        lines.groupBy("source_file")
        .agg(F.count(F.lit(1)).alias("lines"), F.count_if(is_header).alias("headers"))
        .select(
            F.regexp_extract("source_file", _DAY_IN_NAME, 1).alias("collection_date"),
            "source_file",
            (F.col("lines") - 1).alias("raw_csv_rows"),
            F.greatest(F.col("headers") - 1, F.lit(0)).alias("duplicate_header_rows"),
        )
    )


def read_csv_projected(
    spark: SparkSession, path: str, required: Sequence[str], optional: Sequence[str] = ()
) -> DataFrame:
    """Read only the named text columns; missing required ones are an error."""
    df = spark.read.option("header", True).csv(path)
    require_columns(df, required, f"CSV {path}")
    return df.select(*required, *(name for name in optional if name in df.columns))


def read_parquet_projected(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    df = spark.read.parquet(path)
    require_columns(df, columns, f"Parquet {path}")
    return df.select(*columns)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or glob) exists on whatever file system it names."""
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(hadoop_path)
    return found is not None and len(found) > 0


# Which stored tables a named source accepts, in order of preference.
SOURCE_PREFERENCES = {
    "auto": ("model_baseline", "all_file", "daily"),
    "model_baseline": ("model_baseline",),
    "all_file": ("all_file",),
    "daily": ("daily",),
    "validation_log": ("validation_log",),
    "repaired_log": ("repaired_log",),
}


def choose_source(spark: SparkSession, paths: Mapping[str, str], source: str = "auto") -> tuple[str, str]:
    """First existing (name, path) the source option accepts."""
    if source not in SOURCE_PREFERENCES:
        raise ValueError(f"source must be one of {sorted(SOURCE_PREFERENCES)}")
    for name in SOURCE_PREFERENCES[source]:
        if name in paths and path_exists(spark, paths[name]):
            return name, paths[name]
    raise FileNotFoundError(f"no input found for source {source!r} among {dict(paths)}")


def read_source(spark: SparkSession, paths: Mapping[str, str], source: str = "auto") -> DataFrame:
    """Observations of the chosen source: Parquet tables as stored, logs cleaned from CSV."""
    name, path = choose_source(spark, paths, source)
    if name in ("model_baseline", "all_file"):
        return clean_column_names(spark.read.parquet(path))
    if name == "daily":
        return read_daily_logs(spark, path)
    text = spark.read.option("header", True).csv(path).select("*", F.col("_metadata.file_name").alias("source_file"))
    named = remove_header_rows(clean_column_names(text))
    require_columns(named, schemas.RAW_COLUMNS, "observation log")
    return clean_observations(named.select(*schemas.RAW_COLUMNS, "source_file"))


PROTOTYPE_WEATHER_NAMES = {
    "temperature_2m": "temp", "relative_humidity_2m": "rhum", "precipitation": "prcp", "wind_speed_10m": "wspd",
    "surface_pressure": "pres",
}


def weather_rows(documents: DataFrame, prototype_names: bool = False) -> DataFrame:
    """Hourly rows from the column-array document; the first row of a repeated hour stays."""
    names = [name for name in documents.schema["hourly"].dataType.names if name != "time"]
    # A variable the file lacks becomes an empty array, which zips to nulls.
    empty = F.array().cast("array<double>")
    arrays = [F.col("hourly.time"), *(F.coalesce(F.col(f"hourly.{name}"), empty).alias(name) for name in names)]
    rows = documents.select(F.posexplode(F.arrays_zip(*arrays)).alias("place", "row")).select(
        "place", to_utc_timestamp(F.col("row.time")).alias("weather_hour"), *(F.col(f"row.{name}") for name in names)
    )
    known = rows.filter(F.col("weather_hour").isNotNull())
    unique = first_per_key(known, ["weather_hour"], ["place", *names]).drop("place")
    if not prototype_names:
        return unique
    renamed = {old: new for old, new in PROTOTYPE_WEATHER_NAMES.items() if old in names}
    return unique.withColumnsRenamed({**renamed, "weather_hour": "hour"})


def read_weather(spark: SparkSession, path: str, prototype_names: bool = False) -> DataFrame:
    documents = spark.read.schema(schemas.WEATHER_JSON).option("multiLine", True).json(path)
    return weather_rows(documents, prototype_names)


def read_dimension(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A static schedule table (``<name>.txt``) by header names, typed by its contract."""
    contract = schemas.STATIC_TABLES[name]
    text = clean_column_names(spark.read.option("header", True).csv(f"{directory}/{name}.txt"))
    require_columns(text, [f.name for f in contract.fields], f"{name}.txt")
    parsers = {"int": lambda c: to_long(c).cast("int"), "double": to_double, "string": lambda c: c}
    return text.select(
        *(parsers[f.dataType.simpleString()](F.col(f.name)).alias(f.name) for f in contract.fields)
    )


_TRIP_ATTRIBUTES = {"duration": "duration_sec", "timeLoss": "time_loss_sec", "waitingTime": "waiting_time_sec",
                    "routeLength": "route_length_m"}
_STEP_COUNTS = ("loaded", "inserted", "ended", "arrived", "halting")


def _xml(spark: SparkSession, path: str, row_tag: str, attributes: Sequence[str]) -> DataFrame:
    schema = ", ".join(f"`{name}` string" for name in attributes)
    return (
        spark.read.format("xml")
        .schema(schema)
        .option("rowTag", row_tag)
        .option("attributePrefix", "")
        .load(path)
    )


def read_scenario_trips(spark: SparkSession, path: str, scenario: str) -> DataFrame:
    """Attributes of every ``tripinfo`` element; an absent measure is zero."""
    raw = _xml(spark, path, "tripinfo", ["id", "vType", *_TRIP_ATTRIBUTES])
    return raw.select(
        F.lit(scenario).alias("scenario_name"),
        F.col("id").alias("vehicle_id"),
        F.col("vType").alias("vehicle_type"),
        *(F.coalesce(to_double(F.col(name)), F.lit(0.0)).alias(new) for name, new in _TRIP_ATTRIBUTES.items()),
    )


def read_scenario_steps(spark: SparkSession, path: str, scenario: str) -> DataFrame:
    """Attributes of every ``step`` element; absent counts are 0 and absent means -1."""
    raw = _xml(spark, path, "step", ["time", *_STEP_COUNTS, "meanTravelTime", "meanSpeed"])

    def number(name: str, absent: float) -> Column:
        return F.coalesce(to_double(F.col(name)), F.lit(absent))

    return raw.select(
        F.lit(scenario).alias("scenario_name"),
        number("time", 0.0).alias("time_sec"),
        *(number(name, 0.0).cast("bigint").alias(name) for name in _STEP_COUNTS),
        number("meanTravelTime", -1.0).alias("mean_travel_time_sec"),
        number("meanSpeed", -1.0).alias("mean_speed"),
    )


def read_scenarios(spark: SparkSession, paths: Mapping[str, str], kind: str) -> DataFrame:
    """Trips (``kind='trips'``) or steps of several scenarios, by scenario name."""
    reader = {"trips": read_scenario_trips, "steps": read_scenario_steps}[kind]
    frames = [reader(spark, path, scenario) for scenario, path in paths.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def read_weather_source(spark: SparkSession, json_path: str | None, decisions_path: str | None = None) -> DataFrame:
    """Weather from its landed JSON, or recovered from an earlier decision table."""
    from delayloom.operators.enrich import weather_from_decision_table

    if json_path and path_exists(spark, json_path):
        return read_weather(spark, json_path)
    if decisions_path and path_exists(spark, decisions_path):
        return weather_from_decision_table(spark.read.parquet(decisions_path))
    raise FileNotFoundError("neither a weather file nor a decision table to recover it from was found")


