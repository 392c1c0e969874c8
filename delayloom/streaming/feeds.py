"""Structured Streaming over landed snapshot files.

Snapshots are files that arrive in a folder.  Every poll counts as a record,
exactly as in the batch tables, unless the caller asks for deduplication.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from delayloom import schemas
from delayloom.functions.lookups import calendar_bounded
from delayloom.functions.measures import mean_minutes, observed_seconds
from delayloom.functions.parsing import date_text, to_utc_timestamp
from delayloom.operators import cleaning, enrich
from delayloom.sources.readers import flatten_snapshots

POLL_INTERVAL = "600 seconds"
TIME = "collection_time_utc"


def stream_snapshots(spark: SparkSession, path: str, max_files: int = 1_000) -> DataFrame:
    """Flattened rows of snapshot files as they land."""
    documents = (
        spark.readStream.schema(schemas.SNAPSHOT)
        .option("multiLine", True)
        .option("maxFilesPerTrigger", max_files)
        .json(path)
    )
    landed: Column = F.col("_metadata.file_modification_time")
    stamped = documents.select(F.coalesce(to_utc_timestamp(F.col(TIME)), landed).alias(TIME), "response")
    return flatten_snapshots(stamped)


def deduplicate(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Keep the first report of each entity and feed timestamp within the watermark (opt-in)."""
    return stream.withWatermark(TIME, delay).dropDuplicatesWithinWatermark(["entity_id", "timestamp"])


def hourly_delay(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Records, mean and maximum delay per hour and route; rows behind the watermark are dropped.

    Partial aggregation runs before the shuffle, so a busy route reaches its
    state as one row per input task.
    """
    seconds = observed_seconds(stream)
    return (
        stream.withWatermark(TIME, delay)
        .groupBy(F.window(TIME, "1 hour"), "route_id")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.round(mean_minutes(seconds), 6).alias("avg_delay_minutes"),
            F.max(seconds).cast("double").alias("max_delay_seconds"),
        )
        .select(F.col("window.start").alias("hour"), "route_id", "records", "avg_delay_minutes", "max_delay_seconds")
    )


HOUR_KEY = "hour_key"
_STREAM_KEYS = ("hour", "route_id")


def upsert_hours(spark: SparkSession, table: str, rows: StructType) -> Callable[[DataFrame, int], None]:
    """A sink for ``hourly_delay`` in update mode: a table with one folder per hour, in which a batch replaces its rows.

    A batch holds the (hour, route) rows that it changed.  Only the folders of its hours are read and written again: rows
    of other routes stay, rows of the batch take the place of older ones.  A batch that is run again after a failure
    replaces the same rows by the same values, and its work files are named by its number, so nothing is counted twice.
    """
    work = f"{table.rstrip('/')}_work"
    keyed = StructType([*rows.fields, StructField(HOUR_KEY, StringType())])
    empty = spark.createDataFrame([], keyed)
    empty.write.mode("append").partitionBy(HOUR_KEY).parquet(table)

    def sink(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        changed = batch.withColumn(HOUR_KEY, F.date_format("hour", "yyyy-MM-dd-HH"))
        changed.write.mode("overwrite").parquet(f"{work}/changed-{number}")
        changed = session.read.schema(keyed).parquet(f"{work}/changed-{number}")
        hours = calendar_bounded(changed.select(HOUR_KEY).distinct())
        current = session.read.schema(keyed).parquet(table).join(hours, HOUR_KEY, "left_semi")
        replaced = changed.select(*(F.col(name).alias(f"_{name}") for name in _STREAM_KEYS))
        same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in _STREAM_KEYS]
        merged = current.join(replaced, same, "left_anti").unionByName(changed)
        merged.write.mode("overwrite").parquet(f"{work}/merged-{number}")
        ready = session.read.schema(keyed).parquet(f"{work}/merged-{number}")
        ready.repartition(HOUR_KEY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            HOUR_KEY).parquet(table)

    return sink


def read_hours(spark: SparkSession, table: str, rows: StructType) -> DataFrame:
    """The table that ``upsert_hours`` keeps; after a finished stream it has every hour that was not behind the watermark."""
    keyed = StructType([*rows.fields, StructField(HOUR_KEY, StringType())])
    return spark.read.schema(keyed).parquet(table).select(*rows.names)


def keep_hourly_delay(
    stream: DataFrame, table: str, checkpoint: str, delay: str = "1 hour", once: bool = True
) -> StreamingQuery:
    """Run ``hourly_delay`` into an upserted table.

    In update mode a batch passes on only the rows it changed, so what is written follows the batch and not the history.
    State behind the watermark is dropped; its rows are final in the table already, so the end of the input needs no
    flush: no window waits for a later event to be written.
    """
    hourly = hourly_delay(stream, delay)
    sink = upsert_hours(stream.sparkSession, table, hourly.schema)
    return write_stream(hourly, checkpoint, sink, mode="update", once=once)


def label_stream(stream: DataFrame, weather: DataFrame) -> DataFrame:
    """Risk, action and weather of every record: stateless, with a stream-static lookup."""
    timed = cleaning.add_time_features(stream)
    return cleaning.label_decisions(enrich.attach_weather(timed, weather))


def _started(writer, checkpoint: str, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=POLL_INTERVAL)
    return writer.start()


def append_by_day(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append rows to a Parquet folder per UTC day, exactly once per file."""
    dated = stream.withColumn("collection_date", date_text(F.col(TIME)))
    return _started(
        dated.writeStream.format("parquet").option("path", path).partitionBy("collection_date").outputMode("append"),
        checkpoint, once,
    )


def write_stream(
    stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append", once: bool = True
) -> StreamingQuery:
    """Hand every micro-batch to ``sink``."""
    return _started(stream.writeStream.outputMode(mode).foreachBatch(sink), checkpoint, once)
