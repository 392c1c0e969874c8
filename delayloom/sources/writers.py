"""Published tables and small exports."""

from __future__ import annotations

from typing import Any, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from delayloom import schemas
from delayloom.operators.cleaning import clean_observations, normalize_decision_types, require_columns
from delayloom.operators.filters import baseline_only
from delayloom.functions.parsing import date_text

# Spark's own CSV format stops at milliseconds; observation times have microseconds.
CSV_OPTIONS = {"header": True, "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def by_day(df: DataFrame) -> DataFrame:
    """Group rows by day before a partitioned write, letting AQE split large days and merge small ones."""
    return df.hint("rebalance", "collection_date")


def observed(df: DataFrame, figures: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """Rows that are counted while they are written, and where the figures arrive.

    Put this last before the write: figures taken before a shuffle would count the rows of a lost and repeated task twice,
    those of the writing stage count each partition once.
    """
    seen = Observation()
    wanted = figures or {"rows": F.count(F.lit(1))}
    return df.observe(seen, *(column.alias(name) for name, column in wanted.items())), seen


def write_daily_table(
    df: DataFrame, path: str, mode: str = "overwrite", cluster_by: str = "route_id",
    figures: Mapping[str, Column] | None = None,
) -> dict[str, Any]:
    """Parquet partitioned by the text date, so a day filter reads one folder; returns figures of the written rows.

    Files are ordered by route, so a query about one route skips most row
    groups.  ``overwrite`` replaces only the days present in ``df``.
    """
    order = ["collection_date", *([cluster_by] if cluster_by in df.columns else [])]
    counted, seen = observed(by_day(df).sortWithinPartitions(*order), figures)
    counted.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("collection_date").parquet(path)
    return seen.get


def write_table(df: DataFrame, path: str, figures: Mapping[str, Column] | None = None) -> dict[str, Any]:
    """Replace a Parquet table; returns figures of the written rows."""
    counted, seen = observed(df, figures)
    counted.write.mode("overwrite").parquet(path)
    return seen.get


def read_daily_table(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """Read a daily table with the partition column as text, in the given column order."""
    df = spark.read.parquet(path)
    df = df.withColumn("collection_date", F.col("collection_date").cast("string"))
    return df.select(*columns) if columns else df


def append_daily(df: DataFrame, path: str) -> None:
    """Append flattened snapshot rows to the CSV folder of their UTC day, each file with its header."""
    dated = df.withColumn("collection_date", date_text(F.col("collection_time_utc")))
    by_day(dated).write.mode("append").options(**CSV_OPTIONS).partitionBy("collection_date").csv(path)


def split_log_by_day(spark: SparkSession, source: str, target: str, overwrite: bool = False) -> None:
    """Split one long CSV log into daily folders of cleaned raw columns."""
    log = spark.read.schema(schemas.RAW_OBSERVATION).option("header", True).option("enforceSchema", False)
    rows = clean_observations(log.csv(source)).select(*schemas.RAW_COLUMNS, "collection_date")
    writer = by_day(rows).write.mode("overwrite" if overwrite else "append")
    writer.option("partitionOverwriteMode", "dynamic").options(**CSV_OPTIONS).partitionBy("collection_date").csv(target)


def write_baseline_tables(
    obs: DataFrame,
    all_path: str,
    baseline_path: str,
    figures: Mapping[str, Column] | None = None,
    baseline_figures: Mapping[str, Column] | None = None,
) -> tuple[dict[str, Any], dict[str, Any]]:
    """The all-file observation table and its model-baseline subset, read back from the first; figures of both."""
    require_columns(obs, schemas.CLEAN_COLUMNS, "observation")
    everything = write_daily_table(obs.select(*schemas.CLEAN_COLUMNS), all_path, figures=figures)
    stored = read_daily_table(obs.sparkSession, all_path, schemas.CLEAN_COLUMNS)
    return everything, write_daily_table(baseline_only(stored), baseline_path, figures=baseline_figures)


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str) -> int:
    """Convert a decision CSV to typed Parquet; returns the rows written."""
    text = spark.read.option("header", True).csv(csv_path)
    require_columns(text, schemas.DASHBOARD_REQUIRED, "dashboard")
    return write_table(normalize_decision_types(text), parquet_path)["rows"]


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> int:
    """Write a result as CSV with a header and return the rows written.

    ``single_file`` is for small summaries only: it sends the result through
    one task.
    """
    counted, seen = observed(df.coalesce(1) if single_file else df)
    counted.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return seen.get["rows"]


def write_predictions(full: DataFrame, test: DataFrame, full_path: str, test_path: str) -> None:
    write_daily_table(full, full_path)
    write_daily_table(test, test_path)


def earliest_rows(df: DataFrame, limit: int, *tie_breakers: str) -> DataFrame:
    """The first rows by collection time; ties in a fixed order."""
    order = [name for name in tie_breakers or ("route_id", "trip_id", "entity_id") if name in df.columns]
    return df.orderBy("collection_time_utc", *order).limit(limit)


def write_sample(test_predictions: DataFrame, path: str, limit: int = 200) -> int:
    return write_csv(earliest_rows(test_predictions, limit), path, single_file=True)


def export_head(df: DataFrame, path: str, limit: int = 10_000) -> int:
    return write_csv(earliest_rows(df, limit), path, single_file=True)
