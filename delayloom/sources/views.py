"""SQL views over the published tables."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession

from delayloom.sources.readers import path_exists

VIEW_FORMATS = {
    "realtime_all": "parquet",
    "realtime_model_baseline": "parquet",
    "decision_engine_model_baseline": "parquet",
    "decision_engine_all_file": "parquet",
    "route_daily_summary": "csv",
    "collection_completeness": "csv",
}


def register_views(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Create or replace the six views; every input must exist before any view is made."""
    wanted = {name: paths.get(name) for name in VIEW_FORMATS}
    missing = [name for name, path in wanted.items() if path is None or not path_exists(spark, path)]
    if missing:
        raise FileNotFoundError(f"required inputs not found for views: {missing}")
    frames = {}
    for name, path in wanted.items():
        reader = spark.read
        if VIEW_FORMATS[name] == "csv":
            # These two are small published summaries, so inferring their types is one short pass.
            frames[name] = reader.option("header", True).option("inferSchema", True).csv(path)
        else:
            frames[name] = reader.parquet(path)
        frames[name].createOrReplaceTempView(name)
    return frames
