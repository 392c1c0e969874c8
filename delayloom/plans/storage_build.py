"""From a folder of daily logs to the published observation tables."""

from __future__ import annotations

from typing import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delayloom import schemas
from delayloom.operators import enrich, quality, summaries
from delayloom.sources import readers, writers


# A busy route may hold a large part of all rows; beyond the broadcast threshold its lookup is spread over this many tasks.
SALTS = 8


def enriched_observations(obs: DataFrame, manifest: DataFrame, routes: DataFrame, salts: int = SALTS) -> DataFrame:
    joined = enrich.attach_routes(enrich.attach_completeness(obs, manifest), enrich.route_metadata(routes), salts)
    return joined.select(*schemas.CLEAN_COLUMNS)


def build_storage(
    spark: SparkSession,
    daily_dir: str,
    static_dir: str,
    out_dir: str,
    complete_days: Collection[str] = (),
    notes: Mapping[str, str] | None = None,
    min_coverage_hours: float | None = None,
    pattern: str = readers.DAILY_GLOB,
) -> DataFrame:
    """Write observations, baseline, manifest and summaries; return the validation table.

    Every table is built from the one published before it, so the raw logs are
    parsed once for the manifest and once for the observations, and a lost
    executor never has to go further back than a published table.  The figures
    of the validation are counted while the tables are written.  A schedule
    that names a route twice is an error.
    """
    obs = readers.read_daily_logs(spark, daily_dir, pattern)
    stats = readers.file_row_stats(spark, daily_dir, pattern)
    daily = summaries.completeness_manifest(obs, stats, complete_days, notes, min_coverage_hours, with_files=True)
    counted, seen = writers.observed(daily, quality.manifest_figures() | {"files": F.sum("daily_files")})
    counted.drop("daily_files").write.mode("overwrite").parquet(f"{out_dir}/completeness")
    days = seen.get
    if not days["days"]:
        raise ValueError(f"no valid rows in the daily logs of {daily_dir}")
    manifest = spark.read.parquet(f"{out_dir}/completeness")
    routes = enrich.require_unique(readers.read_dimension(spark, static_dir, "routes"), ["route_id"])
    enriched = enriched_observations(obs, manifest, routes)
    facts, model = writers.write_baseline_tables(
        enriched, f"{out_dir}/observations", f"{out_dir}/observations_baseline",
        quality.observation_figures(enriched), quality.baseline_figures(),
    )
    everything = writers.read_daily_table(spark, f"{out_dir}/observations", schemas.CLEAN_COLUMNS)
    writers.write_table(summaries.daily_summary(everything), f"{out_dir}/daily_summary")
    summary = writers.write_table(
        summaries.route_daily_summary(everything), f"{out_dir}/route_daily_summary", quality.route_daily_figures())
    route_daily = spark.read.parquet(f"{out_dir}/route_daily_summary")
    top = summaries.top_delayed_routes_by_day_mean(route_daily)
    ranked = writers.write_table(top, f"{out_dir}/top_delayed_routes", quality.top_route_figures(top))

    def fixed(figures: Mapping[str, float | None]) -> dict[str, Column]:
        return {name: F.lit(None if value is None else int(value)).cast("bigint") for name, value in figures.items()}

    return quality.storage_checks(everything, *map(fixed, (days, facts, model, summary, ranked)))
