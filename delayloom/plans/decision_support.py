"""From predictions to the published AI decision table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from delayloom import schemas
from delayloom.operators import cleaning, quality, summaries
from delayloom.sources import writers


def build_ai_decisions(predictions: DataFrame) -> DataFrame:
    cleaning.require_columns(predictions, schemas.AI_REQUIRED, "AI prediction")
    return cleaning.assign_ai_decisions(predictions)


def publish_ai_decisions(predictions: DataFrame, out_dir: str, include_special: bool = False) -> DataFrame:
    """Write the AI decision table by day, audit its mapping and write both summaries."""
    decided = build_ai_decisions(predictions)
    writers.write_daily_table(decided, f"{out_dir}/ai_decisions")
    stored = writers.read_daily_table(decided.sparkSession, f"{out_dir}/ai_decisions", decided.columns)
    quality.assert_mapping(stored, "ai_delay_risk", "ai_recommended_action")
    summaries.ai_recommendation_summary(stored).write.mode("overwrite").parquet(f"{out_dir}/ai_recommendation_summary")
    summaries.ai_route_recommendation_counts(stored, include_special).write.mode("overwrite").parquet(
        f"{out_dir}/ai_route_recommendation_counts"
    )
    return stored
