"""Storage and dashboard summary tables built from observations and decisions."""

from __future__ import annotations

from typing import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayloom import rules, schemas
from delayloom.functions import labels
from delayloom.functions.measures import (
    average,
    average_minutes,
    largest,
    largest_minutes,
    modal,
    observed_seconds,
    one_row,
    one_step,
    rows,
    rule_rows,
    smallest,
    tally,
    two_step,
    with_share,
)
from delayloom.functions.parsing import blank_to_null, to_double
from delayloom.operators.enrich import attach_file_stats
from delayloom.operators.filters import exclude_special


def _outliers():
    return tally("delay_outliers_abs_gt_120", F.abs("delay_minutes") > rules.OUTLIER_MINUTES)


def _day_grain(obs: DataFrame, keys: Sequence[str], measures, with_routes: bool = True) -> DataFrame:
    """Measures plus distinct routes and trips, both counted over (key, route, trip) rows."""
    distinct = [F.countDistinct("trip_id").alias("unique_trips")]
    if with_routes:
        distinct.insert(0, F.countDistinct("route_id").alias("unique_routes"))
    return two_step(obs, keys, ["route_id", "trip_id"] if with_routes else ["trip_id"], measures, distinct)


def completeness_manifest(
    obs: DataFrame,
    file_stats: DataFrame | None = None,
    complete_days: Collection[str] = (),
    notes: Mapping[str, str] | None = None,
    min_coverage_hours: float | None = None,
    with_files: bool = False,
) -> DataFrame:
    """One row per collection day.

    A day is complete when it is listed, or, with ``min_coverage_hours``, when
    it spans at least that many hours.  ``with_files`` adds ``daily_files``, the landed files of the day.
    """
    daily = _day_grain(
        obs,
        ["collection_date"],
        [
            rows("cleaned_rows"),
            smallest("first_collection_time_utc", F.col("collection_time_utc")),
            largest("last_collection_time_utc", F.col("collection_time_utc")),
            _outliers(),
        ],
    )
    span = F.unix_micros("last_collection_time_utc") - F.unix_micros("first_collection_time_utc")
    daily = daily.withColumn("collection_coverage_hours", F.round(span / F.lit(3_600_000_000), 2))
    complete = F.col("collection_date").isin(*complete_days) if complete_days else F.lit(False)
    if min_coverage_hours is not None:
        complete = complete | (F.col("collection_coverage_hours") >= min_coverage_hours)
    note = F.coalesce(labels.mapped(F.col("collection_date"), notes), F.lit("")) if notes else F.lit("")
    flagged = daily.withColumns(
        {
            "is_model_baseline_day": complete,
            "is_partial_day": ~complete,
            "collection_day_status": F.when(complete, rules.DAY_COMPLETE).otherwise(rules.DAY_PARTIAL),
            "collection_note": note,
        }
    )
    if file_stats is None:
        flagged = flagged.withColumns(
            {
                "raw_csv_rows": F.lit(None).cast("bigint"),
                "duplicate_header_rows": F.lit(None).cast("bigint"),
                "source_file": F.lit(None).cast("string"),
                "daily_files": F.lit(None).cast("bigint"),
            }
        )
    else:
        flagged = attach_file_stats(flagged, file_stats)
    return flagged.select(*schemas.MANIFEST_COLUMNS, *(name for name in ("daily_files",) if with_files))


def daily_summary(obs: DataFrame) -> DataFrame:
    seconds = observed_seconds(obs)
    return _day_grain(
        obs,
        ["collection_date", "collection_day_status", "is_model_baseline_day", "is_partial_day"],
        [
            rows(),
            average_minutes("avg_delay_minutes", seconds, None),
            smallest("min_delay_minutes", F.col("delay_minutes")),
            largest("max_delay_minutes", F.col("delay_minutes")),
            _outliers(),
        ],
    )


ROUTE_DAY_KEYS = (
    "collection_date", "collection_day_status", "is_model_baseline_day", "route_id", "service_type",
    "route_display_name", "is_special_route",
)


def _route_measures(obs: DataFrame, digits: int | None):
    return [
        rows(),
        average_minutes("avg_delay_minutes", observed_seconds(obs), digits),
        largest("max_delay_minutes", F.col("delay_minutes")),
    ]


def route_daily_summary(obs: DataFrame) -> DataFrame:
    return _day_grain(obs, ROUTE_DAY_KEYS, _route_measures(obs, None), with_routes=False)


def top_delayed_routes_by_day_mean(route_daily: DataFrame, limit: int = 50) -> DataFrame:
    """Non-special routes by the unweighted mean of their daily means."""
    return (
        exclude_special(route_daily)
        .groupBy("route_id", "service_type", "route_display_name", "is_special_route")
        .agg(
            F.sum("records").alias("records"),
            F.avg("avg_delay_minutes").alias("avg_delay_minutes"),
            F.max("max_delay_minutes").alias("max_delay_minutes"),
        )
        .orderBy(F.desc("avg_delay_minutes"), F.desc("records"), "route_id")
        .limit(limit)
    )


def daily_summary_with_weather(decisions: DataFrame) -> DataFrame:
    return _day_grain(
        decisions,
        ["collection_date"],
        [
            rows(),
            average_minutes("avg_delay_minutes", observed_seconds(decisions), 2),
            smallest("min_delay_minutes", F.col("delay_minutes")),
            largest("max_delay_minutes", F.col("delay_minutes")),
            tally("weather_match_records", F.col("temperature_2m").isNotNull()),
        ],
    )


NAMED_ROUTE_KEYS = (
    "route_id", "route_short_name", "route_long_name", "service_type", "route_display_name",
    "route_corridor_name", "is_special_route",
)


def route_daily_summary_named(decisions: DataFrame) -> DataFrame:
    keys = [name for name in ("collection_date", *NAMED_ROUTE_KEYS) if name in decisions.columns]
    return _day_grain(decisions, keys, _route_measures(decisions, 2), with_routes=False)


def top_delayed_routes_by_record_mean(decisions: DataFrame, limit: int = 20) -> DataFrame:
    """Non-special routes by the mean over all their records."""
    source = exclude_special(decisions)
    keys = [name for name in NAMED_ROUTE_KEYS if name in source.columns]
    ranked = one_step(
        source,
        keys,
        [
            rows(),
            average_minutes("mean_delay", observed_seconds(source), None),
            largest("max_delay_minutes", F.col("delay_minutes")),
        ],
    )
    return (
        ranked.orderBy(F.desc("mean_delay"), F.desc("records"), "route_id")
        .limit(limit)
        .withColumn("avg_delay_minutes", F.round("mean_delay", 2))
        .drop("mean_delay")
    )


def risk_classes(spark) -> DataFrame:
    ranked = [(name, place) for place, name in enumerate(rules.RISK_ORDER, 1)]
    return rule_rows(spark, ["delay_risk", "risk_rank"], ranked)


def risk_distribution(df: DataFrame, column: str = "delay_risk") -> DataFrame:
    """Counts and shares of every risk class, absent classes as zero."""
    counts = df.groupBy(F.col(column).alias("delay_risk")).agg(F.count(F.lit(1)).alias("records"))
    shares = with_share(counts)
    return (
        risk_classes(df.sparkSession)
        .join(shares, "delay_risk", "left")
        .select(
            "delay_risk",
            F.coalesce("records", F.lit(0)).alias("records"),
            F.coalesce("share_pct", F.lit(0.0)).alias("share_pct"),
        )
        .orderBy(labels.rank_of(F.col("delay_risk"), rules.RISK_ORDER))
    )


def value_counts(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Counts and shares of a column's values (nulls are a value)."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("records"))
    return with_share(counts, digits=digits).orderBy(F.desc("records"), F.asc_nulls_last(column))


def action_distribution(df: DataFrame) -> DataFrame:
    return value_counts(df, "recommended_action")


def target_distribution(df: DataFrame, column: str = "delay_risk") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("records")).orderBy(column)


def unmatched_routes(decisions: DataFrame) -> DataFrame:
    """Routes without schedule metadata, with the letters their ids start with."""
    missing = decisions.filter(F.col("route_short_name").isNull())
    grouped = _day_grain(missing, ["route_id"], _route_measures(missing, 2), with_routes=False)
    return grouped.withColumn("route_prefix", labels.route_prefix(F.col("route_id"))).orderBy(
        F.desc("records"), F.desc("avg_delay_minutes"), "route_id"
    )


def unmatched_prefixes(decisions: DataFrame) -> DataFrame:
    """Unmatched routes per id prefix."""
    missing = decisions.filter(F.col("route_short_name").isNull()).select("route_id").distinct()
    return missing.groupBy(labels.route_prefix(F.col("route_id")).alias("route_prefix")).agg(
        F.count(F.lit(1)).alias("routes")
    )


def unmatched_by_file(decisions: DataFrame) -> DataFrame:
    missing = decisions.filter(F.col("route_short_name").isNull())
    return missing.groupBy("source_file").agg(F.count(F.lit(1)).alias("unmatched_records"))


def _by_risk(df: DataFrame, risk: str) -> DataFrame:
    return df.orderBy(labels.rank_of(F.col(risk), rules.RISK_ORDER), *[c for c in df.columns if c != "records"])


def recommendation_summary(decisions: DataFrame) -> DataFrame:
    grouped = decisions.groupBy("delay_risk", "recommended_action").agg(F.count(F.lit(1)).alias("records"))
    return _by_risk(with_share(grouped), "delay_risk")


def ai_recommendation_summary(ai: DataFrame) -> DataFrame:
    grouped = ai.groupBy("ai_delay_risk", "ai_recommended_action", "ai_confidence_band").agg(
        F.count(F.lit(1)).alias("records")
    )
    return _by_risk(with_share(grouped), "ai_delay_risk")


def _route_counts(df: DataFrame, candidates: Sequence[str], risk: str, include_special: bool) -> DataFrame:
    keys = [name for name in candidates if name in df.columns]
    everything = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    grouped = exclude_special(df, include_special).groupBy(*keys).agg(F.count(F.lit(1)).alias("records"))
    shared = with_share(grouped, digits=4, total=everything)
    order = [F.asc_nulls_last(name) for name in ("route_display_name", "route_id") if name in keys]
    return shared.orderBy(*order, labels.rank_of(F.col(risk), rules.RISK_ORDER))


def route_recommendation_counts(decisions: DataFrame, include_special: bool = False) -> DataFrame:
    """Records per route, risk and action; shares are of *all* records, special ones included."""
    return _route_counts(
        decisions, (*NAMED_ROUTE_KEYS, "delay_risk", "recommended_action"), "delay_risk", include_special
    )


AI_ROUTE_KEYS = (
    "route_id", "route_short_name", "route_display_name", "route_corridor_name", "service_type",
    "is_special_route", "ai_delay_risk", "ai_recommended_action", "ai_confidence_band",
)


def ai_route_recommendation_counts(ai: DataFrame, include_special: bool = False) -> DataFrame:
    return _route_counts(ai, AI_ROUTE_KEYS, "ai_delay_risk", include_special)


def _trip_summary(df: DataFrame, keys: Sequence[str], extra=()) -> DataFrame:
    seconds = observed_seconds(df)
    measures = [
        rows(),
        average_minutes("avg_delay_minutes", seconds, 3),
        largest_minutes("max_delay_minutes", seconds, 3),
        *extra,
    ]
    return _day_grain(df, keys, measures, with_routes=False)


def route_delay_risk_summary(decisions: DataFrame) -> DataFrame:
    cleaned = decisions.filter(F.col("route_id").isNotNull()).withColumns(
        {
            "service_type": labels.known_service(rules.UNKNOWN_SERVICE),
            "route_corridor_name": F.coalesce(
                blank_to_null(F.col("route_corridor_name")),
                blank_to_null(F.col("route_long_name")),
                blank_to_null(F.col("route_display_name")),
                F.col("route_id"),
            ),
            "route_display_name": F.coalesce(
                blank_to_null(F.col("route_display_name")), blank_to_null(F.col("route_short_name")), F.col("route_id")
            ),
            "is_special_route": labels.is_special(decisions),
        }
    )
    keys = ["service_type", "route_display_name", "route_corridor_name", "route_id", "is_special_route",
            "delay_risk", "recommended_action"]
    return _trip_summary(cleaned, keys)


def service_type_delay_summary(decisions: DataFrame) -> DataFrame:
    cleaned = decisions.withColumns(
        {
            "service_type": labels.known_service(rules.UNKNOWN_SERVICE),
            "is_special_route": labels.is_special(decisions),
        }
    )
    return _trip_summary(cleaned, ["service_type", "delay_risk", "recommended_action", "is_special_route"])


def weather_delay_risk_summary(decisions: DataFrame) -> DataFrame:
    weather = [F.col(name) for name in ("precipitation", "rain", "wind_speed_10m")]
    labelled = decisions.withColumns(
        {
            "service_type": labels.known_service(rules.UNKNOWN_SERVICE),
            "weather_context": labels.weather_context(*weather),
            "weather_rule": labels.weather_rule(*weather),
        }
    )
    extra = [average(f"avg_{name}", F.col(name), 3) for name in ("precipitation", "rain", "wind_speed_10m")]
    return _trip_summary(
        labelled, ["service_type", "weather_context", "weather_rule", "delay_risk", "recommended_action"], extra
    )


def weather_context_summary(weather_summary: DataFrame) -> DataFrame:
    """Roll the weather summary up to contexts; means weighted by records that have a mean."""
    cleaned = weather_summary.withColumns(
        {
            "records": F.coalesce("records", F.lit(0)),
            "avg_delay_minutes": to_double(F.col("avg_delay_minutes")),
        }
    ).dropna(subset=["weather_context", "weather_rule"])
    grouped = cleaned.groupBy("weather_context", "weather_rule").agg(
        F.sum("records").alias("records"),
        weighted_mean("avg_delay_minutes", "records", 3).alias("avg_observed_delay"),
        F.max("max_delay_minutes").alias("max_delay_minutes"),
    )
    return with_share(grouped, "record_pct").select(
        "weather_context", "weather_rule", "records", "record_pct", "avg_observed_delay", "max_delay_minutes"
    )


def weighted_mean(value: str, weight: str, digits: int):
    """Weighted mean of already averaged values; a null average brings no weight either.

    The products are summed as decimals, so the result does not depend on order.
    """
    product = (F.col(value) * F.col(weight)).cast("decimal(28,9)")
    weights = F.sum(F.when(F.col(value).isNotNull(), F.col(weight)))
    return F.round(F.sum(product).cast("double") / F.nullif(weights, F.lit(0)), digits)


def action_totals(decision_counts: DataFrame) -> DataFrame:
    """Records per action with the short label charts use."""
    return (
        decision_counts.groupBy("recommended_action")
        .agg(F.sum("records").alias("records"))
        .withColumn("action_label", labels.action_chart_label(F.col("recommended_action")))
        .orderBy(F.desc("records"), "recommended_action")
    )


def storage_counters(obs: DataFrame, manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Row, file and day counters of one storage build, as one row; ``files`` has one row per landed file."""
    landed = files.agg(F.count(F.lit(1))).scalar()
    days = manifest.agg(
        landed.alias("daily_files"),
        F.sum("raw_csv_rows").alias("raw_csv_rows"),
        F.sum("duplicate_header_rows").alias("duplicate_header_rows"),
        F.count_if("is_model_baseline_day").alias("complete_days"),
        F.count_if("is_partial_day").alias("partial_days"),
    )
    facts = obs.agg(
        F.count(F.lit(1)).alias("cleaned_rows"),
        F.count_if("is_model_baseline_day").alias("model_baseline_rows"),
        F.count_if(F.abs("delay_minutes") > rules.OUTLIER_MINUTES).alias("delay_outliers_abs_gt_120"),
    )
    day = one_row(days)
    return facts.select("*", *(day[name].alias(name) for name in days.columns))


def observation_day_kpis(daily: DataFrame) -> DataFrame:
    """Headline numbers over a daily table; the mean is the unweighted mean of daily means."""
    return daily.agg(
        F.countDistinct("collection_date").alias("observation_days"),
        F.sum("records").alias("total_records"),
        F.round(F.avg("avg_observed_delay"), 2).alias("mean_of_daily_means"),
        F.max("max_observed_delay").alias("max_observed_delay"),
    )


def intervention_priority(cases: DataFrame, delay: str = "actual_arrival_delay_min",
                          congestion: str = "traffic_congestion_index") -> DataFrame:
    """Routes with the most intervention cases."""
    grouped = cases.dropna(subset=["route_id"]).groupBy("route_id").agg(
        F.count("trip_id").alias("total_cases"),
        F.avg(delay).alias("avg_delay_min"),
        F.max(delay).alias("max_delay_min"),
        F.avg(congestion).alias("avg_congestion"),
    )
    return grouped.orderBy(F.desc("total_cases"), F.desc("avg_delay_min"), "route_id")


def scenario_stats(cases: DataFrame, route_id: str, columns: Sequence[str]) -> DataFrame:
    aggregates = [agg(name).alias(f"{kind}_{name}") for name in columns
                  for kind, agg in (("mean", F.avg), ("max", F.max))]
    return cases.filter(F.col("route_id") == route_id).agg(*aggregates)


def kpi_table(decisions: DataFrame) -> DataFrame:
    """Four headline indicators as (kpi, value) text rows."""
    seconds = observed_seconds(decisions)
    one = two_step(
        decisions,
        [],
        ["recommended_action"],
        [
            rows("total"),
            average_minutes("mean", seconds, 2),
            tally("high", F.col("delay_risk").isin(*rules.ACTIONABLE_RISKS)),
        ],
        [modal(F.col("recommended_action"), F.col("group_rows")).alias("action")],
    )
    texts = {"Total Records": "total", "Average Delay (min)": "mean", "High/Severe Risk Cases": "high",
             "Most Common Recommendation": "action"}
    pairs = [F.struct(F.lit(label).alias("kpi"), F.col(name).cast("string").alias("value"))
             for label, name in texts.items()]
    return one.select(F.inline(F.array(*pairs)))
