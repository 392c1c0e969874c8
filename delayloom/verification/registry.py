"""Registered queries: one key per operator, over the driver's tables."""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayloom import rules, schemas
from delayloom.functions import labels
from delayloom.functions.measures import observed_seconds
from delayloom.operators import (
    cleaning,
    enrich,
    explain,
    features,
    filters,
    metrics,
    model_prep,
    models,
    network,
    observed,
    prediction,
    quality,
    routes,
    scenario,
    summaries,
    timeseries,
    weather,
)
from delayloom.plans import training
from delayloom.session import at_once, ensure_checkpoint_dir
from delayloom.sources import readers, writers
from delayloom.streaming import feeds
from delayloom.verification.files import FILE_QUERIES
from delayloom.verification.fixtures import (
    FOCUS_BUS_ROUTE,
    FOCUS_ROUTE,
    SALTS,
    DriverTables,
    driver_tables,
    scenario_steps,
    scenario_trips,
)

Query = Callable[[DriverTables], DataFrame]

BUS_MORNING = filters.DashboardFilter(service_type="Bus", hour="08:00")
ONE_DAY = filters.DashboardFilter(day="2024-01-15")
SPECIALS = filters.DashboardFilter(service_type=rules.SPECIAL_SERVICE)


def _text_times(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text, so that results compare the same in every engine."""
    return df.withColumns({name: F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS") for name in columns})


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    names = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: F.round(name, digits) for name in names})


def _comparison(d: DriverTables) -> DataFrame:
    return scenario.scenario_compare(
        scenario.scenario_trip_metrics(scenario_trips(d)), scenario.scenario_last_step(scenario_steps(d))
    )


def _cases(d: DriverTables) -> DataFrame:
    """Intervention candidates with the prototype's delay and congestion columns."""
    return filters.intervention_candidates(d.decisions).withColumns(
        {
            "actual_arrival_delay_min": F.col("delay_seconds"),
            "traffic_congestion_index": F.col("trip_hour") * 3 + F.col("weekday"),
        }
    )


def _contributions(d: DriverTables) -> DataFrame:
    """Prediction errors as signed contributions of each record's service type and hour."""
    return d.ai.select(
        F.inline(
            F.array(
                F.struct(F.col("service_type").alias("feature"), F.col("predicted_delay_minutes").alias("shap_value")),
                F.struct(
                    F.concat(F.lit("trip_hour_"), F.col("trip_hour").cast("string")).alias("feature"),
                    F.round(F.col("predicted_actionable_probability") - 0.5, 6).alias("shap_value"),
                ),
            )
        )
    )


def _hourly(d: DriverTables) -> DataFrame:
    return timeseries.interpolate_hourly(timeseries.hourly_mean(d.decisions))


def _weather_on_grid(d: DriverTables) -> DataFrame:
    hours = d.observations.select(F.date_trunc("hour", "collection_time_utc").alias("hour")).distinct()
    grid = timeseries.hourly_grid(hours).select(F.col("hour").alias("weather_hour"))
    return grid.join(enrich.weather_by_hour(d.weather), "weather_hour", "left")


def _scored_test(d: DriverTables) -> DataFrame:
    """Test-side records of the date split with their deterministic scores."""
    _, test = model_prep.time_split(d.ai)
    return test


def _train(d: DriverTables) -> DataFrame:
    train, _ = model_prep.time_split(d.ai)
    return train.withColumn("actionable_delay_risk", F.col("actual_actionable_delay_risk"))


def _route_summary(d: DriverTables) -> DataFrame:
    return summaries.route_delay_risk_summary(d.decisions)


def _clean(d: DriverTables) -> DataFrame:
    cleaned = cleaning.clean_observations(d.raw_text)
    return _rounded(_text_times(cleaned, "collection_time_utc").drop("event_id"))


def _storage_validation(d: DriverTables) -> DataFrame:
    return quality.storage_validation(
        d.storage,
        filters.baseline_only(d.storage),
        d.manifest,
        d.route_daily,
        summaries.top_delayed_routes_by_day_mean(d.route_daily),
        d.file_stats,
    )


def _weather_attached(d: DriverTables) -> DataFrame:
    joined = enrich.attach_weather(d.observations, d.weather)
    return joined.select("entity_id", *rules.WEATHER_COLUMNS)


def _routes_attached(d: DriverTables) -> DataFrame:
    joined = enrich.attach_routes(d.observations, d.route_metadata, SALTS)
    return joined.select("entity_id", *schemas.ROUTE_METADATA_COLUMNS, "is_special_route")


def _path_rows(d: DriverTables) -> DataFrame:
    """Paths as text and centres at six decimals, for comparison."""
    point = lambda p: F.concat_ws(" ", p[0].cast("string"), p[1].cast("string"))
    return enrich.route_path(d.trips, d.shapes).select(
        "route_id",
        "shape_id",
        F.array_join(F.transform("path", point), ";").alias("path"),
        F.round("latitude", 6).alias("latitude"),
        F.round("longitude", 6).alias("longitude"),
    )


def _routes_of_snapshot(d: DriverTables) -> DataFrame:
    return enrich.realtime_with_routes(d.observations, d.routes, SALTS)


def _time_features(d: DriverTables) -> DataFrame:
    kept = cleaning.add_time_features(cleaning.filter_outliers(d.observations))
    return kept.select(
        "entity_id", "trip_hour", "weekday", "day_of_month", "collection_date",
        F.round("delay_abs_minutes", 6).alias("delay_abs_minutes"),
    )


def _classes(d: DriverTables) -> DataFrame:
    test = _scored_test(d)
    return metrics.metric_rows(
        metrics.classification_metrics(test, "actual_actionable_delay_risk", "predicted_actionable_delay_risk"),
        "scores", "classification", metrics.TARGET,
    ).select("metric", "value")


def _delays(d: DriverTables) -> DataFrame:
    test = _scored_test(d)
    return metrics.metric_rows(
        metrics.regression_metrics(test, "delay_minutes", "predicted_delay_minutes"), "scores", "regression",
        "delay_minutes",
    ).select("metric", "value")


def _long_metrics(d: DriverTables) -> DataFrame:
    """A long metric table over both sides of the date split."""
    train, test = model_prep.time_split(d.ai)
    frames = []
    for name, side in (("Most frequent baseline", train), ("GBT classifier", test)):
        one = metrics.classification_metrics(side, "actual_actionable_delay_risk", "predicted_actionable_delay_risk")
        frames.append(metrics.metric_rows(one, name, "classification", metrics.TARGET))
    for name, side in (("Median baseline", train), ("GBT regressor", test)):
        one = metrics.regression_metrics(side, "delay_minutes", "predicted_delay_minutes")
        frames.append(metrics.metric_rows(one, name, "regression", "delay_minutes"))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


SAMPLE_ROWS = 2_000
RARE_ROWS = 55
_MODEL_KEY = ("collection_time_utc", "route_id", "delay_minutes")


def _model_sides(d: DriverTables) -> tuple[DataFrame, DataFrame]:
    """All train and test rows, checkpointed: boosting passes over them many times."""
    ensure_checkpoint_dir(d.spark)
    return model_prep.time_split(cleaning.model_input(d.decisions).checkpoint())


def _once(d: DriverTables, name: str, make: Callable[[], object]):
    """Trained things are shared by the queries of a session."""
    if name not in d.trained:
        d.trained[name] = make()
    return d.trained[name]


def _sides_and_encoding(d: DriverTables) -> tuple[DataFrame, DataFrame, model_prep.FittedEncoding]:
    def make():
        train, test = _model_sides(d)
        return train, test, model_prep.fit_encoding(train)

    return _once(d, "sides", make)


def _classifier(d: DriverTables) -> tuple[models.TrainedModel, DataFrame]:
    """The classifier as the training plan fits it, and all test rows."""
    train, test, encoding = _sides_and_encoding(d)
    sample = lambda: model_prep.stratified_sample(train, _MODEL_KEY).checkpoint()
    return _once(d, "classifier", lambda: models.train_classifier(sample(), encoding=encoding)), test


def _regressor(d: DriverTables) -> models.TrainedModel:
    train, _, encoding = _sides_and_encoding(d)
    return _once(d, "regressor", lambda: models.train_regressor(train, encoding=encoding))


def _models(d: DriverTables) -> tuple[models.TrainedModel, models.TrainedModel, DataFrame, DataFrame]:
    """Both models, which share their encoding, and all train and test rows."""
    train, test, _ = _sides_and_encoding(d)
    (classifier, _), regressor = at_once(d.spark, lambda: _classifier(d), lambda: _regressor(d))
    return classifier, regressor, train, test


def _gbt_metrics(d: DriverTables) -> DataFrame:
    classifier, test = _classifier(d)
    one = metrics.classification_metrics(
        models.score_class(classifier, test), models.TARGET, "predicted_actionable_delay_risk"
    )
    return metrics.metric_rows(one, training.CLASSIFIER_NAME, "classification", models.TARGET)


def _gbt_delays(d: DriverTables) -> DataFrame:
    _, test, _ = _sides_and_encoding(d)
    one = metrics.regression_metrics(models.score_delay(_regressor(d), test), "delay_minutes", "predicted_delay_minutes")
    return metrics.metric_rows(one, training.REGRESSOR_NAME, "regression", "delay_minutes")


def _scored_rows(d: DriverTables) -> DataFrame:
    """All test rows scored by both models: rows per day, and rows whose scores are missing or contradict one another."""
    classifier, regressor, _, test = _models(d)
    probability, risk = F.col("predicted_actionable_probability"), F.col("predicted_actionable_delay_risk")
    return models.score(classifier, regressor, test).groupBy("collection_date").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(~probability.between(0, 1) | probability.isNull()).alias("bad_probability"),
        F.count_if(risk != (probability > 0.5).cast("int")).alias("bad_class"),
        F.count_if(F.col("predicted_delay_minutes").isNull() | F.isnan("predicted_delay_minutes")).alias("bad_delay"),
        F.round(F.sum(F.round(F.col("delay_minutes") * 60, 6).cast("decimal(18,6)")).cast("double"), 3).alias("seconds"),
    )


def _model_structure(d: DriverTables) -> DataFrame:
    """Features, total gain and negative gains of each model."""
    classifier, regressor, train, _ = _models(d)
    gains = [models.model_importance(m, train, name) for m, name in
             ((classifier, training.CLASSIFIER_NAME), (regressor, training.REGRESSOR_NAME))]
    return gains[0].unionByName(gains[1]).groupBy("source").agg(
        F.count(F.lit(1)).alias("features"), F.countDistinct("feature").alias("names"),
        F.round(F.sum("importance"), 6).alias("total_gain"), F.count_if(F.col("importance") < 0).alias("negative"))


def _metric_domains(d: DriverTables) -> DataFrame:
    """Every metric of the training plan's evaluation with whether its value can be one; counts add up to the test rows."""
    classifier, regressor, train, test = _models(d)
    rows = training.evaluate(classifier, regressor, train, test)
    share = F.col("metric").isin("accuracy", "precision", "recall", "f1", "macro_f1", "weighted_f1")
    possible = F.when(share, F.col("value").between(0, 1)).when(F.col("metric") == "r2", F.col("value") <= 1).otherwise(F.col("value") >= 0)
    cell = F.col("metric").isin("true_negative_low", "false_positive_actionable", "false_negative_actionable", "true_positive_actionable")
    return rows.groupBy("model", "target_type").agg(
        F.count(F.lit(1)).alias("metrics"), F.count_if(~possible | F.col("value").isNull()).alias("impossible"),
        F.coalesce(F.sum(F.when(cell, F.col("value"))), F.lit(0.0)).alias("counted"))


def _trained_evidence(d: DriverTables) -> DataFrame:
    """What the dashboard shows of the trained models: baselines and gain from the training plan's own metrics."""
    classifier, regressor, train, test = _models(d)
    return prediction.model_evidence(
        training.evaluate(classifier, regressor, train, test), training.CLASSIFIER_NAME, training.REGRESSOR_NAME)


def _imputation(d: DriverTables) -> DataFrame:
    """What gaps of each feature are filled with: exact medians and most frequent categories of the training rows."""
    train, _ = model_prep.time_split(cleaning.model_input(d.decisions))
    encoding = model_prep.fit_encoding(train)
    rows = [(name, F.lit(None).cast("string"), F.lit(encoding.medians[name])) for name in schemas.NUMERIC_FEATURES]
    rows += [(name, F.lit(encoding.modes[name]), F.lit(None).cast("double")) for name in schemas.CATEGORICAL_FEATURES]
    return d.spark.range(1).select(F.inline(F.array(*(
        F.struct(F.lit(name).alias("feature"), mode.alias("mode"), F.round(median, 6).alias("median")) for name, mode, median in rows))))


def _permutation(d: DriverTables) -> DataFrame:
    return explain.permutation_importance(*_classifier(d), _MODEL_KEY)


def _contribution_rows(d: DriverTables) -> DataFrame:
    return _once(d, "contributions", lambda: explain.contribution_rows(*_classifier(d)))


def _contribution_points(d: DriverTables) -> DataFrame:
    return explain.contribution_points(_contribution_rows(d))


def _contribution_sums(d: DriverTables) -> DataFrame:
    """Test rows whose base value and contributions add up to the probability, and how many contributions there are."""
    rows = _contribution_rows(d)
    return explain.additivity(rows).withColumn("contributions", rows.agg(F.count("shap_value")).scalar())


def _top_contributions(d: DriverTables) -> DataFrame:
    """The ranking that the dashboard reads, over the contributions of the trained classifier."""
    return features.top_features(explain.contribution_importance(_contribution_rows(d), training.CLASSIFIER_NAME))


def _clean_names(d: DriverTables) -> DataFrame:
    """The schedule under the header names a spreadsheet gives it, cleaned."""
    spoken = d.routes.toDF(*(f" {name.replace('_', ' ').title()} " for name in d.routes.columns))
    return cleaning.clean_column_names(spoken).withColumn("route_type", F.col("route_type").cast("bigint"))


def _realtime_types(d: DriverTables) -> DataFrame:
    """Observations as text, typed again without their date."""
    names = ("entity_id", "direction_id", "timestamp", "delay_seconds", "delay_minutes", "is_deleted")
    when = F.date_format("collection_time_utc", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("collection_time_utc")
    text = d.observations.select(when, *(F.col(name).cast("string") for name in names))
    return _rounded(_text_times(cleaning.normalize_realtime_types(text), "collection_time_utc"))


def _missing_columns(d: DriverTables) -> DataFrame:
    """Columns the dashboard requires that a table lacks, with the rows that lack them."""
    cleaning.require_columns(d.decisions, schemas.DASHBOARD_REQUIRED, "dashboard")  # the whole table passes
    published = d.decisions.drop("rain", "service_type")
    absent = cleaning.missing_columns(published, schemas.DASHBOARD_REQUIRED)
    return published.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(F.array(*map(F.lit, absent))).alias("column_name"), "rows")


def _scenario_report(d: DriverTables) -> DataFrame:
    """The report's facts from texts that state them."""
    results = scenario.scenario_results(_comparison(d)).withColumns({
        "selected_route": F.lit(FOCUS_ROUTE),
        "validation_interpretation": F.concat(F.lit("about "), F.col("congestion_index").cast("string"), F.lit(" Percent lower loss")),
    })
    days = d.manifest.select(F.concat(F.lit("evidence up to "), F.col("collection_date"), F.lit(".")).alias("description"))
    return scenario.scenario_report(results, days)


def _text_decisions(d: DriverTables) -> DataFrame:
    """Decisions as text, the way a CSV hands them over, typed again."""
    text = d.decisions.select(*(F.col(name).cast("string") for name in d.decisions.columns))
    typed = cleaning.normalize_decision_types(text)
    return _text_times(
        typed.select("collection_time_utc", "route_id", "trip_id", "route_type", "delay_seconds", "is_special_route",
                     "is_partial_day", "rain", "wind_speed_10m", "trip_hour"),
        "collection_time_utc",
    )


def _snapshots(d: DriverTables) -> DataFrame:
    """Observations as one JSON document each, parsed and flattened again."""
    trip = F.struct("trip_id", "route_id", F.col("direction_id").cast("int").alias("direction_id"), "start_time",
                    F.col("start_date").cast("string").alias("start_date"))
    update = F.struct("timestamp", F.col("delay_seconds").cast("double").alias("delay"), trip.alias("trip"))
    entity = F.struct(F.col("entity_id").alias("id"), "is_deleted", update.alias("trip_update"))
    document = F.to_json(F.struct(F.struct(F.array(entity).alias("entity")).alias("response")))
    parsed = d.observations.select(
        "collection_time_utc", F.from_json(document, schemas.SNAPSHOT)["response"].alias("response")
    )
    return _rounded(_text_times(readers.flatten_snapshots(parsed), "collection_time_utc"))


def _model_rows(d: DriverTables) -> DataFrame:
    prepared = cleaning.model_input(d.decisions)
    return _rounded(_text_times(
        prepared.select("collection_time_utc", "collection_date", "route_short_name", "route_type", "service_type",
                        "trip_hour", "rain", "delay_minutes", "delay_risk", "actionable_delay_risk"),
        "collection_time_utc",
    ))


def _split_rows(d: DriverTables) -> DataFrame:
    train, test = model_prep.time_split(d.ai)
    target = "actual_actionable_delay_risk"
    return metrics.split_metrics(d.ai, d.ai, train, test, target).select("model", "metric", "value")


def _stream_hourly(d: DriverTables) -> DataFrame:
    """Hourly delays from a file stream run to its end: each batch replaces the (hour, route) rows it changes."""
    run = f"{ensure_checkpoint_dir(d.spark)}/stream-hourly-{uuid.uuid4().hex}"
    feeds.keep_hourly_delay(d.observation_stream, f"{run}/hours", f"{run}/state").awaitTermination()
    rows = feeds.hourly_delay(d.observations).schema
    return _text_times(feeds.read_hours(d.spark, f"{run}/hours", rows), "hour")


def _faulty_copy(d: DriverTables) -> DataFrame:
    """The decision table as a faulty publication: one hour is missing, and Sundays have blank service types."""
    blank = F.when(F.col("weekday") == 6, F.lit(" ")).otherwise(F.col("service_type"))
    return d.decisions.filter("trip_hour <> 3").withColumn("service_type", blank)


QUERIES: dict[str, Query] = {
    # network
    "decision_summary": lambda d: network.decision_summary(d.ai),
    "decision_summary_bus_morning": lambda d: network.decision_summary(d.ai, BUS_MORNING),
    "decision_summary_one_day": lambda d: network.decision_summary(d.ai, ONE_DAY),
    "decision_summary_special": lambda d: network.decision_summary(d.ai, SPECIALS),
    "risk_percentages": lambda d: network.risk_percentages(d.ai),
    "high_severe_share": lambda d: network.high_severe_share(d.ai),
    "network_kpis": lambda d: network.network_kpis(d.ai),
    "attention_summary": lambda d: network.attention_summary(d.ai),
    "action_summary": lambda d: network.action_summary(d.ai),
    "available_days": lambda d: network.available_days(d.ai),
    "available_hours": lambda d: network.available_hours(d.ai),
    # weather
    "weather_context": lambda d: weather.weather_context(d.ai),
    "weather_integration": lambda d: weather.weather_integration_summary(d.ai),
    "rain_severity": lambda d: weather.rain_severity_breakdown(d.ai),
    "daily_weather_events": lambda d: weather.daily_weather_events(d.ai),
    "service_weather_view": lambda d: weather.service_type_weather_view(d.ai, filters.EVERYTHING),
    "weather_route_examples": lambda d: weather.weather_route_examples(d.ai),
    "weather_context_rollup": lambda d: summaries.weather_context_summary(
        summaries.weather_delay_risk_summary(d.decisions)
    ),
    "weather_features": lambda d: weather.weather_features(features.feature_explanation_lookup(d.importance)),
    # observed
    "observed_daily_records": lambda d: observed.observed_daily_records(d.ai),
    "observed_daily_rollup": lambda d: _rounded(observed.observed_daily_rollup(d.route_daily)),
    "top_observed_records": lambda d: observed.top_observed_routes_records(d.ai),
    "top_observed_rollup": lambda d: _rounded(
        observed.top_observed_routes_rollup(d.route_daily, enrich.route_corridor_lookup(_route_summary(d)))
    ),
    "delay_histogram_records": lambda d: observed.delay_histogram_records(d.ai),
    "delay_histogram_routeday": lambda d: observed.delay_histogram_route_days(d.route_daily),
    "observation_day_kpis": lambda d: summaries.observation_day_kpis(observed.observed_daily_records(d.ai)),
    # prediction
    "actionable_comparison": lambda d: prediction.actionable_comparison(d.ai),
    "prediction_summary": lambda d: prediction.prediction_summary(d.ai),
    "risk_category_cards": lambda d: prediction.risk_category_cards(d.ai),
    "timing_mix": lambda d: prediction.timing_mix(d.ai),
    "prediction_examples": lambda d: prediction.prediction_examples(d.ai),
    "route_prediction_examples": lambda d: prediction.route_prediction_examples(d.ai, FOCUS_ROUTE),
    "balanced_examples": lambda d: prediction.balanced_examples(d.ai),
    "model_evidence": lambda d: prediction.model_evidence(_long_metrics(d), "GBT classifier", "GBT regressor"),
    # routes
    "top_routes": lambda d: routes.top_routes(d.ai),
    "route_options": lambda d: routes.route_options(d.ai, filters.EVERYTHING),
    "route_options_by_risk": lambda d: routes.route_options_by_risk(d.ai, "Severe"),
    "route_signal_scatter": lambda d: routes.route_signal_scatter(d.ai),
    "route_focus": lambda d: routes.route_focus(d.ai, FOCUS_ROUTE),
    "route_timing_mix": lambda d: prediction.route_timing_mix(d.ai, FOCUS_ROUTE),
    "route_action_mix": lambda d: routes.route_action_mix(d.ai, FOCUS_ROUTE),
    "route_stats_ranked": lambda d: routes.route_stats_ranked(d.decisions, min_records=30),
    "route_evidence": lambda d: routes.route_evidence(d.decisions, FOCUS_BUS_ROUTE),
    "route_risk_share": lambda d: routes.route_risk_action_share(d.decisions, FOCUS_BUS_ROUTE),
    "search_routes": lambda d: filters.search_routes(routes.top_routes(d.ai, limit=None), "5-"),
    # storage summaries
    "completeness_manifest": lambda d: _text_times(
        d.manifest, "first_collection_time_utc", "last_collection_time_utc"
    ),
    "daily_summary": lambda d: _rounded(summaries.daily_summary(d.storage)),
    "route_daily_summary": lambda d: _rounded(d.route_daily),
    "top_delayed_day_mean": lambda d: _rounded(summaries.top_delayed_routes_by_day_mean(d.route_daily)),
    "daily_summary_weather": lambda d: _rounded(summaries.daily_summary_with_weather(d.decisions)),
    "route_daily_named": lambda d: _rounded(summaries.route_daily_summary_named(d.decisions)),
    "top_delayed_record_mean": lambda d: _rounded(summaries.top_delayed_routes_by_record_mean(d.decisions)),
    "risk_distribution": lambda d: summaries.risk_distribution(d.decisions),
    "action_distribution": lambda d: summaries.action_distribution(d.decisions),
    "target_distribution": lambda d: summaries.target_distribution(d.decisions),
    "unmatched_routes": lambda d: _rounded(summaries.unmatched_routes(d.decisions)),
    "unmatched_prefixes": lambda d: summaries.unmatched_prefixes(d.decisions),
    "unmatched_by_file": lambda d: summaries.unmatched_by_file(d.decisions),
    "recommendation_summary": lambda d: summaries.recommendation_summary(d.decisions),
    "route_recommendation_counts": lambda d: summaries.route_recommendation_counts(d.decisions),
    "ai_recommendation_summary": lambda d: summaries.ai_recommendation_summary(d.ai),
    "ai_route_recommendation_counts": lambda d: summaries.ai_route_recommendation_counts(d.ai),
    "route_delay_risk": _route_summary,
    "service_type_delay": lambda d: summaries.service_type_delay_summary(d.decisions),
    "weather_delay_risk": lambda d: summaries.weather_delay_risk_summary(d.decisions),
    "action_totals": lambda d: summaries.action_totals(network.decision_summary(d.ai)),
    "kpi_table": lambda d: summaries.kpi_table(d.decisions),
    "storage_counters": lambda d: summaries.storage_counters(d.storage, d.manifest, d.file_stats),
    "value_counts_service_type": lambda d: summaries.value_counts(d.decisions, "service_type"),
    # cleaning and enrichment
    "clean_observations": _clean,
    "dropped_rows": lambda d: cleaning.dropped_rows(
        d.observations.withColumn("trip_id", F.when(~F.col("is_deleted"), F.col("trip_id")))
    ),
    "outlier_filter": lambda d: cleaning.outlier_report(d.observations),
    "time_features": _time_features,
    "attach_weather": _weather_attached,
    "attach_routes": _routes_attached,
    "corridor_labels": lambda d: d.corridors,
    "route_endpoints": lambda d: enrich.route_endpoints(d.trips, d.stop_times, d.stops),
    "shape_usage": lambda d: enrich.shape_usage(d.trips),
    "route_path": _path_rows,
    "busiest_routes": lambda d: enrich.busiest_routes(d.trips),
    "trips_with_routes": lambda d: enrich.trips_with_routes(d.trips, d.routes, SALTS),
    "realtime_with_routes": lambda d: _routes_of_snapshot(d).select(
        "entity_id", "route_short_name", "route_long_name", "route_type", "transport_mode"
    ),
    "attach_completeness": lambda d: enrich.attach_completeness(d.observations, d.manifest).select(
        "entity_id", *enrich.COMPLETENESS_COLUMNS
    ),
    "weather_from_decisions": lambda d: _text_times(
        enrich.weather_from_decision_table(d.decisions), "weather_hour"
    ),
    "decision_types": _text_decisions,
    "flatten_snapshots": _snapshots,
    "model_input": _model_rows,
    "earliest_rows": lambda d: _text_times(
        writers.earliest_rows(d.integrated.select("collection_time_utc", "entity_id", "route_id", "delay_seconds"), 200),
        "collection_time_utc",
    ),
    "clean_names": _clean_names,
    "realtime_types": _realtime_types,
    "missing_columns": _missing_columns,
    "model_columns": lambda d: quality.null_profile(cleaning.select_model_columns(d.decisions)),
    "readable_corridors": lambda d: d.corridors.select(
        "route_id", labels.readable_corridor(F.col("route_corridor_name")).alias("corridor")
    ),
    "scenario_report": _scenario_report,
    "intervention_candidates": lambda d: filters.intervention_candidates(d.integrated).select(
        "entity_id", "recommended_action"
    ),
    "semi_by_dates": lambda d: enrich.semi_by_dates(
        d.integrated, model_prep.split_dates(d.integrated).filter("is_test")
    ).select("entity_id", "collection_date"),
    # quality
    "pair_audit": lambda d: quality.pair_audit(d.decisions),
    "invalid_pairs": lambda d: quality.invalid_pairs(
        d.decisions.withColumn(
            "recommended_action",
            F.when(F.col("is_special_route"), F.lit("Call depot")).otherwise(F.col("recommended_action")),
        )
    ),
    "field_checks": lambda d: quality.field_checks(d.decisions),
    "null_profile": lambda d: quality.null_profile(d.decisions),
    "missing_or_blank": lambda d: quality.missing_or_blank(d.decisions),
    "decision_validation": lambda d: quality.decision_validation(d.decisions, _faulty_copy(d)),
    "describe_delay": lambda d: quality.describe(d.decisions, "delay_seconds"),
    "duplicate_rows": lambda d: quality.duplicate_rows(
        d.decisions.select("collection_date", "trip_hour", "route_id", "trip_id", "delay_risk")
    ),
    "distinct_counts": lambda d: quality.distinct_counts(
        d.storage,
        {"routes": "route_id", "trips": "trip_id", "timestamps": "collection_time_utc", "files": "source_file"},
    ),
    "match_rate": lambda d: quality.match_rate(d.decisions, "route_short_name"),
    "weather_match_rate": lambda d: quality.match_rate(d.decisions, "temperature_2m"),
    "late_ratio": lambda d: quality.late_ratio(_routes_of_snapshot(d), "route_short_name"),
    "mean_delay": lambda d: quality.mean_by(
        observed_seconds(d.observations), _routes_of_snapshot(d), "transport_mode"
    ),
    "median_delay": lambda d: quality.median_by(
        _routes_of_snapshot(d), "delay_seconds", "transport_mode", "median_delay_seconds"
    ),
    "box_stats": lambda d: quality.box_stats(_routes_of_snapshot(d), "delay_seconds", "transport_mode"),
    "storage_validation": _storage_validation,
    "probability_domain": lambda d: quality.probability_domain(d.predictions),
    # features
    "top_features": lambda d: features.top_features(d.importance),
    "feature_lookup": lambda d: features.feature_explanation_lookup(d.importance),
    "prepare_features": lambda d: features.prepare_features(d.importance),
    "importance_by_category": lambda d: features.importance_by_category(d.importance),
    "importance_chart_groups": lambda d: features.importance_by_category(d.importance, chart=True),
    "mean_abs_contribution": lambda d: features.mean_abs_contribution(_contributions(d)),
    "min_max_normalise": lambda d: _rounded(
        features.min_max_normalise(
            d.importance.select("feature", "notes", F.col("importance").alias("value")), salts=SALTS
        )
    ),
    # time series
    "hourly_interpolated": lambda d: _rounded(_text_times(_hourly(d), "hour")),
    "forward_fill": lambda d: _rounded(
        _text_times(timeseries.forward_fill(_weather_on_grid(d), rules.WEATHER_COLUMNS), "weather_hour")
    ),
    "ar1_forecast": lambda d: _rounded(
        _text_times(timeseries.hourly_forecasts(timeseries.hourly_series(d.decisions)), "hour")
    ),
    # modelling
    "stratified_sample": lambda d: model_prep.stratified_sample(d.integrated, ["entity_id"], SAMPLE_ROWS).select(
        "entity_id", "collection_date", "delay_risk"
    ),
    "stratified_split": lambda d: model_prep.stratified_split(d.integrated, ["entity_id"]).select(
        "entity_id", "delay_risk", "is_test"
    ),
    "split_metrics": _split_rows,
    "metric_lookup": lambda d: prediction.metric_lookup(
        _long_metrics(d), [("accuracy", "classifier", "ACCURACY"), ("rmse", "median", "rmse")], exact=False
    ),
    "ordered_importance": lambda d: features.ordered_importance(d.importance),
    "time_split": lambda d: model_prep.split_dates(d.ai),
    "one_hot_rare": lambda d: model_prep.category_table(_train(d), min_rows=RARE_ROWS),
    "baselines": lambda d: _rounded(model_prep.baselines(_train(d))),
    "scale_pos_weight": lambda d: _rounded(model_prep.scale_pos_weight(_train(d))),
    "classification_metrics": _classes,
    "regression_metrics": _delays,
    # scenarios
    "intervention_priority": lambda d: _rounded(summaries.intervention_priority(_cases(d))),
    "scenario_stats": lambda d: _rounded(
        summaries.scenario_stats(_cases(d), FOCUS_BUS_ROUTE, ["actual_arrival_delay_min", "traffic_congestion_index"])
    ),
    "scenario_trip_metrics": lambda d: scenario.scenario_trip_metrics(scenario_trips(d)),
    "scenario_last_step": lambda d: scenario.scenario_last_step(scenario_steps(d)),
    "scenario_compare": _comparison,
    "scenario_improvement": lambda d: scenario.scenario_improvement(_comparison(d)),
    "scenario_results": lambda d: scenario.scenario_results(_comparison(d)),
    # streaming
    "stream_hourly": _stream_hourly,
    # files
    **FILE_QUERIES,
    # rows-only: trained models
    "gbt_classifier": _gbt_metrics,
    "gbt_regressor": _gbt_delays,
    "trained_evidence": _trained_evidence,
    "permutation_importance": _permutation,
    "contribution_points": _contribution_points,
    "trained_top_features": _top_contributions,
    # trained models, by what must hold of any
    "scored_rows": _scored_rows,
    "model_structure": _model_structure,
    "metric_domains": _metric_domains,
    "contribution_sums": _contribution_sums,
    "imputation": _imputation,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: query(driver_tables(spark, folder))

    return {name: bound(query) for name, query in QUERIES.items()}
