"""Sampling, splitting, encoding, metrics, series and the trained models."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from delayloom import schemas
from delayloom.operators import explain, features, metrics, model_prep, models, quality, timeseries


def test_stratified_sample_is_exact_and_repeatable(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, None).otherwise("a").alias("collection_date"), F.lit("Low").alias("delay_risk"))
    sample = model_prep.stratified_sample(df, ["id"], 300)
    counts = {r[0]: r[1] for r in sample.groupBy("collection_date").count().collect()}
    assert counts == {None: 100, "a": 200}
    again = model_prep.stratified_sample(df.repartition(7), ["id"], 300)
    assert {r.id for r in sample.collect()} == {r.id for r in again.collect()}
    assert model_prep.stratified_sample(df, ["id"], 10_000).count() == 3000


def test_sample_equals_brute_force(spark):
    import hashlib

    df = spark.range(500).select("id", (F.col("id") % 2).cast("string").alias("collection_date"), F.lit("x").alias("delay_risk"))
    got = {r.id for r in model_prep.stratified_sample(df, ["id"], 50).collect()}
    want = set()
    for stratum in (0, 1):
        ids = [i for i in range(500) if i % 2 == stratum]
        want |= set(sorted(ids, key=lambda i: hashlib.md5(f"{i}|42".encode()).hexdigest())[:25])
    assert got == want


def test_stratified_split_marks_every_row(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 50, "a").otherwise("b").alias("delay_risk"))
    split = model_prep.stratified_split(df, ["id"])
    assert split.count() == 100
    assert {tuple(r) for r in split.groupBy("delay_risk").agg(F.count_if("is_test")).collect()} == {("a", 10), ("b", 10)}


def days(spark, n):
    return spark.range(n).select(F.concat(F.lit("2026-05-"), F.lpad((F.col("id") + 1).cast("string"), 2, "0")).alias("collection_date"))


def test_time_split_rounds_half_even(spark):
    train, test = model_prep.time_split(days(spark, 23))
    assert (train.count(), test.count()) == (18, 5)
    assert test.agg(F.min("collection_date")).first()[0] == "2026-05-19"
    with pytest.raises(ValueError, match="not enough"):
        model_prep.time_split(days(spark, 4))


def test_metrics_match_closed_forms(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(0, 1)] * 2 + [(1, 0)] + [(0, 0)] * 4, "y int, p int")
    m = metrics.classification_metrics(df, "y", "p").first()
    assert (m.accuracy, m.precision, m.recall) == (0.7, 0.6, 0.75)
    assert m.f1 == pytest.approx(2 * 0.6 * 0.75 / 1.35)
    f0 = 8 / 11
    assert m.macro_f1 == pytest.approx((m.f1 + f0) / 2) and m.weighted_f1 == pytest.approx(0.4 * m.f1 + 0.6 * f0)
    none = metrics.classification_metrics(df.filter("y = 0 and p = 0"), "y", "p").first()
    assert (none.precision, none.recall, none.f1, none.accuracy) == (0.0, 0.0, 0.0, 1.0)
    r = metrics.regression_metrics(spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "y double, p double"), "y", "p").first()
    assert (r.mae, r.mse, r.r2) == (0.5, 0.5, 0.5)
    long = metrics.metric_rows(spark.createDataFrame([(float("nan"), 1 / 3)], "a double, b double"), "m", "t", "x").collect()
    assert [(x.metric, x.value) for x in long] == [("a", None), ("b", 0.333333)]


def hourly(spark, values):
    start = datetime(2026, 5, 30)
    return spark.createDataFrame([(start + timedelta(hours=i), v) for i, v in values.items()], "hour timestamp, mean_delay double")


def test_interpolation_fills_gaps_across_a_month_end(spark):
    series = hourly(spark, {0: None, 1: 1.0, 60: 60.0, 61: None})
    out = [r.mean_delay for r in timeseries.interpolate_hourly(series).orderBy("hour").collect()]
    assert len(out) == 62 and out[0] == 1.0 and out[-1] == 60.0
    assert out[30] == pytest.approx(30.0) and out[1:61] == pytest.approx([float(i) for i in range(1, 61)])


def test_forward_fill_carries_over_blocks(spark):
    series = hourly(spark, {i: (5.0 if i == 2 else None) for i in range(60)}).withColumnRenamed("hour", "weather_hour")
    out = [r.mean_delay for r in timeseries.forward_fill(series, ["mean_delay"]).orderBy("weather_hour").collect()]
    assert out == [None, None] + [5.0] * 58


def test_ar1_recovers_its_coefficients(spark):
    value, values = 10.0, {}
    for i in range(100):
        values[i] = value
        value = 0.5 * value + 2.0
    split = timeseries.split_by_position(hourly(spark, values))
    assert split.filter("is_train").count() == 80
    fit = timeseries.ar1_coefficients(split.filter("position < 12").withColumn("is_train", F.lit(True))).first()
    assert fit.phi == pytest.approx(0.5) and fit.intercept == pytest.approx(2.0)
    out = timeseries.hourly_forecasts(timeseries.split_by_position(hourly(spark, {i: values[i] for i in range(12)}), 0.5)).orderBy("hour").collect()
    assert [r.ar1_forecast for r in out] == pytest.approx([r.mean_delay for r in out])


def test_category_buckets_and_unseen_categories(spark):
    train = spark.createDataFrame([("big", 1.0)] * 3 + [("rare", None), (None, 3.0)], "c string, n double")
    encoding = model_prep.fit_encoding(train, ["c"], ["n"], min_rows=2)
    assert encoding.medians == {"n": 1.0} and encoding.modes == {"c": "big"}
    out = {r.c: (r.c_bucket, r.n) for r in encoding.apply(spark.createDataFrame([("big", None), ("rare", 2.0), ("new", 2.0)], "c string, n double")).collect()}
    assert out == {"big": ("big", 1.0), "rare": ("infrequent_sklearn", 2.0), "new": (None, 2.0)}


def test_baselines(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (1, 9.0), (0, 4.0)], "actionable_delay_risk int, delay_minutes double")
    assert tuple(model_prep.baselines(df).first()) == (0, 3.0)
    assert model_prep.scale_pos_weight(df).first()[0] == 1.0


@pytest.fixture(scope="module")
def labelled(spark):
    """Delays that depend on the hour and the route, so that a model can beat the baselines."""
    i = F.col("id")
    df = spark.range(1200).select(
        i, F.concat(F.lit("2026-05-"), F.lpad((i % 10 + 1).cast("string"), 2, "0")).alias("collection_date"),
        F.concat(F.lit("r"), (i % 4).cast("string")).alias("route_id"), (i % 24).cast("double").alias("trip_hour"))
    late = (F.col("trip_hour") > 15) | (F.col("route_id") == "r3")
    df = df.withColumns({"delay_minutes": F.when(late, 20.0).otherwise(1.0), "actionable_delay_risk": late.cast("int")})
    constant = {n: F.lit("x") for n in schemas.CATEGORICAL_FEATURES if n != "route_id"}
    constant.update({n: F.lit(1.0) for n in schemas.NUMERIC_FEATURES if n != "trip_hour"})
    return df.withColumns(constant).checkpoint() if spark.sparkContext.getCheckpointDir() else df.withColumns(constant)


def test_models_beat_the_baselines_and_explain_the_right_features(spark, labelled):
    train, test = model_prep.time_split(labelled)
    encoding = model_prep.fit_encoding(train)
    classifier = models.train_classifier(train, models.TreeSettings(trees=3, depth=3, row_share=1.0, column_share=1.0), encoding)
    regressor = models.train_regressor(train, models.TreeSettings(trees=2, depth=3, row_share=1.0, column_share=1.0), encoding)
    scored = models.score(classifier, regressor, test)
    got = metrics.classification_metrics(scored, models.TARGET, "predicted_actionable_delay_risk").first()
    assert got.recall == 1.0 and got.accuracy > 0.95
    assert metrics.regression_metrics(scored, "delay_minutes", "predicted_delay_minutes").first().r2 > 0.5
    unseen = models.score_class(classifier, test.limit(1).withColumn("route_id", F.lit("never")))
    assert unseen.count() == 1
    named = models.model_importance(classifier, train, "GBT classifier").collect()
    assert {"trip_hour", "route_id_r3"} <= {r.feature for r in named if r.importance > 0}
    ranked = [r.feature for r in explain.permutation_importance(classifier, test, ["id"], ["trip_hour", "route_id", "weekday"]).orderBy(F.desc("importance")).collect()]
    assert ranked[-1] == "weekday"
    rows = explain.contribution_rows(classifier, test, exclude=["rain"])
    assert rows.count() == test.count() * (len(schemas.FEATURES) - 1) and rows.filter("feature = 'rain'").count() == 0
    top = features.top_features(explain.contribution_importance(rows, "GBT classifier"), 2).collect()
    assert len(top) == 2 and all(r.importance > 0 for r in top)
    points = explain.contribution_points(rows, subset=["trip_hour", "weekday"]).collect()
    assert len(points) == 2 * test.count() and all(0 <= p.value_norm <= 1 for p in points)
    assert all(p.shap_value == 0 for p in points if p.feature == "weekday")


def test_quality_checks(spark, facts):
    df = facts({}, {}, {"delay_risk": "High"}, {"recommended_action": None})
    audit = {(r.delay_risk, r.recommended_action): (r.is_allowed, r.risks_of_action) for r in quality.pair_audit(df).collect()}
    assert audit[("Low", "No operational action required")] == (True, 2) and audit[("Low", None)][0] is False
    assert quality.invalid_pairs(df).count() == 2
    with pytest.raises(ValueError, match="mapping is broken"):
        quality.assert_mapping(df)
    quality.assert_mapping(facts({}, {}))
    assert tuple(quality.duplicate_rows(facts({}, {}, {"rain": None}, {"rain": None})).first()) == (4, 2)
    blanks = {r.check_name: r.records for r in quality.missing_or_blank(facts({"service_type": " "}, {"service_type": None}, {})).collect()}
    assert blanks["service_type"] == 2
    stats = quality.describe(facts({"delay_seconds": 0}, {"delay_seconds": 10}, {"delay_seconds": 20}, {"delay_seconds": None}), "delay_seconds").first()
    assert (stats["count"], stats.mean, stats.std, stats.q25, stats["median"]) == (3, 10.0, 10.0, 5.0, 10.0)
    near = quality.distinct_counts(df, {"r": "route_id", "t": "trip_id"}, approximate=True).first()
    assert tuple(near) == tuple(quality.distinct_counts(df, {"r": "route_id", "t": "trip_id"}).first()) == (1, 1)


def test_feature_tables(spark):
    df = spark.createDataFrame([("s", "mean_abs_shap", "route_id_infrequent_sklearn", 3.0, ""), ("s", "mean_abs_shap", "rain", 1.0, ""),
                                ("s", "other", "rain", 9.0, "")], schemas.IMPORTANCE_LONG)
    assert features.top_features(df).first().feature == "Low-frequency routes (grouped)"
    assert [(r.category, r.share_pct) for r in features.importance_by_category(df).collect()] == [("Weather", 76.9), ("Route", 23.1)]
    assert features.ordered_importance(df).first().feature == "route_id_infrequent_sklearn"
    norm = features.min_max_normalise(spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "feature string, value double"))
    assert sorted(r.value_norm for r in norm.collect()) == [0.0, 0.0, 1.0]
