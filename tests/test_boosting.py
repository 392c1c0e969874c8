"""The learner over category codes against Spark's own one over one-hot features."""

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from delayloom.operators import boosting, model_prep, models

WHOLE = models.TreeSettings(trees=6, depth=4, row_share=1.0, column_share=1.0)


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 250.0
    df = spark.range(1500).select(
        i, F.concat(F.lit("r"), (i * 7 % 13).cast("string")).alias("route"), F.concat(F.lit("d"), (i % 60).cast("string")).alias("stop"),
        (i * 5 % 24).cast("double").alias("hour"), (i * 3 % 7).cast("double").alias("day"), noise.alias("noise"))
    late = (F.col("route") == "r3").cast("int") * 9 + (F.col("hour") > 15).cast("int") * 5 + (F.col("stop") == "d7").cast("int") * 30
    df = df.withColumn("delay_minutes", late + F.col("noise") - F.col("day") / 3)
    return df.withColumn("actionable_delay_risk", (F.col("delay_minutes") > 7).cast("int")).drop("noise").localCheckpoint()


@pytest.fixture(scope="module")
def encoding(rows):
    return model_prep.fit_encoding(rows, ["route", "stop"], ["hour", "day"], min_rows=20)


def spark_fit(kind, rows, encoding, settings, **columns):
    return kind(maxIter=settings.trees, maxDepth=settings.depth, stepSize=settings.step, seed=settings.seed, **columns).fit(encoding.encode(rows))


def test_regressor_equals_spark_on_one_hot_features(rows, encoding):
    own = models.train_regressor(rows, WHOLE, encoding)
    wanted = spark_fit(GBTRegressor, rows, encoding, WHOLE, labelCol="delay_minutes")
    got = wanted.transform(own.trees.transform(encoding.encode(rows)).withColumnRenamed("prediction", "own"))
    assert got.agg(F.max(F.abs(F.col("own") - F.col("prediction")))).first()[0] < 1e-9
    assert own.trees.featureImportances.toArray() == pytest.approx(wanted.featureImportances.toArray(), abs=1e-9)
    assert own.trees.treeWeights == wanted.treeWeights and own.trees.numFeatures == wanted.numFeatures
    assert [t.numNodes for t in own.trees.trees] == [t.numNodes for t in wanted.trees]


def test_classifier_equals_spark_on_one_hot_features(rows, encoding):
    own = models.train_classifier(rows, WHOLE, encoding)
    weight = model_prep.scale_pos_weight(rows).first()[0]
    weighted = rows.withColumn("w", F.when(F.col("actionable_delay_risk") == 1, F.lit(weight)).otherwise(1.0))
    wanted = spark_fit(GBTClassifier, weighted, encoding, WHOLE, labelCol="actionable_delay_risk", weightCol="w")
    p = vector_to_array("probability")[1]
    both = models.score_class(own, rows).select("id", "predicted_actionable_probability").join(
        wanted.transform(encoding.encode(rows)).select("id", p.alias("p")), "id")
    assert both.agg(F.max(F.abs(F.col("predicted_actionable_probability") - F.col("p"))), F.count("*")).first() == pytest.approx((0, 1500), abs=1e-9)


def test_trees_do_not_depend_on_how_rows_are_dealt(rows, encoding, monkeypatch):
    alone = models.train_regressor(rows, WHOLE, encoding)
    for name, value in {"ONE_TASK_ROWS": 0, "LEAST_ROWS": 200, "MOST_RESULTS": 2, "BLOCK_ROWS": 100, "PENDING": 2, "PASS_BYTES": 5000, "KEPT_BYTES": 0}.items():
        monkeypatch.setattr(boosting, name, value)
    spread = models.train_regressor(rows, WHOLE, encoding)
    both = models.score_delay(alone, rows).withColumnRenamed("predicted_delay_minutes", "own")
    assert models.score_delay(spread, both).agg(F.max(F.abs(F.col("own") - F.col("predicted_delay_minutes")))).first()[0] < 1e-9


def test_shares_of_rows_and_features(rows, encoding):
    settings = models.TreeSettings(trees=5, depth=3, row_share=0.7, column_share=0.3)
    first, again = (models.train_regressor(rows.coalesce(1), settings, encoding) for _ in range(2))
    assert first.trees.toDebugString.split("\n")[1:] == again.trees.toDebugString.split("\n")[1:]
    layout = boosting.Layout(("a", "b"), ((), ()), ("c",), (8,))
    allowed = [boosting._allowed(layout, 0.25, 1, 0, node) for node in range(50)]
    assert {int(x.sum()) for x in allowed} == {3} and all(any(x[k] for x in allowed) for k in range(10))
    assert boosting._allowed(layout, 1.0, 1, 0, 0) is None


def test_jobs_do_not_follow_trees_or_categories(spark):
    """Spark's learner took a job a level of each tree, over a vector with a place for each of 1,200 categories."""
    i = F.col("id")
    wide = spark.range(6000).select(
        *(F.concat(F.lit(name), (i % 400).cast("string")).alias(name) for name in ("route", "name", "corridor")),
        (i % 24).cast("double").alias("hour"), (F.pmod(F.xxhash64("id"), F.lit(60)) / 1.0).alias("delay_minutes"))
    encoding = model_prep.fit_encoding(wide, ["route", "name", "corridor"], ["hour"], min_rows=2)
    assert len(encoding.feature_names()) == 1201
    context = spark.sparkContext
    try:
        context.setJobGroup("boosting-jobs", "", False)
        model = models.train_regressor(wide, models.TreeSettings(trees=24), encoding)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert model.trees.getNumTrees == 24
    assert 0 < len(context.statusTracker().getJobIdsForGroup("boosting-jobs")) < 60


def test_few_and_many_values_of_a_number(spark):
    df = spark.range(4000).select((F.col("id") % 3).cast("double").alias("few"), (F.col("id") * 1.0).alias("many"))
    few, many = boosting._cuts(df, ["few", "many"])
    assert few == (0.5, 1.5)
    assert len(many) == 31 and many[15] == pytest.approx(2000, abs=50) and list(many) == sorted(set(many))
    assert boosting._cuts(df, []) == ()


@pytest.mark.parametrize("change", [{"delay_minutes": None}, {"hour": float("nan")}, {"delay_minutes": float("inf")}])
def test_rows_without_usable_values_are_an_error(rows, encoding, change):
    odd = rows.withColumns({name: F.when(F.col("id") == 3, F.lit(value).cast("double")).otherwise(F.col(name)) for name, value in change.items()})
    with pytest.raises(ValueError, match="1 of 1500 training rows"):
        models.train_regressor(odd, WHOLE, encoding)


def test_one_label_and_one_category(spark):
    df = spark.range(40).select((F.col("id") % 4).cast("double").alias("hour"), F.lit("x").alias("kind"), F.lit(3.0).alias("delay_minutes"))
    encoding = model_prep.fit_encoding(df, ["kind"], ["hour"])
    model = models.train_regressor(df, WHOLE, encoding)
    assert {round(r.predicted_delay_minutes, 9) for r in models.score_delay(model, df).collect()} == {3.0}
    assert all(t.numNodes == 1 for t in model.trees.trees)
