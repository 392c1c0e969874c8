"""Queries over trained models: the jobs they take do not follow the trees."""

import pytest

from delayloom.operators import models
from delayloom.session import at_once
from delayloom.verification import registry
from delayloom.verification.fixtures import DriverTables

TRAINED = ["contribution_points", "contribution_sums", "gbt_classifier", "gbt_regressor", "metric_domains", "model_structure",
           "permutation_importance", "scored_rows", "trained_evidence", "trained_top_features"]


def test_trained_queries_take_fewer_jobs_than_levels_of_trees(spark):
    """Spark's learner took a job a level of each tree, 1,700 for both models."""
    tables, context, jobs = DriverTables(spark, "/root/testdata/sf0.001"), spark.sparkContext, {}
    try:
        for name in TRAINED:
            context.setJobGroup(f"trained-{name}", "", False)
            assert registry.QUERIES[name](tables).count() > 0
            jobs[name] = len(context.statusTracker().getJobIdsForGroup(f"trained-{name}"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    print(jobs)
    assert all(0 < n < 400 for n in jobs.values()), jobs
    assert tables.trained["classifier"].trees.getNumTrees == models.CLASSIFIER.trees == 160
    assert tables.trained["regressor"].trees.getNumTrees == models.REGRESSOR.trees == 180


def test_functions_at_once_keep_their_order_and_errors(spark):
    assert at_once(spark, lambda: spark.range(3).count(), lambda: "second") == [3, "second"]
    with pytest.raises(ZeroDivisionError):
        at_once(spark, lambda: 1, lambda: 1 / 0)
