"""Every registered query gives what its SQL gives."""

import pytest

import __spark_entry__ as registered
from verify import connect
from delayloom.verification import registry
from delayloom.verification.compare import difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, STATEMENTS = registered.queries(), registered.oracle_sql()
TRAINED = {"gbt_classifier", "gbt_regressor", "permutation_importance", "contribution_points", "trained_top_features",
           "trained_evidence"}


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_only_trained_models_have_no_sql():
    own = registry.queries()  # training-data queries are held against brute force in their own tests
    assert set(own) - set(STATEMENTS) == TRAINED
    assert set(own) <= set(QUERIES)
    assert set(STATEMENTS) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert registered.entry(spark).count() == 4


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_matches_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, FOLDER), connection, STATEMENTS[name]) is None
