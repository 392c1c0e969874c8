"""The physical plans keep the properties that matter on a large table."""

import re

import pytest
from pyspark.sql import functions as F

from delayloom.operators import filters, network, observed, prediction, routes, summaries
from delayloom.sources import writers
from delayloom.verification.fixtures import driver_tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def d(spark):
    return driver_tables(spark, FOLDER)


@pytest.fixture(scope="module")
def stored(spark, d, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ai") / "ai")
    writers.write_daily_table(d.ai, path)
    return writers.read_daily_table(spark, path, d.ai.columns)


def test_lookups_without_used_columns_are_not_joined(d):
    text = plan(network.decision_summary(d.ai))
    assert "Join" not in text and "orders.parquet" not in text and "customer.parquet" not in text


def test_only_needed_columns_are_read(stored):
    text = plan(network.decision_summary(stored))
    read = set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)))
    assert read == {"route_id", "is_special_route", "ai_delay_risk", "ai_recommended_action"}


def test_day_filter_prunes_partitions_and_others_are_pushed(stored):
    where = filters.DashboardFilter(service_type="Bus", day="2024-01-15", hour="08:00")
    text = plan(network.decision_summary(stored, where))
    assert re.search(r"PartitionFilters: \[[^\]]*collection_date[^\]]*2024-01-15", text)
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "EqualTo(service_type,Bus)" in pushed and "EqualTo(trip_hour,8)" in pushed
    assert "Or(Not(EqualTo(is_special_route,true)),IsNull(is_special_route))" in pushed


def test_latest_day_is_found_without_reading_every_row_twice(stored):
    text = plan(prediction.route_prediction_examples(stored, "7-202"))
    assert "TakeOrderedAndProject" in text and "EqualTo(route_id,7-202)" in text


@pytest.mark.parametrize("query", [
    lambda t: routes.top_routes(t), lambda t: observed.top_observed_routes_records(t),
    lambda t: prediction.prediction_examples(t), lambda t: summaries.top_delayed_routes_by_record_mean(t)])
def test_rankings_take_the_top_rows_without_a_global_sort(stored, query):
    text = plan(query(stored))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_one_row_per_group_is_limited_before_the_shuffle(stored):
    text = plan(prediction.balanced_examples(stored))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_no_query_gathers_facts_in_one_partition_or_crosses_tables(d):
    for df in (network.decision_summary(d.ai), routes.top_routes(d.ai), summaries.ai_route_recommendation_counts(d.ai),
               summaries.route_daily_summary(d.storage), observed.delay_histogram_records(d.ai)):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert not re.search(r"Window .*\n.*Exchange SinglePartition", text)


def test_no_python_runs_in_the_hot_path(d):
    for df in (d.ai, summaries.completeness_manifest(d.observations), summaries.weather_delay_risk_summary(d.decisions)):
        assert not re.search(r"Python|Arrow", plan(df))


def test_partial_aggregation_precedes_every_shuffle_of_facts(stored):
    for df in (routes.top_routes(stored), observed.observed_daily_records(stored)):
        for before in re.findall(r"Exchange hashpartitioning.*\n\W*(?:\*\(\d+\) )?(\w+)", plan(df)):
            assert before in ("HashAggregate", "SortAggregate", "ObjectHashAggregate"), before


def test_published_and_derived_tables_agree(stored, d):
    left = network.decision_summary(stored, filters.EVERYTHING)
    right = network.decision_summary(d.ai, filters.EVERYTHING)
    assert left.exceptAll(right).count() == 0 and left.count() == right.count()
    assert stored.agg(F.sum("delay_seconds")).first() == d.ai.agg(F.sum("delay_seconds")).first()
