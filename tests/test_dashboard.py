"""Dashboard queries on the cases where they are easy to get wrong."""

import pytest
from pyspark.sql import functions as F

from delayloom import rules
from delayloom.operators import filters, network, observed, prediction, routes, summaries, weather
from delayloom.operators.filters import EVERYTHING, DashboardFilter


def test_filter_settles_special_by_flag_then_prefix(facts):
    df = facts({"route_id": "s1", "is_special_route": None}, {"route_id": "s2", "is_special_route": False},
               {"route_id": "9", "is_special_route": True}, {"route_id": "9", "is_special_route": None})
    assert filters.global_filter(df).count() == 2
    assert filters.global_filter(df, include_special=True).count() == 4
    special = filters.global_filter(df, service_type=rules.SPECIAL_SERVICE)
    assert special.count() == 2


def test_filter_day_hour_service(facts):
    df = facts({}, {"service_type": None}, {"service_type": ""}, {"trip_hour": 9}, {"collection_date": "2026-05-12"})
    assert filters.global_filter(df, "Unknown / unmatched route").count() == 2
    assert filters.global_filter(df, hour="09:00").count() == 1
    assert filters.global_filter(df, day="2026-05-12").count() == 1
    text = df.withColumns({"is_special_route": F.lit("x"), "trip_hour": F.col("trip_hour").cast("string")})
    assert filters.global_filter(text, hour="09:00").count() == 1


def test_search_is_literal(facts):
    df = facts({"route_id": "a.b", "route_corridor_name": "C"}, {"route_id": "axb", "route_corridor_name": None})
    assert [r.route_id for r in filters.search_routes(df, "A.B").collect()] == ["a.b"]
    assert filters.search_routes(df, "  ").count() == 2


def test_summary_filter_flags_or_prefix(facts):
    df = facts({"route_id": "S1", "is_special_route": False}, {"route_id": "9"}, {"route_id": "8", "service_type": None})
    assert filters.summary_filter(df).count() == 2
    assert filters.summary_filter(df, DashboardFilter(service_type=rules.SPECIAL_SERVICE)).count() == 1
    assert filters.summary_filter(df, DashboardFilter(service_type=rules.UNKNOWN_SERVICE)).count() == 1


def test_blank_and_null_labels_share_one_group(facts):
    df = facts({"ai_delay_risk": ""}, {"ai_delay_risk": None}, {"service_type": None}, {"service_type": ""})
    cards = {r.ai_delay_risk: r.records for r in prediction.risk_category_cards(df).collect()}
    assert cards == {"Unknown": 2, "Low": 2}
    assert weather.service_type_weather_view(df).count() == 2


def test_modal_action_ties_go_to_the_smaller_text(facts):
    df = facts({"ai_recommended_action": "b"}, {"ai_recommended_action": "a"}, {"ai_recommended_action": None},
               {"ai_recommended_action": None}, {"ai_recommended_action": None})
    assert routes.top_routes(df).first().recommended_action == "a"
    assert routes.route_focus(df, "10-1").first().recommended_action == "a"


def test_empty_selection_still_answers(facts):
    df, nothing = facts({}), DashboardFilter(day="1999-01-01")
    assert [tuple(r) for r in prediction.timing_mix(df, nothing).collect()] == [
        ("Early-running", 0, 0.0), ("Near on-time", 0, 0.0), ("Late-running", 0, 0.0)]
    assert [r.share_pct for r in network.risk_percentages(df, nothing).collect()] == [0.0] * 4
    kpis = network.network_kpis(df, nothing).first()
    assert (kpis.total_records, kpis.actionable_records, kpis.avg_delay_minutes, kpis.most_common_recommendation) == (
        0, 0, None, "Unavailable")
    assert network.attention_summary(df, nothing).first().route == "Unavailable"
    assert network.high_severe_share(df, nothing).first().share_from_counts_pct == 0.0
    assert prediction.actionable_comparison(df, nothing).count() == 2


def test_shares_sum_to_one_hundred_and_keep_risk_order(facts):
    df = facts(*({"ai_delay_risk": r, "ai_recommended_action": rules.ACTION_BY_RISK[r]} for r in ("Severe", "Low", "High", "High")))
    out = network.decision_summary(df).collect()
    assert [r.delay_risk for r in out] == ["Low", "High", "Severe"]
    assert sum(r.share_pct for r in out) == pytest.approx(100)
    assert network.high_severe_share(df).first().share_from_counts_pct == 75.0
    assert network.action_summary(df).first().risk_pct == 75.0


def test_means_come_from_exact_seconds(facts):
    df = facts({"delay_seconds": 1}, {"delay_seconds": 1}, {"delay_seconds": 1}, {"delay_seconds": 0})
    assert network.network_kpis(df).first().avg_delay_minutes == 0.013
    without = df.drop("delay_seconds")
    assert network.network_kpis(without).first().avg_delay_minutes == 0.013


def test_histogram_edges(facts, spark):
    df = facts({"delay_minutes": 30.0}, {"delay_minutes": 99.0}, {"delay_minutes": -30.0}, {"delay_minutes": -99.0},
               {"delay_minutes": 0.0}, {"delay_seconds": None, "delay_minutes": None})
    out = {r.bin_mid: r["count"] for r in observed.delay_histogram_records(df).collect()}
    assert out == {31: 2, -29: 2, 1: 1}
    daily = spark.createDataFrame([("9", False, "Bus", 30.0), ("9", False, "Bus", -30.0), ("9", False, "Bus", None)],
                                  "route_id string, is_special_route boolean, service_type string, avg_delay_minutes double")
    grid = observed.delay_histogram_route_days(daily).collect()
    assert len(grid) == 30 and sum(r["count"] for r in grid) == 1 and grid[0].bin_mid == -29


def test_weighted_rollup_ignores_records_without_a_mean(spark):
    daily = spark.createDataFrame(
        [("d", "9", "Bus", "n", False, 10, 2.0, 5.0), ("d", "9", "Bus", "n", False, 90, None, None), (None, "9", "Bus", "n", False, 1, 1.0, 1.0)],
        "collection_date string, route_id string, service_type string, route_display_name string, is_special_route boolean, records bigint, avg_delay_minutes double, max_delay_minutes double")
    row = observed.observed_daily_rollup(daily).first()
    assert (row.records, row.avg_observed_delay, row.max_observed_delay) == (100, 2.0, 5.0)
    corridors = spark.createDataFrame([("9", "Somewhere")], "route_id string, corridor_name string")
    assert observed.top_observed_routes_rollup(daily, corridors).first().corridor_name == "Somewhere"


def test_three_average_delays_differ(facts):
    df = facts({"collection_date": "a", "delay_seconds": 600}, {"collection_date": "b", "delay_seconds": 0},
               {"collection_date": "b", "delay_seconds": 0}, {"collection_date": "b", "delay_seconds": 0})
    storage = df.withColumns({"collection_day_status": F.lit("x"), "is_model_baseline_day": F.lit(True)})
    by_day = summaries.top_delayed_routes_by_day_mean(summaries.route_daily_summary(storage)).first()
    by_record = summaries.top_delayed_routes_by_record_mean(df).first()
    assert (by_day.avg_delay_minutes, by_record.avg_delay_minutes) == (5.0, 2.5)


def test_weather_examples_need_fifty_exposed_records(facts):
    def of(route, wet):
        return [{"route_id": route, "rain": 1.0, "delay_seconds": 120}] * wet + [{"route_id": route, "delay_seconds": 60}] * 2

    df = facts(*of("49", 49), *of("50", 50))
    out = weather.weather_route_examples(df).collect()
    assert [(r.route_id, r.weather_context_records, r.weather_delay_delta) for r in out] == [("50", 50, 1.0)]


def test_route_examples_use_the_latest_day_of_the_table(facts):
    df = facts({"collection_date": "a"}, {"collection_date": "b"}, {"collection_date": "c", "route_id": "other"})
    assert prediction.route_prediction_examples(df, "10-1").count() == 0
    assert prediction.route_prediction_examples(df, "10-1", where=DashboardFilter(day="a")).count() == 1


def test_balanced_examples_take_one_per_risk_and_timing(facts):
    df = facts({"predicted_actionable_probability": 0.3, "route_id": "1"}, {"predicted_actionable_probability": 0.4, "route_id": "2"},
               {"predicted_actionable_probability": None, "route_id": "0"}, {"delay_seconds": 600}, {"ai_delay_risk": "odd"})
    out = prediction.balanced_examples(df).collect()
    assert [(r.timing_band, r.route_id) for r in out] == [("Near on-time", "2"), ("Late-running", "10-1")]


def test_route_rankings_and_options(facts):
    df = facts({"predicted_actionable_delay_risk": 1, "route_id": "1"}, {"route_id": "2", "actual_actionable_delay_risk": 1}, {"route_id": "3"})
    assert routes.top_routes(df, 1).first().route_id == "1"
    assert {r.route_id for r in routes.route_signal_scatter(df).collect()} == {"1", "2"}
    assert routes.route_options_by_risk(df, "All").count() == 3
    assert routes.route_options_by_risk(df, "Low").count() == 3
    assert routes.route_options_by_risk(df, "High").count() == 0


def test_route_counts_share_of_all_records(facts):
    df = facts({}, {}, {}, {"is_special_route": True})
    assert summaries.route_recommendation_counts(df).first().share_pct == 75.0
    assert summaries.route_recommendation_counts(df, include_special=True).count() == 2


def test_risk_probability_text(spark):
    df = spark.createDataFrame([("High", 0.735), (None, 0.5), ("Low", None)], "r string, p double")
    out = [r[0] for r in df.select(prediction.risk_probability_text(F.col("r"), F.col("p"))).collect()]
    assert out == ["High · 74%", "Unknown · 50%", "Low"]


def test_days_hours_and_page(facts):
    from delayloom.plans.page_bundle import page_bundle

    df = facts({}, {"collection_date": "2026-05-12", "trip_hour": 17})
    assert [r.day for r in network.available_days(df).collect()] == ["2026-05-12", "2026-05-11"]
    assert [r.hour for r in network.available_hours(df).collect()] == ["08:00", "17:00"]
    with page_bundle(df, EVERYTHING) as page:
        assert page["network_kpis"].first().total_records == 2
        assert page["decision_summary"].count() == 1
