"""Cleaning, typing and the decision rules."""

import pytest
from pyspark.sql import functions as F

from delayloom import schemas
from delayloom.operators import cleaning, summaries

RAW = "2026-05-11T08:00:00+00:00"


def raw(spark, *changes):
    base = dict(zip(schemas.RAW_COLUMNS, [RAW, "e", "t", "r", "1", "08:00:00", "20260511", "1778486400", "60",
                                          "False", "1.0"]))
    data = [tuple({**base, **change}[name] for name in schemas.RAW_COLUMNS) for change in changes]
    return spark.createDataFrame(data, schemas.RAW_OBSERVATION)


def test_clean_observations_drops_headers_bad_times_and_bad_delays(spark):
    header = dict(zip(schemas.RAW_COLUMNS, schemas.RAW_COLUMNS))
    df = raw(spark, {}, header, {"collection_time_utc": "soon"}, {"delay_minutes": None}, {"delay_minutes": "late"},
             {"route_id": None, "direction_id": "x"})
    cleaned = cleaning.clean_observations(df).orderBy(F.col("route_id").isNull()).collect()
    assert len(cleaned) == 2
    assert cleaned[0].collection_date == "2026-05-11" and cleaned[0].delay_seconds == 60
    assert cleaned[1].route_id is None and cleaned[1].direction_id is None


def test_missing_columns_are_named(spark):
    with pytest.raises(cleaning.MissingColumnsError, match="delay_minutes"):
        cleaning.clean_observations(spark.createDataFrame([(1,)], "route_id int"))


def test_column_names_and_header_rows(spark):
    df = cleaning.clean_column_names(spark.createDataFrame([("a", "b"), (" Route_ID ", "x"), (None, "c")],
                                                          "`Route ID` string, ` Other` string"))
    assert df.columns == ["route_id", "other"]
    assert cleaning.remove_header_rows(df).count() == 2


def test_outliers_keep_both_bounds(spark):
    df = spark.createDataFrame([(-60.0,), (120.0,), (-60.1,), (120.5,)], "delay_minutes double")
    assert cleaning.filter_outliers(df).count() == 2
    report = cleaning.outlier_report(df).first()
    assert (report.input_rows, report.removed_rows, report.removal_pct) == (4, 2, 50.0)


def test_time_features_use_monday_zero(spark):
    df = cleaning.clean_observations(raw(spark, {}))
    row = cleaning.add_time_features(df).first()
    assert (row.trip_hour, row.weekday, row.day_of_month, row.delay_abs_minutes) == (8, 0, 11, 1.0)


def test_decision_types_are_tolerant(spark):
    df = spark.createDataFrame([("TRUE", "3.0", "x", "7")], "is_special_route string, route_type string, rain string, other string")
    row = cleaning.normalize_decision_types(df).first()
    assert (row.is_special_route, row.route_type, row.rain, row.other) == (True, 3, None, "7")


def test_realtime_types_derive_the_date(spark):
    row = cleaning.normalize_realtime_types(raw(spark, {"is_deleted": "1"})).first()
    assert row.is_deleted is True and row.collection_date == "2026-05-11"


def test_dropped_rows(spark):
    df = raw(spark, {}, {"trip_id": None})
    assert tuple(cleaning.dropped_rows(df).first()) == (2, 1, 1)
    assert cleaning.drop_incomplete(df).count() == 1


def predictions(spark, *probabilities):
    df = spark.createDataFrame([(p,) for p in probabilities], "predicted_actionable_probability double")
    return df


def test_ai_decisions_map_every_band(spark):
    rows = cleaning.assign_ai_decisions(predictions(spark, 0.1, 0.5, 0.7, 0.85)).collect()
    assert [r.ai_delay_risk for r in rows] == ["Low", "Medium", "High", "Severe"]
    assert rows[3].ai_recommended_action == "Deploy standby bus or supervisor review"
    assert rows[1].ai_confidence_band == "Moderate action probability"


@pytest.mark.parametrize("bad", [None, -0.1, 1.5])
def test_bad_probability_stops_the_job(spark, bad):
    with pytest.raises(Exception, match="predicted_actionable_probability"):
        cleaning.assign_ai_decisions(predictions(spark, bad)).collect()
    assert cleaning.assign_ai_decisions(predictions(spark, bad), strict=False).first().ai_delay_risk is None


def test_model_input_marks_missing_categories(spark, facts):
    df = facts({"route_display_name": None}, {"delay_risk": "High"}, {"delay_seconds": None})
    wide = df.withColumns({name: F.lit(None).cast("string") for name in schemas.MODEL_INPUT_COLUMNS if name not in df.columns})
    prepared = cleaning.model_input(wide).collect()
    assert len(prepared) == 2
    assert {r.route_display_name for r in prepared} == {"missing", "10 - Ten"}
    assert sorted(r.actionable_delay_risk for r in prepared) == [0, 1]


def test_prototype_features_and_leakage(spark):
    df = spark.createDataFrame([("2026-05-11", "07:30:00", "t")], "date string, time string, trip_id string")
    row = cleaning.add_prototype_time_features(df, ["time"]).first()
    assert (row.time_hour, row.day_of_month, row.month) == (7, 11, 5)
    assert cleaning.select_model_columns(df).columns == ["date", "time"]
    assert cleaning.numeric(spark.createDataFrame([("x",), ("1",)], "value string"), ["value", "absent"]).dtypes == [("value", "double")]


def test_averages_count_records_by_their_minutes(spark):
    df = raw(spark, {"delay_minutes": "10.0", "delay_seconds": None}, {"delay_minutes": "2.0", "delay_seconds": "120"},
             {"delay_minutes": "1.515", "delay_seconds": "90.9"})
    cleaned = cleaning.clean_observations(df)
    assert {r.delay_seconds for r in cleaned.collect()} == {None, 120.0, 90.9}
    flags = {"collection_day_status": F.lit("x"), "is_model_baseline_day": F.lit(True), "is_partial_day": F.lit(False)}
    day = summaries.daily_summary(cleaned.withColumns(flags)).first()
    assert day.records == 3 and round(day.avg_delay_minutes, 9) == 4.505
