"""Quantiles by brackets, fills in one pass, fingerprints, dictionaries, additive contributions, observed writes, upserts."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from delayloom.functions import lookups, quantiles
from delayloom.operators import enrich, explain, model_prep, models, quality, summaries, timeseries
from delayloom.sources import writers


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def by_sorting(values, p):
    kept = sorted(v for v in values if v is not None and math.isfinite(v))
    place = p * (len(kept) - 1)
    low, high = kept[math.floor(place)], kept[math.ceil(place)]
    return low + (high - low) * (place - math.floor(place))


@pytest.mark.parametrize("steps", [16_384])
def test_quantiles_equal_sorting(spark, steps):
    random.seed(steps)
    groups = {
        "even": [random.random() * 1e-3 for _ in range(500)], "wide": [random.choice([-1, 1]) * 10.0 ** random.uniform(-300, 300) for _ in range(60)],
        "ties": [5.0] * 300 + [7.25] * 2, "one": [-0.0], None: [float(k % 9) for k in range(100)],
        "odd": [float("nan"), float("inf"), -float("inf"), None, 1e308, -1e308, 3.0]}
    rows = [(name, v) for name, values in groups.items() for v in values] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    wanted = {"q": 0.25, "m": 0.5, "top": 0.99, "least": 0.0}
    found = {r.g: r for r in quantiles.exact_quantiles(df, "v", wanted, ["g"], steps).collect()}
    assert set(found) == set(groups)
    for name, values in groups.items():
        for column, p in wanted.items():
            assert found[name][column] == pytest.approx(by_sorting(values, p), rel=1e-12), (name, column)
    for name in ("even", "wide", "ties", "odd"):
        alone = quantiles.exact_quantiles(df.filter(F.col("g") == name), "v", wanted, (), 64).first()
        assert [alone[c] for c in wanted] == pytest.approx([by_sorting(groups[name], p) for p in wanted.values()], rel=1e-12)
    assert tuple(quantiles.exact_quantiles(df.limit(0), "v", wanted).first()) == (None,) * 4
    assert quantiles.exact_quantiles(df.limit(0), "v", wanted, ["g"]).count() == 0


def test_a_million_distinct_values(spark):
    df = spark.range(1_000_000).select((F.xxhash64("id") / 1e6).alias("v"), F.lit("x").alias("g"))
    got = quantiles.exact_quantiles(df, "v", {"q": 0.25, "m": 0.5}, ["g"]).first()
    want = df.agg(F.percentile("v", 0.25).alias("q"), F.percentile("v", 0.5).alias("m")).first()
    assert (got.q, got.m) == pytest.approx((want.q, want.m), rel=1e-12)


def test_fills_share_one_window_and_one_join(spark):
    hours = spark.range(2000).select((F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("weather_hour"), "id")
    columns = [f"c{k}" for k in range(5)]
    gaps = hours.select("weather_hour", *(F.when(F.col("id") % (7 + k) == k, F.col("id") + k).alias(c) for k, c in enumerate(columns)))
    filled = timeseries.forward_fill(gaps, columns)
    text = plan(filled)
    assert len(re.findall(r"^\W*Window ", text, re.M)) == 2 and text.count("Join") == 1  # rows inside blocks, edges across them
    last = dict.fromkeys(columns)
    for row, known in zip(filled.orderBy("weather_hour").collect(), gaps.orderBy("weather_hour").collect()):
        last |= {c: known[c] for c in columns if known[c] is not None}
        assert [row[c] for c in columns] == list(last.values())


def test_distinct_counts_read_once(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a"), (None, "b")], "x int, y string")
    out = quality.distinct_counts(df, {"xs": "x", "ys": "y"})
    assert tuple(out.first()) == (2, 2) and plan(out).count("LogicalRDD") + plan(out).count("LocalRelation") == 1


def test_duplicates_survive_colliding_fingerprints(spark):
    rows = [(k % 40, None if k % 3 else "x") for k in range(200)] + [(None, "x"), (None, "x"), (None, None)]
    df = spark.createDataFrame(rows, "a int, b string")
    wanted = (len(rows), len(rows) - len(set(rows)))
    assert tuple(quality.duplicate_rows(df).first()) == wanted
    everything_collides = lambda frame: [F.lit(1).alias("_print_1")]
    assert tuple(quality.duplicate_rows(df, everything_collides).first()) == wanted
    assert tuple(quality.duplicate_rows(df.limit(0)).first()) == (0, 0)


@pytest.fixture(scope="module")
def trained(spark):
    i = F.col("id")
    rows = spark.range(900).select(
        i, F.concat(F.lit("r"), (i % 5).cast("string")).alias("route_id"), F.concat(F.lit("d"), (i % 90).cast("string")).alias("direction_id"),
        (i % 24).cast("double").alias("trip_hour"), F.when(i % 11 != 0, i % 7).cast("double").alias("rain"))
    late = (F.col("trip_hour") > 15) | (F.col("route_id") == "r3") | (F.coalesce("rain", F.lit(0.0)) == 6)
    rows = rows.withColumns({"delay_minutes": F.when(late, 20.0).otherwise(1.0), "actionable_delay_risk": late.cast("int")})
    columns, numbers = ["route_id", "direction_id"], ["trip_hour", "rain"]
    encoding = model_prep.fit_encoding(rows, columns, numbers)
    settings = models.TreeSettings(trees=4, depth=3, row_share=1.0, column_share=1.0)
    return rows, encoding, models.train_classifier(rows, settings, encoding), models.train_regressor(rows, settings, encoding)


def test_scoring_joins_nothing_and_encodes_once(trained):
    rows, encoding, classifier, regressor = trained
    assert encoding.rare["direction_id"] and not encoding.frequent["direction_id"]
    scored = models.score(classifier, regressor, rows)
    assert "Join" not in plan(scored)
    separate = models.score_delay(regressor, models.score_class(classifier, rows))
    columns = ["id", "predicted_actionable_delay_risk", "predicted_actionable_probability", "predicted_delay_minutes"]
    assert scored.select(columns).exceptAll(separate.select(columns)).count() == 0
    assert classifier.encoding.feature_names() == ["trip_hour", "rain", *(f"route_id_r{k}" for k in range(5)), "direction_id_infrequent_sklearn"]


def test_joined_vocabulary_gives_the_same_buckets(trained):
    rows, encoding, _, _ = trained
    joined = model_prep.fit_encoding(rows, encoding.columns, encoding.numbers, max_dictionary_bytes=10)
    assert joined.joined == ("direction_id",) and not joined.rare["direction_id"]
    assert joined.feature_names() == encoding.feature_names()
    unseen = rows.unionByName(rows.limit(3).withColumns({"direction_id": F.lit("new"), "route_id": F.lit(None).cast("string")}))
    assert joined.encode(unseen).select("id", "features").exceptAll(encoding.encode(unseen).select("id", "features")).count() == 0


def test_contributions_add_up(spark, trained):
    rows, _, classifier, _ = trained
    features = ["route_id", "direction_id", "trip_hour", "rain"]
    found = explain.contributions(classifier, explain.explained_rows(rows), features).checkpoint()
    assert tuple(explain.additivity(found).first()) == (900, 0)
    own = models.score_class(classifier, rows)
    same = found.groupBy("row_id").agg(F.any_value("probability").alias("p"))
    assert same.agg(F.sum("p")).first()[0] == pytest.approx(own.agg(F.sum("predicted_actionable_probability")).first()[0])
    some = explain.contributions(classifier, explain.explained_rows(rows), features[1:]).checkpoint()
    assert tuple(explain.additivity(some).first()) == (900, 0)


def test_contributions_equal_all_orders_of_two_features(spark, trained):
    rows, encoding, classifier, _ = trained
    features = ["route_id", "trip_hour"]
    sample = explain.explained_rows(rows.limit(40)).checkpoint()
    found = {(r.row_id, r.feature): r.shap_value for r in explain.contributions(classifier, sample, features).collect()}
    typical = {"route_id": F.lit(encoding.modes["route_id"]), "trip_hour": F.lit(encoding.medians["trip_hour"])}

    def scores(*own):
        changed = sample.withColumns({f: typical[f] for f in features if f not in own})
        return {r.row_id: r.predicted_actionable_probability for r in models.score_class(classifier, changed).collect()}

    none, first, second, both = scores(), scores("route_id"), scores("trip_hour"), scores(*features)
    for k in none:  # an order and its reverse are all orders of two features: the exact Shapley value
        assert found[k, "route_id"] == pytest.approx((first[k] - none[k] + both[k] - second[k]) / 2, abs=1e-12)
        assert found[k, "trip_hour"] == pytest.approx((second[k] - none[k] + both[k] - first[k]) / 2, abs=1e-12)


def test_written_rows_are_counted_while_written(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("collection_date"), "id")
    seen = writers.write_daily_table(df, str(tmp_path / "t"), figures={"rows": F.count(F.lit(1)), "most": F.max("id")})
    assert seen == {"rows": 1000, "most": 999}
    assert writers.write_table(df.limit(0), str(tmp_path / "e")) == {"rows": 0}


def test_counters_count_files(spark):
    obs = spark.createDataFrame([("d", True, 1.0)] * 3, "collection_date string, is_model_baseline_day boolean, delay_minutes double")
    manifest = spark.createDataFrame([("d", 4, 1, True, False)], "collection_date string, raw_csv_rows long, duplicate_header_rows long, is_model_baseline_day boolean, is_partial_day boolean")
    files = spark.createDataFrame([("d", "a.csv"), ("d", "b.csv")], "collection_date string, source_file string")
    row = summaries.storage_counters(obs, manifest, files).first()
    assert (row.daily_files, row.cleaned_rows, row.complete_days) == (2, 3, 1)


@pytest.fixture
def unbroadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


def test_only_heavy_keys_are_copied(unbroadcast):
    i = F.col("id")
    facts = unbroadcast.range(9000).select(F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), (i % 500).cast("string"))).alias("route_id"), i.alias("event_id"))
    lookup = unbroadcast.range(600).select(F.when(i == 0, "hot").otherwise(F.concat(F.lit("r"), i.cast("string"))).alias("route_id"), i.alias("x"))
    assert lookups.heavy_keys(facts, "route_id") == ["hot"]
    assert lookups.spread_lookup(lookup, "route_id", ["hot"], 8).count() == 599 + 8
    joined = lookups.left_lookup(facts, lookup, "route_id", ["x"], salts=8)
    plain = facts.join(lookup, "route_id", "left")
    assert "broadcast" not in plan(joined) and joined.columns == plain.columns
    assert joined.exceptAll(plain).count() == 0 and joined.count() == 9000


def test_unused_lookup_is_not_joined(spark):
    facts = spark.range(100).select(F.col("id").cast("string").alias("route_id"))
    lookup = spark.range(50).select(F.col("id").cast("string").alias("route_id"), F.lit("n").alias("name"))
    joined = lookups.left_lookup(facts, lookup, "route_id", ["name"])
    assert "Join" in plan(joined) and "Join" not in plan(joined.groupBy("route_id").count())


def test_checked_lookup_is_part_of_enrichment(spark):
    facts = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(ValueError, match="not unique"):
        enrich.attach_checked(facts, spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), ["k"])
