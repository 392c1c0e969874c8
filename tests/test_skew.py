"""One key holding most rows neither changes results nor ends in one task."""

import pytest
from pyspark.sql import functions as F

from delayloom.functions import lookups
from delayloom.operators import enrich, features, network, prediction, quality, routes
from delayloom.operators.filters import EVERYTHING


@pytest.fixture
def shuffled(spark):
    """Lookups too large to broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
             "spark.sql.adaptive.coalescePartitions.enabled")
    before = {name: spark.conf.get(name) for name in names}
    for name in names[:2]:
        spark.conf.set(name, "-1")
    spark.conf.set(names[2], "false")
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


def hot(spark, rows=4000):
    """Two thirds of the rows on one route, some without a route."""
    i = F.col("id")
    route = F.when(i % 3 != 0, "hot").when(i % 7 == 0, None).otherwise(F.concat(F.lit("r"), (i % 50).cast("string")))
    return spark.range(rows).select(route.alias("route_id"), F.concat(F.lit("t"), i.cast("string")).alias("trip_id"), i.alias("event_id"))


def metadata(spark):
    ids = ["hot", *(f"r{n}" for n in range(0, 50, 2))]
    return enrich.route_metadata(spark.createDataFrame([(r, "a", r, r.upper(), "3") for r in ids],
                                 "route_id string, agency_id string, route_short_name string, route_long_name string, route_type string"))


def test_salted_lookup_gives_the_plain_result(shuffled):
    facts, meta = hot(shuffled), metadata(shuffled)
    plain, spread = enrich.attach_routes(facts, meta), enrich.attach_routes(facts, meta, salts=8)
    assert spread.columns == plain.columns
    assert spread.count() == 4000 and spread.exceptAll(plain).count() == 0


def test_salted_lookup_spreads_the_hot_key(shuffled):
    joined = enrich.attach_routes(hot(shuffled), metadata(shuffled), salts=8)
    sizes = [r[1] for r in joined.filter("route_id = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.9 * sum(sizes)


def test_salted_scaling_gives_the_plain_result(shuffled):
    points = hot(shuffled).select(F.coalesce("route_id", F.lit("none")).alias("feature"), F.col("event_id").cast("double").alias("value"))
    plain, spread = features.min_max_normalise(points), features.min_max_normalise(points, salts=4)
    assert spread.count() == 4000 and spread.select(plain.columns).exceptAll(plain).count() == 0


def test_measured_lookups_are_broadcast_only_below_the_bound(spark):
    lookup = spark.range(10).withColumnRenamed("id", "k")
    facts = spark.range(100).select((F.col("id") % 10).alias("k"))
    small = facts.join(lookups.measured(lookup, max_rows=10), "k")._jdf.queryExecution().optimizedPlan().toString()
    large = facts.join(lookups.measured(lookup, max_rows=9), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in small and "strategy=broadcast" not in large


def test_hot_route_results_equal_brute_force(spark, facts):
    records = [{"route_id": "hot" if i % 3 else f"r{i % 5}", "delay_seconds": i % 601 - 100, "trip_id": f"t{i % 40}",
                "predicted_actionable_delay_risk": i % 2, "ai_recommended_action": "ab"[i % 2]} for i in range(900)]
    df = facts(*records)
    top = routes.top_routes(df, 1, EVERYTHING).first()
    mine = [r for r in records if r["route_id"] == "hot"]
    assert (top.route_id, top.records, top.actionable_records) == ("hot", len(mine), sum(r["predicted_actionable_delay_risk"] for r in mine))
    kpis = network.network_kpis(df, EVERYTHING).first()
    assert kpis.avg_delay_minutes == round(sum(r["delay_seconds"] for r in records) / 900 / 60, 3)
    assert prediction.route_timing_mix(df, "hot", EVERYTHING).agg(F.sum("records")).first()[0] == len(mine)
    copies = quality.duplicate_rows(df.select("route_id", "trip_id")).first()
    assert copies.duplicate_rows == 900 - len({(r["route_id"], r["trip_id"]) for r in records})
