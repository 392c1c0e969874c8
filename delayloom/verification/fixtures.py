"""Domain tables derived from the driver's star-schema tables.

Every driver row takes part: each event is one observation, each customer a
scheduled route, each order a scheduled trip and each line item a shape point.
Special services (S-prefixed ids) are not in the schedule, as in the field.
``oracle_sql`` holds the same derivations in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delayloom import rules, schemas
from delayloom.functions.parsing import date_text
from delayloom.functions import labels
from delayloom.operators import cleaning, enrich, summaries
from delayloom.session import apply_session_defaults

# Days on which collection was interrupted; every other day counts as complete.
PARTIAL_DAY_NOTES = {
    "2024-01-01": "startup partial",
    "2024-01-12": "interrupted partial",
    "2024-01-30": "current/incomplete at audit time",
}
COMPLETE_DAYS = tuple(
    day for day in (f"2024-01-{number:02d}" for number in range(1, 31)) if day not in PARTIAL_DAY_NOTES
)

# Customers grow with the events, so their lookups may be too large to broadcast.
SALTS = 8

FOCUS_ROUTE = "7-202"
FOCUS_BUS_ROUTE = "9-204"


def _text(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(part) if isinstance(part, str) else part.cast("string") for part in parts))


def _scheduled_id(key: str) -> Column:
    return _text(F.col(key), "-20", F.col(key) % 5)


def observations_of(events: DataFrame) -> DataFrame:
    user, event = F.col("user_id"), F.col("event_id")
    when = F.col("ts").cast("timestamp")
    seconds = (F.round(F.col("value") * 100).cast("bigint") * 7) % 3600 - 1200 + F.when(
        event % 97 == 0, F.lit(9000)
    ).otherwise(F.lit(0))
    exact = seconds.cast("double") + F.when(event % 89 == 0, F.lit(0.5)).otherwise(F.lit(0.0))
    return events.select(
        when.alias("collection_time_utc"),
        _text("E", event).alias("entity_id"),
        _text("T", user, "-", event % 40).alias("trip_id"),
        F.when(user % 11 == 0, _text("S", user)).otherwise(_scheduled_id("user_id")).alias("route_id"),
        (event % 2).alias("direction_id"),
        F.date_format(when, "HH:00:00").alias("start_time"),
        F.date_format(when, "yyyyMMdd").cast("bigint").alias("start_date"),
        F.unix_seconds(when).alias("timestamp"),
        # The feed leaves some seconds out and reports others in fractions; the minutes are always there.
        F.when(event % 83 != 0, exact).alias("delay_seconds"),
        (exact / 60).alias("delay_minutes"),
        (event % 100 == 0).alias("is_deleted"),
        date_text(when).alias("collection_date"),
        _text("gtfs_realtime_", date_text(when), ".csv").alias("source_file"),
        event.alias("event_id"),
        user.alias("user_id"),
    )


@dataclass(frozen=True)
class DriverTables:
    """Lazy domain tables over one driver folder."""

    spark: SparkSession
    folder: str
    trained: dict = field(default_factory=dict, compare=False)

    def table(self, name: str) -> DataFrame:
        apply_session_defaults(self.spark)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def observations(self) -> DataFrame:
        """Cleaned observations before enrichment."""
        return observations_of(self.table("events"))

    @cached_property
    def observation_stream(self) -> DataFrame:
        """The same observations as a file stream."""
        apply_session_defaults(self.spark)
        events = self.spark.readStream.schema(self.table("events").schema).option("pathGlobFilter", "events.parquet")
        return observations_of(events.parquet(self.folder))

    @cached_property
    def raw_text(self) -> DataFrame:
        """Observations as landed text, with header rows, bad times and bad delays among them."""
        obs, event = self.observations, F.col("event_id")
        time_text = F.date_format("collection_time_utc", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        raw = obs.select(
            "event_id",
            F.when(event % 251 == 0, "collection_time_utc").when(event % 113 == 0, "not a time").otherwise(
                time_text
            ).alias("collection_time_utc"),
            *(F.col(name).cast("string").alias(name) for name in schemas.RAW_COLUMNS
              if name not in ("collection_time_utc", "delay_minutes")),
            F.when(event % 127 == 0, "late").when(event % 131 == 0, F.lit(None)).otherwise(
                F.col("delay_minutes").cast("string")
            ).alias("delay_minutes"),
        )
        return raw.select(*schemas.RAW_COLUMNS, "event_id")

    @cached_property
    def file_stats(self) -> DataFrame:
        """Per-file counters: lines are the observations, repeated headers the deleted ones."""
        return self.observations.groupBy("collection_date", "source_file").agg(
            F.count(F.lit(1)).alias("raw_csv_rows"),
            F.count_if("is_deleted").alias("duplicate_header_rows"),
        )

    @cached_property
    def manifest(self) -> DataFrame:
        return summaries.completeness_manifest(
            self.observations, self.file_stats, COMPLETE_DAYS, PARTIAL_DAY_NOTES
        )

    @cached_property
    def routes(self) -> DataFrame:
        return self.table("customer").select(
            _scheduled_id("c_custkey").alias("route_id"),
            _text("AG", F.col("c_nationkey")).alias("agency_id"),
            F.col("c_custkey").cast("string").alias("route_short_name"),
            F.col("c_name").alias("route_long_name"),
            (2 + F.col("c_nationkey") % 4).cast("string").alias("route_type"),
        )

    @cached_property
    def route_metadata(self) -> DataFrame:
        return enrich.route_metadata(self.routes)

    @cached_property
    def trips(self) -> DataFrame:
        order = F.col("o_orderkey")
        sign = (
            F.when(F.startswith("o_orderpriority", F.lit("4")), "  ")
            .when(F.col("o_orderstatus") == "F", F.concat_ws(" to ", "o_orderpriority", "o_orderstatus"))
            .when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
            .otherwise(F.concat_ws(" To ", "o_orderpriority", "o_orderstatus"))
        )
        return self.table("orders").select(
            _scheduled_id("o_custkey").alias("route_id"),
            _text("O", order).alias("trip_id"),
            (order % 2).cast("string").alias("direction_id"),
            sign.alias("trip_headsign"),
            _text("SH", F.floor(order / 4)).alias("shape_id"),
        )

    @cached_property
    def shapes(self) -> DataFrame:
        order = F.col("l_orderkey")
        return self.table("lineitem").select(
            _text("SH", F.floor(order / 4)).alias("shape_id"),
            (F.col("l_suppkey") / 8).alias("shape_pt_lat"),
            (F.col("l_partkey") / 8).alias("shape_pt_lon"),
            ((order % 4) * 100 + F.col("l_linenumber")).cast("int").alias("shape_pt_sequence"),
        )

    @cached_property
    def stop_times(self) -> DataFrame:
        return self.table("lineitem").select(
            _text("O", F.col("l_orderkey")).alias("trip_id"),
            _text("ST", F.col("l_suppkey")).alias("stop_id"),
            F.col("l_linenumber").alias("stop_sequence"),
        )

    @cached_property
    def stops(self) -> DataFrame:
        return self.table("supplier").select(
            _text("ST", F.col("s_suppkey")).alias("stop_id"),
            F.col("s_name").alias("stop_name"),
            (F.col("s_nationkey") / 4).alias("stop_lat"),
            F.col("s_acctbal").alias("stop_lon"),
        )

    @cached_property
    def weather(self) -> DataFrame:
        """Hourly weather; hours in which the sensor feed (error events) is silent have none."""
        k = F.get_json_object("props", "$.k").cast("int")
        feed = self.table("events").filter(F.col("event_type") == "error")
        hourly = feed.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("weather_hour")).agg(
            F.max(k).alias("hi"), F.min(k).alias("lo")
        )
        return hourly.select(
            "weather_hour",
            (F.col("lo") / 4).alias("temperature_2m"),
            (F.greatest(F.col("hi") - 60, F.lit(0)) / 20).alias("precipitation"),
            (F.greatest(F.col("hi") - 70, F.lit(0)) / 10).alias("rain"),
            (50 + F.col("hi") / 4).alias("relative_humidity_2m"),
            (F.col("hi") / 2).alias("wind_speed_10m"),
        )

    @cached_property
    def enriched(self) -> DataFrame:
        """Observations with completeness flags and route metadata."""
        flagged = enrich.attach_completeness(self.observations, self.manifest)
        return enrich.attach_routes(flagged, self.route_metadata, SALTS)

    @cached_property
    def storage(self) -> DataFrame:
        return self.enriched.select(*schemas.CLEAN_COLUMNS)

    @cached_property
    def corridors(self) -> DataFrame:
        return enrich.corridor_labels(self.trips, self.routes)

    @cached_property
    def integrated(self) -> DataFrame:
        """Labelled observations that still carry their entity id."""
        timed = cleaning.add_time_features(cleaning.filter_outliers(self.enriched))
        named = enrich.attach_corridors(timed, enrich.corridor_lookup(self.routes, self.corridors), SALTS)
        return cleaning.label_decisions(enrich.attach_weather(named, self.weather))

    @cached_property
    def decisions(self) -> DataFrame:
        return cleaning.decision_table(self.integrated)

    @cached_property
    def predictions(self) -> DataFrame:
        """A deterministic stand-in for model scores, so that results can be compared exactly."""
        probability = ((F.col("event_id") * 37 + F.col("user_id") * 13) % 1001) / 1000
        scored = cleaning.actionable_target(self.integrated).withColumns(
            {
                "predicted_actionable_probability": probability,
                "predicted_actionable_delay_risk": (probability >= 0.5).cast("int"),
                "predicted_delay_minutes": F.col("delay_minutes") / 2,
            }
        )
        return cleaning.prediction_frame(scored)

    @cached_property
    def ai(self) -> DataFrame:
        return cleaning.assign_ai_decisions(self.predictions)

    @cached_property
    def route_daily(self) -> DataFrame:
        return summaries.route_daily_summary(self.storage)

    @cached_property
    def importance(self) -> DataFrame:
        """A long importance table over part names and sizes standing in for encoded features."""
        name = F.col("p_name")
        feature = (
            F.when(F.col("p_size") % 7 == 0, _text("route_id_", F.col("p_partkey")))
            .when(F.col("p_size") % 7 == 1, _text("route_type_", F.col("p_size") % 4))
            .when(F.col("p_size") % 7 == 2, F.element_at(F.array(*map(F.lit, schemas.NUMERIC_FEATURES)),
                                                        (F.col("p_partkey") % 8 + 1).cast("int")))
            .when(F.col("p_size") % 7 == 3, _text("direction_id_", F.col("p_size") % 2))
            .when(F.col("p_size") % 7 == 4, F.lit("service_type_Train / Rail"))
            .otherwise(name)
        )
        return self.table("part").select(
            F.when(F.col("p_partkey") % 2 == 0, "GBT classifier").otherwise("GBT regressor").alias("source"),
            F.when(F.col("p_size") % 2 == 0, "mean_abs_shap").otherwise("feature_importance").alias(
                "explainability_type"
            ),
            feature.alias("feature"),
            F.round(F.col("p_retailprice") / 1000, 6).alias("importance"),
            F.col("p_brand").alias("notes"),
        )


def scenario_trips(d: DriverTables) -> DataFrame:
    """Line items as completed scenario trips, one scenario per return flag."""
    flag = F.col("l_returnflag")
    name = labels.mapped(flag, {"A": rules.SCENARIO_BASELINE, "N": rules.SCENARIO_DISRUPTION,
                                "R": rules.SCENARIO_INTERVENTION})
    loss = F.col("l_linenumber") * F.when(flag == "N", 9).when(flag == "R", 5).otherwise(2)
    return d.table("lineitem").select(
        name.alias("scenario_name"),
        (F.col("l_quantity") * 10 + loss).alias("duration_sec"),
        loss.cast("double").alias("time_loss_sec"),
        (F.col("l_suppkey") % 30).cast("double").alias("waiting_time_sec"),
    )


def scenario_steps(d: DriverTables) -> DataFrame:
    """Orders as scenario steps, one scenario per order status."""
    key = F.col("o_orderkey")
    name = labels.mapped(F.col("o_orderstatus"), {"O": rules.SCENARIO_BASELINE, "F": rules.SCENARIO_DISRUPTION,
                                                  "P": rules.SCENARIO_INTERVENTION})
    return d.table("orders").select(
        name.alias("scenario_name"),
        key.cast("double").alias("time_sec"),
        (key * 3).alias("loaded"),
        (key * 2).alias("inserted"),
        key.alias("ended"),
        key.alias("arrived"),
        (key % 17).alias("halting"),
        (key % 100 / 4).alias("mean_travel_time_sec"),
        (key % 60 / 4).alias("mean_speed"),
    )


_OPEN: dict[tuple[str, str], DriverTables] = {}


def driver_tables(spark: SparkSession, folder: str) -> DriverTables:
    """The tables of a folder; their plans (no data) are shared by all queries of a session."""
    key = (f"{spark.sparkContext.applicationId}/{id(spark)}", folder)
    if key not in _OPEN:
        _OPEN[key] = DriverTables(spark, folder)
    return _OPEN[key]
