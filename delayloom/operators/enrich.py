"""Joins with the static schedule, the completeness manifest and the weather.

Every lookup is made unique on its key by an aggregation.  Catalyst knows the
key is unique and removes the join from queries that use none of its columns.
Which of them may be broadcast is decided in ``functions.lookups``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from delayloom import rules, schemas
from delayloom.functions import labels
from delayloom.functions.lookups import calendar_bounded, left_lookup, unique_rows
from delayloom.functions.parsing import blank_to_null, local_wall_clock, to_double, to_long, to_utc_timestamp
from delayloom.operators.cleaning import require_columns

COMPLETENESS_COLUMNS = (
    "collection_day_status", "collection_coverage_hours", "is_partial_day", "is_model_baseline_day",
)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of every key in an explicit total order.

    The row_number filter becomes a group limit before the shuffle: each task
    passes on at most one row per key, however many rows the key has.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).filter(F.col("_place") == 1).drop("_place")


def attach_completeness(obs: DataFrame, manifest: DataFrame) -> DataFrame:
    days = calendar_bounded(unique_rows(manifest, ["collection_date"], COMPLETENESS_COLUMNS))
    return obs.join(days, "collection_date", "left")


def attach_file_stats(daily: DataFrame, stats: DataFrame) -> DataFrame:
    """Line counters per day, summed over the day's files; the first file name stands for all of them."""
    per_day = stats.groupBy("collection_date").agg(
        F.min("source_file").alias("source_file"),
        F.sum("raw_csv_rows").alias("raw_csv_rows"),
        F.sum("duplicate_header_rows").alias("duplicate_header_rows"),
        F.count(F.lit(1)).alias("daily_files"),
    )
    return daily.join(per_day, "collection_date", "left")


def route_metadata(routes: DataFrame) -> DataFrame:
    """Typed route metadata with service type and display name."""
    require_columns(routes, schemas.ROUTES.names, "route metadata")
    typed = routes.select(*schemas.ROUTES.names).withColumn("route_type", to_long(F.col("route_type")).cast("int"))
    return typed.select(
        *schemas.ROUTES.names,
        labels.service_type(F.col("route_type")).alias("service_type"),
        labels.route_display_name(F.col("route_short_name"), F.col("route_long_name"), F.col("route_id")).alias(
            "route_display_name"
        ),
    ).select(*schemas.ROUTE_METADATA_COLUMNS)


def attach_routes(obs: DataFrame, metadata: DataFrame, salts: int = 1) -> DataFrame:
    """Left join route metadata with fallbacks for unmatched routes, and flag special services."""
    others = [name for name in metadata.columns if name != "route_id"]
    joined = left_lookup(obs, metadata, "route_id", others, salts)
    return joined.withColumns(
        {
            "service_type": F.coalesce("service_type", F.lit(rules.UNKNOWN_SERVICE)),
            "route_display_name": F.coalesce("route_display_name", "route_id"),
            "is_special_route": F.coalesce(labels.has_special_prefix(F.col("route_id")), F.lit(False)),
        }
    )


def duplicate_keys(dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    return dimension.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def require_unique(dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The dimension itself; a repeated key is an error, shown with up to five examples."""
    offenders = duplicate_keys(dimension, keys).limit(5).collect()
    if offenders:
        raise ValueError(f"lookup keys are not unique: {[row.asDict() for row in offenders]}")
    return dimension


def attach_checked(facts: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Many-to-one left join; a repeated dimension key is an error, not a fan-out."""
    return facts.join(require_unique(dimension, keys), list(keys), "left")


def attach_weather(
    obs: DataFrame,
    weather: DataFrame,
    time: Column | None = None,
    columns: Sequence[str] = rules.WEATHER_COLUMNS,
) -> DataFrame:
    """Weather of the UTC hour of collection; null where the hour has no weather."""
    when = F.col("collection_time_utc") if time is None else time
    hourly = calendar_bounded(weather_by_hour(weather, columns))
    return obs.withColumn("weather_hour", F.date_trunc("hour", when)).join(hourly, "weather_hour", "left")


def attach_weather_local(
    obs: DataFrame, weather: DataFrame, zone: str = "Pacific/Auckland", columns: Sequence[str] = rules.WEATHER_COLUMNS
) -> DataFrame:
    """The prototype's key: local wall-clock hour of the feed's epoch timestamp."""
    return attach_weather(obs, weather, local_wall_clock(F.col("timestamp"), zone), columns)


def weather_by_hour(weather: DataFrame, columns: Sequence[str] = rules.WEATHER_COLUMNS) -> DataFrame:
    """One row per weather hour (the smallest row when an hour repeats)."""
    whole = weather.filter(F.col("weather_hour").isNotNull()).withColumn(
        "weather_hour", F.date_trunc("hour", "weather_hour")
    )
    return unique_rows(whole, ["weather_hour"], columns)


def weather_from_decision_table(decisions: DataFrame) -> DataFrame:
    """Recover hourly weather from an earlier decision table: its first record of every hour."""
    when = F.col("collection_time_utc")
    parsed = when if dict(decisions.dtypes)["collection_time_utc"] == "timestamp" else to_utc_timestamp(when)
    hourly = decisions.select(parsed.alias("at"), *(to_double(F.col(c)).alias(c) for c in rules.WEATHER_COLUMNS))
    hourly = hourly.filter(F.col("at").isNotNull()).withColumn("weather_hour", F.date_trunc("hour", "at"))
    return first_per_key(hourly, ["weather_hour"], ["at", *rules.WEATHER_COLUMNS]).select(
        "weather_hour", *rules.WEATHER_COLUMNS
    )


def corridor_labels(trips: DataFrame, routes: DataFrame, order: str = "trip_id") -> DataFrame:
    """A readable corridor per route: its first two distinct headsign endpoints.

    Headsigns are reduced to distinct endpoints where they are read, and the
    ranking passes on two rows per route, so no route's trips are gathered in
    one place.  ``order`` replaces the file order the labels depend on.
    """
    parts = F.split(F.replace(F.trim("trip_headsign"), F.lit(" to "), F.lit(" To ")), " To ", 2)
    # A route whose headsigns are all blank stays, with a null endpoint that ranks last.
    endpoints = (
        trips.filter(F.col("route_id").isNotNull())
        .select("route_id", F.col(order).alias("seen"), F.posexplode_outer(parts).alias("side", "endpoint"))
        .groupBy("route_id", blank_to_null(F.trim("endpoint")).alias("endpoint"))
        .agg(F.min(F.struct("seen", "side")).alias("seen"))
    )
    by_sight = W.partitionBy("route_id").orderBy(F.col("endpoint").isNull(), "seen", "endpoint")
    ranked = endpoints.withColumn("place", F.row_number().over(by_sight)).filter(F.col("place") <= 2)
    pairs = ranked.groupBy("route_id").agg(
        F.concat_ws(
            " / ",
            F.max(F.when(F.col("place") == 1, F.col("endpoint"))),
            F.max(F.when(F.col("place") == 2, F.col("endpoint"))),
        ).alias("corridor")
    )
    names = routes.groupBy("route_id").agg(F.min("route_short_name").alias("short"))
    label = F.coalesce("short", "route_id")
    corridor = F.coalesce(blank_to_null(F.col("corridor")), label)
    named = F.when(corridor != label, F.concat(label, F.lit(" - "), corridor)).otherwise(label)
    return pairs.join(names, "route_id", "left").select("route_id", named.alias("route_corridor_name"))


def corridor_lookup(routes: DataFrame, corridors: DataFrame) -> DataFrame:
    """Corridor for every route of the schedule; short name, then id, where trips give none."""
    named = unique_rows(routes, ["route_id"], ["route_short_name"]).join(corridors, "route_id", "left")
    return named.select(
        "route_id", F.coalesce("route_corridor_name", "route_short_name", "route_id").alias("route_corridor_name")
    )


def attach_corridors(facts: DataFrame, corridors: DataFrame, salts: int = 1) -> DataFrame:
    """Left join corridor names with the fallback chain display name, short name, id."""
    joined = left_lookup(facts, corridors, "route_id", ["route_corridor_name"], salts)
    return joined.withColumn(
        "route_corridor_name",
        F.coalesce("route_corridor_name", "route_display_name", "route_short_name", "route_id"),
    )


def route_corridor_lookup(route_summary: DataFrame) -> DataFrame:
    """First non-blank corridor of every route in a summary table (most records first)."""
    named = route_summary.filter(
        F.col("route_id").isNotNull() & (F.trim(F.coalesce("route_corridor_name", F.lit(""))) != "")
    )
    first = first_per_key(named, ["route_id"], [F.desc("records"), "route_corridor_name"])
    return first.select("route_id", F.col("route_corridor_name").alias("corridor_name"))


def trips_with_routes(trips: DataFrame, routes: DataFrame, salts: int = 1) -> DataFrame:
    others = [name for name in routes.columns if name != "route_id"]
    return left_lookup(trips, routes, "route_id", others, salts)


def realtime_with_routes(records: DataFrame, routes: DataFrame, salts: int = 1) -> DataFrame:
    """Snapshot rows with four route columns and the transport mode."""
    columns = routes.select(
        "route_id", "route_short_name", "route_long_name", to_long(F.col("route_type")).cast("int").alias("route_type")
    )
    others = [name for name in columns.columns if name != "route_id"]
    joined = left_lookup(records, columns, "route_id", others, salts)
    return joined.withColumn("transport_mode", labels.transport_mode(F.col("route_type")))


def semi_by_dates(df: DataFrame, dates: DataFrame) -> DataFrame:
    return df.join(calendar_bounded(dates.select("collection_date")), "collection_date", "left_semi")


def route_endpoints(trips: DataFrame, stop_times: DataFrame, stops: DataFrame, route_id: str | None = None) -> DataFrame:
    """First and last stop of the representative trip of every route and direction."""
    if route_id is not None:
        trips = trips.filter(F.col("route_id") == route_id)
    chosen = first_per_key(trips, ["route_id", "direction_id"], ["trip_id"]).select(
        "route_id", "direction_id", "trip_id", "trip_headsign"
    )
    # Joining the few chosen trips first keeps every other stop time out of the shuffle.
    ends = (
        stop_times.join(chosen, "trip_id")
        .groupBy("route_id", "direction_id", "trip_headsign", "trip_id")
        .agg(
            F.min(F.struct("stop_sequence", "stop_id")).alias("start"),
            F.max(F.struct("stop_sequence", "stop_id")).alias("end"),
        )
    )
    roles = F.create_map(F.lit("start"), F.col("start.stop_id"), F.lit("end"), F.col("end.stop_id"))
    sides = ends.select("route_id", "direction_id", "trip_headsign", F.explode(roles).alias("role", "stop_id"))
    places = stops.groupBy("stop_id").agg(F.min(F.struct("stop_name", "stop_lat", "stop_lon")).alias("stop"))
    return sides.join(places, "stop_id", "left").select(
        "route_id", "direction_id", "trip_headsign", "role", "stop_id", "stop.stop_name", "stop.stop_lat",
        "stop.stop_lon",
    )


def shape_usage(trips: DataFrame) -> DataFrame:
    return (
        trips.dropna(subset=["route_id", "shape_id"])
        .groupBy("route_id", "shape_id")
        .agg(F.count(F.lit(1)).alias("trip_count"))
    )


def most_used_shapes(trips: DataFrame) -> DataFrame:
    """The shape most trips of a route follow; ties go to the smaller shape id."""
    usage = shape_usage(trips)
    return usage.groupBy("route_id").agg(
        F.min_by("shape_id", F.struct(-F.col("trip_count"), F.col("shape_id"))).alias("shape_id"),
        F.max("trip_count").alias("trip_count"),
    )


def route_path_points(trips: DataFrame, shapes: DataFrame, route_id: str | None = None) -> DataFrame:
    """Points of every route's most used shape, one row each."""
    chosen = most_used_shapes(trips)
    if route_id is not None:
        chosen = chosen.filter(F.col("route_id") == route_id)
    return chosen.join(shapes, "shape_id").select(
        "route_id", "shape_id", "shape_pt_sequence", "shape_pt_lon", "shape_pt_lat"
    )


def route_path(trips: DataFrame, shapes: DataFrame, route_id: str | None = None) -> DataFrame:
    """One row per route: ordered path of [lon, lat] and the mean centre.

    The array holds one polyline, so its length is that of a shape and does
    not grow with the observations.
    """
    points = route_path_points(trips, shapes, route_id)
    ordered = F.sort_array(F.collect_list(F.struct("shape_pt_sequence", "shape_pt_lon", "shape_pt_lat")))
    return (
        points.groupBy("route_id", "shape_id")
        .agg(ordered.alias("points"), F.avg("shape_pt_lat").alias("latitude"), F.avg("shape_pt_lon").alias("longitude"))
        .select(
            "route_id",
            "shape_id",
            F.transform("points", lambda p: F.array(p["shape_pt_lon"], p["shape_pt_lat"])).alias("path"),
            "latitude",
            "longitude",
        )
    )


def busiest_routes(trips: DataFrame, limit: int = 10, by: str = "route_id") -> DataFrame:
    """Routes with the most scheduled trips."""
    counted = trips.dropna(subset=[by]).groupBy(by).agg(F.count(F.lit(1)).alias("trips"))
    return counted.orderBy(F.desc("trips"), by).limit(limit)


