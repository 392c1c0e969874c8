"""Hourly series: gap filling, splits by position and baseline forecasts.

Series rows number one per hour, so their size follows the calendar, not the
observations.  Carrying values along time still never needs one ordered pass
over a whole series: a window runs inside each calendar block, and one short
pass over the blocks hands the last value of a block to the next.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from delayloom.functions.measures import mean_minutes, observed_seconds, one_row
from delayloom.session import ensure_checkpoint_dir


def hourly_mean(df: DataFrame, by: Sequence[str] = (), time: str = "collection_time_utc") -> DataFrame:
    """Mean delay per hour (and series key)."""
    return df.groupBy(*by, F.date_trunc("hour", time).alias("hour")).agg(
        mean_minutes(observed_seconds(df)).alias("mean_delay")
    )


def hourly_grid(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every hour between the first and last hour of each series."""
    bounds = series.groupBy(*by).agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    return bounds.select(*by, F.explode(F.sequence("lo", "hi", F.expr("interval 1 hour"))).alias("hour"))


@dataclass(frozen=True)
class Carry:
    """A new column ``name``: the nearest earlier (or later) non-null ``value`` in time, this row included."""

    name: str
    value: Column
    forward: bool = True


def _carried(df: DataFrame, carries: Sequence[Carry], order: str, by: Sequence[str]) -> DataFrame:
    """Add every carried column in one pass: one window inside blocks, one hand-over between them.

    All values share the sort of a block, whichever direction they are carried in.  A block's edge state is one row with
    the first and last known value of each column, and one join hands the states of the other blocks in.
    """
    block = "_block"
    inside, across = W.partitionBy(*by, block).orderBy(order), W.partitionBy(*by).orderBy(block)
    earlier = (inside.rowsBetween(W.unboundedPreceding, W.currentRow), across.rowsBetween(W.unboundedPreceding, -1))
    later = (inside.rowsBetween(W.currentRow, W.unboundedFollowing), across.rowsBetween(1, W.unboundedFollowing))
    numbered = list(enumerate(carries))
    source = df.withColumn(block, F.date_trunc("month", order)).withColumns({f"_value{k}": c.value for k, c in numbered})

    def edge(k: int, carry: Carry) -> Column:
        pick = F.max_by if carry.forward else F.min_by
        return pick(f"_value{k}", F.when(F.col(f"_value{k}").isNotNull(), F.col(order)))

    def nearest(column: str, carry: Carry, place: int) -> Column:
        frame = (earlier if carry.forward else later)[place]
        return (F.last if carry.forward else F.first)(column, ignorenulls=True).over(frame)

    states = source.groupBy(*by, block).agg(*(edge(k, c).alias(f"_edge{k}") for k, c in numbered))
    handed = states.select(*by, block, *(nearest(f"_edge{k}", c, 1).alias(f"_handed{k}") for k, c in numbered))
    within = source.withColumns({f"_within{k}": nearest(f"_value{k}", c, 0) for k, c in numbered})
    joined = within.join(handed, [*by, block], "left")
    carried = {c.name: F.coalesce(f"_within{k}", f"_handed{k}") for k, c in numbered}
    kept = [name for name in df.columns if name not in carried]
    return joined.select(*kept, *(value.alias(name) for name, value in carried.items()))


def forward_fill(df: DataFrame, columns: Sequence[str], order: str = "weather_hour", by: Sequence[str] = ()) -> DataFrame:
    """Replace nulls by the last known earlier value of the column."""
    return _carried(df, [Carry(column, F.col(column)) for column in columns], order, by).select(*df.columns)


def interpolate_hourly(series: DataFrame, value: str = "mean_delay", by: Sequence[str] = ()) -> DataFrame:
    """Linear interpolation on the full hourly grid; ends take the nearest known value."""
    keys = [*by, "hour"]
    grid = hourly_grid(series, by).join(series.select(*keys, value), keys, "left")
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("hour").alias("at"), F.col(value).alias("v")))
    grid = _carried(grid, [Carry("_before", known), Carry("_after", known, forward=False)], "hour", by)
    at = F.unix_seconds("hour")
    lo, hi = F.unix_seconds("_before.at"), F.unix_seconds("_after.at")
    line = F.col("_before.v") + (F.col("_after.v") - F.col("_before.v")) * (at - lo) / F.nullif(hi - lo, F.lit(0))
    return grid.select(*keys, F.coalesce(F.col(value), line, F.col("_before.v"), F.col("_after.v")).alias(value))


def with_position(series: DataFrame) -> DataFrame:
    """Position of every hour of a gap-free grid, by arithmetic instead of a global sort."""
    bounds = one_row(series.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi")))
    start, end = bounds["lo"], bounds["hi"]
    hours = F.lit(3600)
    return series.withColumns(
        {
            "position": ((F.unix_seconds("hour") - F.unix_seconds(start)) / hours).cast("bigint"),
            "hours_total": ((F.unix_seconds(end) - F.unix_seconds(start)) / hours).cast("bigint") + 1,
        }
    )


def split_by_position(series: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Mark the first share of the hours as train, at least one."""
    placed = with_position(series)
    cut = F.greatest(F.lit(1), F.floor(F.col("hours_total") * F.lit(train_share)))
    return placed.withColumn("is_train", F.col("position") < cut)


MIN_HOURS = 30


def hourly_series(df: DataFrame) -> DataFrame:
    """Gap-free hourly mean delay, positioned and split.

    The forecasts read the series several times, so it is checkpointed: the
    observations are scanned once and only the small series is read again.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return split_by_position(interpolate_hourly(hourly_mean(df)).checkpoint())


def ar1_coefficients(split: DataFrame) -> DataFrame:
    """Slope and intercept of each training hour on the hour before it, with the last training value."""
    train = split.filter("is_train").select("position", F.col("mean_delay").alias("y"))
    before = train.select((F.col("position") + 1).alias("position"), F.col("y").alias("x"))
    fit = train.join(before, "position").agg(
        F.regr_slope("y", "x").alias("phi"), F.regr_intercept("y", "x").alias("intercept")
    )
    last = one_row(train.agg(F.max_by("y", "position").alias("v"), F.max("position").alias("p")))
    return fit.select("phi", "intercept", last["v"].alias("last_value"), last["p"].alias("last_position"))


def hourly_forecasts(split: DataFrame) -> DataFrame:
    """Test hours with three forecasts: AR(1) in closed form, last value, and hour-of-week mean."""
    fit = one_row(ar1_coefficients(split))
    week = [F.weekday("hour").alias("weekday"), F.hour("hour").alias("clock")]
    seasonal = split.filter("is_train").groupBy(*week).agg(F.avg("mean_delay").alias("seasonal_forecast"))
    test = split.filter(~F.col("is_train")).withColumns(
        {
            "weekday": F.weekday("hour"),
            "clock": F.hour("hour"),
            "phi": fit["phi"],
            "intercept": fit["intercept"],
            "last_value_forecast": fit["last_value"],
            "steps": F.col("position") - fit["last_position"],
        }
    )
    decay = F.pow("phi", "steps")
    closed = decay * F.col("last_value_forecast") + F.col("intercept") * F.when(
        F.col("phi") == 1, F.col("steps")
    ).otherwise((1 - decay) / (1 - F.col("phi")))
    return test.join(seasonal, ["weekday", "clock"], "left").select(
        "hour", "mean_delay", closed.alias("ar1_forecast"), "last_value_forecast",
        F.coalesce("seasonal_forecast", "last_value_forecast").alias("seasonal_forecast"),
    )
