"""Exact, order-independent aggregates and the two-step grouping they share.

Float sums change with the order in which partitions finish.  Means here are
taken over exact sums (six-decimal values as decimal), so a result does not depend on partitioning, retries or the cluster
size.

``two_step`` groups by the wanted keys *plus* one finer column, then by the
keys.  The first step is an ordinary hash aggregate with map-side combine, so
a hot key is reduced where it is read; the second step only sees one row per
(key, finer value).  It yields the modal value of the finer column, or the
number of its distinct values, next to plain measures, in one pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIX_DECIMALS = "decimal(18,6)"


def observed_seconds(df: DataFrame) -> Column:
    """Observed delay in seconds, as an exact six-decimal value taken from the minutes.

    A record counts by its minutes: the seconds of a feed may be absent or fractional.
    """
    if "delay_minutes" in df.columns:
        return F.round(F.col("delay_minutes") * 60, 6).try_cast(SIX_DECIMALS)
    return F.col("delay_seconds").try_cast(SIX_DECIMALS)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; zero denominators give null."""
    return numerator / F.nullif(denominator, F.lit(0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(ratio(part * F.lit(100.0), whole), digits)


def mean_minutes(seconds: Column) -> Column:
    return F.sum(seconds).cast("double") / F.nullif(F.count(seconds), F.lit(0)) / F.lit(60)


def mean_six_decimals(value: Column) -> Column:
    return F.sum(value.cast(SIX_DECIMALS)).cast("double") / F.nullif(F.count(value), F.lit(0))


@dataclass(frozen=True)
class Measure:
    """One output column: partial aggregates by suffix, and how to finish them."""

    name: str
    partials: Mapping[str, Column]
    finish: Callable[[Callable[[str], Column]], Column]

    def partial_columns(self) -> list[Column]:
        return [column.alias(f"{self.name}__{suffix}") for suffix, column in self.partials.items()]

    def final_column(self) -> Column:
        return self.finish(lambda suffix: F.col(f"{self.name}__{suffix}")).alias(self.name)


def rows(name: str = "records") -> Measure:
    return Measure(name, {"n": F.count(F.lit(1))}, lambda p: F.sum(p("n")))


def total(name: str, value: Column) -> Measure:
    return Measure(name, {"s": F.sum(value)}, lambda p: F.sum(p("s")))


def tally(name: str, condition: Column) -> Measure:
    return Measure(name, {"n": F.count_if(condition)}, lambda p: F.sum(p("n")))


def largest(name: str, value: Column, finish: Callable[[Column], Column] = lambda c: c) -> Measure:
    return Measure(name, {"m": F.max(value)}, lambda p: finish(F.max(p("m"))))


def smallest(name: str, value: Column, finish: Callable[[Column], Column] = lambda c: c) -> Measure:
    return Measure(name, {"m": F.min(value)}, lambda p: finish(F.min(p("m"))))


def largest_minutes(name: str, seconds: Column, digits: int) -> Measure:
    return largest(name, seconds, lambda m: F.round(m.cast("double") / F.lit(60), digits))


def average_minutes(name: str, seconds: Column, digits: int | None) -> Measure:
    def finish(p):
        mean = F.sum(p("s")).cast("double") / F.nullif(F.sum(p("n")), F.lit(0)) / F.lit(60)
        return mean if digits is None else F.round(mean, digits)

    return Measure(name, {"s": F.sum(seconds), "n": F.count(seconds)}, finish)


def average(name: str, value: Column, digits: int, scale: int = 1) -> Measure:
    """Mean of a six-decimal value, times ``scale``, rounded."""

    def finish(p):
        mean = F.sum(p("s")).cast("double") / F.nullif(F.sum(p("n")), F.lit(0))
        return F.round(mean if scale == 1 else mean * F.lit(scale), digits)

    return Measure(name, {"s": F.sum(value.cast(SIX_DECIMALS)), "n": F.count(value)}, finish)


def derived(name: str, parts: Sequence[Measure], finish: Callable[..., Column]) -> Measure:
    """A measure computed from the finished values of other measures."""
    partials = {f"{part.name}__{suffix}": column for part in parts for suffix, column in part.partials.items()}

    def combine(p):
        return finish(*(part.finish(lambda suffix, part=part: p(f"{part.name}__{suffix}")) for part in parts))

    return Measure(name, partials, combine)


def modal(value: Column, weight: Column) -> Column:
    """Most frequent non-null value; ties go to the smallest value."""
    return F.min_by(value, F.when(value.isNotNull() & (weight > 0), F.struct(-weight, value)))


def two_step(
    df: DataFrame,
    keys: Sequence[str],
    finer: Sequence[str],
    measures: Sequence[Measure],
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Group by ``keys + finer``, then by ``keys``; ``extra`` aggregates see the first step's rows.

    Each first-step row carries ``group_rows``, the number of input rows behind it.
    """
    partials = [column for measure in measures for column in measure.partial_columns()]
    first = df.groupBy(*keys, *finer).agg(F.count(F.lit(1)).alias("group_rows"), *partials)
    finals = [measure.final_column() for measure in measures]
    return first.groupBy(*keys).agg(*finals, *extra) if keys else first.agg(*finals, *extra)


def one_step(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    return two_step(df, keys, (), measures)


def with_share(
    grouped: DataFrame,
    name: str = "share_pct",
    digits: int = 2,
    count: str = "records",
    total: Column | None = None,
) -> DataFrame:
    """Add each row's share of the total as a percentage.

    The total is a scalar subquery over the already grouped rows (its exchange
    is reused), so no row has to move to a single task.
    """
    if total is None:
        total = grouped.agg(F.sum(count).alias("total")).scalar()
    return grouped.withColumn(name, percent(F.col(count), total, digits))


def one_row(df: DataFrame) -> Column:
    """A one-row table as a scalar struct column; its fields share one subquery, hence one scan."""
    return df.select(F.struct("*").alias("row")).scalar()


def rule_rows(spark: SparkSession, columns: Sequence[str], values: Sequence[Sequence]) -> DataFrame:
    """A small rule table as rows, planned inside the JVM (no Python data is shipped)."""
    structs = [F.struct(*(F.lit(v).alias(c) for c, v in zip(columns, row))) for row in values]
    return spark.range(1).select(F.inline(F.array(*structs)))
