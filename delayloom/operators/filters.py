"""Filters shared by the dashboard queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayloom import rules
from delayloom.functions.labels import has_special_prefix, special_flag
from delayloom.functions.parsing import hour_of_label


def _special_condition(df: DataFrame, wanted: bool) -> Column:
    """``is_special(df) == wanted`` in conjunctive form.

    The first conjunct only mentions the stored flag, so the scan can use it
    to skip row groups; the second settles the rows without a flag.
    """
    flag = special_flag(df)
    prefix = has_special_prefix(F.col("route_id"))
    return ((flag == wanted) | flag.isNull()) & (flag.isNotNull() | (prefix == wanted))


def _service_condition(name: str) -> Column:
    service = F.col("service_type")
    if name == rules.UNKNOWN_SERVICE:
        return service.isNull() | service.isin("", name)
    return service == name


@dataclass(frozen=True)
class DashboardFilter:
    """Service type, special services, day and hour, all optional.

    Choosing the special service label implies ``include_special``.
    """

    service_type: str = rules.ALL_SERVICES
    include_special: bool = False
    day: str = rules.ALL_DAYS
    hour: str = rules.ALL_HOURS

    def apply(self, df: DataFrame) -> DataFrame:
        if self.service_type == rules.SPECIAL_SERVICE:
            df = df.filter(_special_condition(df, True))
        else:
            if self.service_type != rules.ALL_SERVICES:
                df = df.filter(_service_condition(self.service_type))
            if not self.include_special:
                df = df.filter(_special_condition(df, False))
        if self.day != rules.ALL_DAYS:
            day = F.col("collection_date")
            text_day = day if dict(df.dtypes)["collection_date"] == "string" else F.date_format(day, "yyyy-MM-dd")
            df = df.filter(text_day == self.day)
        if self.hour != rules.ALL_HOURS:
            hour = F.col("trip_hour")
            number = hour.try_cast("int") if dict(df.dtypes)["trip_hour"] == "string" else hour
            df = df.filter(number == hour_of_label(self.hour))
        return df


EVERYTHING = DashboardFilter(include_special=True)
DEFAULT = DashboardFilter()


def global_filter(
    df: DataFrame,
    service_type: str = rules.ALL_SERVICES,
    include_special: bool = False,
    day: str = rules.ALL_DAYS,
    hour: str = rules.ALL_HOURS,
) -> DataFrame:
    return DashboardFilter(service_type, include_special, day, hour).apply(df)


def summary_filter(df: DataFrame, where: DashboardFilter = DEFAULT) -> DataFrame:
    """The same intent on the route-day summary: special if flagged *or* S-prefixed, no hour."""
    special = F.coalesce(special_flag(df), F.lit(False)) | F.coalesce(
        has_special_prefix(F.col("route_id")), F.lit(False)
    )
    if where.day != rules.ALL_DAYS:
        df = df.filter(F.col("collection_date") == where.day)
    if where.service_type == rules.SPECIAL_SERVICE:
        return df.filter(special)
    if not where.include_special:
        df = df.filter(~special)
    if where.service_type != rules.ALL_SERVICES:
        df = df.filter(F.coalesce(F.col("service_type"), F.lit(rules.UNKNOWN_SERVICE)) == where.service_type)
    return df


def baseline_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_model_baseline_day"))


def exclude_special(df: DataFrame, include: bool = False) -> DataFrame:
    """Drop rows whose stored flag says special; rows without a flag stay."""
    if include or "is_special_route" not in df.columns:
        return df
    return df.filter(~F.coalesce(special_flag(df), F.lit(False)))


def search_routes(routes: DataFrame, text: str) -> DataFrame:
    """Case-insensitive literal substring of route id or corridor; blank text keeps all."""
    if not text.strip():
        return routes
    needle = F.lit(text.lower())
    return routes.filter(
        F.contains(F.lower("route_id"), needle) | F.contains(F.lower("route_corridor_name"), needle)
    )


def intervention_candidates(df: DataFrame) -> DataFrame:
    return df.filter(F.col("recommended_action").isin(*rules.INTERVENTION_ACTIONS, rules.STANDBY_ACTION))
