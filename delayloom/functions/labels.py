"""Domain labels as Column expressions (no Python UDFs)."""

from __future__ import annotations

from itertools import chain
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayloom import rules
from delayloom.functions.parsing import blank_to_null, to_flag


def mapped(column: Column, table: Mapping) -> Column:
    """Look a value up in a small fixed rule table; a missing key gives null."""
    literals = [F.lit(item) for item in chain.from_iterable(table.items())]
    return F.try_element_at(F.create_map(*literals), column)


def _banded(column: Column, bounds: Iterable[tuple[str, float]], last: str, closed: bool) -> Column:
    first, *rest = bounds
    inside = (lambda bound: column <= bound) if closed else (lambda bound: column < bound)
    label = F.when(inside(first[1]), first[0])
    for name, bound in rest:
        label = label.when(inside(bound), name)
    return label.when(column.isNotNull(), last)


def rank_of(column: Column, order: Iterable[str]) -> Column:
    """Position of an ordered category, for sorting; unknown values go last."""
    order = tuple(order)
    return F.coalesce(mapped(column, {name: place for place, name in enumerate(order, 1)}), F.lit(len(order) + 1))


def delay_risk(minutes: Column, signed: bool = False) -> Column:
    """Observed risk from the absolute delay (``signed=True`` keeps the sign, as the prototype did)."""
    return _banded(minutes if signed else F.abs(minutes), rules.DELAY_RISK_UPPER_MINUTES, "Severe", closed=True)


def recommended_action(risk: Column, prototype: bool = False) -> Column:
    table = rules.PROTOTYPE_ACTION_BY_RISK if prototype else rules.ACTION_BY_RISK
    return F.coalesce(mapped(risk, table), F.lit(table["Severe"]))


def ai_delay_risk(probability: Column) -> Column:
    return _banded(probability, rules.AI_RISK_UPPER_PROBABILITY, "Severe", closed=False)


def timing_band(minutes: Column) -> Column:
    return (
        F.when(minutes < -rules.TIMING_TOLERANCE_MINUTES, rules.TIMING_ORDER[0])
        .when(minutes > rules.TIMING_TOLERANCE_MINUTES, rules.TIMING_ORDER[2])
        .otherwise(rules.TIMING_ORDER[1])
    )


def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0.0))


def rain_band(rain: Column) -> Column:
    return F.when(_or_zero(rain) == 0, rules.RAIN_ORDER[0]).otherwise(
        _banded(rain, rules.RAIN_UPPER_MM, rules.RAIN_ORDER[3], closed=True)
    )


def rain_detected(rain: Column) -> Column:
    return F.when(_or_zero(rain) > 0, rules.RAIN_DETECTED).otherwise(rules.NO_RAIN_DETECTED)


def weather_exposed(rain: Column, wind: Column) -> Column:
    return (_or_zero(rain) > 0) | (_or_zero(wind) >= rules.HIGH_WIND_KMH)


def weather_rule(precipitation: Column, rain: Column, wind: Column) -> Column:
    return (
        F.when((_or_zero(precipitation) > 0) | (_or_zero(rain) > 0), rules.RULE_RAIN)
        .when(_or_zero(wind) >= rules.HIGH_WIND_KMH, rules.RULE_WIND)
        .otherwise(rules.RULE_NONE)
    )


def weather_context(precipitation: Column, rain: Column, wind: Column) -> Column:
    rule = weather_rule(precipitation, rain, wind)
    return F.when(rule == rules.RULE_NONE, rules.NORMAL_WEATHER).otherwise(rules.ADVERSE_WEATHER)


def service_type(route_type: Column) -> Column:
    return F.coalesce(mapped(route_type, rules.SERVICE_TYPE_BY_ROUTE_TYPE), F.lit(rules.UNKNOWN_SERVICE))


def transport_mode(route_type: Column) -> Column:
    return F.coalesce(mapped(route_type, rules.TRANSPORT_MODE_BY_ROUTE_TYPE), F.lit("Other"))


def route_display_name(short_name: Column, long_name: Column, route_id: Column) -> Column:
    short, long, route = (F.trim(F.coalesce(c, F.lit(""))) for c in (short_name, long_name, route_id))
    return (
        F.when((short != "") & (long != "") & (short != long), F.concat_ws(" - ", short, long))
        .when(long != "", long)
        .when(short != "", short)
        .otherwise(route)
    )


def has_special_prefix(route_id: Column) -> Column:
    return F.startswith(F.upper(route_id), F.lit(rules.SPECIAL_PREFIX))


def special_flag(df: DataFrame, flag: str = "is_special_route") -> Column:
    """The stored flag in boolean form, whatever type the table keeps it in."""
    if flag not in df.columns:
        return F.lit(None).cast("boolean")
    return F.col(flag) if dict(df.dtypes)[flag] == "boolean" else to_flag(F.col(flag))


def is_special(df: DataFrame) -> Column:
    """Stored flag first, S-prefix of the route id where the flag is missing."""
    return F.coalesce(special_flag(df), has_special_prefix(F.col("route_id")))


def known_service(fallback: str) -> Column:
    return F.coalesce(blank_to_null(F.col("service_type")), F.lit(fallback))


def corridor_name() -> Column:
    """Corridor, else display name, else route id, without the leading route code."""
    return F.regexp_replace(corridor_or_route(), "^[A-Z0-9]+ - ", "")


def corridor_or_route() -> Column:
    return F.coalesce(
        blank_to_null(F.col("route_corridor_name")), blank_to_null(F.col("route_display_name")), F.col("route_id")
    )


def readable_corridor(name: Column) -> Column:
    """Text after the first `` - ``; the whole text when there is none."""
    return F.element_at(F.split(name, " - ", 2), -1)


def route_prefix(route_id: Column) -> Column:
    return F.coalesce(blank_to_null(F.regexp_extract(route_id, "^([A-Za-z]+)", 1)), F.lit("numeric_or_other"))


def ai_risk_or_unknown() -> Column:
    return F.coalesce(blank_to_null(F.col("ai_delay_risk")), F.lit(rules.UNKNOWN))


def ai_action_or_unavailable() -> Column:
    return F.coalesce(blank_to_null(F.col("ai_recommended_action")), F.lit(rules.UNAVAILABLE))


def short_action(action: Column) -> Column:
    return F.coalesce(mapped(action, rules.ACTION_SHORT_LABELS), action)


def action_chart_label(action: Column) -> Column:
    return F.coalesce(mapped(action, rules.ACTION_CHART_LABELS), action)


# --- model feature names ---------------------------------------------------

def feature_operator_category(feature: Column) -> Column:
    categories = tuple(rules.FEATURE_CATEGORY_TEXT)
    return (
        F.when(F.startswith(feature, F.lit("route_id_")), categories[0])
        .when(F.startswith(feature, F.lit("route_type_")), categories[1])
        .when(feature.isin(*rules.TIME_FEATURES), categories[2])
        .when(feature.isin(*rules.WEATHER_COLUMNS), categories[3])
        .otherwise(categories[4])
    )


def feature_operator_explanation(feature: Column) -> Column:
    return mapped(feature_operator_category(feature), rules.FEATURE_CATEGORY_TEXT)


def _mentions(text: Column, *terms: str) -> Column:
    found = F.contains(text, F.lit(terms[0]))
    for term in terms[1:]:
        found = found | F.contains(text, F.lit(term))
    return found


def feature_category(feature: Column) -> Column:
    text = F.lower(feature)
    return (
        F.when(_mentions(text, "route", "low-frequency"), "Route")
        .when(_mentions(text, "service", "train", "rail"), "Service")
        .when(_mentions(text, "hour", "weekday", "day", "month"), "Time")
        .when(_mentions(text, "rain", "wind", "temperature", "humidity", "weather", "precip"), "Weather")
        .when(_mentions(text, "direction"), "Direction")
        .otherwise("Other")
    )


def feature_chart_group(feature: Column) -> Column:
    """The narrower grouping behind the importance chart (direction before weather)."""
    text = F.lower(feature)
    return (
        F.when(_mentions(text, "route", "low-frequency"), "Route")
        .when(_mentions(text, "service"), "Service")
        .when(_mentions(text, "hour", "weekday", "day"), "Time")
        .when(_mentions(text, "direction"), "Direction")
        .when(_mentions(text, "rain", "wind", "weather", "precip"), "Weather")
        .otherwise("Other")
    )


def feature_text(feature: Column) -> Column:
    label = feature
    for old, new in rules.FEATURE_TEXT_REPLACEMENTS:
        label = F.replace(label, F.lit(old), F.lit(new))
    return F.trim(label)


def feature_display_label(feature: Column) -> Column:
    """Listed labels, ``Route <id>`` for a route's own feature, else the feature's name."""
    route = F.when(F.startswith(feature, F.lit("route_id_")), F.concat(F.lit("Route "), F.substring(feature, 10, 1 << 20)))
    return F.coalesce(mapped(feature, rules.FEATURE_DISPLAY_LABELS), route, feature)
