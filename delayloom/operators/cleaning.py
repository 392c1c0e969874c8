"""From landed text rows to typed, labelled observations."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayloom import rules, schemas
from delayloom.functions import labels
from delayloom.functions.parsing import date_text, to_double, to_flag, to_long, to_utc_timestamp


class MissingColumnsError(ValueError):
    """Raised when an input lacks columns its contract requires."""


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Iterable[str], label: str) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise MissingColumnsError(f"Missing required {label} columns: {missing}")
    return df


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(name.strip().lower().replace(" ", "_") for name in df.columns))


def remove_header_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which any column repeats its own name."""
    repeats = [F.lower(F.trim(F.col(name).cast("string"))) == name for name in df.columns]
    return df.filter(~F.coalesce(reduce(lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)),
                                        repeats), F.lit(False)))


def clean_observations(df: DataFrame) -> DataFrame:
    """Type the raw daily rows; drop repeated headers, unparsable times and null delays.

    Ids stay null when they are missing (they never become text).
    """
    require_columns(df, schemas.RAW_COLUMNS, "observation")
    typed = df.filter(~F.col("collection_time_utc").cast("string").eqNullSafe(F.lit("collection_time_utc"))).withColumns(
        {
            "collection_time_utc": to_utc_timestamp(F.col("collection_time_utc")),
            "direction_id": to_long(F.col("direction_id")),
            "start_date": to_long(F.col("start_date")),
            "timestamp": to_long(F.col("timestamp")),
            "delay_seconds": to_double(F.col("delay_seconds")),
            "delay_minutes": to_double(F.col("delay_minutes")),
            "is_deleted": to_flag(F.col("is_deleted")),
            "route_id": F.col("route_id").cast("string"),
            "trip_id": F.col("trip_id").cast("string"),
        }
    )
    return typed.dropna(subset=["collection_time_utc", "delay_minutes"]).withColumn(
        "collection_date", date_text(F.col("collection_time_utc"))
    )


def normalize_realtime_types(df: DataFrame) -> DataFrame:
    """Type whichever of the known columns are present; derive the date if it is missing."""
    numbers = {"direction_id": to_long, "timestamp": to_long, "delay_seconds": to_double,
               "delay_minutes": to_double, "collection_coverage_hours": to_double}
    changes = {name: parse(F.col(name)) for name, parse in numbers.items() if name in df.columns}
    changes["collection_time_utc"] = to_utc_timestamp(F.col("collection_time_utc"))
    for name in ("is_deleted", "is_partial_day", "is_model_baseline_day", "is_special_route"):
        if name in df.columns:
            changes[name] = to_flag(F.col(name))
    typed = df.withColumns(changes)
    if "collection_date" in df.columns:
        return typed
    return typed.withColumn("collection_date", date_text(F.col("collection_time_utc")))


_PARSERS = {"boolean": to_flag, "bigint": to_long, "int": to_long, "double": to_double,
            "timestamp": to_utc_timestamp, "string": lambda c: c.cast("string")}


def normalize_decision_types(df: DataFrame) -> DataFrame:
    """Give every known decision column its published type, tolerantly; keep the others."""
    types = {field.name: field.dataType.simpleString() for field in schemas.DECISION.fields}
    return df.select(
        *(_PARSERS[types[name]](F.col(name)).alias(name) if name in types else F.col(name) for name in df.columns)
    )


REQUIRED_VALUES = ("collection_time_utc", "delay_minutes", "delay_seconds", "route_id", "trip_id")


def drop_incomplete(df: DataFrame, columns: Sequence[str] = REQUIRED_VALUES) -> DataFrame:
    return df.dropna(subset=list(columns))


def dropped_rows(df: DataFrame, columns: Sequence[str] = REQUIRED_VALUES) -> DataFrame:
    """One row: rows in, rows kept and rows dropped by ``drop_incomplete``."""
    complete = reduce(lambda a, b: a & b, (F.col(name).isNotNull() for name in columns))
    return df.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(complete).alias("kept_rows"),
        F.count_if(~complete).alias("dropped_rows"),
    )


def _reasonable(lo: float, hi: float):
    return F.col("delay_minutes").between(lo, hi)


def filter_outliers(
    df: DataFrame,
    lo: float = rules.MIN_REASONABLE_DELAY_MINUTES,
    hi: float = rules.MAX_REASONABLE_DELAY_MINUTES,
) -> DataFrame:
    return df.filter(_reasonable(lo, hi))


def outlier_report(
    df: DataFrame,
    lo: float = rules.MIN_REASONABLE_DELAY_MINUTES,
    hi: float = rules.MAX_REASONABLE_DELAY_MINUTES,
) -> DataFrame:
    kept = F.count_if(_reasonable(lo, hi))
    every = F.count(F.lit(1))
    return df.agg(
        every.alias("input_rows"),
        kept.alias("kept_rows"),
        (every - kept).alias("removed_rows"),
        F.round((every - kept) / F.nullif(every, F.lit(0)) * 100, 2).alias("removal_pct"),
    )


def add_time_features(df: DataFrame) -> DataFrame:
    """UTC hour, weekday (Monday = 0), day of month, date text and absolute delay."""
    when = F.col("collection_time_utc")
    return df.withColumns(
        {
            "trip_hour": F.hour(when),
            "weekday": F.weekday(when),
            "day_of_month": F.dayofmonth(when),
            "collection_date": date_text(when),
            "delay_abs_minutes": F.abs("delay_minutes"),
        }
    )


def add_prototype_time_features(df: DataFrame, clock_columns: Sequence[str], date_column: str = "date") -> DataFrame:
    """Hours of ``HH:MM:SS`` clock texts plus day of month and month of a date."""
    from delayloom.functions.parsing import clock_hour

    day = F.col(date_column).try_cast("date")
    hours = {f"{name}_hour": clock_hour(F.col(name)) for name in clock_columns}
    return df.withColumns({**hours, "day_of_month": F.dayofmonth(day), "month": F.month(day)})


def label_decisions(df: DataFrame, signed: bool = False) -> DataFrame:
    """Observed risk from the delay, and the action the rule table gives it."""
    risk = labels.delay_risk(F.col("delay_minutes"), signed)
    return df.withColumn("delay_risk", risk).withColumn(
        "recommended_action", labels.recommended_action(F.col("delay_risk"), prototype=signed)
    )


def decision_table(df: DataFrame) -> DataFrame:
    """The published decision columns, in order; optional ones may be absent."""
    types = {field.name: field.dataType for field in schemas.DECISION.fields}
    return df.select(*(F.col(name).cast(types[name]) for name in schemas.DECISION_COLUMNS if name in df.columns))


def actionable_target(df: DataFrame, name: str = "actionable_delay_risk") -> DataFrame:
    return df.withColumn(name, (F.col("delay_risk") != "Low").cast("int"))


def numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Coerce the listed columns that exist to doubles."""
    return df.withColumns({name: to_double(F.col(name)) for name in columns if name in df.columns})


def model_input(df: DataFrame) -> DataFrame:
    """Rows and types the models train on, with the binary target added."""
    require_columns(df, schemas.MODEL_INPUT_COLUMNS, "modeling")
    when = F.col("collection_time_utc")
    changes = {
        "collection_time_utc": when if dict(df.dtypes)["collection_time_utc"] == "timestamp" else to_utc_timestamp(when),
        "collection_date": date_text(F.col("collection_date").try_cast("date")),
    }
    for name in (*schemas.NUMERIC_FEATURES, "delay_minutes"):
        changes[name] = to_double(F.col(name))
    for name in (*schemas.CATEGORICAL_FEATURES, "route_short_name", "delay_risk", "recommended_action"):
        changes[name] = F.coalesce(F.col(name).cast("string"), F.lit("missing"))
    typed = df.withColumns(changes).dropna(
        subset=["collection_time_utc", "collection_date", "delay_minutes", "delay_risk"]
    )
    return actionable_target(typed)


LEAKAGE_COLUMNS = ("trip_id", "actual_departure_delay_min", "actual_arrival_delay_min")


def select_model_columns(df: DataFrame, drop: Sequence[str] = LEAKAGE_COLUMNS) -> DataFrame:
    return df.drop(*drop)


def prediction_frame(df: DataFrame) -> DataFrame:
    """Context columns that exist plus the four outputs, scores at six decimals."""
    context = [name for name in schemas.PREDICTION_CONTEXT if name in df.columns]
    keep_seconds = ["delay_seconds"] if "delay_seconds" in df.columns else []
    return df.select(
        *context,
        *keep_seconds,
        F.col("actionable_delay_risk").alias("actual_actionable_delay_risk"),
        F.col("predicted_actionable_delay_risk").cast("int"),
        F.round("predicted_actionable_probability", 6).alias("predicted_actionable_probability"),
        F.round("predicted_delay_minutes", 6).alias("predicted_delay_minutes"),
    )


def assign_ai_decisions(predictions: DataFrame, strict: bool = True) -> DataFrame:
    """Map predicted probability to risk band, action, confidence band and basis.

    With ``strict`` a null or out-of-range probability stops the job; without
    it such rows get null labels (see ``quality.probability_domain``).
    """
    name = "predicted_actionable_probability"
    valid = F.col(name).between(0, 1)
    # The check is a column of its own, so that each row is checked once and not in every band.
    if strict:
        message = F.lit(f"{name} must be between 0 and 1 and never null")
        checked = F.when(valid, F.col(name)).otherwise(F.raise_error(message).cast("double"))
        labelled = predictions.withColumn(name, checked).withColumn("ai_delay_risk", labels.ai_delay_risk(F.col(name)))
    else:
        labelled = predictions.withColumn("ai_delay_risk", F.when(valid, labels.ai_delay_risk(F.col(name))))
    risk = F.col("ai_delay_risk")
    return labelled.withColumns(
        {
            "ai_recommended_action": labels.mapped(risk, rules.ACTION_BY_RISK),
            "ai_confidence_band": labels.mapped(risk, rules.CONFIDENCE_BY_RISK),
            "ai_decision_basis": F.lit(rules.AI_DECISION_BASIS),
        }
    )
