"""Data-quality checks as queries."""

from __future__ import annotations

from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayloom import rules, schemas
from delayloom.functions import labels
from delayloom.functions.lookups import measured
from delayloom.functions.measures import one_row, percent, rule_rows
from delayloom.functions.quantiles import exact_quantiles, stored_column


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count per column, as (column_name, null_count) rows, from one scan."""
    names = list(columns or df.columns)
    one = df.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in names))
    pairs = [F.struct(F.lit(name).alias("column_name"), F.col(name).alias("null_count")) for name in names]
    return one.select(F.inline(F.array(*pairs)))


QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def describe(df: DataFrame, value: str, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum of the finite values."""
    v = F.col(value)
    known = stored_column(df.filter(v.isNotNull()), [*by, value])
    grouped = (known.groupBy(*by) if by else known).agg(
        F.count(v).alias("count"),
        F.avg(v).alias("mean"),
        F.min(v).cast("double").alias("min"),
        F.max(v).cast("double").alias("max"),
        F.sum(v * v).alias("_squares"),
    )
    variance = (F.col("_squares") - F.col("count") * F.col("mean") * F.col("mean")) / F.nullif(
        F.col("count") - 1, F.lit(0)
    )
    quartiles = exact_quantiles(known, value, QUARTILES, by)
    renamed = quartiles.select(*(F.col(name).alias(f"_of_{name}") for name in by), *QUARTILES)
    if by:
        joined = grouped.join(renamed, [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in by], "left")
    else:
        row = one_row(renamed)
        joined = grouped.select("*", *(row[name].alias(name) for name in QUARTILES))
    rounded = [F.round(name, digits).alias(name) for name in ("mean", "min", "q25", "median", "q75", "max")]
    return joined.select(
        *by, "count", rounded[0], F.round(F.sqrt(F.greatest(variance, F.lit(0.0))), digits).alias("std"), *rounded[1:]
    )


def median_by(df: DataFrame, value: str, by: str, name: str = "median_delay", digits: int = 6) -> DataFrame:
    return exact_quantiles(stored_column(df, [by, value]), value, {name: 0.5}, [by]).select(by, F.round(name, digits).alias(name))


def mean_by(seconds: Column, df: DataFrame, by: str, name: str = "mean_delay", digits: int = 6) -> DataFrame:
    return df.groupBy(by).agg(F.round(F.sum(seconds) / F.count(seconds) / 60, digits).alias(name))


def box_stats(df: DataFrame, value: str, by: str, digits: int = 6) -> DataFrame:
    """Exact quartiles per group, as a box plot shows them."""
    full = describe(df, value, [by], digits)
    return full.select(by, "count", "min", "q25", "median", "q75", "max")


def late_ratio(df: DataFrame, by: str, digits: int = 6) -> DataFrame:
    """Share of records behind schedule; records without a delay count as not late."""
    late = F.count_if(F.col("delay_minutes") > 0)
    return df.groupBy(by).agg(F.round(late / F.count(F.lit(1)), digits).alias("late_ratio"))


def row_fingerprint(df: DataFrame) -> list[Column]:
    """128 bits of a row as two columns; which columns are null counts."""
    nulls = F.concat(*(F.isnull(name).cast("int").cast("string") for name in df.columns))
    return [F.xxhash64(F.lit(seed), nulls, *df.columns).alias(f"_print_{seed}") for seed in (1, 2)]


def duplicate_rows(df: DataFrame, fingerprint: Callable[[DataFrame], list[Column]] = row_fingerprint) -> DataFrame:
    """Rows that repeat an earlier row in every column (nulls compare equal).

    What moves is a fingerprint of each row, counted where it is read.  Only rows that share one are compared as a whole,
    so rows that merely have the same fingerprint do not count.
    """
    # the columns keep their names: renamed copies beside the fingerprints would multiply the optimizer's constraints
    marked = df.select("*", *fingerprint(df))
    prints = marked.columns[len(df.columns):]
    groups = marked.groupBy(*prints).agg(F.count(F.lit(1)).alias("rows"))
    shared = measured(groups.filter("rows > 1").select(*prints))
    copies = marked.join(shared, prints, "left_semi").groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    repeated = copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n")).scalar()
    return df.agg(F.count(F.lit(1)).alias("total_rows"), repeated.alias("duplicate_rows"))


def distinct_counts(df: DataFrame, columns: Mapping[str, str], approximate: bool = False) -> DataFrame:
    """Distinct values of several columns in one row; ``columns`` maps output to input names.

    One scan: each row passes on one (column, value) pair per counted column, pairs are made distinct where they are read
    and once more after the shuffle, and then counted.  ``approximate`` gives sketches instead.
    """
    count = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(*(count(source).alias(name) for name, source in columns.items()))


def match_rate(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    matched = F.count(F.col(column))
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        matched.alias("matched"),
        percent(matched, F.count(F.lit(1)), digits).alias("match_pct"),
    )


def pair_audit(df: DataFrame, risk: str = "delay_risk", action: str = "recommended_action",
               rule_table: Mapping[str, str] = rules.ACTION_BY_RISK) -> DataFrame:
    """Every distinct risk/action pair with its records and whether the rule table allows it.

    ``risks_of_action`` above one marks an ambiguous action.
    """
    pairs = df.groupBy(risk, action).agg(F.count(F.lit(1)).alias("records"))
    allowed = F.coalesce(labels.mapped(F.col(risk), rule_table) == F.col(action), F.lit(False))
    per_action = pairs.groupBy(F.col(action).alias("_action")).agg(F.countDistinct(risk).alias("risks_of_action"))
    return pairs.withColumn("is_allowed", allowed).join(
        per_action, F.col(action).eqNullSafe(F.col("_action")), "left"
    ).drop("_action")


def invalid_pairs(df: DataFrame, risk: str = "delay_risk", action: str = "recommended_action",
                  rule_table: Mapping[str, str] = rules.ACTION_BY_RISK) -> DataFrame:
    """Observed pairs the rule table does not hold."""
    observed = df.select(risk, action).distinct()
    allowed = rule_rows(df.sparkSession, [risk, action], list(rule_table.items()))
    return observed.exceptAll(allowed)


def assert_mapping(df: DataFrame, risk: str = "delay_risk", action: str = "recommended_action",
                   rule_table: Mapping[str, str] = rules.ACTION_BY_RISK) -> None:
    """Raise if any pair is null, not allowed, or maps one action to several risks."""
    audit = pair_audit(df, risk, action, rule_table)
    missing = F.col(risk).isNull() | F.col(action).isNull()
    bad = audit.filter(missing | ~F.col("is_allowed") | (F.col("risks_of_action") > 1)).limit(10).collect()
    if bad:
        raise ValueError(f"risk/action mapping is broken: {[row.asDict() for row in bad]}")


def field_checks(df: DataFrame, columns: Sequence[str] = (
        "route_corridor_name", "service_type", "route_display_name", "is_special_route")) -> DataFrame:
    """Nulls of the audited columns, S-prefixed rows and flagged rows, as (check, value) rows."""
    present = [name for name in columns if name in df.columns]
    checks = {f"missing_{name}": F.count_if(F.col(name).isNull()) for name in present}
    checks["s_prefix_rows"] = F.count_if(F.coalesce(labels.has_special_prefix(F.col("route_id")), F.lit(False)))
    checks["special_rows"] = F.count_if(F.coalesce(labels.special_flag(df), F.lit(False)))
    return _check_rows(df, checks, "records")


def _check_rows(df: DataFrame, checks: Mapping[str, Column], value: str) -> DataFrame:
    one = df.agg(*(column.alias(name) for name, column in checks.items()))
    pairs = [F.struct(F.lit(name).alias("check_name"), F.col(name).alias(value)) for name in checks]
    return one.select(F.inline(F.array(*pairs)))


def probability_domain(predictions: DataFrame, column: str = "predicted_actionable_probability") -> DataFrame:
    value = F.col(column)
    return predictions.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(value.isNull()).alias("null_rows"),
        F.count_if(~value.between(0, 1)).alias("out_of_range_rows"),
        F.min(value).alias("min_probability"),
        F.max(value).alias("max_probability"),
    )


def missing_or_blank(df: DataFrame, columns: Sequence[str] = schemas.DASHBOARD_REQUIRED) -> DataFrame:
    """Null or blank values per required field, plus the special rows."""
    present = [name for name in columns if name in df.columns]
    types = dict(df.dtypes)

    def empty(name: str) -> Column:
        column = F.col(name)
        return column.isNull() | (F.trim(column) == "") if types[name] == "string" else column.isNull()

    checks = {name: F.count_if(F.coalesce(empty(name), F.lit(True))) for name in present}
    if "is_special_route" in df.columns:
        checks["special_route_rows"] = F.count_if(F.coalesce(labels.special_flag(df), F.lit(False)))
    return _check_rows(df, checks, "records")


def decision_validation(source: DataFrame, published: DataFrame) -> DataFrame:
    """Row equality of source and published decisions, and empty required fields, as check rows."""
    rows_in = source.agg(F.count(F.lit(1))).scalar()
    fields = missing_or_blank(published).select(
        F.concat(F.lit("missing_"), "check_name").alias("check_name"),
        F.lit(None).cast("bigint").alias("expected"),
        F.col("records").alias("actual"),
    )
    counts = published.agg(F.count(F.lit(1)).alias("actual")).select(
        F.lit("row_count").alias("check_name"), rows_in.alias("expected"), "actual"
    )
    absent = len([name for name in schemas.DASHBOARD_REQUIRED if name not in published.columns])
    present = counts.select(F.lit("missing_required_fields").alias("check_name"), F.lit(0).cast("bigint").alias("expected"),
                            F.lit(absent).cast("bigint").alias("actual"))
    return _with_verdict(counts.unionByName(present).unionByName(fields))


def _with_verdict(checks: DataFrame) -> DataFrame:
    return checks.withColumn("ok", F.col("expected").isNull() | F.col("expected").eqNullSafe(F.col("actual")))


def manifest_figures() -> dict[str, Column]:
    """What the storage checks need of the completeness manifest."""
    return {
        "days": F.count(F.lit(1)),
        "complete": F.count_if("is_model_baseline_day"),
        "partial": F.count_if("is_partial_day"),
        "cleaned": F.sum("cleaned_rows"),
        "cleaned_complete": F.coalesce(F.sum(F.when(F.col("is_model_baseline_day"), F.col("cleaned_rows"))), F.lit(0)),
        "headers": F.coalesce(F.sum("duplicate_header_rows"), F.lit(0)),
    }


def observation_figures(everything: DataFrame) -> dict[str, Column]:
    """What they need of all observations."""
    rows = F.count(F.lit(1))
    return {
        "rows": rows,
        "matched": F.count("route_type"),
        "unnamed": F.count_if(F.col("route_display_name").isNull()),
        "special": F.count_if(F.coalesce(labels.special_flag(everything), F.lit(False))),
        "match_bp": F.coalesce(F.round(F.count("route_type") * 10000.0 / F.nullif(rows, F.lit(0))), F.lit(0)),
        "service_missing": F.count_if(F.col("service_type").isNull()),
    }


def baseline_figures() -> dict[str, Column]:
    return {"rows": F.count(F.lit(1)), "incomplete": F.count_if(~F.col("is_model_baseline_day"))}


def route_daily_figures() -> dict[str, Column]:
    return {"records": F.coalesce(F.sum("records"), F.lit(0)), "groups": F.count(F.lit(1))}


def top_route_figures(top_routes: DataFrame) -> dict[str, Column]:
    return {"special": F.count_if(F.coalesce(labels.special_flag(top_routes), F.lit(False)))}


def storage_validation(
    everything: DataFrame,
    baseline: DataFrame,
    manifest: DataFrame,
    route_daily: DataFrame,
    top_routes: DataFrame,
    files: DataFrame | None = None,
) -> DataFrame:
    """Checks over the tables of one storage build: (check_name, expected, actual, ok) rows.

    Informational figures have no expected value.  Every table is read once.  ``files`` has one row per landed file.
    """
    def counts(df: DataFrame, figures: Mapping[str, Column]) -> dict[str, Column]:
        one = one_row(df.agg(*(column.cast("bigint").alias(name) for name, column in figures.items())))
        return {name: one[name] for name in figures}

    days = counts(manifest, manifest_figures())
    if files is not None:
        days["files"] = files.agg(F.count(F.lit(1))).scalar()
    return storage_checks(
        everything, days, counts(everything, observation_figures(everything)), counts(baseline, baseline_figures()),
        counts(route_daily, route_daily_figures()), counts(top_routes, top_route_figures(top_routes)),
    )


def storage_checks(
    everything: DataFrame,
    days: Mapping[str, Column],
    facts: Mapping[str, Column],
    model: Mapping[str, Column],
    summary: Mapping[str, Column],
    ranked: Mapping[str, Column],
) -> DataFrame:
    """The checks from figures that were counted already, for example while the tables were written.

    Of ``everything`` only the schema is looked at.
    """
    types = dict(everything.dtypes)

    def fixed(value: int | bool) -> Column:
        return F.lit(int(value)).cast("bigint")

    nothing = F.lit(None).cast("bigint")
    checks = [
        ("all_rows_match_manifest", days["cleaned"], facts["rows"]),
        ("baseline_rows_match_manifest", days["cleaned_complete"], model["rows"]),
        ("baseline_rows_on_partial_days", fixed(0), model["incomplete"]),
        ("route_summary_records", facts["rows"], summary["records"]),
        ("columns_match", fixed(1), fixed(tuple(everything.columns) == schemas.CLEAN_COLUMNS)),
        ("delay_minutes_numeric", fixed(1), fixed(types.get("delay_minutes") in ("double", "float"))),
        ("collection_time_is_timestamp", fixed(1), fixed(types.get("collection_time_utc") == "timestamp")),
        ("service_type_present", fixed(1), fixed("service_type" in types)),
        ("route_display_name_present", fixed(1), fixed("route_display_name" in types)),
        ("is_special_route_present", fixed(1), fixed("is_special_route" in types)),
        ("service_type_missing_rows", fixed(0), facts["service_missing"]),
        ("route_display_name_missing_rows", fixed(0), facts["unnamed"]),
        ("top_routes_special_rows", fixed(0), ranked["special"]),
        ("days_complete_plus_partial", days["days"], days["complete"] + days["partial"]),
        ("daily_files", nothing, days.get("files", days["days"])),
        ("complete_days", nothing, days["complete"]),
        ("partial_days", nothing, days["partial"]),
        ("duplicate_header_rows", nothing, days["headers"]),
        ("route_metadata_matched_rows", nothing, facts["matched"]),
        ("route_metadata_match_basis_points", nothing, facts["match_bp"]),
        ("s_prefix_rows_flagged", nothing, facts["special"]),
        ("route_summary_rows", nothing, summary["groups"]),
    ]
    table = everything.sparkSession.range(1).select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(name).alias("check_name"), expected.alias("expected"), actual.alias("actual"))
                    for name, expected, actual in checks
                )
            )
        )
    )
    return _with_verdict(table)


def view_validation(spark, sources: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """View rows against source rows and required columns still missing, per view."""
    required = required or {}
    frames = []
    for name, source in sources.items():
        view = spark.table(name)
        absent = sorted(set(required.get(name, ())) - set(view.columns))
        frames.append(
            view.agg(F.count(F.lit(1)).alias("view_rows")).select(
                F.lit(name).alias("view_name"),
                "view_rows",
                source.agg(F.count(F.lit(1))).scalar().alias("source_rows"),
                F.lit(",".join(absent)).alias("missing_columns"),
            )
        )
    table = reduce(DataFrame.unionByName, frames)
    return table.withColumn(
        "ok", (F.col("view_rows") == F.col("source_rows")) & (F.col("missing_columns") == "")
    )
