"""Exact quantiles by narrowing brackets of ranks.

A bracket is a range of values that holds a wanted rank.  Its rows are counted in equal steps of that range, with
map-side combine; the step that holds the rank is the next bracket, down to the least and greatest value really found in
it.  A bracket of one value is an answer.  Nothing is sorted, no task holds a group's distinct values, and what is kept of
a group is one counter per step.  After the first narrowing only the rows inside brackets are read again.
"""

from __future__ import annotations

import math
import uuid
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from delayloom.functions.lookups import measured
from delayloom.session import ensure_checkpoint_dir

#: Steps a bracket is counted in.  Whole seconds up to the outlier bound need one narrowing.
STEPS = 16_384


def _by(names: Sequence[str], side: str) -> list[Column]:
    return [F.col(name).alias(f"{side}{name}") for name in names]


def _inside(rows: DataFrame, brackets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with the bracket (lo, hi, wide) that holds them; brackets of one group do not overlap."""
    lookup = measured(brackets.select(*_by(by, "_of_"), "lo", "hi", "wide").distinct())
    same = F.col("_v").between(F.col("lo"), F.col("hi"))
    for name in by:
        same = same & F.col(name).eqNullSafe(F.col(f"_of_{name}"))
    return rows.join(lookup, same).drop(*(f"_of_{name}" for name in by))


def _magnitude(value: Column) -> Column:
    """Sign and order of magnitude; keeps the order of the values."""
    return F.when(value == 0, 0.0).otherwise(F.signum(value) * (F.log(F.abs(value)) + 800.0))


def _narrowed(inside: DataFrame, wanted: DataFrame, by: Sequence[str], steps: int) -> DataFrame:
    """Each wanted rank with the step that holds it as its new bracket, and the rank inside that.

    Steps are equal in the values.  Where one step held over an eighth of a bracket's rows, and that spans orders of
    magnitude, the next ones are equal in those; so each narrowing is a large one whatever the values.
    """
    # halves, so that no range overflows; every operation keeps the order of the values
    plain = (F.col("_v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
    low, high = _magnitude(F.col("lo")), _magnitude(F.col("hi"))
    place = F.when(F.col("wide"), (_magnitude(F.col("_v")) - low) / (high - low)).otherwise(plain)
    step = F.least(F.floor(place * steps), F.lit(steps - 1))
    keys = [*by, "lo", "hi"]
    counted = inside.groupBy(*keys, "wide", step.alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("from"), F.max("_v").alias("to"))
    along = W.partitionBy(*keys).orderBy("step")
    before = F.coalesce(F.sum("n").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("n").over(W.partitionBy(*keys))
    placed = counted.select("*", before.alias("before"), (F.col("n") * 8 > whole).alias("crowded")).select(
        *_by(keys, "_of_"), "n", "from", "to", "before", "crowded")
    here = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))
    for name in keys:
        here = here & F.col(name).eqNullSafe(F.col(f"_of_{name}"))
    wide = F.col("crowded") & (_magnitude(F.col("to")) - _magnitude(F.col("from")) > 1)
    return wanted.join(placed, here).select(
        *by, "target", F.col("from").alias("lo"), F.col("to").alias("hi"), wide.alias("wide"),
        (F.col("rank") - F.col("before")).alias("rank"))


def _literals(values: Sequence[tuple], names: Sequence[str]) -> Column:
    return F.array(*(F.struct(*(F.lit(v).alias(name) for name, v in zip(names, row))) for row in values))


def _overall(rows: DataFrame, probabilities: Mapping[str, float], steps: int) -> DataFrame:
    """The quantiles of all rows: two brackets a quantile at most, so they are part of the plan and each narrowing is one job."""
    spark = rows.sparkSession
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).first()
    found: dict[str, Column] = {}
    if size.n:
        places = {name: p * (size.n - 1) for name, p in probabilities.items()}
        ranks = {rank for place in places.values() for rank in (math.floor(place), math.ceil(place))}
        state = {str(rank): (size.lo, size.hi, False, rank) for rank in ranks}
        while open_targets := [(target, *held) for target, held in state.items() if held[0] < held[1]]:
            brackets = _literals(sorted({held[1:4] for held in open_targets}), ("lo", "hi", "wide"))
            inside = rows.select("_v", F.inline(F.filter(brackets, lambda b: F.col("_v").between(b["lo"], b["hi"]))))
            wanted = spark.range(1).select(F.inline(_literals(open_targets, ("target", "lo", "hi", "wide", "rank"))))
            state |= {r.target: (r.lo, r.hi, r.wide, r.rank) for r in _narrowed(inside, wanted, (), steps).collect()}
        for name, place in places.items():
            below, above = (state[str(rank)][0] for rank in (math.floor(place), math.ceil(place)))
            found[name] = F.lit(below + (above - below) * (place - math.floor(place)))
    return spark.range(1).select(*(found.get(name, F.lit(None).cast("double")).alias(name) for name in probabilities))


def stored_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A few columns as a table in the checkpoint folder: what follows reads them and derives nothing again."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/column-{uuid.uuid4().hex}"
    narrow = df.select(*columns)
    narrow.write.parquet(path)
    return df.sparkSession.read.schema(narrow.schema).parquet(path)


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Mapping[str, float], by: Sequence[str] = (), steps: int = STEPS
) -> DataFrame:
    """One row per group with the named quantiles, interpolated linearly between neighbouring ranks.

    Null, NaN and infinite values do not count; a group without any other value has no row (without groups: a row of
    nulls).  Groups are null-safe.
    The narrowing runs when this is called; the result reads a stored table with one row per group and rank.  ``df`` is read
    two times at least: give a derived table as ``stored_column``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.select(*by, F.col(value).cast("double").alias("_v"))
    rows = rows.filter(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") != float("inf")))
    if not by:
        return _overall(rows, probabilities, steps)
    bounds = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    position = {name: F.lit(float(p)) * (F.col("n") - 1) for name, p in probabilities.items()}
    targets = [
        F.struct(F.lit(f"{name}_{side}").alias("target"), rounding(place).cast("bigint").alias("rank"))
        for name, place in position.items() for side, rounding in (("below", F.floor), ("above", F.ceil))
    ]
    groups = bounds.checkpoint()
    wanted = groups.select(*by, "lo", "hi", F.lit(False).alias("wide"), F.inline(F.array(*targets)))
    settled, source = wanted.filter("lo = hi"), rows
    wanted = wanted.filter("lo < hi").checkpoint()
    while not wanted.isEmpty():
        narrow = _narrowed(_inside(source, wanted, by), wanted, by, steps).checkpoint()
        settled = settled.unionByName(narrow.filter("lo = hi").select(*settled.columns))
        wanted = narrow.filter("lo < hi")
        if not wanted.isEmpty():
            source = _inside(source, wanted, by).select(*by, "_v").checkpoint()
    # one row per group and rank: groups times twice the probabilities
    values = settled.groupBy(*by).pivot("target", [f"{name}_{side}" for name in probabilities for side in ("below", "above")])
    found = values.agg(F.min("lo"))
    share = {name: place - F.floor(place) for name, place in position.items()}
    line = {name: F.col(f"{name}_below") + (F.col(f"{name}_above") - F.col(f"{name}_below")) * share[name] for name in probabilities}
    sized = groups.select(*_by(by, "_of_"), "n")
    same = [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in by]
    return found.join(sized, same).select(*by, *(c.alias(name) for name, c in line.items()))
