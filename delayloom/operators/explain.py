"""Feature contributions by re-scoring: permutation, and Shapley values sampled along feature orders.

Both explain every row they are given.  Rows are encoded once; all altered copies of the encoded columns are scored in
one pass, and nothing is ordered beyond a block of rows.
"""

from __future__ import annotations

import math
import random
from typing import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from delayloom import schemas
from delayloom.operators.features import CONTRIBUTION_TYPE, mean_abs_contribution, min_max_normalise
from delayloom.operators.model_prep import SEED, draw
from delayloom.operators.models import TARGET, TrainedModel
from delayloom.session import ensure_checkpoint_dir

#: Rows that exchange values with one another when a feature is permuted.
BLOCK_ROWS = 10_000


def explained_rows(df: DataFrame) -> DataFrame:
    """All rows with a ``row_id`` of their own, stored because every explanation reads them several times."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.withColumn("row_id", F.monotonically_increasing_id()).checkpoint()


def probability_of(model: TrainedModel, encoded: DataFrame) -> DataFrame:
    """Rows that the model's encoding has been applied to, with the probability of the actionable class."""
    return model.trees.transform(model.encoding.assemble(encoded)).withColumn(
        "probability", vector_to_array("probability")[1]
    )


def permutation_importance(
    model: TrainedModel,
    test: DataFrame,
    key: Sequence[str],
    features: Sequence[str] = schemas.FEATURES,
    target: str = TARGET,
    seed: int = SEED,
) -> DataFrame:
    """Rise of the log loss when a feature takes the values of other rows.

    Rows are encoded once and dealt at random over blocks; within a block each takes the encoded value of the next in a
    second random order.
    """
    rows = explained_rows(test)
    blocks = math.ceil(rows.count() / BLOCK_ROWS)
    block = F.pmod(F.xxhash64(draw(key, seed), "row_id"), F.lit(max(1, blocks)))
    order = W.partitionBy("_block").orderBy("_order", "row_id")
    names = {name: model.encoding.encoded_name(name) for name in features}
    values = F.struct(*names.values())
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    donor = F.coalesce(F.lead(values).over(order), F.first(values).over(whole))
    placed = model.encoding.apply(rows).withColumns({"_block": block, "_order": draw([*key, "row_id"], seed + 1)})
    # only what the model reads goes on: one untouched copy, and one for each feature
    paired = placed.withColumn("_donor", donor).select(target, *_inputs(model), "_donor")
    copies = paired.withColumn("altered", F.explode(F.array(F.lit(""), *map(F.lit, features))))
    copies = copies.withColumns({
        column: F.when(F.col("altered") == name, F.col("_donor")[column]).otherwise(F.col(column))
        for name, column in names.items()
    })
    p = F.greatest(F.least(F.col("probability"), F.lit(1 - 1e-15)), F.lit(1e-15))
    loss = -F.when(F.col(target) == 1, F.log(p)).otherwise(F.log(1 - p))
    losses = probability_of(model, copies).groupBy("altered").agg(F.avg(loss).alias("loss"), F.count(F.lit(1)).alias("rows"))
    # One row per feature, so the whole table is a window.
    base = F.max(F.when(F.col("altered") == "", F.col("loss"))).over(W.partitionBy())
    return losses.withColumn("base", base).filter(F.col("altered") != "").select(
        F.lit("GBT classifier").alias("source"),
        F.lit("permutation_importance").alias("explainability_type"),
        F.col("altered").alias("feature"),
        (F.col("loss") - F.col("base")).alias("importance"),
        F.concat(F.lit("Rise of the log loss on "), F.col("rows").cast("string"), F.lit(" test rows.")).alias("notes"),
    )


def _inputs(model: TrainedModel) -> list[str]:
    encoding = model.encoding
    return [encoding.encoded_name(name) for name in (*encoding.columns, *encoding.numbers)]


#: Seeded feature orders; a row follows one of them and its reverse.
ORDERS = 32


def feature_ranks(count: int, orders: int = ORDERS, seed: int = SEED) -> list[list[int]]:
    """Rank of each feature in each of the seeded orders."""
    draws = random.Random(seed)
    return [draws.sample(range(count), count) for _ in range(orders)]


def contributions(
    model: TrainedModel, rows: DataFrame, features: Sequence[str] = schemas.FEATURES, orders: int = ORDERS, seed: int = SEED
) -> DataFrame:
    """Shapley contributions to the probability, sampled along feature orders.

    From the row with typical values (most frequent category, median) a path turns one feature after the other to the
    row's own value and scores every step; a feature's contribution is the change at its step.  Each row follows one of
    ``orders`` seeded orders and its reverse, and the two changes are averaged.  The changes of a path telescope, so
    ``base_value`` plus all contributions of a row is its probability.  Rows are encoded once, and all steps are scored
    in one pass.

    ``rows`` comes from ``explained_rows``; the result is (row_id, feature, value, shap_value, base_value, probability).
    """
    count, encoding = len(features), model.encoding
    typical, names = encoding.typical(), {name: encoding.encoded_name(name) for name in features}
    ranks = F.array(*(F.array(*map(F.lit, own)) for own in feature_ranks(count, orders, seed)))
    own_ranks = F.get(ranks, F.pmod(F.xxhash64("row_id"), F.lit(orders)).cast("int"))
    numbers = F.array(*(_as_number(name) for name in features))
    placed = encoding.apply(rows.withColumn("_values", numbers)).select(
        "row_id", "_values", own_ranks.alias("_ranks"), *_inputs(model))
    # step 0 is the typical row and the last one the row itself, whichever the direction
    steps = [F.struct(F.lit(backward).alias("backward"), F.lit(step).alias("step"))
             for backward in (False, True) for step in range(1 if backward else 0, count if backward else count + 1)]
    copies = placed.withColumn("_at", F.explode(F.array(*steps)))
    turned = lambda k: F.when(
        F.col("_at.backward"), F.get("_ranks", F.lit(k)) >= count - F.col("_at.step")
    ).otherwise(F.get("_ranks", F.lit(k)) < F.col("_at.step"))
    copies = copies.withColumns({
        column: F.when(turned(k), F.col(column)).otherwise(typical[name]) for k, (name, column) in enumerate(names.items())
    })
    scored = probability_of(model, copies).select("row_id", "_values", "_ranks", "_at", "probability")
    # the steps of a row, a fixed number of them, become two arrays in step order
    steps_of = lambda backward: F.sort_array(F.collect_list(F.when(
        F.col("_at.backward") == backward, F.struct("_at.step", "probability"))))["probability"]
    paths = scored.groupBy("row_id").agg(
        F.any_value("_values").alias("_values"), F.any_value("_ranks").alias("_ranks"),
        steps_of(False).alias("_forward"), steps_of(True).alias("_between"))
    base, own = F.get("_forward", F.lit(0)), F.get("_forward", F.lit(count))
    paths = paths.withColumn("_backward", F.concat(F.array(base), "_between", F.array(own)))
    change = lambda path, place: F.get(path, place + 1) - F.get(path, place)
    own_rows = [
        F.struct(
            F.lit(name).alias("feature"), F.get("_values", F.lit(k)).alias("value"),
            ((change("_forward", F.get("_ranks", F.lit(k))) + change("_backward", count - 1 - F.get("_ranks", F.lit(k)))) / 2
             ).alias("shap_value"),
        )
        for k, name in enumerate(features)
    ]
    return paths.select("row_id", F.inline(F.array(*own_rows)), base.alias("base_value"), own.alias("probability"))


def additivity(rows: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Rows whose base and contributions add up to the probability, and those that do not, as one row."""
    sums = rows.groupBy("row_id").agg(
        (F.sum("shap_value") + F.any_value("base_value") - F.any_value("probability")).alias("error"))
    return sums.agg(
        F.count_if(F.abs("error") <= tolerance).alias("additive_rows"),
        F.count_if((F.abs("error") > tolerance) | F.col("error").isNull()).alias("other_rows"))


def contribution_rows(model: TrainedModel, test: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Stored contributions of all features but ``exclude``, for the tables made of them."""
    features = [name for name in schemas.FEATURES if name not in exclude]
    return contributions(model, explained_rows(test), features).checkpoint()


def contribution_importance(rows: DataFrame, source: str) -> DataFrame:
    """Mean absolute contribution per feature as rows of the long importance table."""
    return mean_abs_contribution(rows).select(
        F.lit(source).alias("source"),
        F.lit(CONTRIBUTION_TYPE).alias("explainability_type"),
        "feature",
        "importance",
        F.lit("Mean absolute Shapley contribution to the probability, along sampled feature orders.").alias("notes"),
    )


def contribution_points(rows: DataFrame, top_n: int = 10, subset: Sequence[str] | None = None) -> DataFrame:
    """Long points behind a contribution plot: the top features by mean absolute contribution, or ``subset``."""
    means = rows.groupBy("feature").agg(F.avg(F.abs("shap_value")).alias("mean_abs"))
    if subset is None:
        means = means.orderBy(F.desc("mean_abs"), "feature").limit(top_n)
    else:
        means = means.filter(F.col("feature").isin(*subset))
    # One row per feature of a fixed list, so neither lookup grows with the data.
    points = rows.join(F.broadcast(means), "feature")
    return min_max_normalise(points).select("feature", "shap_value", "value_norm", "mean_abs", "row_id")


def _as_number(name: str):
    """Numeric features as they are; categories by a fixed hash of their text."""
    if name in schemas.NUMERIC_FEATURES:
        return F.col(name).cast("double")
    return (F.pmod(F.xxhash64(F.col(name).cast("string")), F.lit(1000)) / 1000).cast("double")
