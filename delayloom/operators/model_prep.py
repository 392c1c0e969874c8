"""Sampling, splitting and encoding of model inputs."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from typing import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from delayloom import rules, schemas
from delayloom.functions.lookups import calendar_bounded, measured
from delayloom.functions.measures import one_row
from delayloom.functions.quantiles import exact_quantiles, stored_column

MAX_MODEL_ROWS = 200_000
TEST_DATE_SHARE = 0.2
SEED = 42
MIN_CATEGORY_ROWS = 20


def draw(key: Sequence[str], seed: int = SEED) -> Column:
    """A fixed pseudo-random text per row: the same in every run, partitioning and engine."""
    return F.md5(F.concat_ws("|", *(F.col(name).cast("string") for name in key), F.lit(str(seed))))


_BIN_DIGITS = 4


def _take_per_stratum(
    df: DataFrame, strata: Sequence[str], key: Sequence[str], seed: int, wanted: Callable[[Column, Column], Column]
) -> DataFrame:
    """Mark ``_taken`` on the rows with the smallest draws, ``wanted(stratum rows, all rows)`` of each stratum, exactly.

    Ranking a whole stratum would send it to one task, and one stratum may
    hold a large part of the table.  Draws are counted per leading digits
    instead; all sizes follow from those counts.  Only the one bin per stratum
    that straddles the cut is ranked, about 1 / 65,536 of its rows, to find the
    last draw that is taken.  Then every row is settled by comparison.
    """
    drawn = df.withColumn("_draw", draw(key, seed))
    drawn = drawn.withColumn("_bin", F.substring("_draw", 1, _BIN_DIGITS))
    place = F.struct("_draw", *key)
    # strata and places only: a derived table is derived once for them and once for the result
    places = stored_column(drawn.withColumn("_place", place), [*strata, "_bin", "_place"])
    bins = places.groupBy(*strata, "_bin").agg(F.count(F.lit(1)).alias("_rows")).checkpoint()
    along = W.partitionBy(*strata)
    running = along.orderBy("_bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    size = F.sum("_rows").over(along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    placed = bins.withColumn("_upto", F.sum("_rows").over(running)).withColumn(
        "_wanted", wanted(size, bins.agg(F.sum("_rows")).scalar()))
    still_wanted = F.col("_wanted") - F.col("_upto") + F.col("_rows")
    cut = placed.groupBy(*strata).agg(
        F.min(
            F.when(F.col("_upto") > F.col("_wanted"), F.struct(F.col("_bin").alias("bin"), still_wanted.alias("left")))
        ).alias("_cut")
    )
    renamed = [f"_of_{name}" for name in strata]
    same = [F.col(name).eqNullSafe(F.col(new)) for name, new in zip(strata, renamed)]

    def per_stratum(table: DataFrame, *values: Column) -> DataFrame:
        # One row per stratum, derived from the whole table: counted before it may be broadcast.
        return measured(table.select(*(F.col(name).alias(new) for name, new in zip(strata, renamed)), *values))

    cuts = per_stratum(cut, F.col("_cut.bin").alias("_cut_bin"), F.col("_cut.left").alias("_left"))
    inside = places.join(cuts, [*same, F.col("_bin") == F.col("_cut_bin")])
    rank = F.row_number().over(W.partitionBy(*strata).orderBy("_place"))
    last = inside.withColumn("_rank", rank).filter(F.col("_rank") <= F.col("_left")).groupBy(*strata).agg(
        F.max("_place").alias("_last"))
    limits = per_stratum(
        cut.alias("c").join(last.alias("l"), [F.col(f"c.{n}").eqNullSafe(F.col(f"l.{n}")) for n in strata], "left").select(
            *(F.col(f"c.{n}").alias(n) for n in strata), "_cut", "_last"),
        F.col("_cut.bin").alias("_cut_bin"), "_last")
    joined = drawn.join(limits, same, "left").drop(*renamed)
    within = F.coalesce(place <= F.col("_last"), F.lit(False))
    taken = F.when(F.col("_cut_bin").isNull(), F.lit(True)).when(F.col("_bin") == F.col("_cut_bin"), within).otherwise(
        F.col("_bin") < F.col("_cut_bin"))
    return joined.withColumn("_taken", taken).drop("_draw", "_bin", "_cut_bin", "_last")


def stratified_sample(
    df: DataFrame,
    key: Sequence[str],
    max_rows: int = MAX_MODEL_ROWS,
    strata: Sequence[str] = ("collection_date", "delay_risk"),
    seed: int = SEED,
) -> DataFrame:
    """The same fraction of every stratum, exactly, when the table is larger than ``max_rows``.

    ``key`` identifies a row; it seeds the draw.
    """
    def wanted(size: Column, everything: Column) -> Column:
        return F.bround(size * F.least(F.lit(1.0), F.lit(float(max_rows)) / everything), 0).cast("bigint")

    return _take_per_stratum(df, strata, key, seed, wanted).filter("_taken").drop("_taken")


def stratified_split(
    df: DataFrame, key: Sequence[str], target: str = "delay_risk", test_share: float = TEST_DATE_SHARE, seed: int = SEED
) -> DataFrame:
    """Mark ``is_test`` on an exact share of every class."""
    wanted = lambda size, _: F.bround(size * F.lit(test_share), 0).cast("bigint")
    return _take_per_stratum(df, [target], key, seed, wanted).withColumnRenamed("_taken", "is_test")


def split_dates(df: DataFrame, test_share: float = TEST_DATE_SHARE) -> DataFrame:
    """Distinct dates with ``is_test`` set on the last share of them (at least one).

    The number of dates follows the calendar, so ranking them is a small job.
    """
    dates = df.select("collection_date").filter(F.col("collection_date").isNotNull()).distinct()
    every = W.partitionBy().orderBy(F.desc("collection_date"))
    return (
        dates.withColumn("_from_end", F.row_number().over(every))
        .withColumn("_dates", F.count(F.lit(1)).over(W.partitionBy()))
        .select(
            "collection_date",
            (F.col("_from_end") <= F.greatest(F.lit(1), F.bround(F.col("_dates") * F.lit(test_share), 0))).alias("is_test"),
        )
    )


MIN_SPLIT_DATES = 5


def time_split(df: DataFrame, test_share: float = TEST_DATE_SHARE) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by date; fewer than MIN_SPLIT_DATES dates are an error."""
    dates = split_dates(df, test_share)
    counted = dates.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).first()
    if counted.n < MIN_SPLIT_DATES:
        raise ValueError(f"not enough dates to hold some out: {counted.n} of at least {MIN_SPLIT_DATES}")
    if counted.t in (0, counted.n):
        raise ValueError("the dates leave no training rows or no test rows")

    def side(test: bool) -> DataFrame:
        chosen = dates.filter(F.col("is_test") if test else ~F.col("is_test"))
        return df.join(calendar_bounded(chosen.select("collection_date")), "collection_date", "left_semi")

    return side(False), side(True)


def category_table(
    train: DataFrame, columns: Sequence[str] = schemas.CATEGORICAL_FEATURES, min_rows: int = MIN_CATEGORY_ROWS
) -> DataFrame:
    """Training categories of every column with their rows and the bucket they are encoded as.

    The columns are stacked and counted in one pass over the training rows.
    """
    stacked = train.select(
        F.inline(
            F.array(*(F.struct(F.lit(name).alias("feature"), F.col(name).cast("string").alias("category")) for name in columns))
        )
    )
    counts = stacked.filter(F.col("category").isNotNull()).groupBy("feature", "category").agg(
        F.count(F.lit(1)).alias("train_rows")
    )
    return counts.withColumn(
        "bucket", F.when(F.col("train_rows") >= min_rows, F.col("category")).otherwise(rules.INFREQUENT_CATEGORY)
    )


#: Categories of a column that plans carry as literals, in bytes; a larger vocabulary is joined.
MAX_DICTIONARY_BYTES = 256 * 1024


def _bucket_column(name: str) -> str:
    return f"{name}_bucket"


@dataclass(frozen=True)
class FittedEncoding:
    """What the preprocessing learned from the training rows.

    ``frequent`` has the categories of each column that are features, ``rare`` those that share one bucket.  Both are
    hashed sets in the plan, so a row is looked up once per column and nothing is joined.  Columns in ``joined`` have
    more rare categories than a plan should carry; their buckets come from ``categories`` by a join.
    """

    categories: DataFrame
    medians: dict[str, float]
    modes: dict[str, str]
    frequent: dict[str, tuple[str, ...]]
    rare: dict[str, tuple[str, ...]]
    joined: tuple[str, ...] = ()
    columns: tuple[str, ...] = schemas.CATEGORICAL_FEATURES
    numbers: tuple[str, ...] = schemas.NUMERIC_FEATURES

    def encoded_name(self, feature: str) -> str:
        """The column of ``apply`` that stands for a feature."""
        return _bucket_column(feature) if feature in self.columns else feature

    def bucket(self, name: str, value: Column) -> Column:
        """Bucket of a category; none for one never seen in training."""
        found = F.when(value.isin(*self.frequent[name]), value) if self.frequent[name] else F.lit(None).cast("string")
        if not self.rare[name]:
            return found
        return F.coalesce(found, F.when(value.isin(*self.rare[name]), F.lit(rules.INFREQUENT_CATEGORY)))

    def typical(self) -> dict[str, Column]:
        """Bucket or number of each feature's most frequent category or median."""
        return {
            **{name: self._bucket_of_mode(name) for name in self.columns},
            **{name: F.lit(float(self.medians[name])) for name in self.numbers},
        }

    def _bucket_of_mode(self, name: str) -> Column:
        mode = self.modes.get(name)
        bucket = mode if mode in self.frequent[name] or mode is None else rules.INFREQUENT_CATEGORY
        return F.lit(bucket).cast("string")

    def apply(self, df: DataFrame) -> DataFrame:
        """Fill gaps and add ``<column>_bucket``; a category never seen in training has none."""
        filled = df.withColumns(
            {
                **{name: F.coalesce(F.col(name).cast("string"), F.lit(self.modes.get(name))) for name in self.columns},
                **{name: F.coalesce(F.col(name).cast("double"), F.lit(self.medians.get(name))) for name in self.numbers},
            }
        )
        looked_up = [name for name in self.columns if name not in self.joined]
        filled = filled.withColumns({_bucket_column(name): self.bucket(name, F.col(name)) for name in looked_up})
        for name in self.joined:
            mapping = self.categories.filter(F.col("feature") == name).select(
                F.col("category").alias(name), F.col("bucket").alias(_bucket_column(name))
            )
            filled = filled.join(mapping, name, "left")
        return filled

    @cached_property
    def assembler(self) -> PipelineModel:
        """Buckets and numbers to one ``features`` vector, built from the vocabulary without reading a row.

        Buckets are indexed alphabetically; null and unseen ones come last, and the encoder drops exactly that place.
        """
        from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler

        buckets = [_bucket_column(name) for name in self.columns]
        indexed, one_hot = [f"{name}_index" for name in self.columns], [f"{name}_onehot" for name in self.columns]
        places = [
            sorted({*self.frequent[n], *([rules.INFREQUENT_CATEGORY] if self.rare[n] or n in self.joined else [])})
            for n in self.columns
        ]
        stages = [
            StringIndexerModel.from_labels(list(labels), bucket, index, handleInvalid="keep")
            for labels, bucket, index in zip(places, buckets, indexed) if labels
        ]
        # a column without any training category adds no place
        known = [k for k, labels in enumerate(places) if labels]
        one_hot = [one_hot[k] for k in known]
        if known:
            stages.append(OneHotEncoder(inputCols=[indexed[k] for k in known], outputCols=one_hot, dropLast=True))
        stages.append(VectorAssembler(inputCols=[*self.numbers, *one_hot], outputCol="features"))
        fields = [f"`{name}` string" for name in buckets] + [f"`{name}` double" for name in self.numbers]
        return Pipeline(stages=stages).fit(self.categories.sparkSession.createDataFrame([], ", ".join(fields)))

    def assemble(self, applied: DataFrame) -> DataFrame:
        """Add ``features`` to rows that ``apply`` has encoded."""
        return self.assembler.transform(applied)

    def index(self, applied: DataFrame) -> tuple[DataFrame, dict[str, int]]:
        """Add the code of every bucket, its place among the column's one-hot features; those columns with their places."""
        from pyspark.ml.feature import StringIndexerModel

        indexers = [stage for stage in self.assembler.stages if isinstance(stage, StringIndexerModel)]
        for stage in indexers:
            applied = stage.transform(applied)
        return applied, {stage.getOutputCol(): len(stage.labels) for stage in indexers}

    def encode(self, df: DataFrame) -> DataFrame:
        return self.assemble(self.apply(df))

    def feature_names(self) -> list[str]:
        """Names of the places of ``features``: numbers, then ``<column>_<bucket>``."""
        empty = self.categories.sparkSession.createDataFrame([], ", ".join(
            [f"`{_bucket_column(name)}` string" for name in self.columns] + [f"`{name}` double" for name in self.numbers]))
        groups = self.assemble(empty).schema["features"].metadata["ml_attr"]["attrs"]
        named = sorted((item["idx"], item["name"]) for group in groups.values() for item in group)
        return [name.replace("_onehot_", "_", 1) for _, name in named]


def _vocabulary(table: DataFrame, columns: Sequence[str], max_bytes: int) -> tuple[dict, dict, tuple[str, ...]]:
    """Frequent and rare categories of each column, and the columns with more bytes of rare ones than ``max_bytes``.

    Frequent categories have ``min_rows`` rows each and are places of the feature vector, so the driver has them anyway.
    """
    is_rare = F.col("bucket") != F.col("category")
    sizes = table.filter(is_rare).groupBy("feature").agg(F.sum(F.octet_length("category")).alias("bytes")).collect()
    joined = tuple(sorted(row.feature for row in sizes if row.bytes > max_bytes))
    wanted = table.filter(~is_rare | ~F.col("feature").isin(*joined)) if joined else table
    rows = wanted.select("feature", "category", is_rare.alias("is_rare")).collect()
    pick = lambda name, rare: tuple(sorted(r.category for r in rows if r.feature == name and r.is_rare == rare))
    return {n: pick(n, False) for n in columns}, {n: pick(n, True) for n in columns}, joined


def fit_encoding(
    train: DataFrame,
    columns: Sequence[str] = schemas.CATEGORICAL_FEATURES,
    numbers: Sequence[str] = schemas.NUMERIC_FEATURES,
    min_rows: int = MIN_CATEGORY_ROWS,
    categories: DataFrame | None = None,
    max_dictionary_bytes: int = MAX_DICTIONARY_BYTES,
) -> FittedEncoding:
    """Exact medians, most frequent categories and rare-category buckets of the training rows."""
    # A column without any value has no median; it is filled with zero so that training can go on.
    medians = {name: 0.0 for name in numbers}
    if numbers:
        stacked = train.select(F.inline(F.array(*(
            F.struct(F.lit(name).alias("feature"), F.col(name).cast("double").alias("value")) for name in numbers))))
        medians |= {row.feature: row.median for row in exact_quantiles(stacked, "value", {"median": 0.5}, ["feature"]).collect()}
    # One row per category, stored: the vocabulary is read from it, and columns too large for literals are joined to it.
    table = measured(category_table(train, columns, min_rows)) if categories is None else categories
    modes = {
        row.feature: row.category
        for row in table.groupBy("feature")
        .agg(F.min_by("category", F.struct(-F.col("train_rows"), F.col("category"))).alias("category"))
        .collect()
    }
    return FittedEncoding(
        table, medians, modes, *_vocabulary(table, columns, max_dictionary_bytes), tuple(columns), tuple(numbers)
    )


def baselines(train: DataFrame, target: str = "actionable_delay_risk", value: str = "delay_minutes") -> DataFrame:
    """Most frequent class (ties to the smaller) and exact training median, as one row."""
    classes = train.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    majority = one_row(classes.agg(F.min_by(target, F.struct(-F.col("n"), F.col(target))).alias("c")))
    counted = train.groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.percentile(F.col(value), 0.5, F.col("n")).alias("median_value")).select(
        majority["c"].alias("majority_class"), "median_value"
    )


def scale_pos_weight(train: DataFrame, target: str = "actionable_delay_risk") -> DataFrame:
    positive = F.count_if(F.col(target) == 1)
    return train.agg(
        F.coalesce(F.count_if(F.col(target) == 0) / F.nullif(positive, F.lit(0)), F.lit(1.0)).alias("scale_pos_weight")
    )
