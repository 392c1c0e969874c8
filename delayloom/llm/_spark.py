"""Helpers shared by the training-data operators: stored intermediates and group-wise Arrow tasks."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delayloom.session import ensure_checkpoint_dir

#: Matches the classifier contracts' fold: rows with this remainder of crc32(doc_id) mod 4 are never learnt from.
HELD_OUT_REMAINDER = 2


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT_REMAINDER, F.lit(False))


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write an intermediate result to the shared checkpoint folder and read it back.

    Cuts lineage without keeping blocks on executors: a lost executor costs its running tasks only.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: All columns of documents but doc_id and text, as one: what an operator adds cannot clash with what it holds.
REST = "other_columns"


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the rest of the row in one column."""
    others = [name for name in docs.columns if name not in ("doc_id", "text")]
    rest = F.struct(*(F.col(f"`{name}`") for name in others)) if others else F.lit(None).cast("string")
    return docs.select("doc_id", "text", rest.alias(REST))


def unpacked(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` again, from packed rows with any other columns beside them; ``changed`` replaces some."""
    def column(name: str) -> Column:
        if name in changed:
            return changed[name].cast(docs.schema[name].dataType).alias(name)
        return F.col(name) if name in ("doc_id", "text") else F.col(REST).getField(name).alias(name)

    return rows.select(*map(column, docs.columns))


#: Texts in an Arrow batch: a few MB for usual texts.
BATCH_TEXTS = 1000


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int = BATCH_TEXTS) -> Iterator[None]:
    """Limit the rows of an Arrow batch while an action over large rows runs."""
    with _settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}):
        yield


#: Bits of a runtime filter: at most 8 MB, 16 a key up to 4 million keys.
FILTER_BITS, FILTER_KEYS = 1 << 26, 1 << 22


@contextmanager
def runtime_filters(spark: SparkSession, keys: int) -> Iterator[None]:
    """Let Spark filter the large side of a join by a Bloom filter of the other side's ``keys`` before it moves rows.

    Holds for any size of either side.  Of bounded size: far more keys than ``FILTER_KEYS`` let more rows pass, which the join drops.
    Spark derives it if the other side is a stored table under a comparison, and neither side counts as small enough to broadcast.
    """
    option = "spark.sql.optimizer.runtime.bloomFilter"
    items = min(max(keys, 1), FILTER_KEYS)
    with _settings(spark, {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        f"{option}.enabled": "true",
        f"{option}.applicationSideScanSizeThreshold": "0",
        f"{option}.creationSideThreshold": "1g",
        f"{option}.expectedNumItems": str(items),
        f"{option}.numBits": str(FILTER_BITS // FILTER_KEYS * items),
    }):
        yield


def parts_for(amount: float, each: float, least: int = 1) -> int:
    """Partitions so that one holds about ``each`` of ``amount``."""
    return max(least, math.ceil(amount / each))


def grouped(key: str, work: Callable[[int, pa.Table], Iterator[pa.RecordBatch]]) -> Callable:
    """A ``mapInArrow`` function over partitions sorted by ``key``: calls ``work`` once for each key.

    Cheaper than one pandas frame per group when groups are many and small.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            cuts = [0, *((keys[1:] != keys[:-1]).nonzero()[0] + 1).tolist(), len(keys)]
            for start, end in zip(cuts, cuts[1:]):
                value = keys[start].item()
                if held and value != current:
                    yield from work(current, pa.Table.from_batches(held))
                    held = []
                current = value
                held.append(batch.slice(start, end - start))
        if held:
            yield from work(current, pa.Table.from_batches(held))

    return run


@contextmanager
def bucketed(df: DataFrame, key: str, parts: int) -> Iterator[DataFrame]:
    """``df`` as a table bucketed by ``key`` in the shared folder, so that later joins on it move only the other side."""
    spark = df.sparkSession
    name = f"delayloom_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark)}/{name}"
    writer = df.repartition(parts, key).write.option("path", path).option("compression", "uncompressed")
    writer.bucketBy(parts, key).sortBy(key).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
