"""Deciding whether a lookup may be broadcast.

Spark estimates the size of a lookup that was derived from a large table as if
it were that table, and would shuffle the large side for the join.  Two kinds
of lookups are broadcast explicitly instead: those with one row per calendar
hour or day, whose size is bounded by the period they cover, and those whose
rows and bytes have been counted.  A lookup beyond that is joined by shuffling
the facts; the few keys that hold a large share of them are counted once and
spread over several tasks, and only their lookup rows are copied.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delayloom.session import ensure_checkpoint_dir

MAX_BROADCAST_ROWS = 250_000


def calendar_bounded(lookup: DataFrame) -> DataFrame:
    """Broadcast a lookup that holds at most one row per calendar hour or day."""
    return F.broadcast(lookup)


def broadcast_bytes(spark: SparkSession) -> int:
    """The session's own bound on what it broadcasts; none at all gives -1."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    digits = threshold.rstrip("bkmg")
    return int(digits) * units.get(threshold[len(digits):].rstrip("b"), 1)


def is_small(stored: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether a stored lookup has at most ``max_rows`` rows and its text no more bytes than the session broadcasts."""
    size = stored.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(F.to_json(F.struct(*stored.columns)))).alias("bytes")
    ).first()
    return size.rows <= max_rows and (size.bytes or 0) <= broadcast_bytes(stored.sparkSession)


def measured(lookup: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Store a derived lookup, count it, and broadcast it only when it is small enough.

    The stored rows also cut the lineage: later joins do not derive it again.
    """
    ensure_checkpoint_dir(lookup.sparkSession)
    stored = lookup.checkpoint()
    return F.broadcast(stored) if is_small(stored, max_rows) else stored


SALT = "_salt"


def salted(lookup: DataFrame, salts: int) -> DataFrame:
    """Every lookup row once per salt value."""
    return lookup.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def salt_of(df: DataFrame, salts: int, spread_by: Sequence[str]) -> Column:
    """A fixed salt per row, from columns that vary inside a hot key."""
    names = [name for name in spread_by if name in df.columns]
    return F.pmod(F.xxhash64(*names), F.lit(salts)).cast("int")


SPREAD_COLUMNS = ("collection_time_utc", "trip_id", "entity_id", "event_id")


def unique_rows(lookup: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key of a lookup (the smallest row when a key repeats)."""
    picked = lookup.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("row"))
    return picked.select(*keys, *(F.col(f"row.{name}").alias(name) for name in columns))


#: A key with more than this share of the facts is heavy, so there are fewer than a hundred of them.
HEAVY_SHARE = 0.01


def heavy_keys(facts: DataFrame, key: str, share: float = HEAVY_SHARE) -> list:
    """Keys that hold more than ``share`` of the rows, from one count with map-side combine; fewer than 1 / ``share``."""
    counts = facts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    ensure_checkpoint_dir(facts.sparkSession)
    counted = counts.checkpoint()
    size = counted.agg(F.sum("n")).first()[0] or 0
    return [row[0] for row in counted.filter((F.col("n") > share * size) & F.col(key).isNotNull()).select(key).collect()]


def spread_lookup(lookup: DataFrame, key: str, heavy: Sequence, salts: int) -> DataFrame:
    """Rows of heavy keys once per salt, all others once with salt zero."""
    copies = F.when(F.col(key).isin(*heavy), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return lookup.withColumn(SALT, F.explode(copies))


def left_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    columns: Sequence[str],
    salts: int = 1,
    spread_by: Sequence[str] = SPREAD_COLUMNS,
) -> DataFrame:
    """Left join one row per key; every fact row comes out exactly once.

    The lookup is stored and counted.  While it is small it is broadcast.  Beyond that the facts are shuffled, and a key
    holding a third of them would end in one task: ``salts`` above one counts the keys of the facts once and spreads the
    heavy ones over that many tasks.  Only heavy keys' lookup rows are copied.  The stored rows are made unique on the
    key again, which costs little and lets Catalyst drop the join where none of its columns is used.
    """
    ensure_checkpoint_dir(facts.sparkSession)
    stored = unique_rows(lookup.select(key, *columns), [key], columns).checkpoint()
    if is_small(stored):
        return facts.join(F.broadcast(unique_rows(stored, [key], columns)), key, "left")
    heavy = heavy_keys(facts, key) if salts > 1 and not facts.isStreaming else []
    if not heavy:
        return facts.join(unique_rows(stored, [key], columns), key, "left")
    copies = unique_rows(spread_lookup(stored, key, heavy, salts), [key, SALT], columns)
    salt = F.when(F.col(key).isin(*heavy), salt_of(facts, salts, spread_by)).otherwise(F.lit(0))
    return facts.withColumn(SALT, salt).join(copies, [key, SALT], "left").drop(SALT)
