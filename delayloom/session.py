"""Session settings the library relies on.

Wall-clock fields (collection hour, date, weekday) are UTC everywhere, so the
session time zone must be UTC.  The two broadcast thresholds (estimated and,
under AQE, measured at run time) decide about every lookup that
``functions.lookups`` has not decided about.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "delayloom", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or fetch) a session with the settings above; ``extra`` wins."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return apply_session_defaults(builder.getOrCreate())


def apply_session_defaults(spark: SparkSession) -> SparkSession:
    """Pin the only setting results depend on: the UTC session time zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def at_once(spark: SparkSession, *makes: Callable[[], object]) -> list:
    """Results of functions that run jobs beside one another; the first error is raised when all have ended."""
    with ThreadPoolExecutor(len(makes)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(make)) for make in makes]
    return [one.result() for one in running]


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, for cutting lineage with ``checkpoint()``.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting gets a temporary folder; on a cluster a missing
    setting is an error, because executors could not share the files.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            configured = tempfile.mkdtemp(prefix="delayloom-checkpoint-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()
