"""Spark settings the package is written for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LEAST = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

# Nothing here depends on the size of the data: AQE picks the number of reduce
# tasks, splits skewed join partitions and re-plans joins from measured sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot never compiles methods beyond 8000 bytes of bytecode. Wide summaries generate
    # such methods; with this limit Spark runs them operator by operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Code tables of about 100,000 codes are broadcast; anything above this size is not.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    # '001', '835' and '20260312' must stay text when read back from a path.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # A write task meets few files, so it keeps their writers open side by side
    # and needs no sort by partition columns.
    _WRITERS: "32",
}


def build_session(app: str = "claimwell", master: str | None = None, **extra: str) -> SparkSession:
    """A session with SETTINGS; `extra` keys use `__` for the dots of a Spark key."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes that are planned and run herein remove their shuffle files when they are done,
    instead of when the driver happens to collect its garbage."""
    before = spark.conf.get(_FREE, "false")
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE, before)


@contextmanager
def side_by_side(spark: SparkSession) -> Iterator[None]:
    """Writes by partition that are run herein need no sort of whole rows by their directories,
    also in a session without SETTINGS; beyond that number of directories a task sorts the rest."""
    before = spark.conf.get(_WRITERS, None)
    if before in (None, "0"):
        spark.conf.set(_WRITERS, SETTINGS[_WRITERS])
    try:
        yield
    finally:
        spark.conf.unset(_WRITERS) if before is None else spark.conf.set(_WRITERS, before)


@contextmanager
def widening_joins(spark: SparkSession) -> Iterator[None]:
    """Joins that are run herein give far more rows than they read, so what they read is put
    into four partitions a core instead of one, if there are as many."""
    before = spark.conf.get(_LEAST, None)
    spark.conf.set(_LEAST, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(_LEAST) if before is None else spark.conf.set(_LEAST, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, which every executor reaches.

    It is `spark.checkpoint.dir` of the session, or a folder in the session's
    warehouse where that setting is missing.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/claimwell-work"
    return named.rstrip("/")
