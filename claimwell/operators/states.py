"""The states of files over time: transitions, time in each state, files that are stuck.

A file's events may be many, so they are put in order within a day first, and days are put
together by their last events: no task gets all events of a file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# ---- fixed values: the states that may follow a state; None stands for a new file ----------
FOLLOWING: Mapping[str | None, Sequence[str]] = {
    None: ("RECEIVED",),
    "RECEIVED": ("PROCESSING", "FAILED", "QUARANTINED"),
    "PROCESSING": ("CLEANSED", "FAILED", "QUARANTINED"),
    "CLEANSED": ("TRANSFORMED", "FAILED"),
    "TRANSFORMED": ("CURATED", "FAILED"),
    "CURATED": ("PROCESSING", "FAILED", "QUARANTINED"),
    "FAILED": ("PROCESSING", "FAILED", "QUARANTINED"),
    "QUARANTINED": ("PROCESSING", "FAILED", "QUARANTINED"),
}
FINAL = ("CURATED", "QUARANTINED")
# ----------------------------------------------------------------------------------------------


def is_legal(before: F.Column, after: F.Column) -> F.Column:
    """Whether a state may follow another one; NULL before is a new file."""
    allowed = [F.when(before.eqNullSafe(F.lit(state)), after.isin(*following)) for state, following in FOLLOWING.items()]
    return F.coalesce(*allowed, F.lit(False))


def transitions(
    events: DataFrame, at: str = "event_at", tie: str = "event_id", before: DataFrame | None = None
) -> DataFrame:
    """Each event with the state before it, when that began, the seconds since, and whether the
    step is legal: (file_name, event id, before_status, status, began_at, changed_at, seconds, legal).

    `before` are last states known already (file_name, status, changed_at, event id), as
    `last_states` gives them; they come before all events.
    """
    place = F.struct(F.col(at).alias("at"), F.col(tie).alias("id"))
    own = events.select("file_name", F.col("ingestion_status").alias("status"), place.alias("place"), F.to_date(at).alias("day"))
    in_day = Window.partitionBy("file_name", "day").orderBy("place")
    step = F.struct("status", "place")
    known = own.withColumn("earlier", F.lag(step).over(in_day))
    # the last event of the day before stands before a day's first one
    days = own.groupBy("file_name", "day").agg(F.max_by(step, "place").alias("last"))
    if before is not None:
        seed = F.struct("status", F.struct(F.col("changed_at").alias("at"), F.col(tie).alias("id")).alias("place"))
        days = days.unionByName(before.select("file_name", F.lit(None).cast("date").alias("day"), seed.alias("last")))
    of_file = Window.partitionBy("file_name").orderBy(F.col("day").asc_nulls_first())
    days = days.withColumn("day_before", F.lag("last").over(of_file)).where("day IS NOT NULL").select("file_name", "day", "day_before")
    met = known.join(days, ["file_name", "day"]).withColumn("earlier", F.coalesce("earlier", "day_before"))
    return met.select(
        "file_name",
        F.col("place.id").alias(tie),
        F.col("earlier.status").alias("before_status"),
        "status",
        F.col("earlier.place.at").alias("began_at"),
        F.col("place.at").alias("changed_at"),
        F.timestamp_diff("SECOND", F.col("earlier.place.at"), F.col("place.at")).alias("seconds"),
        is_legal(F.col("earlier.status"), F.col("status")).alias("legal"),
    )


def last_states(events: DataFrame, at: str = "event_at", tie: str = "event_id", before: DataFrame | None = None) -> DataFrame:
    """(file_name, status, changed_at, event id): the last state of each file."""
    own = events.select("file_name", F.col("ingestion_status").alias("status"), F.col(at).alias("changed_at"), tie)
    both = own if before is None else own.unionByName(before.select(*own.columns))
    last = F.max_by(F.struct("status", "changed_at", tie), F.struct("changed_at", tie))
    return both.groupBy("file_name").agg(last.alias("last")).select("file_name", "last.*")


def time_in_states(steps: DataFrame) -> DataFrame:
    """Per file and state: how often it was left, and the seconds spent there altogether."""
    left = steps.where("before_status IS NOT NULL")
    return left.groupBy("file_name", F.col("before_status").alias("status")).agg(
        F.count("*").alias("times_left"), F.sum("seconds").alias("seconds")
    )


def illegal_steps(steps: DataFrame) -> DataFrame:
    """How often a state followed another one that it may not follow."""
    wrong = steps.where(~F.col("legal"))
    return wrong.groupBy("before_status", "status").agg(F.count("*").alias("times"), F.countDistinct("file_name").alias("files"))


def stuck_files(last: DataFrame, now: F.Column, limits: Mapping[str, int]) -> DataFrame:
    """Files that have been in a state for longer than its limit in seconds, and how long; a
    state without a limit is one to stay in."""
    seconds = F.timestamp_diff("SECOND", F.col("changed_at"), now)
    over = [(F.col("status") == state) & (seconds > limit) for state, limit in limits.items()]
    found = last.where(reduce(lambda a, b: a | b, over, F.lit(False)))
    return found.select("file_name", "status", "changed_at", seconds.alias("seconds"))


def run_outcomes(runs: DataFrame, keys: Sequence[str] = ("run_id", "pipeline_name")) -> DataFrame:
    """One state of each run over its files: RUNNING while one has not ended, SUCCESS or FAILED
    where all agree, else PARTIAL."""
    grouped = runs.groupBy(*keys).agg(
        F.count("*").alias("files"),
        F.count_if(F.col("run_status") == "FAILED").alias("failed_files"),
        F.count_if(F.col("ended_at").isNull()).alias("open_files"),
    )
    state = (
        F.when(F.col("open_files") > 0, F.lit("RUNNING"))
        .when(F.col("failed_files") == 0, F.lit("SUCCESS"))
        .when(F.col("failed_files") == F.col("files"), F.lit("FAILED"))
        .otherwise(F.lit("PARTIAL"))
    )
    return grouped.withColumn("outcome", state)
