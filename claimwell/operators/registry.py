"""Files and runs: current status, registration, decisions on arrivals, lineage, queues.

The registry is a table of status events. Nothing is updated in place: a change of status
is one more event and the current row of a file is its latest event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwell.functions.filenames import parse_names, with_file_fields
from claimwell.operators.dedupe import first_per_key
from claimwell.schemas import CURATE_JOB

TRIGGER, SKIP, INVALID, DUPLICATE = "TRIGGER", "SKIP", "INVALID", "DUPLICATE"


def latest_status(
    events: DataFrame, at: str = "received_at", tie: str = "event_id"
) -> DataFrame:
    """The latest event of each file."""
    newest_first = [F.col(at).desc_nulls_last(), F.col(tie).desc_nulls_last()]
    return first_per_key(events, ["file_name"], newest_first)


RECEIVED_FIELDS = (
    "source_id", "bucket_name", "object_key", "file_size_bytes", "file_hash", "received_at",
    "source_name", "client_code", "file_type", "env", "sequence",
)
STATUS_FIELDS = ("event_id", "ingestion_status", "processed_at", "error_message", "event_at")


def current_files(events: DataFrame) -> DataFrame:
    """The registry row of each file: what its first event says of the file itself, and the
    status of its latest one. One aggregate with partial results."""
    place = F.struct("event_at", "event_id")
    first = F.min_by(F.struct(*RECEIVED_FIELDS), place).alias("first")
    last = F.max_by(F.struct(*STATUS_FIELDS), place).alias("last")
    return events.groupBy("file_name").agg(first, last).select("file_name", "first.*", "last.*")


def decide(arrivals: DataFrame, events: DataFrame, force: bool = False, **latest: str) -> DataFrame:
    """Each arrival with its latest status and what to do with it.

    A refused name is INVALID (to be held), a file already CURATED is a SKIP unless forced,
    anything else is a TRIGGER.
    """
    # only the history of the names that arrived is ranked
    own = events.join(arrivals.select("file_name").distinct(), "file_name", "left_semi")
    status = latest_status(own, **latest).select(
        "file_name", F.col("ingestion_status").alias("latest_status")
    )
    named = parse_names(arrivals)
    known = named.join(status, "file_name", "left")
    done = F.coalesce(F.col("latest_status") == "CURATED", F.lit(False)) & F.lit(not force)
    action = (
        F.when(F.col("reject_reason").isNotNull(), F.lit(INVALID))
        .when(done, F.lit(SKIP))
        .otherwise(F.lit(TRIGGER))
    )
    return known.withColumn("action", action)


def without_copies(decisions: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Decisions in which the first arrival of a name is a TRIGGER and its copies, in other
    folders, are DUPLICATEs."""
    place = F.row_number().over(Window.partitionBy("file_name").orderBy(*order))
    copy = (F.col("action") == TRIGGER) & (place > 1)
    return decisions.withColumn("action", F.when(copy, F.lit(DUPLICATE)).otherwise(F.col("action")))


def action_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("action").agg(F.count("*").alias("files"))


def same_content(files: DataFrame, known: DataFrame) -> DataFrame:
    """(file_name, same_as): files (file_name, file_hash) whose content a CURATED file of another
    name has, or another one of `files` that comes first by name. `known` are registry rows."""
    own = files.where(F.col("file_hash").isNotNull())
    done = known.where(F.col("ingestion_status") == "CURATED").select("file_hash", F.col("file_name").alias("other"))
    before = own.select("file_hash", F.col("file_name").alias("other"))
    curated = F.lit(True)
    both = done.withColumn("done", curated).unionByName(before.withColumn("done", ~curated))
    # of a digest, only the first two names of either kind can matter
    place = F.row_number().over(Window.partitionBy("file_hash", "done").orderBy("other"))
    few = both.withColumn("place", place).where("place <= 2")
    met = own.join(few, "file_hash").where(
        (F.col("other") != F.col("file_name")) & (F.col("done") | (F.col("other") < F.col("file_name")))
    )
    first = F.min_by("other", F.struct(~F.col("done"), "other"))
    return met.groupBy("file_name").agg(first.alias("same_as"))


def unregistered(arrivals: DataFrame, events: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The first arrival of each valid file name that no event knows yet, with its fields."""
    valid = with_file_fields(arrivals).filter(F.col("client_code").isNotNull())
    known = events.select("file_name")
    new = valid.join(known, "file_name", "left_anti")
    return first_per_key(new, ["file_name"], order)


def newest(df: DataFrame, at: str, ties: Sequence[str], n: int) -> DataFrame:
    """The n newest rows. `ties` makes the choice definite."""
    return df.orderBy(F.col(at).desc_nulls_last(), *[F.col(t) for t in ties]).limit(n)


def seconds_between(start: str, end: str) -> Column:
    """Whole seconds from start to end."""
    return F.timestamp_diff("SECOND", F.col(start), F.col(end))


def newest_files(files: DataFrame, n: int = 50, ties: Sequence[str] = ("file_name",)) -> DataFrame:
    return newest(files, "received_at", ties, n)


def newest_runs(runs: DataFrame, n: int = 50, ties: Sequence[str] = ("run_id",)) -> DataFrame:
    timed = runs.withColumn("duration_secs", seconds_between("started_at", "ended_at"))
    return newest(timed, "started_at", ties, n)


def paired_lineage(
    files: DataFrame, runs: DataFrame, n: int = 20, file_tie: str = "file_id", run_tie: str = "run_id"
) -> DataFrame:
    """The n newest (file, curate run) pairs, every file being paired with every such run.

    The pairs are ordered by file first, so only the n newest files and the first n runs can
    take part. Both are cut to n rows before they meet, and they meet on the file's rank.
    """
    curate = runs.filter(F.col("pipeline_name") == CURATE_JOB)
    first_runs = curate.orderBy(run_tie).limit(n)
    top_files = newest_files(files, n, (file_tie,))
    one_group = Window.orderBy(F.col("received_at").desc_nulls_last(), file_tie)
    ranked = top_files.withColumn("file_rank", F.row_number().over(one_group))
    spread = first_runs.withColumn("file_rank", F.explode(F.sequence(F.lit(1), F.lit(n))))
    pairs = ranked.join(spread, "file_rank")
    timed = pairs.withColumn("duration_secs", seconds_between("started_at", "ended_at"))
    return timed.orderBy("file_rank", run_tie).limit(n).drop("file_rank")


def keyed_lineage(files: DataFrame, runs: DataFrame) -> DataFrame:
    """Every file with its own runs."""
    timed = runs.withColumn("duration_secs", seconds_between("started_at", "ended_at"))
    return files.join(timed, "file_name")


def next_in_queue(files: DataFrame) -> DataFrame:
    """The file each (client, type) queue should take next: oldest date, then sequence."""
    order = [F.col("file_date"), F.col("sequence"), F.col("env"), F.col("file_name")]
    return first_per_key(files, ["client_code", "file_type"], order)
