"""Lineage while it happens: a stream of file events joined to a stream of runs.

A micro-batch joins its rows to each other and to the rows kept from before, writes the pairs
under its number and keeps the rows that later ones may still need; one that is repeated
writes the same again. The join is one of tables, so it spills where memory ends. Rows meet by
file and by stretches of time, so an event never meets all runs there ever were over its file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimwell.session import freeing_shuffles, widening_joins
from claimwell.streaming.states import _stored

_MARK = "newest_file bigint, newest_run bigint, watermark bigint, too_late bigint"
#: A day is longer than 24 hours where clocks are set back.
_CLOCK_CHANGE = "3 hours"


def _micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def _length(interval: str) -> str:
    return f"unix_micros(timestamp_micros(0) + INTERVAL {interval})"


def left_join_runs(files: DataFrame, runs: DataFrame, within: str, at: str, started: str) -> DataFrame:
    """Each file event with the runs over its file that started at most `within` later, or
    with none. `within` is in days or shorter units.

    An event lies in one stretch of time, a little longer than `within`; a run lies in its own
    and in the one before. So each pair meets once, and rows meet by file and stretch.
    """
    stretch = F.expr(f"{_length(within)} + {_length(_CLOCK_CHANGE)}")
    # The end of the range is made once for an event and not for each run it meets.
    placed = files.withColumns({"_stretch": F.floor(_micros(F.col(at)) / stretch), "_until": F.col(at) + F.expr(f"INTERVAL {within}")})
    own = F.floor(_micros(F.col(started)) / stretch)
    twice = runs.withColumn("_run_stretch", F.explode(F.array(own, own - 1))).withColumnRenamed("file_name", "_run_file")
    same = (F.col("file_name") == F.col("_run_file")) & (F.col("_stretch") == F.col("_run_stretch"))
    in_range = (F.col(started) >= F.col(at)) & (F.col(started) <= F.col("_until"))
    return placed.join(twice, same & in_range, "left").drop("_stretch", "_until", "_run_stretch", "_run_file")


def follow(
    files: DataFrame, runs: DataFrame, root: str, within: str = "1 day", delay: str = "1 hour",
    at: str = "received_at", started: str = "started_at",
) -> StreamingQuery:
    """Start the stream over what is there: each file event with the runs over its file that
    started at most `within` later, or with none once the watermark says that none can come any
    more, goes to `{root}/pairs/batch=n`.

    The watermark is the older of the two sides' newest times, in milliseconds, less `delay`.
    Rows not newer than the one before them are too late and are counted. A row is kept until
    the watermark is `within` past it, so what is kept is bounded by the range and the delay.
    Column names of the two sides must differ, but for file_name; their times are of one type.
    """
    if set(files.columns) & set(runs.columns) != {"file_name"}:
        raise ValueError("file events and runs share other columns than file_name")
    spark = files.sparkSession
    both = files.unionByName(runs, allowMissingColumns=True)
    schema, time, range_ = both.schema, F.coalesce(at, started), F.expr(f"INTERVAL {within}")

    def handle(batch: DataFrame, number: int) -> None:
        batch.persist()  # it is read four times
        try:
            take(batch, number)
        finally:
            batch.unpersist()

    def take(batch: DataFrame, number: int) -> None:
        def store(rows: DataFrame, name: str) -> None:
            rows.write.mode("overwrite").parquet(f"{root}/{name}/batch={number}")

        mark = _stored(spark, f"{root}/mark", number - 1, _MARK).first()
        newest_file, newest_run, before, late = mark or (None, None, None, 0)
        too_late = F.lit(False) if before is None else _micros(time) <= before
        seen = batch.agg(
            _micros(F.max(at)).alias("file"), _micros(F.max(started)).alias("run"), F.count_if(too_late).alias("late")
        ).first()
        newest_file = max((t for t in (newest_file, seen["file"]) if t is not None), default=None)
        newest_run = max((t for t in (newest_run, seen["run"]) if t is not None), default=None)
        now = before
        if newest_file is not None and newest_run is not None:
            least = F.date_trunc("millisecond", F.timestamp_micros(F.lit(min(newest_file, newest_run))))
            after = spark.range(1).select(_micros(least - F.expr(f"INTERVAL {delay}"))).first()[0]
            now = after if before is None else max(before, after)

        held = _stored(spark, f"{root}/held", number - 1, schema).withColumn("_new", F.lit(False))
        known = held.unionByName(batch.where(~too_late).withColumn("_new", F.lit(True)))
        events = known.where(F.col(at).isNotNull()).select(*files.columns, "_new")
        started_runs = known.where(F.col(started).isNotNull()).select(*runs.columns, F.col("_new").alias("_new_run"))
        joined = left_join_runs(events, started_runs, within, at, started)
        over = F.lit(False) if now is None else _micros(F.col(at) + range_) < now
        without = F.col("_new_run").isNull()
        with freeing_shuffles(spark), widening_joins(spark):
            store(joined.where(F.when(without, over).otherwise(F.col("_new") | F.col("_new_run"))).drop("_new", "_new_run"), "pairs")
        kept = F.lit(True) if now is None else _micros(time + range_) >= now
        store(known.where(kept & time.isNotNull()).drop("_new"), "held")
        store(spark.createDataFrame([(newest_file, newest_run, now, late + seen["late"])], _MARK), "mark")

    writer = both.writeStream.foreachBatch(handle).option("checkpointLocation", f"{root}/checkpoint")
    return writer.trigger(availableNow=True).start()


def pairs(spark: SparkSession, root: str) -> DataFrame:
    """All pairs, and events without a run, so far."""
    return spark.read.parquet(f"{root}/pairs").drop("batch")
