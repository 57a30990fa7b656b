"""Transitions of file states from a stream of events, in the order of event time.

Events of a file may come late and mixed. A micro-batch keeps those that are newer than the
watermark (the newest event time less a delay) for later, takes the others in order after
each file's last known state, and stores both under its number; one that is repeated writes
the same again. Events older than the watermark before them are too late and are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimwell.operators.states import last_states, transitions

_LAST = "file_name string, status string, changed_at {at}, event_id {id}"
_MARK = "watermark timestamp, too_late bigint"


def _stored(spark: SparkSession, path: str, number: int, schema: str | T.StructType) -> DataFrame:
    """What a micro-batch stored; nothing before the first one."""
    if number < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/batch={number}")


def follow(events: DataFrame, root: str, delay: str = "1 hour", at: str = "event_at") -> StreamingQuery:
    """Start the stream over what is there: transitions go to `{root}/steps/batch=n`."""
    spark, schema = events.sparkSession, events.schema
    last_schema = _LAST.format(at=schema[at].dataType.simpleString(), id=schema["event_id"].dataType.simpleString())

    def handle(batch: DataFrame, number: int) -> None:
        def store(rows: DataFrame, name: str) -> None:
            rows.write.mode("overwrite").parquet(f"{root}/{name}/batch={number}")

        known = _stored(spark, f"{root}/last", number - 1, last_schema)
        held = _stored(spark, f"{root}/held", number - 1, schema)
        mark = _stored(spark, f"{root}/mark", number - 1, _MARK).first()
        before = mark["watermark"] if mark else None
        in_time = batch if before is None else batch.where(F.col(at) > F.lit(before))
        both = held.unionByName(in_time)
        late = 0 if before is None else batch.where(F.col(at) <= F.lit(before)).count()
        newest = both.agg((F.max(at) - F.expr(f"INTERVAL {delay}")).alias("w")).first()["w"]
        now = max((w for w in (before, newest) if w is not None), default=None)
        ready = both.where(F.lit(False) if now is None else F.col(at) <= F.lit(now))
        store(transitions(ready, at, before=known), "steps")
        store(both.where(F.lit(True) if now is None else F.col(at) > F.lit(now)), "held")
        store(last_states(ready, at, before=known), "last")
        store(spark.createDataFrame([(now, (mark["too_late"] if mark else 0) + late)], _MARK), "mark")

    writer = events.writeStream.foreachBatch(handle).option("checkpointLocation", f"{root}/checkpoint")
    return writer.trigger(availableNow=True).start()


def steps(spark: SparkSession, root: str) -> DataFrame:
    """All transitions so far."""
    return spark.read.parquet(f"{root}/steps").drop("batch")
