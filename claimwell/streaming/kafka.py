"""Claim records from Kafka topics, one JSON object per message.

The Kafka connector has to be on the classpath of the session (it is not part of PySpark).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwell.schemas import RAW_CLAIM


def claim_records(messages: DataFrame) -> DataFrame:
    """Claims as texts; the message key is the name of the logical file."""
    fields = F.from_json(F.col("value").cast("string"), RAW_CLAIM)
    parsed = messages.select(
        F.col("key").cast("string").alias("source_file"), fields.alias("claim"), "timestamp"
    )
    return parsed.select("source_file", "claim.*", F.col("timestamp").alias("arrived_at"))


def read_claim_topic(
    spark: SparkSession, servers: str, topic: str, max_per_batch: int = 1_000_000
) -> DataFrame:
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_per_batch)
        .load()
    )
    return claim_records(messages)
