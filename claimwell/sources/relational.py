"""Audit tables kept in a relational database, read and appended over JDBC.

The lake's own audit tables are the default. The driver jar of the database has to be on
the classpath of the session.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    pieces: int = 8,
) -> DataFrame:
    """A table; with a numeric column to split on, `pieces` tasks read it side by side."""
    if split_on is None or bounds is None:
        return spark.read.jdbc(url, table, properties=dict(properties))
    low, high = bounds
    return spark.read.jdbc(
        url, table, column=split_on, lowerBound=low, upperBound=high,
        numPartitions=pieces, properties=dict(properties),
    )


def append_rows(rows: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    rows.write.jdbc(url, table, mode="append", properties=dict(properties))
