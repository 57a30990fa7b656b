"""The reports behind the monitoring and analytics pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwell.functions.money import mean, total
from claimwell.functions.quality import CLAIM_RULES, RuleSet, passes, with_amount
from claimwell.operators.registry import seconds_between
from claimwell.schemas import BILLED_BUCKETS, CLEANSE_JOB, CURATE_JOB, TOP_BUCKET, TRANSFORM_JOB


def file_figures(files: DataFrame) -> DataFrame:
    def having(status: str) -> Column:
        return F.count_if(F.col("ingestion_status") == status)

    return files.agg(
        F.count("*").alias("total_files"),
        having("CURATED").alias("curated"),
        having("FAILED").alias("failed"),
        having("QUARANTINED").alias("quarantined"),
        F.count_distinct("client_code").alias("unique_clients"),
    )


def run_figures(runs: DataFrame) -> DataFrame:
    """Figures of finished runs."""
    finished = runs.filter(F.col("ended_at").isNotNull())
    return finished.agg(
        F.count("*").alias("total_runs"),
        F.count_if(F.col("run_status") == "SUCCESS").alias("successful"),
        F.count_if(F.col("run_status") == "FAILED").alias("failed"),
        F.round(F.avg(seconds_between("started_at", "ended_at")), 1).alias("avg_duration_secs"),
    )


def member_figures(members: DataFrame) -> DataFrame:
    """Figures over the member summary; the mean is the mean of the members' means."""
    return members.agg(
        F.count("*").alias("total_members"),
        F.sum("total_claims").alias("total_claims"),
        total("total_billed").alias("total_billed"),
        mean("avg_billed").alias("avg_billed_per_member"),
        F.count_if("has_chronic_condition").alias("chronic_members"),
    )


def by_total_billed(summary: DataFrame, key: str) -> DataFrame:
    return summary.orderBy(F.col("total_billed").desc_nulls_last(), key)


def top_by_total_billed(summary: DataFrame, key: str, n: int = 20) -> DataFrame:
    return by_total_billed(summary, key).limit(n)


def chronic_split(members: DataFrame) -> DataFrame:
    label = F.when(F.col("has_chronic_condition"), "Chronic").otherwise("Non-Chronic")
    return members.groupBy(label.alias("label")).agg(F.count("*").alias("members"))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Rows per equal-width bin between the least and the greatest value of a column.

    The greatest value belongs to the last bin. The range is one aggregate, which the plan
    uses as a scalar subquery.
    """
    x = df.select(F.col(column).cast("double").alias("x")).filter("x IS NOT NULL")
    ends = x.agg(F.struct(F.min("x").alias("low"), F.max("x").alias("high"))).scalar()
    placed = x.withColumn("ends", ends).selectExpr(
        "x",
        "ends.low AS low",
        "ends.high - ends.low AS span",
    )
    place = F.floor(F.try_divide(F.col("x") - F.col("low"), F.col("span") / F.lit(bins)))
    # No span, no division: all values are equal and share the first bin.
    bin_of = F.when(F.col("span") == 0, F.lit(0)).otherwise(F.least(place, F.lit(bins - 1)))
    return placed.groupBy(bin_of.cast("int").alias("bin")).agg(F.count("*").alias("members"))


def category_volumes(payers: DataFrame) -> DataFrame:
    """Claims per payer and bucket in long form, for a stacked bar."""
    names = [b for b, _ in BILLED_BUCKETS] + [TOP_BUCKET]
    named = payers.select("payer_id", *[F.col(f"{b.lower()}_claims").alias(b) for b in names])
    return named.unpivot(["payer_id"], names, "category", "claims")


def stage_counts(runs: DataFrame) -> DataFrame:
    """Rows that each stage read, wrote and rejected, summed over its runs."""
    counters = ("records_read", "records_written", "records_rejected")
    return runs.groupBy("pipeline_name").agg(*[F.sum(c).alias(c) for c in counters])
