"""Summaries of transformed claims.

`by` puts further keys in front of the usual ones: with the columns that name a file the
summary is one per file, without them one over all files. Distinct counts cannot be added
up over files, so the summary over all files is computed from the claims again.

Exact distinct counts run as partial aggregates by (key, value) before any row of a key
meets its siblings, so a payer with a third of all claims is spread over all tasks.
`approximate=True` trades exactness for one small sketch per key.

`member` and `provider` name the columns of the ids. Where claims still have the ids as they
were sent, these are shorter than their hashes; the finished groups are masked then.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwell.functions import masking, money
from claimwell.schemas import BILLED_BUCKETS, MONEY_SUM, TOP_BUCKET


MEMBER, PROVIDER = "member_id_hash", "provider_npi_hash"


def _distinct(column: str, approximate: bool) -> Column:
    """Number of distinct values; hashes are told apart by their bytes, half the size of the
    text, as they travel through the shuffles of a distinct count."""
    value = F.unhex(column) if column.endswith("_hash") else F.col(column)
    return F.approx_count_distinct(value) if approximate else F.count_distinct(value)


def _mean_age() -> Column:
    return F.round(F.avg("claim_age_days"), 1).alias("avg_claim_age_days")


def _summary(
    claims: DataFrame, keys: Sequence[str], figures: Sequence[Column], at_column: str, at: datetime | None
) -> DataFrame:
    """Claims, billed total and billed mean per key, and further figures.

    Total and mean come from one decimal sum per group. Hashed keys travel in their short form.
    """
    short = {k for k in keys if k.endswith("_hash")}
    grouped = claims.groupBy(*[masking.packed(F.col(k)).alias(k) if k in short else F.col(k) for k in keys]).agg(
        F.count("claim_id").alias("total_claims"),
        F.sum("billed_amount").alias("_billed"),
        F.count("billed_amount").alias("_amounts"),
        *figures,
    )
    taken = {*keys, "total_claims", "_billed", "_amounts"}
    others = [c for c in grouped.columns if c not in taken]
    out = grouped.select(
        *[masking.unpacked(F.col(k)).alias(k) if k in short else k for k in keys],
        "total_claims",
        F.col("_billed").cast(MONEY_SUM).alias("total_billed"),
        money.mean_of(F.col("_billed"), F.col("_amounts")).alias("avg_billed"),
        *others,
    )
    return out if at is None else out.withColumn(at_column, F.lit(at))


def payer_category_summary(
    claims: DataFrame, by: Sequence[str] = (), at: datetime | None = None, approximate: bool = False, member: str = MEMBER
) -> DataFrame:
    figures = [
        _mean_age(),
        _distinct(member, approximate).alias("unique_members"),
        _distinct("cpt_code", approximate).alias("unique_cpt_codes"),
    ]
    return _summary(claims, [*by, "payer_id", "billed_category"], figures, "summarized_at", at)


def cpt_summary(
    claims: DataFrame,
    cpt: DataFrame,
    by: Sequence[str] = (),
    at: datetime | None = None,
    approximate: bool = False,
    member: str = MEMBER,
) -> DataFrame:
    """Per procedure code. A code has one description and category, so the code table is
    joined to the finished groups instead of to every claim."""
    figures = [
        _distinct("payer_id", approximate).alias("unique_payers"),
        _distinct(member, approximate).alias("unique_members"),
    ]
    per_code = _summary(claims, [*by, "cpt_code"], figures, "summarized_at", at)
    described = cpt.select("cpt_code", "cpt_description", "cpt_category")
    return per_code.join(described, "cpt_code", "left")


def member_summary(
    claims: DataFrame, by: Sequence[str] = (), at: datetime | None = None, approximate: bool = False,
    member: str = MEMBER, provider: str = PROVIDER,
) -> DataFrame:
    figures = [
        _distinct(provider, approximate).alias("unique_providers"),
        _distinct("payer_id", approximate).alias("unique_payers"),
        F.coalesce(F.bool_or("chronic_flag"), F.lit(False)).alias("has_chronic_condition"),
        F.max("service_date").alias("most_recent_service_date"),
    ]
    return _summary(claims, [*by, member], figures, "curated_at", at)


def payer_summary(
    claims: DataFrame, by: Sequence[str] = (), at: datetime | None = None, approximate: bool = False,
    member: str = MEMBER, provider: str = PROVIDER,
) -> DataFrame:
    buckets = [name for name, _ in BILLED_BUCKETS] + [TOP_BUCKET]
    figures = [
        _distinct(member, approximate).alias("unique_members"),
        _distinct(provider, approximate).alias("unique_providers"),
        _mean_age(),
        *[F.count_if(F.col("billed_category") == b).alias(f"{b.lower()}_claims") for b in buckets],
    ]
    return _summary(claims, [*by, "payer_id"], figures, "curated_at", at)


def provider_summary(
    claims: DataFrame, by: Sequence[str] = (), at: datetime | None = None, approximate: bool = False,
    member: str = MEMBER, provider: str = PROVIDER,
) -> DataFrame:
    figures = [
        _distinct(member, approximate).alias("unique_members"),
        _distinct("payer_id", approximate).alias("unique_payers"),
        _distinct("cpt_code", approximate).alias("unique_cpt_codes"),
    ]
    return _summary(claims, [*by, provider], figures, "curated_at", at)
