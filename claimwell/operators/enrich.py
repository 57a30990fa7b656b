"""Code tables joined to claims, and the derived columns of a transformed claim.

No join carries a broadcast hint: code tables can grow with the data. Spark broadcasts a
table whose size is below spark.sql.autoBroadcastJoinThreshold and otherwise shuffles both
sides, where AQE splits the partitions of a hot code (a left join may split its left side).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwell.functions import derive, masking
from claimwell.functions.money import cents
from claimwell.schemas import BILLED_BUCKETS, PHI_COLUMNS


class DuplicateCodes(ValueError):
    """A code table lists a code twice, which would multiply claims."""


def duplicate_codes(codes: DataFrame, key: str) -> DataFrame:
    """Codes listed more than once."""
    return (
        codes.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("listed"))
        .filter("listed > 1")
    )


def require_unique(codes: DataFrame, key: str) -> DataFrame:
    """The table itself, after a check that no code repeats."""
    repeated = duplicate_codes(codes, key).limit(5).collect()
    if repeated:
        raise DuplicateCodes(f"{key} repeats in its code table, e.g. {[r[key] for r in repeated]}")
    return codes


def code_table_profile(codes: DataFrame, key: str, name: str) -> DataFrame:
    """One row: listed codes, distinct codes, codes listed twice or more."""
    per_code = codes.groupBy(key).agg(F.count("*").alias("listed"))
    return per_code.agg(
        F.lit(name).alias("code_table"),
        F.sum("listed").alias("listed_codes"),
        F.count(key).alias("distinct_codes"),
        F.count_if(F.col("listed") > 1).alias("repeated_codes"),
    )


def with_codes(claims: DataFrame, cpt: DataFrame, icd10: DataFrame) -> DataFrame:
    """Every claim with the columns of its procedure and diagnosis codes, NULL without a match."""
    return claims.join(cpt, "cpt_code", "left").join(icd10, "icd10_code", "left")


def with_chronic_flag(claims: DataFrame, icd10: DataFrame) -> DataFrame:
    """Only the chronic flag of the diagnosis: what the member summary needs."""
    flags = icd10.select("icd10_code", "chronic_flag")
    joined = claims.join(flags, "icd10_code", "left")
    return joined.withColumn("chronic_flag", derive.is_chronic(F.col("chronic_flag")))


def standardised(
    claims: DataFrame, as_of: date, buckets: Sequence[tuple[str, float]] = BILLED_BUCKETS
) -> DataFrame:
    """Typed and derived claim columns; needs no code table.

    The amount is rounded to cents first and the bucket is taken from the rounded amount.
    """
    return _derived(_typed(claims), as_of, buckets)


def _typed(claims: DataFrame) -> DataFrame:
    return claims.withColumns(
        {
            "cpt_code": F.col("cpt_code").cast("string"),
            "icd10_code": F.col("icd10_code").cast("string"),
            "billed_amount": cents(F.col("billed_amount")),
            "service_date": F.col("service_date").try_cast("date"),
        }
    )


def _derived(typed: DataFrame, as_of: date, buckets: Sequence[tuple[str, float]]) -> DataFrame:
    return typed.withColumns(
        {
            "place_of_service_desc": derive.place_of_service_desc(F.col("place_of_service")),
            "billed_category": derive.billed_category(F.col("billed_amount"), buckets),
            "claim_age_days": derive.claim_age_days(F.col("service_date"), as_of),
        }
    )


def transformed(
    claims: DataFrame,
    cpt: DataFrame,
    icd10: DataFrame,
    as_of: date,
    at: datetime | None = None,
    buckets: Sequence[tuple[str, float]] = BILLED_BUCKETS,
) -> DataFrame:
    """Standardised claims with both code tables; `at` stamps every row of a run alike.

    A code table that is too large for a broadcast sends claims through a shuffle. They travel with
    their hashes in the short form, and what is derived from them comes afterwards.
    """
    hashed = [f"{c}_hash" for c in PHI_COLUMNS if f"{c}_hash" in claims.columns]
    short = _typed(claims).withColumns({c: masking.packed(F.col(c)) for c in hashed})
    out = with_codes(short, cpt, icd10)
    out = _derived(out.withColumns({c: masking.unpacked(F.col(c)) for c in hashed}), as_of, buckets)
    out = out.withColumn("chronic_flag", derive.is_chronic(F.col("chronic_flag")))
    return out if at is None else out.withColumn("transformed_at", F.lit(at))
