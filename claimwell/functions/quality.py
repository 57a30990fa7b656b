"""Record rules: a list of (message, failing condition), and the split they define.

Every condition is TRUE or FALSE, never NULL, so each row is either clean or rejected
and none can be in neither output.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwell.schemas import RAW_MONEY

Rule = tuple[str, str]


@dataclass(frozen=True)
class RuleSet:
    """Rules, and in `clean` the shortest condition that says the same as "no rule fails":
    the rules explain a rejection, the condition splits the rows and is worked out for all."""

    rules: tuple[Rule, ...]
    clean: str

    def and_rules(self, more: Sequence[Rule]) -> RuleSet:
        passing = [f"NOT ({failing})" for _, failing in more]
        return RuleSet((*self.rules, *more), " AND ".join([self.clean, *passing]))


# The messages, in the order in which they are listed for a row.
# `amount` is the billed amount as an exact number, NULL where the text is not one.
CLAIM_RULES = RuleSet(
    rules=(
        ("missing claim_id", "claim_id IS NULL"),
        ("missing member_id", "member_id IS NULL"),
        ("missing provider_npi", "provider_npi IS NULL"),
        ("missing billed_amount", "billed_amount IS NULL"),
        ("invalid billed_amount", "coalesce(amount <= 0, false)"),
        ("unparseable billed_amount", "billed_amount IS NOT NULL AND amount IS NULL"),
    ),
    clean=(
        "claim_id IS NOT NULL AND member_id IS NOT NULL AND provider_npi IS NOT NULL"
        " AND coalesce(amount > 0, false)"
    ),
)

ERROR_SEPARATOR = ", "


def blank_id_rules(columns: Sequence[str] = ("claim_id", "member_id", "provider_npi")) -> tuple[Rule, ...]:
    """Optional rules: an id made of blanks counts as an error too."""
    return tuple((f"blank {c}", f"coalesce(trim({c}) = '', false)") for c in columns)


def with_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", F.col("billed_amount").try_cast(RAW_MONEY))


def passes(rules: RuleSet = CLAIM_RULES) -> Column:
    """No rule fails. A conjunction, so that null tests can reach a Parquet scan."""
    return F.expr(rules.clean)


def errors(rules: RuleSet = CLAIM_RULES) -> Column:
    """Messages of all failing rules in one text; empty for a clean row."""
    return F.concat_ws(ERROR_SEPARATOR, *[F.when(F.expr(f), F.lit(m)) for m, f in rules.rules])


def clean_rows(df: DataFrame, rules: RuleSet = CLAIM_RULES) -> DataFrame:
    return with_amount(df).filter(passes(rules)).drop("amount")


def rejected_rows(df: DataFrame, rules: RuleSet = CLAIM_RULES) -> DataFrame:
    flagged = with_amount(df).filter(~passes(rules))
    return flagged.withColumn("validation_errors", errors(rules)).drop("amount")


def errors_by_file(rejected: DataFrame, file_column: str = "source_file") -> DataFrame:
    """Rejected rows per file and message; a row with two errors counts under both."""
    one_per_error = rejected.select(
        file_column,
        F.explode(F.split("validation_errors", ERROR_SEPARATOR)).alias("validation_error"),
    )
    return one_per_error.groupBy(file_column, "validation_error").agg(
        F.count("*").alias("rejected_claims")
    )
