"""The file-name grammar as column expressions over a table of file names.

A name is {CLIENT}_{TYPE}_{ENV}_{YYYYMMDD}_{SEQ}.csv. The pattern decides whether it is
well formed; a well-formed name holds exactly four underscores, so a split gives its parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwell.schemas import ENVIRONMENTS, FILE_KEYS, FILE_TYPES

# Fixed value: the pattern of an accepted name, closed by the very end of the text.
NAME_PATTERN = (
    r"^[A-Z0-9]{3,10}"
    rf"_({'|'.join(FILE_TYPES)})"
    rf"_({'|'.join(ENVIRONMENTS)})"
    r"_[0-9]{8}_[0-9]{3}[.]csv\z"
)


def well_formed(name: Column) -> Column:
    return F.coalesce(name.rlike(NAME_PATTERN), F.lit(False))


def stem(name: Column) -> Column:
    """The name without its four characters of extension."""
    return F.substring(name, F.lit(1), F.length(name) - 4)


def real_date(digits: Column) -> Column:
    """Whether eight digits are a day of the calendar (the calendar starts with year 1)."""
    return F.try_to_date(digits, "yyyyMMdd").isNotNull() & (F.substring(digits, 1, 4) != "0000")


def _with_parts(df: DataFrame, name: str) -> DataFrame:
    """`_parts`, the parts of a well-formed name, and `_dated`, whether its date exists.

    Both are columns of their own, so that Spark works them out once per row.
    """
    parts = F.when(well_formed(F.col(name)), F.split(stem(F.col(name)), "_"))
    dated = F.coalesce(real_date(F.get("_parts", F.lit(3))), F.lit(False))
    return df.withColumn("_parts", parts).withColumn("_dated", dated)


def _fields() -> dict[str, Column]:
    return {key: F.when(F.col("_dated"), F.get("_parts", F.lit(i))) for i, key in enumerate(FILE_KEYS)}


def with_file_fields(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Add client_code, file_type, env, file_date and sequence; all NULL for a refused name."""
    return _with_parts(df, name).withColumns(_fields()).drop("_parts", "_dated")


def parse_names(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Everything a file name says: fields, stem, partition key, PROD mark, reject reason."""
    given, date_part = F.col(name), F.get("_parts", F.lit(3))
    quoted = F.concat(F.lit("'"), given, F.lit("'"))
    reason = F.when(F.col("_parts").isNull(), F.concat(F.lit("Invalid filename: "), quoted)).when(
        ~F.col("_dated"),
        F.concat(F.lit("Invalid date '"), date_part, F.lit("' in filename "), quoted),
    )
    named = _with_parts(df, name).withColumns({**_fields(), "reject_reason": reason})
    return named.withColumns(
        {
            "stem": F.when(F.col("_dated"), stem(given)),
            "partition_key": partition_key(),
            "is_prod": F.col("env") == "PROD",
        }
    ).drop("_parts", "_dated")


def partition_key() -> Column:
    """client/type/env/date_sequence of a parsed file, NULL for a refused name."""
    return F.concat(
        F.col("client_code"), F.lit("/"), F.col("file_type"), F.lit("/"), F.col("env"), F.lit("/"),
        F.col("file_date"), F.lit("_"), F.col("sequence"),
    )
