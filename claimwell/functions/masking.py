"""One-way hashes in place of personal identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwell.schemas import PHI_COLUMNS

SALT_SETTING = "spark.claimwell.phi.salt"


def hashed(value: Column, salt: str | None = None) -> Column:
    """SHA-256 in lower-case hex of the text, with the salt appended; NULL stays NULL."""
    text = value.cast("string")
    return F.sha2(F.concat(text, F.lit(salt)) if salt else text, 256)


def mask(df: DataFrame, columns: Sequence[str] = PHI_COLUMNS, salt: str | None = None) -> DataFrame:
    """Replace each column by `<column>_hash`."""
    return df.withColumns({f"{c}_hash": hashed(F.col(c), salt) for c in columns}).drop(*columns)


#: How the short form of a text begins: that of a hash, that of any other text.
_HASH, _TEXT = bytearray(b"\x00"), bytearray(b"\x01")
_REST = (1 << 31) - 1


def packed(text: Column) -> Column:
    """A short form of a text, for shuffles: the bytes of a SHA-256 instead of its 64 digits.
    Any other text keeps its own, so different texts have different forms."""
    raw = F.unhex(text)
    is_hash = (F.length(text) == 64) & raw.isNotNull() & (F.lower(text) == text)
    form = F.when(is_hash, F.concat(F.lit(_HASH), raw)).otherwise(F.concat(F.lit(_TEXT), text.cast("binary")))
    return F.when(text.isNotNull(), form)


def unpacked(form: Column) -> Column:
    """The text of a short form."""
    rest = F.substring(form, 2, _REST)
    return F.when(F.substring(form, 1, 1) == F.lit(_HASH), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
