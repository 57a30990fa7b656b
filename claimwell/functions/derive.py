"""Derived claim fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimwell.schemas import BILLED_BUCKETS, OTHER_PLACE, PLACES_OF_SERVICE, TOP_BUCKET


def decoded(code: Column, meanings: Mapping[int, str], default: str) -> Column:
    """The meaning of a code; `default` for an unknown or missing one."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(meanings.items())])
    return F.coalesce(F.try_element_at(table, code), F.lit(default))


def place_of_service_desc(code: Column) -> Column:
    return decoded(code.try_cast("int"), PLACES_OF_SERVICE, OTHER_PLACE)


def billed_category(
    amount: Column,
    buckets: Sequence[tuple[str, float]] = BILLED_BUCKETS,
    top: str = TOP_BUCKET,
) -> Column:
    """First bucket whose bound lies above the amount; `top` when none does or it is NULL."""
    below = [F.when(amount < F.lit(bound), F.lit(name)) for name, bound in buckets]
    return F.coalesce(*below, F.lit(top))


def claim_age_days(service_date: Column, as_of: date) -> Column:
    """Whole days from service to `as_of`; negative for a future date, NULL for none."""
    return F.datediff(F.lit(as_of), service_date)


def is_chronic(flag: Column) -> Column:
    """Only the word true counts, in any case; a missing flag is false."""
    return F.coalesce(F.lower(F.trim(flag)) == "true", F.lit(False))
