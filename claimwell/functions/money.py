"""Exact money: sums and means stay decimal and are rounded half up once, at the end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimwell.schemas import MONEY, MONEY_SUM


def cents(amount: Column) -> Column:
    return amount.cast(MONEY)


def total(amount: str) -> Column:
    return F.sum(amount).cast(MONEY_SUM)


def mean_of(billed: Column, amounts: Column) -> Column:
    """Mean in cents of a sum and its count; NULL where nothing was counted."""
    return F.round(F.try_divide(billed, amounts), 2).cast(MONEY)


def mean(amount: str) -> Column:
    return mean_of(F.sum(amount), F.count(amount))
