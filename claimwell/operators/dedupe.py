"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in `order`, which should rank every row (a total order).

    Spark turns the rank filter into a limit of one row per key before the shuffle, so the
    copies of a hot key shrink to one per task where they are read.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def one_per_claim(
    claims: DataFrame, newest: Sequence[str] = (), within: Sequence[str] = ()
) -> DataFrame:
    """One row per claim_id: greatest in the `newest` columns, then least in all others.

    `within` are further keys, such as the file, inside which a claim may appear once. Rows
    without a claim_id cannot be told to be the same claim, so all of them stay.
    """
    keys = [*within, "claim_id"]
    taken = {*newest, *keys}
    order = [F.col(c).desc_nulls_last() for c in newest]
    for name, kind in claims.dtypes:
        if name not in taken:
            value = F.to_json(F.array_sort(F.map_entries(name))) if kind.startswith("map") else F.col(name)
            order.append(value.asc_nulls_last())
    named = first_per_key(claims.where("claim_id IS NOT NULL"), keys, order)
    return named.unionByName(claims.where("claim_id IS NULL"))
