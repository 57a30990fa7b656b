"""Summaries in parts: what each file adds to them, so that files can be added and taken out.

A file's part of all summaries is two tables. *Sums* hold what can be added and subtracted,
by summary and key. *Links* hold which values occur together (a payer and a member, say),
each pair once; over many files a pair has the number of files that hold it, so that a
distinct count is a count of pairs whose number is above zero. A file that is replaced is
taken out by adding its parts with the opposite sign. Claims of other files are not read again.

The parts of a file are larger than its claims, so they are made when a rollup needs them, from
what they need of claims, and only their sums are stored. Linked values are kept in their short form.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwell.functions import masking, money
from claimwell.schemas import BILLED_BUCKETS, MONEY_SUM, TOP_BUCKET

BUCKETS = [name for name, _ in BILLED_BUCKETS] + [TOP_BUCKET]
SUMS = ("total_claims", "billed", "amounts", "age_days", "aged", *[f"{b.lower()}_claims" for b in BUCKETS], "chronic_claims")
SUM_KEYS, LINK_KEYS = ("summary", "key", "key2"), ("link", "a", "b", "category")


@dataclass(frozen=True)
class Parts:
    """How a summary is put together: its keys, its distinct counts as (link, side of the key),
    and its further figures."""

    keys: tuple[str, ...]
    distinct: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    mean_age: bool = False
    buckets: bool = False
    chronic: bool = False


#: The values that a link joins: a, b, and whether each amount category counts by itself.
LINKS = {
    "payer-member": ("payer_id", "member_id_hash", True),
    "payer-cpt": ("payer_id", "cpt_code", True),
    "cpt-member": ("cpt_code", "member_id_hash", False),
    "member-provider": ("member_id_hash", "provider_npi_hash", False),
    "payer-provider": ("payer_id", "provider_npi_hash", False),
    "provider-cpt": ("provider_npi_hash", "cpt_code", False),
    "member-day": ("member_id_hash", "service_date", False),
}
SUMMARIES = {
    "payer_category_summary": Parts(
        ("payer_id", "billed_category"), {"unique_members": ("payer-member", "a"), "unique_cpt_codes": ("payer-cpt", "a")}, mean_age=True
    ),
    "cpt_summary": Parts(("cpt_code",), {"unique_payers": ("payer-cpt", "b"), "unique_members": ("cpt-member", "a")}),
    "member_summary": Parts(
        ("member_id_hash",), {"unique_providers": ("member-provider", "a"), "unique_payers": ("payer-member", "b")}, chronic=True
    ),
    "payer_summary": Parts(
        ("payer_id",), {"unique_members": ("payer-member", "a"), "unique_providers": ("payer-provider", "a")}, mean_age=True, buckets=True
    ),
    "provider_summary": Parts(
        ("provider_npi_hash",),
        {"unique_members": ("member-provider", "b"), "unique_payers": ("payer-provider", "b"), "unique_cpt_codes": ("provider-cpt", "a")},
    ),
}
UNIQUES = ("unique_members", "unique_providers", "unique_payers", "unique_cpt_codes")
_LATEST = "member-day"
_IDS = ("payer_id", "member_id_hash", "provider_npi_hash", "cpt_code")


def shortened(claims: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What the parts need of claims, ids in their short form: that is most of the work on a claim,
    so it is done once for all parts."""
    has_id = F.when(F.col("claim_id").isNotNull(), F.lit(True)).alias("claim_id")
    ids = [masking.packed(F.col(c)).alias(c) for c in _IDS]
    return claims.select(*by, has_id, *ids, "billed_category", "service_date", "billed_amount", "claim_age_days", "chronic_flag")


def sums_of(claims: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What claims add to the sums of every summary: one pass, with partial results before
    the shuffle, for each of `by` (the file) on its own."""
    return sums_of_short(shortened(claims, by), by)


def sums_of_short(short: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same of `shortened` claims."""
    keys = [
        F.struct(F.lit(name).alias("summary"), F.col(p.keys[0]).alias("key"), (F.col(p.keys[1]) if p.keys[1:] else F.lit(None).cast("string")).alias("key2"))
        for name, p in SUMMARIES.items()
    ]
    each = short.select("*", F.explode(F.array(*keys)).alias("_of")).select("*", "_of.*")
    added = each.groupBy(*by, *SUM_KEYS).agg(
        F.count("claim_id").alias("total_claims"),
        F.sum("billed_amount").cast(MONEY_SUM).alias("billed"),
        F.count("billed_amount").alias("amounts"),
        F.sum(F.col("claim_age_days").cast("bigint")).alias("age_days"),
        F.count("claim_age_days").alias("aged"),
        *[F.count_if(F.col("billed_category") == b).alias(f"{b.lower()}_claims") for b in BUCKETS],
        F.count_if("chronic_flag").alias("chronic_claims"),
        F.lit(1).cast("bigint").alias("files"),
    )
    return added.withColumn("key", masking.unpacked(F.col("key")))


def links_of(claims: DataFrame, by: Sequence[str] = (), names: Sequence[str] = tuple(LINKS)) -> DataFrame:
    """Which values occur together in claims, each pair once (for each of `by`); of all links or some.

    The latest day of a member is the greatest of the files' latest days, so a file keeps
    one day for each member.
    """
    short = shortened(claims, by)
    return reduce(DataFrame.unionByName, [_pairs(short, name, by).distinct() for name in LINKS if name in names])


def _pairs(short: DataFrame, link: str, by: Sequence[str]) -> DataFrame:
    """The pairs of one link, as often as claims have them."""
    a, b, split = LINKS[link]
    none = F.lit(None).cast("string")
    if link == _LATEST:
        rows = short.groupBy(*by, F.col(a).alias("a")).agg(masking.packed(F.max(b).cast("string")).alias("b"))
        category = none
    else:
        rows = short.select(*by, F.col(a).alias("a"), F.col(b).alias("b"), "billed_category")
        category = F.col("billed_category") if split else none
    return rows.select(*by, F.lit(link).alias("link"), "a", "b", category.alias("category"), F.lit(1).cast("bigint").alias("files"))


def next_links(link: str, by: str, held: DataFrame | None, came: DataFrame | None, went: DataFrame | None) -> DataFrame:
    """One link with the number of files that hold each pair: pairs that are held so far, and those
    of `shortened` claims that came and went.

    Ids other than payers make nearly as many pairs as claims, so nothing is gained by adding up
    before a shuffle: such pairs are dealt by their two values, and files and pairs are counted
    where they lie. Payers may be few, so their pairs are first made distinct.
    """
    few = LINKS[link][0] == "payer_id" or link == _LATEST
    found = [_pairs(came, link, [by])] if came is not None else []
    found += [taken_out(_pairs(went, link, [by]))] if went is not None else []
    so_far = [] if held is None else [held.select(F.lit(None).cast("string").alias(by), *LINK_KEYS, "files")]
    if few:
        return added_links(*so_far, *[p.distinct() for p in found])
    # a held pair has no file, so it stays by itself, and a file that came and went has both signs
    each = reduce(DataFrame.unionByName, [*so_far, *found]).repartition("a", "b")
    return added_links(each.distinct())


def taken_out(rows: DataFrame) -> DataFrame:
    """Parts with the opposite sign."""
    return rows.withColumns({c: -F.col(c) for c in (*SUMS, "files") if c in rows.columns})


def added_sums(*parts: DataFrame) -> DataFrame:
    """Sums of all parts; keys that no file holds any more are gone."""
    each = reduce(DataFrame.unionByName, [p.select(*SUM_KEYS, *SUMS, "files") for p in parts])
    found = each.groupBy(*SUM_KEYS).agg(*[F.sum(c).alias(c) for c in (*SUMS, "files")]).where("files > 0")
    return found.withColumn("billed", F.col("billed").cast(MONEY_SUM))


def added_links(*parts: DataFrame) -> DataFrame:
    """Links of all parts with the number of files that hold them."""
    each = reduce(DataFrame.unionByName, [p.select(*LINK_KEYS, "files") for p in parts])
    return each.groupBy(*LINK_KEYS).agg(F.sum("files").alias("files")).where("files > 0")


def _uniques(links: DataFrame, name: str) -> DataFrame:
    """(key, key2, figure, n): the distinct counts of a summary.

    A pair is counted once for its key, also where several amount categories hold it: such
    pairs are made distinct before they meet their key, so a large key is spread over tasks. Other
    links hold a pair once, so they are counted where they lie.
    """
    parts = SUMMARIES[name]
    found = []
    for figure, (link, side) in parts.distinct.items():
        other = "b" if side == "a" else "a"
        key2 = F.col("category") if "billed_category" in parts.keys else F.lit(None).cast("string")
        pairs = links.where((F.col("link") == link) & F.col(other).isNotNull())
        pairs = pairs.select(F.col(side).alias("key"), key2.alias("key2"), F.col(other).alias("value"))
        if LINKS[link][2] and "billed_category" not in parts.keys:
            pairs = pairs.distinct()
        counted = pairs.groupBy("key", "key2").agg(F.count("*").alias("n")).withColumn("figure", F.lit(figure))
        found.append(counted.withColumn("key", masking.unpacked(F.col("key"))))
    return reduce(DataFrame.unionByName, found)


def finished(name: str, sums: DataFrame, links: DataFrame) -> DataFrame:
    """A summary over all files from added sums and links, with the columns of the summary
    that is computed from claims (a code's description and time stamps apart)."""
    parts = SUMMARIES[name]
    figures = {c: F.col(c) for c in SUMS} | {"latest": F.lit(None).cast("date")}
    figures |= {u: F.lit(None).cast("bigint") for u in parts.distinct}
    rows = sums.where(F.col("summary") == name).select("key", "key2", *[v.alias(c) for c, v in figures.items()])
    none = {c: F.lit(None).cast(t) for c, t in rows.dtypes if c not in ("key", "key2")}

    def only(df: DataFrame, **given: Column) -> DataFrame:
        return df.select("key", "key2", *[given.get(c, v).alias(c) for c, v in none.items()])

    uniques = _uniques(links, name)
    counted = only(uniques, **{u: F.when(F.col("figure") == u, F.col("n")) for u in parts.distinct})
    rows = rows.unionByName(counted)
    if parts.chronic:
        days = links.where(F.col("link") == _LATEST).groupBy("a").agg(F.max("b").alias("b"))  # as texts, days are in order
        days = days.select(masking.unpacked(F.col("a")).alias("key"), F.lit(None).cast("string").alias("key2"), masking.unpacked(F.col("b")).alias("b"))
        rows = rows.unionByName(only(days, latest=F.col("b").cast("date")))
    # one row of sums for each key, and those of its distinct counts
    grouped = rows.groupBy("key", "key2").agg(
        *[F.sum(c).alias(c) for c in SUMS],
        *[F.coalesce(F.max(u), F.lit(0).cast("bigint")).alias(u) for u in parts.distinct],
        F.max("latest").alias("most_recent_service_date"),
    )
    out = {key: F.col(place) for key, place in zip(parts.keys, ("key", "key2"))}
    out |= {
        "total_claims": F.col("total_claims"),
        "total_billed": F.col("billed").cast(MONEY_SUM),
        "avg_billed": money.mean_of(F.col("billed"), F.col("amounts")),
    }
    if parts.mean_age:
        out["avg_claim_age_days"] = F.round(F.try_divide(F.col("age_days").cast("double"), F.col("aged")), 1)
    out |= {u: F.col(u) for u in parts.distinct}
    if parts.buckets:
        out |= {f"{b.lower()}_claims": F.col(f"{b.lower()}_claims") for b in BUCKETS}
    if parts.chronic:
        out |= {"has_chronic_condition": F.col("chronic_claims") > 0, "most_recent_service_date": F.col("most_recent_service_date")}
    return grouped.select(*[c.alias(n) for n, c in out.items()])


def sketches_of(claims: DataFrame, by: Sequence[str] = (), lg_k: int = 12) -> DataFrame:
    """Approximate distinct counts in parts: a sketch of each counted value, by summary and key.

    Sketches of files can be joined but not taken out, so they suit tables whose files are
    not replaced, or a fresh join over the current files.
    """
    found = []
    for name, parts in SUMMARIES.items():
        key2 = F.col(parts.keys[1]) if parts.keys[1:] else F.lit(None).cast("string")
        for figure, (link, side) in parts.distinct.items():
            value = LINKS[link][1 if side == "a" else 0]
            grouped = claims.groupBy(*by, F.col(parts.keys[0]).alias("key"), key2.alias("key2"))
            sketch = grouped.agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias("sketch"))
            found.append(sketch.select(*by, F.lit(name).alias("summary"), "key", "key2", F.lit(figure).alias("figure"), "sketch"))
    return reduce(DataFrame.unionByName, found)


def joined_sketches(*parts: DataFrame) -> DataFrame:
    """(summary, key, key2, figure, estimate) over all parts."""
    each = reduce(DataFrame.unionByName, [p.select(*SUM_KEYS, "figure", "sketch") for p in parts])
    return each.groupBy(*SUM_KEYS, "figure").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
