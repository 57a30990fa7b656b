"""Summaries over all files, kept up from the parts of files that came, changed or went.

A version holds the added sums and links of all files that were current when it was made. The
next one is that version, plus the parts of files that are new or replaced since, minus those
of the snapshots that they replaced. Both are made from the claims of these snapshots; claims of
files that stayed are not read. A version is seen once its row is in the `rollups` table, so a broken update
leaves the version before in place.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwell.operators import partials
from claimwell.schemas import FILE_KEYS, ROLLUP
from claimwell.sources.lake import Lake
from claimwell.sources.layout import SNAPSHOT_COLUMN

_FILE = [*FILE_KEYS, SNAPSHOT_COLUMN]
ZONE = "transformed_claims"


def latest_version(lake: Lake, as_of: datetime | None = None) -> str | None:
    """The version that was current at a time (default: now); one row comes to the driver."""
    made = lake.audit("rollups")
    if as_of:
        made = made.where(F.col("published_at") <= F.lit(as_of))
    return made.agg(F.max_by("version", F.struct("published_at", "version"))).first()[0]


def changed_files(lake: Lake, version: str | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Current files, those of them that a version does not hold, and those it should not hold."""
    now = lake.current_snapshots(ZONE).select(*_FILE)
    held = lake.rolled("files", version).select(*_FILE)
    return now, now.join(held, _FILE, "left_anti"), held.join(now, _FILE, "left_anti")


def update(lake: Lake) -> str | None:
    """Make the next version, if files have changed since the last one; the current version.

    Updates are meant to follow each other, after runs; two at once would each add to the
    same version, and the later one would be seen alone.
    """
    before = latest_version(lake)
    now, came, went = changed_files(lake, before)
    both = came.select(F.lit(True).alias("is_new")).unionByName(went.select(F.lit(False).alias("is_new")))
    counts = both.agg(F.count_if("is_new").alias("added"), F.count_if(~F.col("is_new")).alias("taken_out")).first()
    if not counts["added"] and not counts["taken_out"]:
        return before
    at = datetime.now(timezone.utc)
    version = f"{at:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    place = f"rollup-{version}"

    def short(name: str, files: DataFrame) -> DataFrame | None:
        """What parts need of the claims of some snapshots, a file having one at most."""
        if not counts[name]:
            return None
        return lake.set_by(name, partials.shortened(lake.replaced_rows(ZONE, files), ["source_file"]), place)

    try:
        new, old = short("added", came), short("taken_out", went)
        kept = [] if before is None else [lake.rolled("sums", before)]
        kept += [] if new is None else [partials.sums_of_short(new, ["source_file"])]
        kept += [] if old is None else [partials.taken_out(partials.sums_of_short(old, ["source_file"]))]
        lake.roll("sums", partials.added_sums(*kept), version)
        # one after the other, as links are nearly as many as claims: the shuffle of one is gone
        # before the next
        for link in partials.LINKS:
            held = None if before is None else lake.rolled("links", before).where(F.col("link") == link)
            lake.roll("links", partials.next_links(link, "source_file", held, new, old), version)
    finally:
        lake.clear(place)
    lake.roll("files", now, version)
    row = (version, at, lake.rolled("files", version).count(), counts["added"], counts["taken_out"])
    lake.append("rollups", lake.spark.createDataFrame([row], ROLLUP))
    return version


def summary(lake: Lake, name: str, as_of: datetime | None = None) -> DataFrame:
    """A summary over all files as of the last update (or the last one before a time)."""
    version = latest_version(lake, as_of)
    return partials.finished(name, lake.rolled("sums", version), lake.rolled("links", version))
