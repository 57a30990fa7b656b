"""Where everything lies under the root of a lake."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from claimwell import schemas as S

SNAPSHOT_COLUMN = "snapshot_id"


@dataclass(frozen=True)
class Zone:
    """A table of the lake: one directory level per partition column."""

    path: str
    schema: T.StructType
    partitions: tuple[str, ...] = ()


_PER_FILE = (SNAPSHOT_COLUMN, *S.FILE_KEYS)

# Tables that hold the rows of files. A file is one leaf directory of a snapshot, so a
# filter on client, type, environment or date prunes directories.
ZONES = {
    # `record_state` comes first: rejected rows keep identifiers, and their directory can
    # carry its own access rules.
    "checked_claims": Zone("checked/claims", S.CHECKED_CLAIM, ("record_state", *_PER_FILE)),
    "transformed_claims": Zone("transformed/claims", S.TRANSFORMED_CLAIM, _PER_FILE),
    "payer_category_summary": Zone(
        "transformed/summaries/payer", S.per_file(S.PAYER_CATEGORY_SUMMARY), _PER_FILE
    ),
    "cpt_summary": Zone("transformed/summaries/cpt", S.per_file(S.CPT_SUMMARY), _PER_FILE),
    "member_summary": Zone("curated/member_summary", S.per_file(S.MEMBER_SUMMARY), _PER_FILE),
    "payer_summary": Zone("curated/payer_summary", S.per_file(S.PAYER_SUMMARY), _PER_FILE),
    "provider_summary": Zone("curated/provider_summary", S.per_file(S.PROVIDER_SUMMARY), _PER_FILE),
}

# Lines of files as they came, refused files included: one directory for each run.
RAW_ZONE = Zone("raw/lines", S.RAW_LINE, (SNAPSHOT_COLUMN,))

# Tables that a run uses more than once, removed at its end: one directory for each run.
SET_BY = "set_by"

# Small leaves of zones in files of a target size: one directory for each client and file of a pack.
PACKED = "packed"


def packed(name: str, schema: T.StructType) -> Zone:
    """The packs of a zone of that schema."""
    zone = ZONES[name]
    keys = [T.StructField(c, T.StringType()) for c in zone.partitions if c not in {f.name for f in schema.fields}]
    columns = [f for f in T.StructType(schema.fields + keys).fields if f.name != "client_code"]
    return Zone(f"{PACKED}/{name}", T.StructType(columns), ("pack_id", "client_code", "pack_file"))


# Summaries over all files: one directory for each version.
ROLLED = {
    "sums": Zone("rollup/sums", S.CLAIM_SUMS, ("version",)),
    "links": Zone("rollup/links", S.CLAIM_LINKS, ("version",)),
    "files": Zone("rollup/files", S.ROLLED_FILE, ("version",)),
}

AUDIT = {
    "file_events": Zone("audit/file_events", S.FILE_EVENT),
    "pipeline_runs": Zone("audit/pipeline_runs", S.PIPELINE_RUN, ("run_id",)),
    "arrival_decisions": Zone("audit/arrival_decisions", S.ARRIVAL_DECISION, ("run_id",)),
    "snapshots": Zone("audit/snapshots", S.SNAPSHOT),
    "landings": Zone("audit/landings", S.LANDING, ("run_id",)),
    "zone_schemas": Zone("audit/zone_schemas", S.ZONE_SCHEMA),
    "packs": Zone("audit/packs", S.PACK),
    "expiries": Zone("audit/expiries", S.EXPIRY),
    "key_index": Zone("audit/key_index", S.KEY_INDEX, ("client_code",)),
    "rollups": Zone("audit/rollups", S.ROLLUP),
    "source_systems": Zone("audit/source_systems", S.SOURCE_SYSTEM),
}

# The zones that are made of clean rows, and so have none of a file without them.
LATER_ZONES = tuple(name for name in ZONES if name != "checked_claims")

CLEAN, QUARANTINE = "clean", "quarantine"


def checkpoint_path(root: str, label: str) -> str:
    return f"{root.rstrip('/')}/checkpoints/{label}"
