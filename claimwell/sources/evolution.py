"""Changes of a zone's schema, and formats of client files that are read from JSON.

A zone may get further columns and wider types. Files that were written before keep theirs:
a reader asks for the newest schema, finds NULL in columns that a file lacks, and has narrower
numbers widened while they are read, so no file is rewritten.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwell.schemas import ZONE_SCHEMA
from claimwell.sources.claims_csv import FileFormat
from claimwell.sources.fixed_width import Field
from claimwell.sources.lake import Lake, SchemaMismatch, is_wider

#: What an entry of a format file may say.
_KEYS = {"client_code", "file_type", "valid_from", "delimiter", "columns", "renames", "fields", "checksum", "schema"}


def evolved(now: T.StructType, new: T.StructType) -> T.StructType:
    """The schema that holds rows of both: columns of `now` with the wider type, then those
    that `new` adds. Raises where a type is neither equal nor wider; a column that `new`
    lacks stays."""
    given = {f.name: f for f in new.fields}
    out, wrong = [], []
    for f in now.fields:
        other = given.pop(f.name, f)
        if other.dataType == f.dataType or is_wider(f.dataType, other.dataType):
            wider = f.dataType
        elif is_wider(other.dataType, f.dataType):
            wider = other.dataType
        else:
            wider = f.dataType
            wrong.append(f"{f.name}: {other.dataType.simpleString()} does not hold {f.dataType.simpleString()}")
        out.append(T.StructField(f.name, wider))
    if wrong:
        raise SchemaMismatch("; ".join(wrong))
    return T.StructType([*out, *[T.StructField(f.name, f.dataType) for f in given.values()]])


def evolve(lake: Lake, zone_name: str, new: T.StructType) -> T.StructType:
    """Make the columns and types of `new` part of a zone from now on; the schema it has then."""
    now = lake.schema_of(zone_name)
    schema = evolved(now, new)
    if schema != now:
        row = (zone_name, schema.json(), datetime.now(timezone.utc))
        lake.append("zone_schemas", lake.spark.createDataFrame([row], ZONE_SCHEMA))
    return schema


def formats_from_json(text: str) -> list[FileFormat]:
    """Formats of client files from a JSON list, one object for each client, type and version.

    Keys are those of FileFormat, with `fields` as [name, start, end] or [name, start, end,
    scale] lists. `valid_from` (a date) says from which file date on an entry counts: a later
    version of a client's mapping replaces the earlier one for later files only. `schema`, the
    JSON of a struct of texts, may name the columns instead of `columns`.
    """
    found = []
    for entry in json.loads(text):
        if unknown := sorted(entry.keys() - _KEYS):
            raise ValueError(f"no such keys of a format: {', '.join(unknown)}")
        columns = tuple(entry.get("columns", ()))
        if "schema" in entry:
            columns = tuple(T.StructType.fromJson(entry["schema"]).names)
        found.append(
            FileFormat(
                client_code=entry.get("client_code"),
                file_type=entry.get("file_type"),
                delimiter=entry.get("delimiter", ","),
                columns=columns,
                renames=entry.get("renames", {}),
                fields=tuple(Field(n, a, b, scale=scale[0] if scale else None) for n, a, b, *scale in entry.get("fields", ())),
                checksum=entry.get("checksum"),
                valid_from=date.fromisoformat(entry["valid_from"]) if "valid_from" in entry else None,
            )
        )
    return found


def read_formats(lake: Lake, path: str) -> list[FileFormat]:
    """The formats of one JSON file, wherever Spark reads it from."""
    lines: Sequence = lake.spark.read.text(path, wholetext=True).select(F.col("value")).collect()
    return formats_from_json(lines[0]["value"])
