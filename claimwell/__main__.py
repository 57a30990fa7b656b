"""Command line: process arriving files, recover files left behind, print reports.

    python -m claimwell ingest  --inbound DIR --lake DIR --cpt FILE --icd10 FILE
    python -m claimwell recover --inbound DIR --lake DIR --cpt FILE --icd10 FILE [--dry-run]
    python -m claimwell report  --lake DIR --name payers
"""

from __future__ import annotations

import argparse
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame

from claimwell.operators import registry, reports
from claimwell.plans.run import RunSettings, preview, process_arrivals
from claimwell.session import build_session
from claimwell.sources.arrivals import list_arrivals
from claimwell.sources.claims_csv import FileFormat, read_cpt_codes, read_icd10_codes
from claimwell.sources.lake import Lake
from claimwell.sources.layout import checkpoint_path
from claimwell.streaming.arrivals import ingest


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="claimwell")
    commands = parser.add_subparsers(dest="command", required=True)
    lake = argparse.ArgumentParser(add_help=False)
    lake.add_argument("--lake", required=True, help="root folder of the lake")
    files = argparse.ArgumentParser(add_help=False, parents=[lake])
    files.add_argument("--inbound", required=True, help="folder of arriving files")
    files.add_argument("--cpt", required=True, help="CSV of procedure codes")
    files.add_argument("--icd10", required=True, help="CSV of diagnosis codes")
    files.add_argument("--as-of", type=date.fromisoformat, help="day claim ages are counted to")
    files.add_argument("--delimiter", default=",", help="'auto' finds it out per file")
    files.add_argument("--force", action="store_true", help="process finished files again")
    files.add_argument("--one-per-claim", action="store_true", help="one row per claim_id of a file")
    files.add_argument("--max-files", type=int, default=1000, help="files per micro-batch")
    arriving = commands.add_parser("ingest", parents=[files])
    arriving.add_argument("--every", help="go on with this interval, e.g. '30 seconds'")
    arriving.add_argument("--archive", help="move files that are done to this folder")
    left = commands.add_parser("recover", parents=[files])
    left.add_argument("--dry-run", action="store_true", help="only show what would be done")
    left.add_argument("--file-name", help="one file of the inbound folder")
    left.add_argument("--out", help="write what a dry run finds as CSV files here")
    shown = commands.add_parser("report", parents=[lake])
    shown.add_argument("--name", choices=sorted(REPORTS), required=True)
    shown.add_argument("--out", help="write the report as CSV files here instead of printing all of it")
    return parser


def _files(lake: Lake) -> DataFrame:
    return registry.current_files(lake.audit("file_events"))


REPORTS = {
    "files": lambda lake: reports.file_figures(_files(lake)),
    "runs": lambda lake: reports.run_figures(lake.audit("pipeline_runs")),
    "newest-files": lambda lake: registry.newest_files(_files(lake)),
    "newest-runs": lambda lake: registry.newest_runs(lake.audit("pipeline_runs"), ties=("run_id", "file_name")),
    "lineage": lambda lake: registry.keyed_lineage(
        _files(lake).select("file_name", "client_code", "env", "ingestion_status"),
        lake.audit("pipeline_runs"),
    ),
    "members": lambda lake: reports.member_figures(lake.current("member_summary")),
    "payers": lambda lake: reports.by_total_billed(lake.current("payer_summary"), "payer_id"),
    "providers": lambda lake: reports.top_by_total_billed(
        lake.current("provider_summary"), "provider_npi_hash"
    ),
}


def _give(rows: DataFrame, out: str | None) -> None:
    """Write all rows as CSV to `out`, or print all of them, a partition at a time."""
    if out:
        rows.write.option("header", True).csv(out)
        return
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def main(arguments: list[str] | None = None) -> None:
    given = _parser().parse_args(arguments)
    spark = build_session()
    lake = Lake(spark, given.lake)
    if given.command == "report":
        _give(REPORTS[given.name](lake), given.out)
        return
    codes = read_cpt_codes(spark, given.cpt), read_icd10_codes(spark, given.icd10)
    settings = RunSettings(
        as_of=given.as_of,
        force=given.force,
        formats=(FileFormat(delimiter=given.delimiter),),
        one_per_claim=given.one_per_claim,
    )
    if given.command == "ingest":
        query = ingest(lake, given.inbound, *codes, settings, given.max_files, continuous_every=given.every, archive=given.archive)
        query.awaitTermination()
    elif given.dry_run or given.file_name:
        where = f"{given.inbound.rstrip('/')}/{given.file_name}" if given.file_name else given.inbound
        arrivals = list_arrivals(spark, where)
        if given.dry_run:
            decided = preview(lake, arrivals, settings)
            _give(decided.select("file_name", "latest_status", "action", "reject_reason"), given.out)
            _give(registry.action_counts(decided), None)
        else:
            process_arrivals(lake, arrivals, *codes, settings)
    else:
        again = checkpoint_path(lake.root, f"recover-{uuid4().hex[:8]}")
        ingest(lake, given.inbound, *codes, settings, given.max_files, again).awaitTermination()


if __name__ == "__main__":
    main()
