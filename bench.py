"""Headline queries, timed; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of cores, BENCH_RUNS how
often a query runs after one warm-up (the median counts). The large tables are first rewritten
with one file for each core, untimed: given as one row group, they are one task's work.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from claimwell.plans import catalog
from claimwell.session import build_session

HEADLINE = (
    "q01_clean_claims", "q02_quarantined_claims", "q03_masked_claims", "q07_enriched_claims",
    "q08_payer_category_summary", "q09_cpt_summary", "q10_member_summary", "q11_payer_summary",
    "q12_provider_summary", "q14_file_figures", "q15_member_figures", "q17_top_providers",
    "q19_file_names", "q20_arrival_decisions", "q21_latest_status", "q23_keyed_lineage",
    "q24_billed_histogram", "q27_one_per_claim", "q30_quarantine_audit",
    "q32_payer_summary_by_file",
)

#: Timed, but no part of the total: a whole run into a lake, and states over time.
FURTHER = ("q26_stage_counts", "q54_state_transitions", "q55_state_figures")


def seconds(action) -> float:
    begin = time.perf_counter()
    action()
    return time.perf_counter() - begin


def in_files(spark, folder: str, files: int) -> str:
    """The folder's tables again, the large ones in several files."""
    made = tempfile.mkdtemp(prefix="claimwell-bench-")
    for table in Path(folder).glob("*.parquet"):
        if table.stem in ("lineitem", "orders", "events"):
            spark.read.parquet(str(table)).repartition(files).write.parquet(f"{made}/{table.name}")
        else:
            (Path(made) / table.name).symlink_to(table)
    return made


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "claimwell-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = in_files(spark, folder, int(cpus))

    def run(name: str) -> None:
        query = catalog.REGISTERED[name](spark, tables)
        query.write.format("noop").mode("overwrite").save()

    def timed(names: tuple[str, ...]) -> dict[str, float]:
        found = {}
        for name in names:
            run(name)
            found[name] = round(statistics.median(seconds(lambda: run(name)) for _ in range(runs)), 3)
        return found

    times = timed(HEADLINE)
    line = {
        "metric": "claims_headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "further": timed(FURTHER),
        "layout": f"lineitem, orders and events in {cpus} files each",
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
