"""Plan choices of the package next to the plain alternative, on one machine.

Times a step-by-step plan (a count after every step, nothing shared) against the plans
used here, over claims written as CSV from the given tables. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import date, datetime, timezone
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwell.functions import masking, quality
from claimwell.functions.filenames import with_file_fields
from claimwell.operators import enrich, summaries
from claimwell.plans import stages
from claimwell.plans.catalog import AS_OF
from claimwell.schemas import RAW_CLAIM
from claimwell.session import build_session
from claimwell.sources.sample_tables import SampleTables

NAME = "BCBS001_837P_PROD_20240131_001.csv"


def timed(action, runs: int = 2) -> float:
    best = []
    for _ in range(runs + 1):
        begin = time.perf_counter()
        action()
        best.append(time.perf_counter() - begin)
    return round(min(best[1:]), 2)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(
        "claimwell-plans", "local[8]", spark__sql__shuffle__partitions="8",
        spark__driver__memory="16g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    tables = SampleTables(spark, folder)
    tables.claims().write.option("header", True).csv(f"{work}/csv")
    cpt, icd10 = tables.cpt_codes(), tables.icd10_codes()
    settings = stages.StageSettings(date(2002, 1, 1), datetime.now(timezone.utc))
    tries = iter(range(1000))

    def put(df: DataFrame, *by: str) -> str:
        path = f"{work}/out-{next(tries)}"
        df.write.partitionBy(*by).parquet(path)
        return path

    named = with_file_fields(spark.createDataFrame([(NAME,)], "source_file string"), "source_file")
    files = spark.read.parquet(put(named))

    def raw() -> DataFrame:
        rows = spark.read.schema(RAW_CLAIM).option("header", True).csv(f"{work}/csv")
        return rows.withColumns({"extra": F.lit(None).cast("map<string,string>"), "source_file": F.lit(NAME)})

    def cleanse_step_by_step() -> None:
        rows = spark.read.option("header", True).option("inferSchema", True).csv(f"{work}/csv")
        rows.count()
        bad = quality.rejected_rows(rows)
        bad.count()
        good = masking.mask(quality.clean_rows(rows))
        good.count()
        put(good)
        put(bad)

    def cleanse_one_pass() -> None:
        put(stages.check_claims(raw(), files, settings).drop("extra"), "record_state")

    clean_path = put(masking.mask(quality.clean_rows(raw())))
    clean = spark.read.parquet(clean_path)

    def transformed() -> DataFrame:
        return enrich.transformed(clean, cpt, icd10, AS_OF)

    def transform_step_by_step() -> None:
        enrich.with_codes(clean, cpt, icd10).count()
        claims = transformed()
        claims.count()
        put(claims.drop("extra"))
        for summary in (summaries.payer_category_summary(claims), summaries.cpt_summary(claims, cpt)):
            summary.count()
            put(summary)

    def transform_read_back() -> None:
        claims = spark.read.parquet(put(transformed().drop("extra")))
        put(summaries.payer_category_summary(claims))
        put(summaries.cpt_summary(claims, cpt))

    claims = spark.read.parquet(put(transformed().drop("extra")))
    made = (summaries.member_summary, summaries.payer_summary, summaries.provider_summary)

    def curate_scans() -> None:
        for summary in made:
            put(summary(claims))

    def curate_cached() -> None:
        narrow = claims.select(
            "claim_id", "member_id_hash", "provider_npi_hash", "payer_id", "cpt_code", "billed_amount",
            "billed_category", "claim_age_days", "chronic_flag", "service_date",
        ).persist()
        for summary in made:
            put(summary(narrow))
        narrow.unpersist(blocking=True)

    def curate_counted() -> None:
        claims.count()
        for summary in made:
            summary(claims).count()
            put(summary(claims))

    def providers_regrouped() -> None:
        keys = ["provider_npi_hash", "member_id_hash", "payer_id", "cpt_code"]
        fine = claims.groupBy(*keys).agg(F.count("claim_id").alias("n"), F.sum("billed_amount").alias("s"))
        put(
            fine.groupBy("provider_npi_hash").agg(
                F.sum("n").alias("n"), F.sum("s").alias("s"), *[F.count_distinct(k).alias(k[:6]) for k in keys[1:]]
            )
        )

    one_client = put(claims.withColumn("client", F.expr("concat('C', payer_id)")), "client")
    line = {
        "cleanse_step_by_step": timed(cleanse_step_by_step),
        "cleanse_one_pass": timed(cleanse_one_pass),
        "transform_step_by_step": timed(transform_step_by_step),
        "transform_read_back": timed(transform_read_back),
        "curate_counted": timed(curate_counted),
        "curate_scans": timed(curate_scans),
        "curate_cached": timed(curate_cached),
        "provider_exact": timed(lambda: put(summaries.provider_summary(claims))),
        "provider_regrouped": timed(providers_regrouped),
        "provider_approximate": timed(lambda: put(summaries.provider_summary(claims, approximate=True))),
        "one_client_by_partition": timed(
            lambda: spark.read.parquet(one_client).filter("client = 'CP3'").agg(F.sum("billed_amount")).collect()
        ),
        "one_client_by_scan": timed(
            lambda: claims.filter("payer_id = 'P3'").agg(F.sum("billed_amount")).collect()
        ),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
