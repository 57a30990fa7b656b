"""Claims, code tables, file names, registry and runs derived from a folder of generic
star-schema Parquet tables, so that every operator can run on tables of any size.

Amounts are decimal from the start. A share of rows gets missing or negative fields, and a
share of codes finds no partner, by rules on the keys. No row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimwell.functions.filenames import with_file_fields
from claimwell.schemas import FILE_KEYS

_PLACE = (
    "CASE l_linenumber WHEN 1 THEN 11 WHEN 2 THEN 21 WHEN 3 THEN 22 WHEN 4 THEN 23"
    " WHEN 5 THEN 31 WHEN 6 THEN 81 END"
)
_AMOUNT = (
    "CASE WHEN l_partkey % 101 = 0 THEN NULL"
    " WHEN l_partkey % 103 = 0 THEN -cast(l_extendedprice % 1000 AS decimal(18,2))"
    " ELSE cast(l_extendedprice % 1000 AS decimal(18,2)) END"
)
_CLAIM = (
    "CASE WHEN l_orderkey % 97 = 0 THEN NULL"
    " ELSE concat('C', cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) END AS claim_id",
    "CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN NULL"
    " ELSE cast(o_custkey AS string) END AS member_id",
    "CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE cast(l_suppkey AS string) END AS provider_npi",
    "concat('P', cast(c_nationkey AS string)) AS payer_id",
    "cast(l_partkey AS string) AS cpt_code",
    "cast(l_suppkey % 25 AS string) AS icd10_code",
    f"{_PLACE} AS place_of_service",
    "billed_amount",
    "service_date",
)
_FILE_NAME = (
    "concat(CASE WHEN o_orderkey % 41 = 0 THEN 'bcbs' ELSE 'BCBS' END,"
    " lpad(cast(o_custkey % 20 AS string), 3, '0'), '_',"
    " CASE WHEN o_orderkey % 43 = 0 THEN 'UNKNOWN' WHEN o_orderstatus = 'F' THEN '837P'"
    " WHEN o_orderstatus = 'O' THEN '837I' ELSE '835' END, '_',"
    " CASE WHEN o_orderkey % 47 = 0 THEN 'DEV' WHEN o_orderkey % 3 = 0 THEN 'TEST'"
    " ELSE 'PROD' END, '_',"
    " CASE WHEN o_orderkey % 53 = 0 THEN '20261399'"
    " ELSE replace(cast(cast(o_orderdate AS date) AS string), '-', '') END, '_',"
    " CASE WHEN o_orderkey % 59 = 0 THEN '01' ELSE lpad(cast(o_orderkey % 4 AS string), 3, '0') END,"
    " CASE WHEN o_orderkey % 61 = 0 THEN '.txt' ELSE '.csv' END)"
)
_EVENT_FILE_NAME = (
    "concat('BCBS', lpad(cast(user_id % 20 AS string), 3, '0'), '_837P_PROD_202401',"
    " lpad(cast(user_id % 28 + 1 AS string), 2, '0'), '_',"
    " lpad(cast(user_id % 1000 AS string), 3, '0'), '.csv')"
)


class SampleTables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def claims(
        self, *more: str, lines: DataFrame | None = None, orders: DataFrame | None = None
    ) -> DataFrame:
        """One claim per line item; `more` are further columns as SQL expressions. `lines`
        may be a stream of the line items, and `orders` may have further columns.

        Customers meet the orders first, so line items, the largest table, are shuffled once
        at most, with amounts in cents and days, which are shorter than what they come from.
        """
        if lines is None:
            lines = self.table("lineitem")
        orders = self.table("orders") if orders is None else orders
        customers = self.table("customer")
        placed = orders.join(customers, orders.o_custkey == customers.c_custkey)
        lines = lines.selectExpr("*", f"{_AMOUNT} AS billed_amount", "cast(l_shipdate AS date) AS service_date")
        joined = lines.join(placed, lines.l_orderkey == placed.o_orderkey)
        return joined.selectExpr(*_CLAIM, *more)

    def claims_with_file(self) -> DataFrame:
        """Claims with the name of the file they came in, and the fields of a valid name.

        A name belongs to an order, so it is parsed there and not for every claim.
        """
        orders = self.table("orders").selectExpr(
            "o_orderkey", "o_custkey", f"{_FILE_NAME} AS source_file"
        )
        named = with_file_fields(orders, "source_file")
        return self.claims("source_file", *FILE_KEYS, orders=named)

    def cpt_codes(self) -> DataFrame:
        return self.table("part").selectExpr(
            "CASE WHEN p_partkey % 10 = 0 THEN concat('X', cast(p_partkey AS string))"
            " ELSE cast(p_partkey AS string) END AS cpt_code",
            "p_name AS cpt_description",
            "p_type AS cpt_category",
            "p_size AS typical_duration_mins",
        )

    def icd10_codes(self) -> DataFrame:
        nations = self.table("nation")
        regions = self.table("region")
        return nations.join(regions, nations.n_regionkey == regions.r_regionkey).selectExpr(
            "CASE WHEN n_nationkey = 7 THEN 'X7' ELSE cast(n_nationkey AS string) END AS icd10_code",
            "n_name AS icd10_description",
            "r_name AS icd10_category",
            "CASE WHEN n_regionkey IN (1, 3) THEN 'true' ELSE 'false' END AS chronic_flag",
        )

    def arrivals(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS arrival_id", "o_orderdate AS arrived_at", f"{_FILE_NAME} AS file_name"
        )

    def file_events(self, events: DataFrame | None = None) -> DataFrame:
        """One event of a file per row; `events` may be a stream of the rows."""
        return (self.table("events") if events is None else events).selectExpr(
            "event_id",
            f"{_EVENT_FILE_NAME} AS file_name",
            "concat('BCBS', lpad(cast(user_id % 20 AS string), 3, '0')) AS client_code",
            "'837P' AS file_type",
            "'PROD' AS env",
            "lpad(cast(user_id % 1000 AS string), 3, '0') AS sequence",
            "CASE WHEN user_id % 17 = 0 THEN 'QUARANTINED' WHEN event_type = 'view' THEN 'RECEIVED'"
            " WHEN event_type = 'click' THEN 'CLEANSED' WHEN event_type = 'signup' THEN 'TRANSFORMED'"
            " WHEN event_type = 'purchase' THEN 'CURATED' ELSE 'FAILED' END AS ingestion_status",
            "ts AS received_at",
        )

    def runs(self, events: DataFrame | None = None) -> DataFrame:
        """One run over a file per row of events, which may be a stream of them."""
        return (self.table("events") if events is None else events).selectExpr(
            "event_id AS run_id",
            f"{_EVENT_FILE_NAME} AS file_name",
            "CASE event_id % 3 WHEN 0 THEN 'claims_cleanse_job' WHEN 1 THEN 'claims_transform_job'"
            " ELSE 'claims_curate_job' END AS pipeline_name",
            "CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS run_status",
            "ts AS started_at",
            "CASE WHEN event_id % 50 = 0 THEN NULL"
            " ELSE timestampadd(MILLISECOND, cast(floor(value * 1000) AS int), ts) END AS ended_at",
            "event_id % 1000 AS records_read",
            "event_id % 1000 - event_id % 7 % (event_id % 1000 + 1) AS records_written",
            "event_id % 7 % (event_id % 1000 + 1) AS records_rejected",
        )
