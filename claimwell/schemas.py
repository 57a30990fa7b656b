"""Declared schemas and the fixed values of the claims data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values -------------------------------------------------------------
FILE_TYPES = ("837P", "837I", "835", "MEMBER", "PHARMACY", "CROSSWALK")
ENVIRONMENTS = ("PROD", "TEST", "SYS1", "SYS2", "UAT1", "UAT2")
FILE_STATUSES = (
    "RECEIVED", "PROCESSING", "CLEANSED", "TRANSFORMED", "CURATED", "FAILED", "QUARANTINED",
)
RUN_STATUSES = ("RUNNING", "SUCCESS", "FAILED", "PARTIAL")
CLEANSE_JOB = "claims_cleanse_job"
TRANSFORM_JOB = "claims_transform_job"
CURATE_JOB = "claims_curate_job"
PLACES_OF_SERVICE = {
    11: "Office",
    21: "Inpatient Hospital",
    22: "Outpatient Hospital",
    23: "Emergency Room",
    31: "Skilled Nursing Facility",
}
OTHER_PLACE = "Other"
# A billed amount below the bound falls in the bucket; anything else is TOP_BUCKET.
BILLED_BUCKETS = (("LOW", 200), ("MEDIUM", 500))
TOP_BUCKET = "HIGH"
# --------------------------------------------------------------------------------

MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(28, 2)
# Amounts as they were sent: wide enough to test `> 0` before rounding to cents.
RAW_MONEY = T.DecimalType(38, 10)

PHI_COLUMNS = ("member_id", "provider_npi")
FILE_KEYS = ("client_code", "file_type", "env", "file_date", "sequence")


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "binary": T.BinaryType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "money": MONEY,
    "money_sum": MONEY_SUM,
    "raw_money": RAW_MONEY,
    "texts": T.MapType(T.StringType(), T.StringType()),
}


def _struct(spec: str) -> T.StructType:
    """A schema from 'name type' pairs; needs no running session."""
    fields = (pair.split() for pair in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


RAW_CLAIM = _struct(
    "claim_id string, member_id string, provider_npi string, payer_id string, cpt_code string,"
    "icd10_code string, place_of_service string, billed_amount string, service_date string"
)

_TYPES["sent_claim"] = T.StructType(RAW_CLAIM.fields + _struct("extra texts").fields)

_FILE = "client_code string, file_type string, env string, file_date string, sequence string"

# Clean and rejected rows are written by one pass over the input: `raw` and
# `validation_errors` are filled for rejected rows only, the rest for clean rows only.
CHECKED_CLAIM = _struct(
    "record_state string, claim_id string, member_id_hash string, provider_npi_hash string,"
    "payer_id string, cpt_code string, icd10_code string, place_of_service int,"
    "billed_amount raw_money, service_date date, extra texts,"
    "processed_at timestamp, raw sent_claim, validation_errors string, source_file string," + _FILE
)

TRANSFORMED_CLAIM = _struct(
    "claim_id string, member_id_hash string, provider_npi_hash string, payer_id string,"
    "cpt_code string, icd10_code string, place_of_service int, billed_amount money,"
    "service_date date, extra texts, processed_at timestamp, source_file string,"
    "cpt_description string, cpt_category string, typical_duration_mins int,"
    "icd10_description string, icd10_category string, chronic_flag boolean,"
    "place_of_service_desc string, billed_category string, claim_age_days int,"
    "transformed_at timestamp," + _FILE
)

CPT_CODE = _struct(
    "cpt_code string, cpt_description string, cpt_category string, typical_duration_mins int"
)
ICD10_CODE = _struct(
    "icd10_code string, icd10_description string, icd10_category string, chronic_flag string"
)

PAYER_CATEGORY_SUMMARY = _struct(
    "payer_id string, billed_category string, total_claims bigint, total_billed money_sum,"
    "avg_billed money, avg_claim_age_days double, unique_members bigint,"
    "unique_cpt_codes bigint, summarized_at timestamp"
)
CPT_SUMMARY = _struct(
    "cpt_code string, cpt_description string, cpt_category string, total_claims bigint,"
    "total_billed money_sum, avg_billed money, unique_payers bigint,"
    "unique_members bigint, summarized_at timestamp"
)
MEMBER_SUMMARY = _struct(
    "member_id_hash string, total_claims bigint, total_billed money_sum,"
    "avg_billed money, unique_providers bigint, unique_payers bigint,"
    "has_chronic_condition boolean, most_recent_service_date date, curated_at timestamp"
)
PAYER_SUMMARY = _struct(
    "payer_id string, total_claims bigint, total_billed money_sum, avg_billed money,"
    "unique_members bigint, unique_providers bigint, avg_claim_age_days double,"
    "low_claims bigint, medium_claims bigint, high_claims bigint, curated_at timestamp"
)
PROVIDER_SUMMARY = _struct(
    "provider_npi_hash string, total_claims bigint, total_billed money_sum,"
    "avg_billed money, unique_members bigint, unique_payers bigint,"
    "unique_cpt_codes bigint, curated_at timestamp"
)

# Parts of summaries: see operators/partials.py.
CLAIM_SUMS = _struct(
    "summary string, key string, key2 string, total_claims bigint, billed money_sum, amounts bigint,"
    "age_days bigint, aged bigint, low_claims bigint, medium_claims bigint, high_claims bigint,"
    "chronic_claims bigint, files bigint"
)
CLAIM_LINKS = _struct("link string, a binary, b binary, category string, files bigint")


def per_file(schema: T.StructType) -> T.StructType:
    """A summary schema with the columns that name the file it belongs to."""
    return T.StructType(schema.fields + _struct(_FILE).fields)


# The registry is kept as status events; the current row of a file is its latest event.
FILE_EVENT = _struct(
    "event_id string, source_id int, file_name string, bucket_name string, object_key string,"
    "file_size_bytes bigint, file_hash string, ingestion_status string, received_at timestamp,"
    "processed_at timestamp, source_name string, error_message string, client_code string,"
    "file_type string, env string, sequence string, event_at timestamp"
)
PIPELINE_RUN = _struct(
    "run_id string, file_name string, pipeline_name string, run_status string,"
    "started_at timestamp, ended_at timestamp, records_read bigint, records_written bigint,"
    "records_rejected bigint, error_message string"
)
SOURCE_SYSTEM = _struct(
    "source_id int, source_name string, source_type string, active_flag boolean,"
    "created_at timestamp"
)
ARRIVAL = _struct("path string, file_name string, file_size_bytes bigint, modified_at timestamp")
ARRIVAL_DECISION = _struct(
    "run_id string, path string, file_name string, file_size_bytes bigint, modified_at timestamp,"
    "client_code string, file_type string, env string, file_date string, sequence string,"
    "latest_status string, action string, reason string, decided_at timestamp"
)
# The files whose parts a version of the rolled-up summaries holds, and the versions.
ROLLED_FILE = _struct(_FILE + ", snapshot_id string")
ROLLUP = _struct("version string, published_at timestamp, files bigint, added bigint, taken_out bigint")
# Lines of files as they came, and what is known of each file that landed.
RAW_LINE = _struct("source_file string, block_start bigint, ordinal bigint, value string")
LANDING = _struct(
    "run_id string, source_file string, path string, file_size_bytes bigint, modified_at timestamp,"
    "action string, lines bigint, all_lines bigint, file_hash string, landed_at timestamp"
)
# Schemas that a zone got after the declared one, as JSON.
ZONE_SCHEMA = _struct("zone string, schema_json string, since timestamp")
# Leaves whose rows are read from a pack, and the times before which reads are refused.
PACK = _struct("zone string, pack_id string, snapshot_id string, packed_at timestamp," + _FILE)
# Which claims the parts of a leaf may hold: see plans/corrections.py.
KEY_INDEX = _struct(
    "snapshot_id string, key_group int, part int, parts int, least string, greatest string, bitmap binary," + _FILE
)
EXPIRY = _struct("horizon timestamp, expired_at timestamp")
SNAPSHOT = _struct(
    "zone string, snapshot_id string, published_at timestamp, source_file string, row_count bigint,"
    + _FILE
)
