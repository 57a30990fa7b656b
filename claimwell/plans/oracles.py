"""For each registered query, the same result as DuckDB SQL over the same tables."""

from __future__ import annotations

import re

# The file types and environments a name may have.
NAME_PATTERN = (
    "^[A-Z0-9]{3,10}_(837P|837I|835|MEMBER|PHARMACY|CROSSWALK)"
    "_(PROD|TEST|SYS1|SYS2|UAT1|UAT2)_[0-9]{8}_[0-9]{3}[.]csv$"
)

_CLAIM_COLUMNS = """
  case when l_orderkey % 97 = 0 then null
       else concat('C', cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) end as claim_id,
  case when l_linenumber = 7 and l_returnflag = 'R' then null else cast(o_custkey as varchar) end as member_id,
  case when l_suppkey % 50 = 0 then null else cast(l_suppkey as varchar) end as provider_npi,
  concat('P', cast(c_nationkey as varchar)) as payer_id,
  cast(l_partkey as varchar) as cpt_code,
  cast(l_suppkey % 25 as varchar) as icd10_code,
  case l_linenumber when 1 then 11 when 2 then 21 when 3 then 22 when 4 then 23
                    when 5 then 31 when 6 then 81 end as place_of_service,
  case when l_partkey % 101 = 0 then null
       when l_partkey % 103 = 0 then -cast(l_extendedprice % 1000 as decimal(18,2))
       else cast(l_extendedprice % 1000 as decimal(18,2)) end as billed_amount,
  cast(l_shipdate as date) as service_date"""

_FILE_NAME = """concat(
    case when o_orderkey % 41 = 0 then 'bcbs' else 'BCBS' end,
    lpad(cast(o_custkey % 20 as varchar), 3, '0'), '_',
    case when o_orderkey % 43 = 0 then 'UNKNOWN' when o_orderstatus = 'F' then '837P'
         when o_orderstatus = 'O' then '837I' else '835' end, '_',
    case when o_orderkey % 47 = 0 then 'DEV' when o_orderkey % 3 = 0 then 'TEST' else 'PROD' end, '_',
    case when o_orderkey % 53 = 0 then '20261399'
         else replace(cast(cast(o_orderdate as date) as varchar), '-', '') end, '_',
    case when o_orderkey % 59 = 0 then '01' else lpad(cast(o_orderkey % 4 as varchar), 3, '0') end,
    case when o_orderkey % 61 = 0 then '.txt' else '.csv' end)"""

_EVENT_FILE = """concat('BCBS', lpad(cast(user_id % 20 as varchar), 3, '0'), '_837P_PROD_202401',
    lpad(cast(user_id % 28 + 1 as varchar), 2, '0'), '_',
    lpad(cast(user_id % 1000 as varchar), 3, '0'), '.csv')"""

_RUN_FILE = """concat('BCBS', lpad(cast(o_custkey % 20 as varchar), 3, '0'),
    '_837P_PROD_20240131_001.csv')"""

_JOINED = """lineitem join orders on l_orderkey = o_orderkey
             join customer on o_custkey = c_custkey"""

_VALID = """claim_id is not null and member_id is not null and provider_npi is not null
            and billed_amount is not null and billed_amount > 0"""

_ERRORS = """concat_ws(', ',
    case when claim_id is null then 'missing claim_id' end,
    case when member_id is null then 'missing member_id' end,
    case when provider_npi is null then 'missing provider_npi' end,
    case when billed_amount is null then 'missing billed_amount' end,
    case when billed_amount <= 0 then 'invalid billed_amount' end)"""


_RUN_COUNTS = f"""with r as (select {_CLAIM_COLUMNS}, {_RUN_FILE} as file_name from {_JOINED}),
        c as (select file_name, count(*) as n, count(*) filter (where {_VALID}) as ok,
              count(distinct case when {_VALID} then member_id end)
              + count(distinct case when {_VALID} then payer_id end)
              + count(distinct case when {_VALID} then provider_npi end) as made
              from r group by file_name)
        select file_name, 'claims_cleanse_job' as pipeline_name, 'SUCCESS' as run_status,
          n as records_read, ok as records_written, n - ok as records_rejected from c
        union all select file_name, 'claims_transform_job', 'SUCCESS', ok, ok, 0 from c
        union all select file_name, 'claims_curate_job', 'SUCCESS', ok, made, 0 from c"""


def _file_fields(name: str) -> str:
    ok = (
        f"regexp_matches({name}, '{NAME_PATTERN}')"
        f" and try_strptime(split_part({name}, '_', 4), '%Y%m%d') is not null"
    )
    stem = f"replace({name}, '.csv', '')"
    columns = ("client_code", "file_type", "env", "file_date", "sequence")
    return ", ".join(
        f"case when {ok} then split_part({stem}, '_', {i}) end as {c}"
        for i, c in enumerate(columns, start=1)
    )


def _bucket(low: int = 200, medium: int = 500) -> str:
    return (
        f"case when billed_amount < {low} then 'LOW' when billed_amount < {medium} then 'MEDIUM'"
        " else 'HIGH' end"
    )


_CTES = {
    "claims": f"select {_CLAIM_COLUMNS} from {_JOINED}",
    "clean": f"select * from claims where {_VALID}",
    "rejected": f"select *, {_ERRORS} as validation_errors from claims where ({_VALID}) is not true",
    "masked": """select sha256(member_id) as member_id_hash, sha256(provider_npi) as provider_npi_hash,
        * exclude (member_id, provider_npi) from clean""",
    "standard": f"""select *,
        case place_of_service when 11 then 'Office' when 21 then 'Inpatient Hospital'
          when 22 then 'Outpatient Hospital' when 23 then 'Emergency Room'
          when 31 then 'Skilled Nursing Facility' else 'Other' end as place_of_service_desc,
        {_bucket()} as billed_category,
        date_diff('day', service_date, date '2002-01-01') as claim_age_days
        from masked""",
    "cpt": """select case when p_partkey % 10 = 0 then concat('X', cast(p_partkey as varchar))
          else cast(p_partkey as varchar) end as cpt_code,
        p_name as cpt_description, p_type as cpt_category, p_size as typical_duration_mins from part""",
    "icd10": """select case when n_nationkey = 7 then 'X7' else cast(n_nationkey as varchar) end as icd10_code,
        n_name as icd10_description, r_name as icd10_category,
        case when n_regionkey in (1, 3) then 'true' else 'false' end as chronic_text
        from nation join region on n_regionkey = r_regionkey""",
    "transformed": """select s.*, cpt_description, cpt_category, typical_duration_mins,
        icd10_description, icd10_category, coalesce(chronic_text = 'true', false) as chronic_flag
        from standard s left join cpt on s.cpt_code = cpt.cpt_code
        left join icd10 on s.icd10_code = icd10.icd10_code""",
    "filed": f"select {_CLAIM_COLUMNS}, {_FILE_NAME} as source_file from {_JOINED}",
    "filed_keys": f"select *, {_file_fields('source_file')} from filed",
    "arrivals": f"""select o_orderkey as arrival_id, o_orderdate as arrived_at,
        {_FILE_NAME} as file_name from orders""",
    "named": f"select *, {_file_fields('file_name')} from arrivals",
    "file_events": f"""select event_id, {_EVENT_FILE} as file_name,
        concat('BCBS', lpad(cast(user_id % 20 as varchar), 3, '0')) as client_code,
        '837P' as file_type, 'PROD' as env, lpad(cast(user_id % 1000 as varchar), 3, '0') as sequence,
        case when user_id % 17 = 0 then 'QUARANTINED' when event_type = 'view' then 'RECEIVED'
             when event_type = 'click' then 'CLEANSED' when event_type = 'signup' then 'TRANSFORMED'
             when event_type = 'purchase' then 'CURATED' else 'FAILED' end as ingestion_status,
        ts as received_at from events""",
    "latest": """select * from file_events qualify row_number() over
        (partition by file_name order by received_at desc, event_id desc) = 1""",
    "runs": f"""select event_id as run_id, {_EVENT_FILE} as file_name,
        case event_id % 3 when 0 then 'claims_cleanse_job' when 1 then 'claims_transform_job'
             else 'claims_curate_job' end as pipeline_name,
        case when event_type = 'error' then 'FAILED' else 'SUCCESS' end as run_status,
        ts as started_at,
        case when event_id % 50 = 0 then null
             else ts + to_milliseconds(cast(floor(value * 1000) as bigint)) end as ended_at,
        event_id % 1000 as records_read,
        event_id % 1000 - event_id % 7 % (event_id % 1000 + 1) as records_written,
        event_id % 7 % (event_id % 1000 + 1) as records_rejected from events""",
    "timed": "select *, date_sub('second', started_at, ended_at) as duration_secs from runs",
    "waiting": """select file_name from arrivals
        union all select distinct file_name from file_events""",
    "waiting_named": f"select *, {_file_fields('file_name')} from waiting",
    "decided": f"""select w.file_name, l.ingestion_status as latest_status, w.client_code,
        case when w.client_code is not null then null
             when not regexp_matches(w.file_name, '{NAME_PATTERN}')
               then concat('Invalid filename: ''', w.file_name, '''')
             else concat('Invalid date ''', split_part(w.file_name, '_', 4), ''' in filename ''',
                         w.file_name, '''') end as reject_reason
        from waiting_named w left join latest l on w.file_name = l.file_name""",
}

# Half-up mean of positive decimals in cents, in whole numbers.
_MEAN = "((2 * cast(sum({x}) * 100 as bigint) + count(*)) // (2 * count(*))) / 100.0"


def _volume(x: str = "billed_amount") -> str:
    return (
        f"count(claim_id) as total_claims, cast(sum({x}) as double) as total_billed,"
        f" cast({_MEAN.format(x=x)} as double) as avg_billed"
    )


_AGE = "round(avg(claim_age_days), 1) as avg_claim_age_days"
_VOLUMES = ", ".join(
    f"cast(count(*) filter (where billed_category = '{b}') as bigint) as {b.lower()}_claims"
    for b in ("LOW", "MEDIUM", "HIGH")
)
_MEMBERS = f"""select member_id_hash, {_volume()},
    count(distinct provider_npi_hash) as unique_providers, count(distinct payer_id) as unique_payers,
    bool_or(chronic_flag) as has_chronic_condition, max(service_date) as most_recent_service_date
    from transformed group by member_id_hash"""
_PAYERS = f"""select payer_id, {_volume()}, count(distinct member_id_hash) as unique_members,
    count(distinct provider_npi_hash) as unique_providers, {_AGE}, {_VOLUMES}
    from standard group by payer_id"""
_PROVIDERS = f"""select provider_npi_hash, {_volume()},
    count(distinct member_id_hash) as unique_members, count(distinct payer_id) as unique_payers,
    count(distinct cpt_code) as unique_cpt_codes from standard group by provider_npi_hash"""
_CTES["members"] = _MEMBERS
_CTES["payers"] = _PAYERS
_CTES["providers"] = _PROVIDERS

# What is left after BCBS003 sent bad rows only and BCBS007 two places of service only.
_CTES["rerun"] = f"""select sha256(member_id) as member_id_hash, sha256(provider_npi) as provider_npi_hash,
    c.* exclude (member_id, provider_npi), {_bucket()} as billed_category,
    date_diff('day', service_date, date '2002-01-01') as claim_age_days,
    coalesce(chronic_text = 'true', false) as chronic_flag
    from (select {_CLAIM_COLUMNS}, o_custkey % 20 as client from {_JOINED}) c left join icd10 on c.icd10_code = icd10.icd10_code
    where {_VALID} and client <> 3 and (client <> 7 or place_of_service in (11, 21))"""


def _figures(**given: str) -> str:
    """The figures that a rolled-up summary has, and NULL for those that it has not."""
    kinds = {"avg_claim_age_days": "double", **{f"unique_{x}": "bigint" for x in ("members", "providers", "payers", "cpt_codes")}}
    kinds |= {f"{b}_claims": "bigint" for b in ("low", "medium", "high")}
    kinds |= {"has_chronic_condition": "boolean", "most_recent_service_date": "date"}
    return ", ".join(f"{given[c]} as {c}" if c in given else f"cast(null as {kind}) as {c}" for c, kind in kinds.items())


_COUNT = "count(distinct {})"
_MEMBER, _PAYER, _PROVIDER, _CPT = (_COUNT.format(c) for c in ("member_id_hash", "payer_id", "provider_npi_hash", "cpt_code"))
_MEAN_AGE = "round(avg(claim_age_days), 1)"
_ROLLED = (
    ("payer_category_summary", "payer_id", "billed_category", "payer_id, billed_category",
     _figures(avg_claim_age_days=_MEAN_AGE, unique_members=_MEMBER, unique_cpt_codes=_CPT)),
    ("cpt_summary", "cpt_code", "null", "cpt_code", _figures(unique_payers=_PAYER, unique_members=_MEMBER)),
    ("member_summary", "member_id_hash", "null", "member_id_hash",
     _figures(unique_providers=_PROVIDER, unique_payers=_PAYER, has_chronic_condition="bool_or(chronic_flag)",
              most_recent_service_date="max(service_date)")),
    ("payer_summary", "payer_id", "null", "payer_id",
     _figures(avg_claim_age_days=_MEAN_AGE, unique_members=_MEMBER, unique_providers=_PROVIDER,
              **{f"{b.lower()}_claims": f"count(*) filter (where billed_category = '{b}')" for b in ("LOW", "MEDIUM", "HIGH")})),
    ("provider_summary", "provider_npi_hash", "null", "provider_npi_hash",
     _figures(unique_members=_MEMBER, unique_payers=_PAYER, unique_cpt_codes=_CPT)),
)

# Files of 20 clients by their number modulo 4, three more with the lines of client 4, and one refused.
_CTES["kinds"] = f"""select o_custkey % 20 as client, count(*) as n, count(*) filter (where {_VALID}) as ok
    from (select {_CLAIM_COLUMNS}, o_custkey from {_JOINED}) group by 1"""
_NAMED = "concat('BCBS', lpad(cast(client as varchar), 3, '0'), '_837P_PROD_20240131_{}.csv')"

# The states that may follow a state.
_LEGAL = (
    ("", "RECEIVED"), ("RECEIVED", "PROCESSING"), ("RECEIVED", "FAILED"), ("RECEIVED", "QUARANTINED"),
    ("PROCESSING", "CLEANSED"), ("PROCESSING", "FAILED"), ("PROCESSING", "QUARANTINED"),
    ("CLEANSED", "TRANSFORMED"), ("CLEANSED", "FAILED"), ("TRANSFORMED", "CURATED"), ("TRANSFORMED", "FAILED"),
    ("CURATED", "PROCESSING"), ("CURATED", "FAILED"), ("CURATED", "QUARANTINED"),
    ("FAILED", "PROCESSING"), ("FAILED", "FAILED"), ("FAILED", "QUARANTINED"),
    ("QUARANTINED", "PROCESSING"), ("QUARANTINED", "FAILED"), ("QUARANTINED", "QUARANTINED"),
)
_CTES["steps"] = f"""select file_name, event_id, before_status, status, began_at, changed_at,
    cast(floor(epoch_us(changed_at - began_at) / 1000000.0) as bigint) as seconds,
    concat(coalesce(before_status, ''), '>', status) in ({", ".join(f"'{a}>{b}'" for a, b in _LEGAL)}) as legal
    from (select file_name, event_id, ingestion_status as status, received_at as changed_at,
          lag(ingestion_status) over w as before_status, lag(received_at) over w as began_at
          from file_events window w as (partition by file_name order by received_at, event_id))"""
_STUCK = {"RECEIVED": 86400, "CLEANSED": 3600, "TRANSFORMED": 3600, "FAILED": 7 * 86400}

_AS_DOUBLE = "* replace (cast(billed_amount as double) as billed_amount)"
_ACTION = """case when reject_reason is not null then 'INVALID'
    when coalesce(latest_status = 'CURATED', false) and not {force} then 'SKIP' else 'TRIGGER' end"""
_LINEAGE = """f.file_name, f.client_code, f.env, f.ingestion_status, p.run_id, p.pipeline_name,
    p.records_read, p.records_written, p.run_status, p.duration_secs"""

_BODIES = {
    "q01_clean_claims": f"select {_AS_DOUBLE} from clean",
    "q02_quarantined_claims": f"select {_AS_DOUBLE} from rejected",
    "q03_masked_claims": f"select {_AS_DOUBLE} from masked",
    "q04_claims_with_lineage": f"""select sha256(member_id) as member_id_hash,
        sha256(provider_npi) as provider_npi_hash, {_AS_DOUBLE.replace('* ', '* exclude (member_id, provider_npi) ')}
        from filed_keys where client_code is not null and {_VALID}""",
    "q05_standardised_claims": f"select {_AS_DOUBLE.replace('* ', '* exclude (claim_age_days) ')} from standard",
    "q06_claim_age": "select claim_id, service_date, cast(claim_age_days as integer) as claim_age_days from standard",
    "q07_enriched_claims": """select * replace (cast(billed_amount as double) as billed_amount,
        cast(claim_age_days as integer) as claim_age_days) from transformed""",
    "q08_payer_category_summary": f"""select payer_id, billed_category, {_volume()}, {_AGE},
        count(distinct member_id_hash) as unique_members, count(distinct cpt_code) as unique_cpt_codes
        from standard group by payer_id, billed_category""",
    "q09_cpt_summary": f"""select cpt_code, cpt_description, cpt_category, {_volume()},
        count(distinct payer_id) as unique_payers, count(distinct member_id_hash) as unique_members
        from transformed group by cpt_code, cpt_description, cpt_category""",
    "q10_member_summary": "select * from members",
    "q11_payer_summary": "select * from payers",
    "q12_provider_summary": "select * from providers",
    "q13_run_figures": """select count(*) as total_runs,
        count(*) filter (where run_status = 'SUCCESS') as successful,
        count(*) filter (where run_status = 'FAILED') as failed,
        round(avg(duration_secs), 1) as avg_duration_secs from timed where ended_at is not null""",
    "q14_file_figures": """select count(*) as total_files,
        count(*) filter (where ingestion_status = 'CURATED') as curated,
        count(*) filter (where ingestion_status = 'FAILED') as failed,
        count(*) filter (where ingestion_status = 'QUARANTINED') as quarantined,
        count(distinct client_code) as unique_clients from latest""",
    "q15_member_figures": """select count(*) as total_members,
        cast(sum(total_claims) as bigint) as total_claims,
        (select cast(sum(billed_amount) as double) from standard) as total_billed,
        cast(((2 * cast(round(sum(avg_billed * 100)) as bigint) + count(*)) // (2 * count(*))) / 100.0
             as double) as avg_billed_per_member,
        count(*) filter (where has_chronic_condition) as chronic_members from members""",
    "q16_payers_by_billed": "select * exclude (unique_providers) from payers order by total_billed desc, payer_id",
    "q17_top_providers": "select * from providers order by total_billed desc, provider_npi_hash limit 20",
    "q18_members_by_billed": "select * from members order by total_billed desc, member_id_hash",
    "q19_file_names": f"""select *,
        case when client_code is not null then replace(file_name, '.csv', '') end as stem,
        case when client_code is not null then concat(client_code, '/', file_type, '/', env, '/',
             file_date, '_', sequence) end as partition_key,
        env = 'PROD' as is_prod,
        case when client_code is not null then null
             when not regexp_matches(file_name, '{NAME_PATTERN}')
               then concat('Invalid filename: ''', file_name, '''')
             else concat('Invalid date ''', split_part(file_name, '_', 4), ''' in filename ''',
                         file_name, '''') end as reject_reason
        from named""",
    "q20_arrival_decisions": f"""select file_name, latest_status, {_ACTION.format(force='false')} as action,
        reject_reason from decided""",
    "q20_action_counts": f"""select {_ACTION.format(force='false')} as action, count(*) as files
        from decided group by 1""",
    "q20_forced_action_counts": f"""select {_ACTION.format(force='true')} as action, count(*) as files
        from decided group by 1""",
    "q20_new_registrations": """select *, 'RECEIVED' as ingestion_status, client_code as source_name
        from named where client_code is not null
          and file_name not in (select file_name from file_events)
        qualify row_number() over (partition by file_name order by arrived_at, arrival_id) = 1""",
    "q21_latest_status": "select * from latest",
    "q22_paired_lineage": f"""select {_LINEAGE} from latest f
        join timed p on p.pipeline_name = 'claims_curate_job'
        order by f.received_at desc, f.event_id, p.run_id limit 20""",
    "q23_keyed_lineage": f"select {_LINEAGE} from latest f join timed p on p.file_name = f.file_name",
    "q23_clients_over_both_sources": f"""select client_code, c.total_claims, c.total_billed, f.files, f.curated_files from
        (select client_code, count(claim_id) as total_claims,
                cast(sum(billed_amount) as double) as total_billed
         from filed_keys where client_code is not null and {_VALID} group by client_code) c
        full outer join (select client_code, count(*) as files,
                count(*) filter (where ingestion_status = 'CURATED') as curated_files
              from latest group by client_code) f using (client_code)""",
    "q24_billed_histogram": """select cast(case when hi = lo then 0
          else least(floor((x - lo) / ((hi - lo) / 20)), 19) end as integer) as bin,
        count(*) as members
        from (select total_billed as x, min(total_billed) over () as lo,
                     max(total_billed) over () as hi from members) group by 1""",
    "q25_category_volumes": """select payer_id, category, claims from
        (select payer_id, low_claims as LOW, medium_claims as MEDIUM, high_claims as HIGH from payers)
        unpivot (claims for category in (LOW, MEDIUM, HIGH))""",
    "q26_stage_counts": f"""select pipeline_name, cast(sum(records_read) as bigint) as records_read,
        cast(sum(records_written) as bigint) as records_written,
        cast(sum(records_rejected) as bigint) as records_rejected from ({_RUN_COUNTS}) group by 1""",
    "q27_one_per_claim": f"""select {_AS_DOUBLE} from clean qualify row_number() over (partition by claim_id
        order by member_id nulls last, provider_npi nulls last, payer_id nulls last,
        cpt_code nulls last, icd10_code nulls last, place_of_service nulls last,
        billed_amount nulls last, service_date nulls last) = 1""",
    "q28_newest_files": "select * from latest order by received_at desc, event_id limit 50",
    "q29_newest_runs": "select * from timed order by started_at desc, run_id limit 50",
    "q30_quarantine_audit": f"""select source_file, validation_error, count(*) as rejected_claims from
        (select source_file, unnest(string_split({_ERRORS}, ', ')) as validation_error
         from filed where ({_VALID}) is not true) group by 1, 2""",
    "q31_chronic_split": """select case when has_chronic_condition then 'Chronic' else 'Non-Chronic' end
        as label, count(*) as members from members group by 1""",
    "q32_payer_summary_by_file": f"""select source_file, client_code, file_type, env, file_date, sequence, payer_id,
        {_volume()}, count(distinct member_id) as unique_members,
        count(distinct provider_npi) as unique_providers, {_AGE}, {_VOLUMES}
        from (select *, {_bucket()} as billed_category,
              date_diff('day', service_date, date '2002-01-01') as claim_age_days
              from filed_keys where client_code is not null and {_VALID}) group by all""",
    "q33_summary_differences": f"""select payer_id, 'changed' as change,
        count(*) as total_claims_before, count(*) as total_claims_after,
        count(*) filter (where b = 'LOW') as low_claims_before,
        count(*) filter (where a = 'LOW') as low_claims_after,
        count(*) filter (where b = 'MEDIUM') as medium_claims_before,
        count(*) filter (where a = 'MEDIUM') as medium_claims_after,
        count(*) filter (where b = 'HIGH') as high_claims_before,
        count(*) filter (where a = 'HIGH') as high_claims_after
        from (select payer_id, {_bucket()} as b, {_bucket(250, 600)} as a from clean) group by payer_id
        having low_claims_before <> low_claims_after or medium_claims_before <> medium_claims_after
            or high_claims_before <> high_claims_after""",
    "q34_salted_hashes": """select claim_id, sha256(concat(member_id, 'pepper')) as member_id_hash,
        sha256(concat(provider_npi, 'pepper')) as provider_npi_hash from clean""",
    "q35_code_table_profiles": """select 'cpt' as code_table, count(*) as listed_codes,
          count(distinct cpt_code) as distinct_codes,
          (select count(*) from (select 1 from cpt group by cpt_code having count(*) > 1)) as repeated_codes
        from cpt
        union all select 'icd10', count(*), count(distinct icd10_code),
          (select count(*) from (select 1 from icd10 group by icd10_code having count(*) > 1)) from icd10""",
    "q36_next_in_queue": """select distinct file_name, client_code, file_type, env, file_date, sequence
        from named where client_code is not null
        qualify row_number() over (partition by client_code, file_type
          order by file_date, sequence, env, file_name) = 1""",
    "q41_envelope_counts": f"""select concat('C', cast(o_custkey as varchar)) as source_file,
        count(*) as header_rows, count(*) as actual_rows,
        count(*) + case when o_custkey % 8 = 0 then 1 else 0 end as trailer_rows,
        o_custkey % 8 <> 0 as accepted from {_JOINED} group by o_custkey""",
    "q42_fixed_width_claims": """select claim_id, member_id, provider_npi,
        cast(billed_amount as varchar) as billed_amount,
        cast(place_of_service as varchar) as place_of_service from clean""",
    "q43_client_sql": f"""select claim_id, client_code, cast(billed_amount as double) as billed_amount,
        case when client_code = 'BCBS001' and billed_amount < 300 then 'LOW'
             when client_code = 'BCBS001' then 'HIGH' else {_bucket()} end as billed_category
        from filed_keys where client_code is not null and {_VALID}""",
    "q37_stream_record_states": f"""select *, {_ERRORS} as validation_errors,
        case when {_VALID} then 'clean' else 'quarantine' end as record_state
        from (select {_AS_DOUBLE} from claims)""",
    "q38_stream_distinct_claims": """select distinct claim_id from claims where claim_id is not null
        union all select claim_id from claims where claim_id is null""",
    "q39_run_member_summaries": f"""select concat('BCBS', lpad(cast(o % 20 as varchar), 3, '0')) as client_code,
        '837P' as file_type, 'PROD' as env, '20240131' as file_date, '001' as sequence,
        sha256(member_id) as member_id_hash, {_volume()},
        count(distinct provider_npi) as unique_providers, count(distinct payer_id) as unique_payers,
        bool_or(coalesce(chronic_text = 'true', false)) as has_chronic_condition,
        max(service_date) as most_recent_service_date
        from (select {_CLAIM_COLUMNS}, o_custkey as o from {_JOINED}) c
        left join icd10 on c.icd10_code = icd10.icd10_code where {_VALID} group by all""",
    "q40_run_audit": f"select *, 'CURATED' as ingestion_status, true as times_in_order from ({_RUN_COUNTS})",
    "q44_claim_files": f"""select source_file, nullif(concat(case when s % 7 = 0 then '@' else '' end, coalesce(claim_id, '')), '') as claim_id,
        cast(billed_amount as double) as billed_amount,
        case when s % 11 = 0 then 'no date' else cast(service_date as varchar) end as service_date,
        concat_ws(', ', nullif({_ERRORS.replace('claim_id is null', "claim_id is null and s % 7 <> 0")}, ''),
          case when s % 13 = 0 then 'surplus fields' end) as validation_errors
        from (select {_CLAIM_COLUMNS}, l_suppkey as s, {_RUN_FILE} as source_file from {_JOINED})""",
    "q46_stored_versions": f"""select client_code, payer_id, 'changed' as change,
        count(*) as total_claims_before, count(*) as total_claims_after,
        count(*) filter (where b = 'LOW') as low_claims_before,
        count(*) filter (where a = 'LOW') as low_claims_after,
        count(*) filter (where b = 'MEDIUM') as medium_claims_before,
        count(*) filter (where a = 'MEDIUM') as medium_claims_after,
        count(*) filter (where b = 'HIGH') as high_claims_before,
        count(*) filter (where a = 'HIGH') as high_claims_after
        from (select split_part({_RUN_FILE}, '_', 1) as client_code, payer_id, {_bucket()} as b, {_bucket(250, 600)} as a
              from (select {_CLAIM_COLUMNS}, o_custkey from {_JOINED}) where {_VALID}) group by client_code, payer_id
        having low_claims_before <> low_claims_after or medium_claims_before <> medium_claims_after
            or high_claims_before <> high_claims_after""",
    "q47_rerun_without_clean_rows": f"""select client_code,
        case when client_code = 'BCBS003' then 'FAILED' else 'CURATED' end as ingestion_status,
        case when client_code = 'BCBS003' then 0 else n end as claims,
        case when client_code = 'BCBS003' then 0 else m end as members,
        case when client_code = 'BCBS003' then 0 else p end as payers
        from (select split_part({_RUN_FILE}, '_', 1) as client_code, count(*) as n, count(distinct member_id) as m,
              count(distinct payer_id) as p from (select {_CLAIM_COLUMNS}, o_custkey from {_JOINED}) where {_VALID} group by 1)""",
    "q48_rolled_up_summaries": " union all ".join(
        f"""select '{name}' as summary, {key} as key, {key2} as key2, {_volume()}, {figures} from rerun group by {by}"""
        for name, key, key2, by, figures in _ROLLED
    ),
    "q49_landed_lines": f"""with f as (
          select {_NAMED.format("001")} as file_name, 'TRIGGER' as action, n, ok, client % 4 as kind, client, '' as part from kinds
          union all select {_NAMED.format("002")}, 'TRIGGER', n, ok, 0, client, 'copy' from kinds where client = 4
          union all select {_NAMED.format("003")}, 'TRIGGER', n, ok, 0, client, '' from kinds where client = 4
          union all select {_NAMED.format("004")}, 'TRIGGER', n, ok, 0, client, '' from kinds where client = 4
          union all select 'bcbs004_837P_PROD_20240131_001.csv', 'INVALID', n, ok, 0, client, 'refused' from kinds where client = 4)
        select file_name, action, n + 1 + case when kind > 0 then 3 else 0 end as all_lines,
          case when part = 'refused' then null when kind > 1 or part = 'copy' then 0 when kind = 1 then n + 1 else n end as records_read,
          case when part = 'refused' then null when kind > 1 or part = 'copy' then 0 else ok end as records_written,
          case when part = 'refused' then null when kind > 1 or part = 'copy' then 0
               when kind = 1 then n + 1 - ok else n - ok end as records_rejected,
          case when part = 'refused' then null when kind > 1 or part = 'copy' then 'QUARANTINED' else 'CURATED' end as ingestion_status,
          case when kind = 2 then 'checksums differ' when kind = 3 then 'checksum missing'
               when part = 'copy' then concat('same content as ', {_NAMED.format("001")}) end as error,
          true as same_again from f""",
    "q50_same_content": f"""select {_NAMED.format("002")} as file_name, {_NAMED.format("001")} as same_as from kinds where client = 4
        union all select 'bcbs004_837P_PROD_20240131_001.csv', {_NAMED.format("001")} from kinds where client = 4""",
    "q51_envelope_checksums": f"""select {_NAMED.format("001")} as source_file, n + 1 as header_rows, n + 1 as actual_rows, n + 1 as trailer_rows,
        case client % 4 when 1 then 'accepted' when 2 then 'checksum differs' else 'checksum missing' end as verdict,
        case client % 4 when 1 then true when 2 then false end as same_checksum from kinds where client % 4 > 0""",
    **{
        query: f"""select client_code, count(*) as providers, cast(sum(n) as bigint) as claims, cast(sum(m) as bigint) as members,
            cast(sum(b) as double) as total_billed
            from (select split_part({_RUN_FILE}, '_', 1) as client_code, provider_npi, count(claim_id) as n,
                  count(distinct member_id) as m, sum(billed_amount) as b
                  from (select {_CLAIM_COLUMNS}, o_custkey from {_JOINED})
                  where {_VALID} and (o_custkey % 20 <> 7 or place_of_service in (11, 21)) group by 1, 2) group by 1"""
        for query in ("q52_packed_lake", "q53_catalog_tables")
    },
    "q54_state_transitions": "select * from steps",
    "q55_state_figures": """select before_status, status, count(*) as times, count(distinct file_name) as files,
        cast(null as bigint) as seconds from steps where not legal group by 1, 2
        union all select 'any time in', before_status, count(*), count(distinct file_name), cast(sum(seconds) as bigint)
        from steps where before_status is not null group by 2""",
    "q56_stuck_files": f"""select * from (select file_name, ingestion_status as status, received_at as changed_at,
        cast(floor(epoch_us((select max(received_at) from file_events) - received_at) / 1000000.0) as bigint) as seconds from latest)
        where {" or ".join(f"(status = '{s}' and seconds > {n})" for s, n in _STUCK.items())}""",
    "q57_stream_transitions": """select * from steps
        where changed_at <= (select max(received_at) from file_events) - interval 1 hour""",
    "q58_run_outcomes": """select file_name, pipeline_name, count(*) as files,
        count(*) filter (where run_status = 'FAILED') as failed_files, count(*) filter (where ended_at is null) as open_files,
        case when count(*) filter (where ended_at is null) > 0 then 'RUNNING'
             when count(*) filter (where run_status = 'FAILED') = 0 then 'SUCCESS'
             when count(*) filter (where run_status = 'FAILED') = count(*) then 'FAILED' else 'PARTIAL' end as outcome
        from runs group by 1, 2""",
    "q59_stream_lineage": """select f.file_name, f.event_id, f.ingestion_status, f.received_at,
        r.run_id, r.run_status, r.started_at
        from file_events f left join runs r on r.file_name = f.file_name and r.pipeline_name = 'claims_curate_job'
          and r.started_at between f.received_at and f.received_at + interval 1 day
        where r.run_id is not null
           or f.received_at + interval 1 day <
              (select date_trunc('millisecond', max(started_at)) from runs where pipeline_name = 'claims_curate_job') - interval 1 hour""",
    "q60_two_schema_versions": f"""select client_code, count(*) as claims, cast(sum(date_diff('day', service_date, date '2002-01-01')) as bigint) as age_days,
        count(case when client_code = 'BCBS007' then payer_id end) as with_channel
        from (select {_CLAIM_COLUMNS}, split_part({_RUN_FILE}, '_', 1) as client_code from {_JOINED}) where {_VALID} group by 1""",
    "q61_stream_ingest": f"""with k as (select o_custkey % 20 as client, count(*) filter (where {_VALID}) as claims,
            cast(sum(billed_amount) filter (where {_VALID}) as double) as billed
            from (select {_CLAIM_COLUMNS}, o_custkey from {_JOINED}) group by 1)
        select {_NAMED.format("001")} as file_name, case when client % 4 > 1 then 'QUARANTINED' else 'CURATED' end as ingestion_status,
          case when client % 4 < 2 then claims end as claims, case when client % 4 < 2 then billed end as billed from k
        union all select concat('BCBS004_837P_PROD_20240131_', s, '.csv'), 'CURATED', claims, billed
        from k cross join (values ('002'), ('003'), ('004')) v(s) where client = 4""",
    "q62_corrected_claims": f"""select client_code, count(distinct provider_npi) as providers, count(claim_id) as claims,
        cast(sum(amount) as double) as total_billed, count(distinct payer) as payers, client in (3, 7) as written_again
        from (select split_part(source_file, '_', 1) as client_code, client, provider_npi, claim_id,
                case when client in (3, 7) and place_of_service = 23 then 'P99' else payer_id end as payer,
                case when client in (3, 7) and place_of_service = 23 then newest + 1000 else billed_amount end as amount
              from (select *, max(billed_amount) over (partition by claim_id) as newest
                    from (select {_CLAIM_COLUMNS}, o_custkey % 20 as client, {_RUN_FILE} as source_file from {_JOINED}))
              where {_VALID} and (client in (3, 7) and place_of_service = 31) is not true) group by client_code, client""",
    "q45_held_claims": """select source_file, count(*) as held_claims, cast(sum(billed_amount) as double) as held_billed
        from filed_keys where client_code is null group by 1""",
}


def _needed(sql: str) -> list[str]:
    """The named parts a statement uses, directly or through others, in order of definition."""
    used: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & (_CTES.keys() - used):
            used.add(name)
            todo.append(_CTES[name])
    return [name for name in _CTES if name in used]


def sql_of(query: str) -> str:
    body = _BODIES[query]
    parts = ", ".join(f"{name} as ({_CTES[name]})" for name in _needed(body))
    if not parts:
        return body
    if body.startswith("with "):
        return f"with {parts}, {body[5:]}"
    return f"with {parts} {body}"


def all_sql() -> dict[str, str]:
    return {query: sql_of(query) for query in _BODIES}
