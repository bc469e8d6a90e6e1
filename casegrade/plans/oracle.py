"""Independent SQL (DuckDB dialect) for every registered query.

Written from the rules, over the pre-registered views of the test tables. All
values are written out here: nothing is imported from the code under test, so a
wrong point value, name or test list there shows as a difference.
"""

from __future__ import annotations

RAW_CLAIMS = """
raw_claims as (
    select case when o_orderkey % 97 = 0 then null
                when o_orderkey % 89 = 0 then '   '
                when o_orderkey % 71 = 0 then ' C' || cast(o_orderkey % 10 as varchar) || ' '
                else ' C' || cast(o_orderkey as varchar) || ' ' end as claim_id,
           case when o_orderkey % 53 = 0 then 'unknown'
                else cast(cast(o_orderdate as date) as varchar) end as date_of_loss,
           case when o_orderkey % 59 = 0 then null else p.part end as body_part,
           case when o_orderkey % 61 = 0 then 'maybe' when o_orderstatus = 'F' then 'true'
                else 'false' end as is_litigated,
           case when o_orderkey % 67 = 0 then 'many' else cast(o_custkey % 6 as varchar) end as number_of_priors,
           o_custkey, 'orders.parquet' as _source_file
    from orders left join (values ('1-URGENT', ' Spine '), ('2-HIGH', 'HEAD'), ('3-MEDIUM', 'Back'),
                                  ('4-NOT SPECIFIED', 'knee'), ('5-LOW', 'arm')) p(priority, part)
         on o_orderpriority = p.priority
)"""

STG_CLAIMS = """
stg_claims as (
    select trim(claim_id) as claim_id, try_cast(date_of_loss as date) as date_of_loss,
           lower(trim(body_part)) as body_part, try_cast(is_litigated as boolean) as is_litigated,
           try_cast(number_of_priors as integer) as number_of_priors, o_custkey, _source_file
    from raw_claims
    where trim(claim_id) <> ''
)"""

RAW_MEDICAL = """
line_events as (
    select case when l_partkey % 83 = 0 then null when l_partkey % 79 = 0 then ' '
                else 'C' || cast(l_orderkey as varchar) end as claim_id,
           case l_returnflag when 'R' then 'surgery' when 'A' then 'opioid prescription'
                             when 'N' then 'physical therapy' end as kind,
           case when l_suppkey % 41 = 0 then 'soon' else cast(cast(l_shipdate as date) as varchar) end as day,
           l_linenumber
    from lineitem
),
raw_medical as (
    select claim_id,
           case when l_linenumber = 4 then [{'type': kind, 'date': day}, {'type': ' SURGERY ', 'date': day}, null]
                when l_linenumber = 5 then [{'type': kind, 'date': day}, {'type': ' ', 'date': null}]
                when l_linenumber = 6 then []
                when l_linenumber = 7 then null
                else [{'type': kind, 'date': day}] end as medical_events
    from line_events
)"""

STG_MEDICAL = """
stg_medical as (
    select trim(claim_id) as claim_id, lower(trim(event.type)) as event_type,
           try_cast(event.date as date) as event_date, 'lineitem.parquet' as _source_file
    from (select claim_id, unnest(medical_events) as event from raw_medical) f
    where trim(claim_id) <> '' and trim(event.type) <> ''
)"""

# The flags as counts of matching events; the score as a sum of points over
# the table of rules that a claim meets.
SCORING = """
flags as (
    select claim_id,
           least(count(*) filter (where event_type = 'surgery'), 1)::integer as has_surgery,
           least(count(*) filter (where event_type = 'opioid prescription'), 1)::integer as has_opioid
    from stg_medical group by all
),
numbered as (
    select row_number() over () as n, s.claim_id, s.date_of_loss, s.body_part, s.is_litigated, s.number_of_priors,
           ifnull(f.has_surgery, 0) as has_surgery, ifnull(f.has_opioid, 0) as has_opioid, s._source_file
    from stg_claims s left join flags f using (claim_id)
),
met as (
    select n, 15 as points from numbered where body_part in ('spine', 'head', 'back')
    union all select n, 20 from numbered where is_litigated
    union all select n, 10 from numbered where number_of_priors >= 3
    union all select n, 25 from numbered where has_surgery = 1
    union all select n, 15 from numbered where has_opioid = 1
),
totals as (select n, sum(points)::integer as total from met group by n),
scored as (
    select numbered.* exclude (n), ifnull(total, 0) as complexity_score,
           (select max_by(name, floor) from (values ('LOW', 0), ('MEDIUM', 30), ('HIGH', 50)) b(name, floor)
            where floor <= ifnull(total, 0)) as complexity_band
    from numbered left join totals using (n)
),
gold as (
    select claim_id, date_of_loss, body_part, is_litigated, number_of_priors, has_surgery, has_opioid,
           complexity_score, complexity_band, date '2026-01-01' as report_date,
           current_timestamp as processed_at, _source_file
    from scored where complexity_band = 'HIGH'
)"""

CHAIN = [RAW_CLAIMS, STG_CLAIMS, RAW_MEDICAL, STG_MEDICAL, SCORING]


def with_chain(body: str) -> str:
    return "with " + ",".join(CHAIN) + "\n" + body


# (reported model, source, column, test, accepted values)
TESTS = [
    ("stg_claims", "stg_claims", "claim_id", "not_null", ""),
    ("stg_claims", "stg_claims", "claim_id", "unique", ""),
    ("stg_claims", "stg_claims", "date_of_loss", "not_null", ""),
    ("stg_claims", "stg_claims", "body_part", "not_null", ""),
    ("stg_claims", "stg_claims", "is_litigated", "not_null", ""),
    ("stg_claims", "stg_claims", "number_of_priors", "not_null", ""),
    ("stg_medical_activity", "stg_medical", "claim_id", "not_null", ""),
    ("stg_medical_activity", "stg_medical", "event_type", "not_null", ""),
    ("stg_medical_activity", "stg_medical", "event_type", "accepted_values", "'surgery', 'opioid prescription'"),
    ("stg_medical_activity", "stg_medical", "event_date", "not_null", ""),
    ("int_claim_complexity_score", "scored", "claim_id", "not_null", ""),
    ("int_claim_complexity_score", "scored", "claim_id", "unique", ""),
    ("int_claim_complexity_score", "scored", "complexity_score", "not_null", ""),
    ("int_claim_complexity_score", "scored", "complexity_band", "not_null", ""),
    ("int_claim_complexity_score", "scored", "complexity_band", "accepted_values", "'LOW', 'MEDIUM', 'HIGH'"),
    ("high_complexity_claims_daily", "gold", "claim_id", "not_null", ""),
    ("high_complexity_claims_daily", "gold", "claim_id", "unique", ""),
    ("high_complexity_claims_daily", "gold", "complexity_score", "not_null", ""),
    ("high_complexity_claims_daily", "gold", "complexity_band", "not_null", ""),
    ("high_complexity_claims_daily", "gold", "complexity_band", "accepted_values", "'HIGH'"),
    ("high_complexity_claims_daily", "gold", "report_date", "not_null", ""),
    ("high_complexity_claims_daily", "gold", "processed_at", "not_null", ""),
]


def _dq_select(model: str, source: str, column: str, test: str, values: str) -> str:
    failed = {
        "not_null": f"select count(*) - count({column}) from {source}",
        "unique": f"select count(*) from (select {column} from {source} group by 1 having count({column}) > 1)",
        "accepted_values": f"select count(distinct {column}) from {source} where {column} not in ({values or 'null'})",
    }[test]
    return (f"select '{model}' as model, '{column}' as column_name, '{test}' as test, "
            f"(select count(*) from {source}) as n_rows, ({failed}) as n_failed")


def dq_sql(kinds: tuple[str, ...], with_passed: bool) -> str:
    body = "\nunion all\n".join(_dq_select(*t) for t in TESTS if t[3] in kinds)
    if with_passed:
        body = f"select *, n_failed = 0 as passed from (\n{body}\n) r"
    return with_chain(body)


CLAIM = "claim_id, date_of_loss, body_part, is_litigated, number_of_priors"

CORE_SQL = {
    "stg_claims": with_chain(f"select {CLAIM}, _source_file from stg_claims"),
    "stg_medical_activity": with_chain("select claim_id, event_type, event_date, _source_file from stg_medical"),
    "medical_flags": with_chain("select claim_id, has_surgery, has_opioid from flags"),
    "claim_medical_join": with_chain(f"select {CLAIM}, has_surgery, has_opioid, _source_file from scored"),
    "complexity_score": with_chain(
        f"select {CLAIM}, has_surgery, has_opioid, complexity_score, _source_file from scored"),
    "complexity_band": with_chain("select * from scored"),
    "high_complexity_daily": with_chain("select * exclude (processed_at) from gold"),
    "dq_not_null": dq_sql(("not_null",), False),
    "dq_unique": dq_sql(("unique",), False),
    "dq_accepted_values": dq_sql(("accepted_values",), False),
    "dq_report": dq_sql(("not_null", "unique", "accepted_values"), True),
}


# The dirty payloads (see the fixture): records in lists by month, cut-off files
# and files that are not UTF-8.
DIRTY = """
    select case when o_orderkey % 64 in (9, 17) or o_orderkey % 8 = 7 then null
                when o_orderkey % 8 = 6 then '{"id":' || cast(o_orderkey as varchar) || '}'
                else 'D' || cast(o_orderkey as varchar) end as claim_id,
           case when o_orderkey % 64 in (9, 17) then -1
                else [1, 1, 1, 1, 4, -1, 0, -1][o_orderkey % 8 + 1] end as n_events,
           case when o_orderkey % 64 in (9, 17) then null
                when o_orderkey % 8 <= 3 then 'surgery' end as first_type,
           case when o_orderkey % 64 in (9, 17) then 'corrupt'
                else [null, null, 'repeated key',
                      '{"note":"n","medical_events":[{"event":0,"rest":{"dose":5}}]}',
                      '{"medical_events":[{"event":0,"rest":{"_value":"surgery"}},{"event":1,"rest":{"_value":7}}]}',
                      '{"medical_events":"surgery"}', null, 'no record'][o_orderkey % 8 + 1] end as rescued,
           o_orderkey % 64 not in (9, 17) as as_in_ledger
    from orders"""

INGEST_SQL = {
    "ingest_claims_csv": with_chain(f"select {CLAIM} from stg_claims"),
    "rescued_fields": with_chain(
        "select claim_id, '{\"policy_id\":\"P' || cast(o_custkey as varchar) || '\"}' as _rescued_data "
        "from stg_claims where body_part in ('back', 'knee')"),
    "ingest_medical_json": with_chain("select claim_id, event_type, event_date from stg_medical"),
    "ingest_medical_split": with_chain("select claim_id, event_type, event_date from stg_medical"),
    "ingest_table_sink": with_chain("select claim_id, event_type, event_date from stg_medical"),
    "ingest_incremental": with_chain(
        f"select {CLAIM}, case when is_litigated then 0 else 1 end as batch_id from stg_claims"),
    "json_dirty_records": DIRTY,
    "bronze_by_name": with_chain(
        "select claim_id, ifnull(len(medical_events), -1)::integer as n_events, true as has_time from raw_medical"),
    "lineage_to_ledger": with_chain(
        "select claim_id, 'sftp_claims' as source_system, true as has_time, true as ends_in_name, true as hashed "
        "from raw_claims"),
}


EVENT_PAYLOADS = """
    select event_id, ts,
           case event_type
             when 'click' then '[' || props || ', ' || props || ']'
             when 'view' then '{"data": [' || props || '], "page": 1}'
             when 'signup' then '{"results": [' || props || ', ' || props || ', ' || props || ']}'
             when 'purchase' then '{"data": ' || cast(user_id as varchar) || ', "item": ' || props || '}'
             else 'error: ' || props end as payload
    from events"""

EVENT_MANIFEST = f"""
    select event_id, ts, case when ok then 'LANDED' else 'FAILED' end as status,
           case when ok then sha256(payload) end as payload_hash,
           case when ok then coalesce(json_array_length(lists[1]), 1)::bigint end as record_count
    from (select *, json_valid(payload) as ok,
                 case when json_valid(payload) then list_filter(
                     [payload::json, payload::json -> '$.data', payload::json -> '$.results'],
                     lambda x: json_type(x) = 'ARRAY') end as lists
          from ({EVENT_PAYLOADS}) p) q"""

DOC_FILES = "(select text || chr(10) as content from documents) f"

LEDGER_SQL = {
    "ledger_file_scan": f"""
        select 'sftp_claims' as source_system, strlen(content) as file_size_bytes, sha256(content) as file_hash,
               'LANDED' as status, true as path_ends_in_name, true as has_suffix, true as has_time
        from {DOC_FILES}""",
    "ledger_duplicates": f"""
        select sha256(content) as file_hash, count(*) over same as n_copies, count(*) over same > 1 as is_duplicate_content
        from {DOC_FILES} window same as (partition by sha256(content))""",
    "ledger_runs": """
        select (doc_id % 3)::integer as run, 'sftp_claims' as source_system, strlen(text || chr(10)) as file_size_bytes,
               sha256(text || chr(10)) as file_hash, 'LANDED' as status
        from documents""",
    "ledger_payload_pages": """
        select 'api_medical_activity' as source_system, 'LANDED' as status, count(*) as n_records, 0::bigint as n_twice
        from lineitem""",
    "ledger_new_files": """
        with man as (
            select 'claims_' || cast(doc_id as varchar) || '.csv' as file_name
            from labels where toxic is distinct from 1 and quality = 1),
        cand as (
            select 'claims_' || cast(doc_id as varchar) ||
                   case lang when 'de' then '.CSV' when 'fr' then '.txt' else '.csv' end as file_name
            from documents)
        select file_name from cand anti join man using (file_name) where lower(file_name) like '%.csv'""",
    "payload_hash": "select doc_id, sha256(text) as payload_hash from documents",
    "payload_record_count": f"select event_id, record_count, status from ({EVENT_MANIFEST}) m",
    "payload_manifest": "select 'LANDED' as status, count(*) as n_records from lineitem",
    "ledger_status": f"""
        select event_id, status, payload_hash, record_count, status = 'FAILED' as has_error
        from ({EVENT_MANIFEST}) m""",
    # run 1: first half of the time range; run 2: everything not yet LANDED.
    # Payloads are fixed per event, so FAILED ones of run 1 are there twice.
    "ledger_append": f"""
        with m as (
            select *, case when status = 'FAILED' and ts < (
                       select min(ts) + (max(ts) - min(ts)) / 2 from events) then 2 else 1 end as times
            from ({EVENT_MANIFEST}) e)
        select status, sum(times)::bigint as n_rows, sum(record_count)::bigint as n_records from m group by status""",
}


# (table, comment, its columns in order)
_CLAIM = ["claim_id", "date_of_loss", "body_part", "is_litigated", "number_of_priors"]
_LINEAGE = ["_source_file", "_ingested_at", "_rescued_data"]
_FLAGS = ["has_surgery", "has_opioid", "complexity_score", "complexity_band"]
COMMENTED = [
    ("bronze.raw_claims", "Claim rows as landed in CSV files, all text, with lineage and rescued fields.",
     [*_CLAIM, "_rescued_data", "_ingested_at", "_source_file"], "raw_claims"),
    ("bronze.raw_medical_activity", "Medical-activity records as landed in JSON payload files, with lineage.",
     ["claim_id", "medical_events", "_rescued_data", "_ingested_at", "_source_file"], "raw_medical"),
    ("silver.stg_claims", "Claims cleaned and typed from the raw claims table.", [*_CLAIM, *_LINEAGE], "stg_claims"),
    ("silver.stg_medical_activity", "One row per medical event, cleaned and typed.",
     ["claim_id", "event_type", "event_date", *_LINEAGE], "stg_medical"),
    ("silver.int_claim_complexity_score", "Claims joined to medical flags, scored and banded.",
     [*_CLAIM, *_FLAGS, "_source_file", "_ingested_at"], "scored"),
    ("gold.high_complexity_claims_daily", "High-complexity claims for reporting, rebuilt on every run.",
     [*_CLAIM, *_FLAGS, "report_date", "processed_at", "_source_file", "_ingested_at"], "gold"),
]
COLUMN_COMMENTS = {
    "claim_id": "Claim identifier (business key).", "date_of_loss": "Date the loss occurred.",
    "body_part": "Injured body part, lower case.", "is_litigated": "Whether the claim is in litigation.",
    "number_of_priors": "Number of earlier claims.", "medical_events": "Events of the record, as landed.",
    "event_type": "Medical event type, lower case.", "event_date": "Date of the medical event.",
    "has_surgery": "1 when any event of the claim is a surgery.",
    "has_opioid": "1 when any event of the claim is an opioid prescription.",
    "complexity_score": "Additive complexity score.", "complexity_band": "LOW, MEDIUM or HIGH.",
    "report_date": "Date the report was built.", "processed_at": "Time the row was written to the report.",
    "_rescued_data": "Unexpected or unreadable fields, as JSON.", "_ingested_at": "Time the record was loaded (UTC).",
    "_source_file": "File the record came from, spelled as in the ledgers.",
}


def _comments_sql() -> str:
    rows = []
    for table, comment, columns, source in COMMENTED:
        rows.append(f"select '{table}' as table_name, null::varchar as column_name, '{comment}' as comment, "
                    f"(select count(*) from {source}) as n_rows")
        rows += [f"select '{table}', '{c}', '{COLUMN_COMMENTS[c]}', null" for c in columns]
    rows += ["select 'audit.no_comments', null, null, null", "select 'audit.no_comments', 'status', null, null"]
    return with_chain("\nunion all\n".join(rows))


def _observed(model: str, source: str, column: str, test: str, values: str) -> str:
    failed = (f"count(*) - count({column})" if test == "not_null"
              else f"count(*) filter (where {column} not in ({values}))")
    return (f"select '{model}' as model, '{column}' as column_name, '{test}' as test, count(*) as n_rows, "
            f"{failed} as n_failed_rows from {source}")


def _violating(model: str, source: str, column: str, test: str, values: str) -> str:
    head = f"select '{model}' as model, '{column}' as column_name, '{test}' as test, claim_id as row_key, "
    if test == "not_null":
        return head + f"null::varchar as value, count(*) as n_records from {source} where {column} is null group by claim_id"
    if test == "unique":
        return head + f"claim_id as value, count(*) as n_records from {source} group by claim_id having count(claim_id) > 1"
    return head + (f"{column}::varchar as value, count(*) as n_records from {source} "
                   f"where {column} not in ({values}) group by claim_id, {column}")


INFERRED = """,
texts as (
    select claim_id, date_of_loss, body_part, is_litigated, number_of_priors, null::varchar as nothing from raw_claims),
keys as (
    select o_orderkey::varchar as whole, (o_orderkey::bigint * 10000000000)::varchar as big,
           lpad(o_orderkey::varchar, 12, '0') as padded, o_totalprice::decimal(18, 4)::varchar as price from orders),
vals as (
    select 'claim_id' as c, trim(claim_id) as v from texts union all select 'date_of_loss', trim(date_of_loss) from texts
    union all select 'body_part', trim(body_part) from texts union all select 'is_litigated', trim(is_litigated) from texts
    union all select 'number_of_priors', trim(number_of_priors) from texts union all select 'nothing', nothing from texts
    union all select 'whole', whole from keys union all select 'big', big from keys
    union all select 'padded', padded from keys union all select 'price', price from keys),
per as (
    select c, count(*) filter (where v <> '') as n,
           count(*) filter (where v in ('true', 'false')) as b,
           count(*) filter (where regexp_matches(v, '^-?(0|[1-9][0-9]*)$') and try_cast(v as integer) is not null) as i,
           count(*) filter (where regexp_matches(v, '^-?(0|[1-9][0-9]*)$') and try_cast(v as bigint) is not null) as l,
           count(*) filter (where regexp_matches(v, '^-?(0|[1-9][0-9]*)([.][0-9]+)?$')) as d,
           count(*) filter (where try_cast(v as date) is not null and length(v) = 10) as t
    from vals group by c),
ways as (
    select c, n, 1 as place, 'boolean' as kind, b as held from per union all select c, n, 2, 'int', i from per
    union all select c, n, 3, 'bigint', l from per union all select c, n, 4, 'double', d from per
    union all select c, n, 5, 'date', t from per union all select c, n, 6, 'text', n from per)
select c as column_name, kind as inferred_type, n as n_values, n - held as n_failing
from ways where kind = 'text' or n > 0 and n - held <= 0.05 * n
qualify row_number() over (partition by c order by place) = 1"""

MODEL_SQL = {
    "inferred_types": "with " + RAW_CLAIMS + INFERRED,
    "payload_file_names": """
        select event_id, 'medical_activity_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' as file_name from events""",
    "schema_registry": """
        select table_name, count(*)::integer as n_columns, true as same_again, true as change_stopped
        from information_schema.columns
        where table_name in ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events', 'documents',
                             'embeddings', 'pages', 'benchmark', 'labels', 'conversations')
        group by table_name""",
    "gold_rebuild": with_chain("select * exclude (processed_at, report_date), date '2026-01-02' as report_date from gold"),
    "catalog_comments": _comments_sql(),
    "dq_observed": with_chain("\nunion all\n".join(_observed(*t) for t in TESTS if t[3] != "unique")),
    "dq_violations": with_chain("\nunion all\n".join(_violating(*t) for t in TESTS)),
}
