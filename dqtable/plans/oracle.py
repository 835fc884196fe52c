"""The same results as plain SQL for DuckDB, written against the tables and not from the library."""

from __future__ import annotations

from dqtable.plans.people import COLUMNS, PEOPLE_SQL

COLS = ", ".join(COLUMNS)
OPTIONAL_NULLS = ", ".join(
    f"cast(null as varchar) as {c}"
    for c in ("position", "location", "status", "manager", "dob", "gender", "contract_type",
              "last_updated")
)
NUMBER = (
    r"^[+-]?((([0-9]+(_[0-9]+)*)(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)"
    r"([eE][+-]?[0-9]+(_[0-9]+)*)?|(?i:inf(inity)?))$"
)


def number(column: str) -> str:
    text = f"trim(replace(replace({column}, ',', ''), '$', ''))"
    value = f"try_cast(replace({text}, '_', '') as double)"
    return (
        f"case when regexp_matches({text}, '{NUMBER}') and {value} >= 0"
        f" and not isnan({value}) then {value} end"
    )


EMAIL = (
    "case when regexp_matches(lower(trim(email)), '^[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}$')"
    " then lower(trim(email)) end"
)
PHONE_TEXT = "regexp_replace(phone, '[^0-9+]', '', 'g')"
PHONE = f"case when regexp_matches({PHONE_TEXT}, '^\\+?[0-9]{{7,15}}$') then {PHONE_TEXT} end"
DATE = "try_strptime(trim(date_joined), ['%Y-%m-%d', '%m/%d/%Y', '%d/%m/%Y'])"


def text(column: str) -> str:
    return f"nullif(trim({column}), '')"


WITH = f"""with base as ({PEOPLE_SQL}),
dirty as (
  select {COLS} from base union all select {COLS} from base where copies = 2
),
dedup as (select {COLS}, count(*) as copies from dirty group by all),
ruled as (
  select *, {EMAIL} as c_email, {PHONE} as c_phone, {number('salary')} as c_salary, {DATE} as c_date
  from dedup
),
flagged as (
  select *, c_email is null as bad_email, c_phone is null as bad_phone,
    c_salary is null as bad_salary, c_date is null as bad_date,
    c_email is not null and c_phone is not null and c_salary is not null and c_date is not null
      as kept
  from ruled
)"""

CLEAN = f"""client_id, id, name, c_email as email, c_phone as phone, c_salary as salary,
  c_date as date_joined, {text('department')} as department, {text('notes')} as notes"""

COUNTERS = """cast(sum(copies) as bigint) as original_rows,
  cast(sum(copies - 1) as bigint) as duplicates_dropped,
  count(*) filter (bad_email) as invalid_emails_dropped,
  count(*) filter (bad_phone) as invalid_phones_dropped,
  count(*) filter (bad_salary) as invalid_numbers_dropped,
  count(*) filter (bad_date) as invalid_dates_dropped,
  count(*) filter (kept) as final_rows"""


def scored(report: str) -> str:
    return f"""select *, printf('%.2f%%', drop_rate * 100) as drop_rate_pct,
  case when drop_rate < 0.1::double then 'LOW' when drop_rate <= 0.3::double then 'MEDIUM'
       else 'HIGH' end as severity
from (select *, 1 - final_rows::double / original_rows::double as drop_rate from ({report}))"""


BY_CLIENT = scored(f"select client_id, {COUNTERS} from flagged group by client_id")

LIMITS = """(
  values ('AUTOMOBILE', 0.9::double, 10::bigint, 100::bigint, 'automobile@example.com'),
         ('BUILDING', 0.5::double, null, null, 'building@example.com'),
         ('MACHINERY', null, 100::bigint, 50::bigint, 'machinery@example.com')
) t(client_id, max_drop_rate, max_invalid_emails, max_invalid_phones, recipient)"""


def alerted(report: str) -> str:
    return f"""select r.*,
  coalesce(t.max_drop_rate, 0.5::double) as max_drop_rate,
  coalesce(t.max_invalid_emails, 1000::bigint) as max_invalid_emails,
  t.max_invalid_phones, t.recipient,
  case when drop_rate > coalesce(t.max_drop_rate, 0.5::double) then 'EXCEEDED' else 'OK' end
    as drop_rate_alert,
  case when invalid_emails_dropped > coalesce(t.max_invalid_emails, 1000) then 'EXCEEDED'
       else 'OK' end as invalid_emails_alert,
  case when t.max_invalid_phones is null then null
       when invalid_phones_dropped > t.max_invalid_phones then 'EXCEEDED' else 'OK' end
    as invalid_phones_alert
from ({report}) r left join {LIMITS} on r.client_id = t.client_id"""


ALERTED = alerted(BY_CLIENT)

SUBJECT = """case severity
  when 'HIGH' then '[ACTION REQUIRED] Data Quality Alert: High Drop Rate'
  when 'MEDIUM' then '[NOTICE] Data Quality Report: Moderate Issues'
  else 'Data Quality Report: Clean Run' end"""

# Copies come in a later delivery, so no delivery holds any.
DELIVERED = """delivered as (
  select 1 as d, * replace (1 as copies) from flagged
  union all select 2 as d, * replace (1 as copies) from flagged where copies = 2
)"""

BY_NATION = """select c_nationkey, count(*) as original_rows, 0::bigint as duplicates_dropped,
  count(*) filter (c_acctbal < 0) as invalid_numbers_dropped,
  count(*) filter (c_acctbal >= 0) as final_rows from customer group by c_nationkey"""

# Every token as text, then three fields that are none.
TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
NO_TOKENS = (" NA", "n/A", "x")
ALIASES = {
    "comments": "notes", "date": "date_joined", "dept": "department", "division": "department",
    "joindate": "date_joined", "joiningdate": "date_joined", "remarks": "notes",
}

SUMMARY = (
    ("Rows Loaded", "original_rows"),
    ("Rows Cleaned", "final_rows"),
    ("Drop Rate", "drop_rate_pct"),
    ("Severity", "severity"),
    ("Drop Rate Threshold", "max_drop_rate"),
    ("Drop Rate Alert", "drop_rate_alert"),
    ("Invalid Emails Dropped", "invalid_emails_dropped"),
    ("Invalid Emails Threshold", "max_invalid_emails"),
    ("Invalid Emails Alert", "invalid_emails_alert"),
    ("Pipeline Version", "'1.0'"),
)
METADATA = (
    ("report_version", "'1.0'"),
    ("analysis_version", "'1.0'"),
    ("timestamp", "'20240101_000000'"),
    ("client_name", "client_id"),
    ("recipient_email", "coalesce(recipient, 'Unknown')"),
)


def key_values(pairs: tuple[tuple[str, str], ...]) -> str:
    rows = " union all ".join(
        f"select client_id, '{key}' as key, cast({value} as varchar) as value from a"
        for key, value in pairs
    )
    return f"{WITH}, a as ({ALERTED}) {rows}"


def cells(sheet: str, source: str, key: str, values: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{sheet}' as sheet, {key} as key, '{item}' as item,"
        f" cast({value} as varchar) as value from {source}"
        for item, value in values.items()
    )


def every_sheet() -> str:
    counters = ("original_rows", "duplicates_dropped", "invalid_emails_dropped",
                "invalid_phones_dropped", "invalid_numbers_dropped", "invalid_dates_dropped",
                "final_rows")
    drift = {"missing_required_columns": "''", "extra_columns": "''"}
    absent = ("position", "location", "status", "manager", "dob", "gender", "contract_type",
              "last_updated")
    run = "(values ('timestamp', 'r1')) v(k, x)"
    metadata = dict(METADATA) | {"timestamp": f"(select x from {run})"}
    parts = [
        cells("report", "a", "client_id", {c: c for c in counters} | drift),
        cells("metadata", "a", "client_id", metadata),
        cells("summary", "a", "client_id", dict(SUMMARY)),
        cells("meta", "c", "''", {"rows": "count(*)", "columns": "max(17)"}),
        *(cells("missing", "c", f"'{c}'", {"missing": "count(*)"}) for c in absent),
        *(
            f"select * from ({cells('missing', 'c', repr(c), {'missing': f'count(*) - count({c})'})})"
            " where value <> '0'"
            for c in ("department", "notes")
        ),
        *(
            cells("statistics", "c", f"'{label}'", {"salary": f"round({call}(salary))::bigint"})
            for label, call in (("mean", "avg"), ("min", "min"), ("max", "max"), ("sum", "sum"))
        ),
        cells(
            "outbox",
            "a",
            "client_id",
            {"subject": SUBJECT, "body": "'[] [] ' || severity || ' ' || original_rows"},
        ),
        cells("runs", "t", "'r1'", {"rows": "original_rows", "label": "drop_rate_pct"}),
    ]
    total = scored(
        "select cast(sum(copies) as bigint) as original_rows,"
        " count(*) filter (kept) as final_rows from flagged"
    )
    return (
        f"{WITH}, a as ({ALERTED}), c as (select {CLEAN} from flagged where kept), t as ({total}) "
        + " union all ".join(f"select * from ({part})" for part in parts)
    )


BODY = (
    "'Dear ' || client_id || ',' || chr(10) || chr(10) || "
    "'your weekly data quality report is ready.' || chr(10) || "
    "'Rows loaded: ' || original_rows || chr(10) || 'Rows kept: ' || final_rows || chr(10) || "
    "'Drop rate: ' || drop_rate_pct || ' (' || severity || ')' || chr(10)"
)

LINEITEM = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax")
ORDERS = ("o_orderkey", "o_custkey", "o_totalprice")


def stats(name: str, columns: tuple[str, ...]) -> str:
    return " union all ".join(
        f"select '{label}' as statistic, '{c}' as \"column\","
        f" round(cast({call}({c}) as double), 4) as value from {name}"
        for c in columns
        for label, call in (("mean", "avg"), ("min", "min"), ("max", "max"), ("sum", "sum"))
    )


def stats_wide(name: str, columns: tuple[str, ...]) -> str:
    return " union all ".join(
        f"select '{label}' as statistic, "
        + ", ".join(f"round(cast({call}({c}) as double), 4) as {c}" for c in columns)
        + f" from {name}"
        for label, call in (("mean", "avg"), ("min", "min"), ("max", "max"), ("sum", "sum"))
    )


def correlation(source: str, columns: tuple[str, ...], digits: int = 9) -> str:
    def r(a: str, b: str) -> str:
        value = f"corr({a}::double, {b}::double)"
        constant = " or ".join(
            f"min({x}) filter ({y} is not null) = max({x}) filter ({y} is not null)"
            for x, y in ((a, b), (b, a))
        )
        value = "1.0::double" if a == b else f"round({value}, {digits})"
        return f"case when {constant} then null else {value} end"

    return " union all ".join(
        f"select '{a}' as col_a, '{b}' as col_b, {r(a, b)} as corr from {source}"
        for a in columns
        for b in columns
    )



def dirty(columns: str) -> str:
    return f"{WITH} select {columns} from dirty"


ORACLE: dict[str, str] = {
    "email_fix": dirty(f"id, {EMAIL} as fixed"),
    "email_valid": dirty(f"id, ({EMAIL}) is not null as valid"),
    "phone_normalize": dirty(f"id, {PHONE} as normalized"),
    "phone_valid": dirty(f"id, ({PHONE}) is not null as valid"),
    "numeric_clean": dirty(f"id, {number('salary')} as number"),
    "number_shapes": """select l_orderkey, l_linenumber, l_partkey,
  case when l_linenumber in (2, 3, 6) then null
       when l_linenumber = 4 then floor(l_extendedprice) * 1000
       when l_linenumber = 5 then floor(l_extendedprice) * 100
       else round(l_extendedprice, 2) end as number
from lineitem""",
    "date_clean": f"""{WITH}, days as (
  select id, date_joined from dirty union all
  select id, case when date_joined like '%/%' then regexp_replace(date_joined, '/20([0-9][0-9])$', '/30\\1')
    else regexp_replace(date_joined, '^20', '16') end from dirty
) select id, {DATE} as date from days""",
    "date_shapes": """select o_orderkey,
  case when o_orderpriority like '3%' then date_trunc('minute', o_orderdate)
       else date_trunc('day', o_orderdate)::timestamp end as date
from orders""",
    "text_clean": dirty(
        f"id, {text('department')} as department, {text('notes')} as notes"
    ),
    "null_tokens": dirty(
        "id, case when salary not in ('NaN', '') then salary end as salary, department"
    ),
    "null_tokens_all": "select c_custkey, case c_custkey % 22 "
    + " ".join(f"when {19 + i} then '{t}'" for i, t in enumerate(NO_TOKENS))
    + f" end as text from customer -- {len(TOKENS)} tokens, {len(NO_TOKENS)} others",
    "sql_functions": dirty(
        f"id, {EMAIL} as email, {PHONE} as phone, {number('salary')} as salary,"
        f" {DATE} as date_joined, {text('department')} as department"
    ),
    "header_aliases": " union all ".join(
        f"select c_custkey as id, '{alias}' as alias, c_name as value from customer"
        for alias in ALIASES
        for _ in range(2)
    ),
    "required_columns": dirty("id, date_joined, department, notes, email"),
    "header_alias_conform": dirty(f"{COLS}, {OPTIONAL_NULLS}"),
    "schema_drift_report": f"""{WITH}, d as (
  select client_id, id, name, email, salary, date_joined, department, notes, count(*) as copies
  from dirty group by all
) select cast(sum(copies) as bigint) as original_rows,
  cast(sum(copies - 1) as bigint) as duplicates_dropped,
  count(*) filter (({EMAIL}) is null) as invalid_emails_dropped,
  count(*) as invalid_phones_dropped,
  count(*) filter (({number('salary')}) is null) as invalid_numbers_dropped,
  count(*) filter (({DATE}) is null) as invalid_dates_dropped,
  0::bigint as final_rows, 'phone' as missing_required_columns, 'badge' as extra_columns
from d""",
    "multi_source_union": """select c_custkey as id, c_name as name, c_acctbal as salary,
  c_mktsegment as department, 'customer' as source from customer
union all by name
select s_suppkey as id, s_name as name, s_acctbal as salary, 'supplier' as source from supplier""",
    "dedup_counts": f"{WITH} select * from dedup",
    "dedup_lineitem": "select *, count(*) as copies from lineitem group by all",
    "invalid_flags": f"""{WITH} select id, bad_email, bad_phone, bad_salary,
  bad_date as bad_date_joined, kept, copies from flagged""",
    "clean_rows": f"{WITH} select {CLEAN} from flagged where kept",
    "all_rows_clean": f"""{WITH} select {CLEAN} from (
  select *, {EMAIL} as c_email, {PHONE} as c_phone, {number('salary')} as c_salary,
    {DATE} as c_date from dirty
) where c_email is not null and c_phone is not null and c_salary is not null
  and c_date is not null""",
    "rejects": f"""{WITH} select client_id, id, name, email, phone, salary, date_joined,
  department, notes,
  concat_ws(',', case when bad_email then 'email' end, case when bad_phone then 'phone' end,
    case when bad_salary then 'salary' end, case when bad_date then 'date_joined' end)
    as reject_reasons
from flagged where not kept""",
    "cleaning_report": f"{WITH} {scored(f'select {COUNTERS} from flagged')}",
    "cleaning_report_by_client": f"{WITH} {BY_CLIENT}",
    "extra_columns_kept": f"""{WITH} select id, c_email as email, '_email ' || id as _email,
  'copies ' || id as copies, 'kept ' || id as kept, 'raw ' || id as raw, 'row ' || id as row,
  'bad_email ' || id as bad_email from flagged where kept""",
    "empty_report": """select 0::bigint as original_rows, 0::bigint as duplicates_dropped,
  0::bigint as invalid_emails_dropped, 0::bigint as invalid_phones_dropped,
  0::bigint as invalid_numbers_dropped, 0::bigint as invalid_dates_dropped,
  0::bigint as final_rows, null::double as drop_rate, null::varchar as drop_rate_pct,
  null::varchar as severity""",
    "malformed_report": """select count(*) as original_rows, 0::bigint as duplicates_dropped,
  0::bigint as invalid_emails_dropped,
  count(*) filter (not wrong and c_custkey % 3 = 0) as invalid_phones_dropped,
  count(*) filter (wrong) as malformed_dropped,
  count(*) filter (not wrong and c_custkey % 3 <> 0) as final_rows
from (select *, c_custkey % 7 = 0 or c_custkey % 5 = 0 or c_custkey % 11 = 0 as wrong
  from customer)""",
    "severity_by_nation": scored(BY_NATION),
    "nation_alerts": f"""select r.*, coalesce(t.rate, 0.5::double) as max_drop_rate,
  t.numbers as max_invalid_numbers, t.recipient,
  case when drop_rate > coalesce(t.rate, 0.5::double) then 'EXCEEDED' else 'OK' end
    as drop_rate_alert,
  case when t.numbers is null then null when invalid_numbers_dropped > t.numbers then 'EXCEEDED'
       else 'OK' end as invalid_numbers_alert
from ({scored(BY_NATION)}) r left join (
  values (0, 0.01::double, 0::bigint, 'zero@example.com'),
         (1, 0.2::double, 100000::bigint, 'one@example.com'), (2, null, 1::bigint, null)
) t(c_nationkey, rate, numbers, recipient) on r.c_nationkey = t.c_nationkey""",
    "threshold_alerts": f"{WITH} {ALERTED}",
    "alert_outbox": f"""{WITH} select client_id, recipient, {SUBJECT} as subject,
  {BODY} as body, severity, drop_rate_alert, invalid_emails_alert, invalid_phones_alert
from ({ALERTED})""",
    "summary_sheet": key_values(SUMMARY),
    "metadata_sheet": key_values(METADATA),
    "profile_missing": f"""{WITH}, n as (
  select count(*) as rows, count(client_id) as client_id, count(id) as id, count(name) as name,
    count(email) as email, count(phone) as phone, count(salary) as salary,
    count(date_joined) as date_joined, count(department) as department, count(notes) as notes
  from (select {CLEAN} from flagged)
) select "column", rows - present as missing
from (unpivot n on columns(* exclude rows) into name "column" value present)
where rows > present""",
    "profile_summary": f"""select count(*) as row_count, 11::bigint as column_count,
  '{",".join(LINEITEM)}' as numeric_columns from lineitem""",
    "profile_stats": stats("lineitem", LINEITEM),
    "profile_stats_orders": stats("orders", ORDERS),
    "profile_stats_events": stats("events", ("value", "user_id")),
    "profile_stats_wide": stats_wide("lineitem", LINEITEM),
    "profile_stats_exact": " union all ".join(
        f"select '{call}' as statistic, '{name}' as \"column\","
        f" cast(cast({call}({value}) as decimal(38, 2)) as varchar) as exact from lineitem"
        for call in ("min", "max", "sum")
        for name, value in (
            ("order_key", "l_orderkey + 9007199254740993"),
            ("part_key", "l_partkey - 1152921504606846976"),
            ("price", "cast(l_extendedprice as decimal(15, 2))"),
        )
    ),
    "profile_empty": " union all ".join(
        f"select '{part}' as part, 0::bigint as \"values\""
        for part in ("summary", "missing", "statistics", "correlation")
    ),
    "profile_correlation": correlation("lineitem", LINEITEM),
    "profile_correlation_wide": f"""with w as (select {", ".join(LINEITEM)},
  case when l_linenumber <> 2 then l_quantity end as gap_quantity,
  case when l_linenumber > 3 then l_discount end as gap_discount,
  l_tax + l_discount as charges, l_partkey + 1000000 as far_key,
  l_quantity * -2 as negative, sqrt(l_extendedprice) as root from lineitem) """
    + correlation(
        "w",
        (*LINEITEM, "gap_quantity", "gap_discount", "charges", "far_key", "negative", "root"),
        7,
    ),
    "csv_encoding": """select c_custkey::varchar as id, 'é ü ' || c_name || ' "ß", ñ' as name
from customer""",
    "profile_correlation_gaps": "with e as (select event_id, value,"
    " case when event_type <> 'click' then user_id end as user_id, 0.1::double as constant"
    " from events) " + correlation("e", ("event_id", "value", "user_id", "constant")),
    "csv_roundtrip_clean": f"{WITH} select {CLEAN} from flagged where kept",
    "report_tables": every_sheet(),
    "run_record": f"""{WITH} select 'r1' as run, timestamp '2024-01-05 10:30:00' as time,
  'report/run_id=r1' as report_path, * from ({scored(
        '''select cast(sum(copies) as bigint) as original_rows,
  count(*) filter (kept) as final_rows from flagged'''
    )})""",
    "checked_report": f"""{WITH} select client_id, cast(sum(copies) as bigint) as original_rows,
  0::bigint as final_rows from flagged group by client_id""",
    "incremental_clean": f"""{WITH}, {DELIVERED}
{scored(f'select client_id, {COUNTERS}, 0::bigint as malformed_dropped from delivered group by client_id')}""",
    "incremental_outbox": f"""{WITH}, {DELIVERED} select client_id, recipient,
  {SUBJECT} as subject, client_id || ' ' || original_rows || ' ' || final_rows || ' []' as body,
  drop_rate_alert
from ({alerted(scored(f'select d, client_id, {COUNTERS} from delivered group by d, client_id'))})""",
    "incremental_runs": f"""{WITH}, {DELIVERED} select original_rows, final_rows, severity
from ({scored(f'select d, {COUNTERS} from delivered group by d')})""",
    "incremental_dedup": f"""{WITH} select 0::bigint as delivery, client_id,
  count(*) as original_rows, 0::bigint as duplicates_dropped,
  count(*) filter (bad_email) as invalid_emails_dropped,
  count(*) filter (bad_phone) as invalid_phones_dropped,
  count(*) filter (bad_salary) as invalid_numbers_dropped,
  count(*) filter (bad_date) as invalid_dates_dropped, 0::bigint as malformed_dropped,
  count(*) filter (kept) as final_rows from flagged group by client_id
union all select 1, client_id, count(*), count(*), 0, 0, 0, 0, 0, 0 from flagged
where copies = 2 group by client_id""",
    "incremental_profile": f"""with u as (
  select * replace (case when l_linenumber <= 3 then l_tax end as l_tax) from lineitem
) select statistic, "column" as col_a, '' as col_b, value from ({stats("u", LINEITEM)})
union all select 'missing', 'l_tax', '', cast(count(*) - count(l_tax) as double) from u
union all select 'correlation', col_a, col_b, corr from ({correlation("u", LINEITEM, 7)})""",
    "whole_runs": f"""{WITH} select 'r1' as run_id, client_id,
  cast(sum(copies) as bigint) as original_rows, count(*) filter (kept) as final_rows
from flagged group by client_id
union all select 'r2', client_id, cast(sum(copies) as bigint), count(*) filter (kept)
from flagged where client_id = 'BUILDING' group by client_id""",
    "row_rules_report": f"""{WITH}, b as (
  select *, case when k % 3 = 0 then 'shared' when k % 7 = 0 then 'pair ' || (k // 14)
                 when k % 5 <> 0 then 'own ' || id end as badge
  from (select *, id::bigint as k from flagged)
), c as (
  select *, badge is not null and count(*) over (partition by badge) > 1 as bad_badge,
    notes is null as bad_notes from (
    select client_id, id, badge, notes, email, any_value(bad_email) as bad_email,
      sum(copies) as copies from b group by all)
) {scored("""select client_id, cast(sum(copies) as bigint) as original_rows,
  cast(sum(copies - 1) as bigint) as duplicates_dropped,
  count(*) filter (bad_badge) as invalid_repeats_dropped,
  count(*) filter (bad_notes) as invalid_nulls_dropped,
  count(*) filter (bad_email) as invalid_emails_dropped,
  count(*) filter (not bad_badge and not bad_notes and not bad_email) as final_rows
  from c group by client_id""")}""",
    "reject_places": f"""{WITH}, copy as (
  select *, id::bigint as k from dirty
), placed as (
  select client_id, id, 2 + coalesce(sum(case when k % 10 = 0 then 2 else 1 end) over (
    partition by client_id order by k rows between unbounded preceding and 1 preceding), 0) as line
  from copy
) select f.client_id as file, cast(min(line) as bigint) as line, f.id,
  any_value(concat_ws(',', case when bad_email then 'email' end, case when bad_phone then 'phone' end,
    case when bad_salary then 'salary' end, case when bad_date then 'date_joined' end)) as reasons
from flagged f join placed p on f.client_id = p.client_id and f.id = p.id where not kept
group by f.client_id, f.id""",
    "mixed_files": """select c_custkey::varchar as id,
  case when c_custkey % 3 < 2 then 'é ' || c_name end as name,
  case when c_custkey % 3 <> 1 then c_mktsegment end as department,
  case when c_custkey % 3 = 1 then c_nationkey::varchar end as phone,
  case c_custkey % 3 when 0 then 'a' when 1 then 'b' else 'c' end as file from customer""",
    "messages_once": f"""{WITH} select 'r1' as run, client_id, {BODY} as body from ({BY_CLIENT})
union all select 'r3', client_id, {BODY} from ({scored(
        f"""select client_id, {COUNTERS} from flagged
  where client_id = 'BUILDING' and id::bigint % 2 = 0 group by client_id"""
    )})""",
    "schema_history": f"""{WITH} select run_id, "column", change, before, after, original_rows from (
  values ('002', 'badge', 'added', null, 'int'), ('002', 'notes', 'removed', 'string', null),
    ('003', 'notes', 'added', null, 'string'), ('003', 'salary', 'type changed', 'string', 'double')
) v(run_id, "column", change, before, after),
(select cast(sum(copies) as bigint) as original_rows from flagged)""",
}
