"""Table quality on Spark: contracts, cleaning, rejects, reports, profiles and alerts."""

from dqtable.contract import PEOPLE, Rule, TableContract
from dqtable.errors import ContractError, EmptyResultError
from dqtable.functions.apply import apply_rules
from dqtable.functions.dates import clean_date
from dqtable.functions.rules import (
    clean_numeric,
    fix_email,
    normalize_phone,
    validate_email,
    validate_phone,
)
from dqtable.functions.sql import register_functions
from dqtable.functions.text import clean_text, null_tokens, strip
from dqtable.operators.clean import clean_data, clean_rows, dedup_counts, flag_rows, reject_rows
from dqtable.operators.headers import (
    conform,
    normalize_headers,
    schema_changes,
    schema_diff,
    schema_table,
)
from dqtable.operators.ledger import post_messages
from dqtable.operators.outbox import outbox
from dqtable.operators.profile import (
    correlation_of,
    merge_pairs,
    merge_profiles,
    missing_of,
    pair_states,
    profile_columns,
    profile_correlation,
    profile_exact,
    profile_missing,
    profile_stats,
    profile_summary,
    stats_of,
    stats_wide,
    summary_of,
)
from dqtable.operators.report import cleaning_report, sum_reports
from dqtable.operators.score import alerts, score
from dqtable.operators.summary import run_metadata, run_summary
from dqtable.plans.batch import run_batch
from dqtable.session import session_options
from dqtable.sinks.tables import finished_runs, read_runs
from dqtable.sources.csv import load_csv, load_csv_files, stream_csv
from dqtable.sources.tables import load_parquet, union_sources
from dqtable.streaming.incremental import clean_incremental

__all__ = [
    "PEOPLE",
    "ContractError",
    "EmptyResultError",
    "Rule",
    "TableContract",
    "alerts",
    "apply_rules",
    "clean_data",
    "clean_date",
    "clean_incremental",
    "clean_numeric",
    "clean_rows",
    "clean_text",
    "cleaning_report",
    "conform",
    "correlation_of",
    "dedup_counts",
    "finished_runs",
    "fix_email",
    "flag_rows",
    "load_csv",
    "load_csv_files",
    "load_parquet",
    "merge_pairs",
    "merge_profiles",
    "missing_of",
    "normalize_headers",
    "normalize_phone",
    "null_tokens",
    "outbox",
    "pair_states",
    "post_messages",
    "profile_columns",
    "profile_correlation",
    "profile_exact",
    "profile_missing",
    "profile_stats",
    "profile_summary",
    "read_runs",
    "register_functions",
    "reject_rows",
    "run_batch",
    "run_metadata",
    "run_summary",
    "schema_changes",
    "schema_diff",
    "schema_table",
    "score",
    "session_options",
    "stats_of",
    "stats_wide",
    "stream_csv",
    "strip",
    "sum_reports",
    "summary_of",
    "union_sources",
    "validate_email",
    "validate_phone",
]
