"""The registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqtable.contract import PEOPLE, Rule, TableContract
from dqtable.functions.apply import apply_rules
from dqtable.functions.rules import validate_email, validate_phone
from dqtable.functions.sql import register_functions
from dqtable.functions.text import NULL_TOKENS, clean_text, null_tokens
from dqtable.operators.clean import (
    bad,
    clean_rows,
    dedup_counts,
    flag_rows,
    reject_rows,
)
from dqtable.operators.headers import conform, normalize_headers, schema_changes, schema_diff
from dqtable.operators.ledger import post_messages
from dqtable.operators.outbox import outbox
from dqtable.operators.profile import (
    correlation_of,
    merge_pairs,
    merge_profiles,
    missing_of,
    numeric_columns,
    pair_states,
    profile_columns,
    profile_correlation,
    profile_exact,
    profile_missing,
    profile_stats,
    profile_summary,
    stats_of,
    stats_wide,
)
from dqtable.operators.report import cleaning_report, sum_reports
from dqtable.operators.score import alerts, score
from dqtable.operators.summary import run_metadata, run_summary
from dqtable.plans.batch import run_batch
from dqtable.plans.people import (
    COLUMNS,
    CUSTOMERS,
    PEOPLE_BY_CLIENT,
    dirty_people,
    drifted_people,
    nation_limits,
    people_with_copies,
    table,
    thresholds,
)
from dqtable.sinks.tables import (
    begin_run,
    check_not_empty,
    commit_run,
    read_runs,
    shared_folder,
    write_csv,
    write_report,
)
from dqtable.sources.csv import load_csv, load_csv_files, stream_csv
from dqtable.sources.tables import union_sources
from dqtable.streaming.incremental import clean_incremental

Query = Callable[[SparkSession, str], DataFrame]


def _rule(kind: str, column: str, target: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        people = dirty_people(spark, sf_dir).select("id", column)
        return apply_rules(people, {target: (column, Rule(kind))}).select("id", target)

    return query


def email_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = dirty_people(spark, sf_dir)
    return people.select("id", validate_email(F.col("email")).alias("valid"))


def phone_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = dirty_people(spark, sf_dir)
    return people.select("id", validate_phone(F.col("phone")).alias("valid"))


def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = dirty_people(spark, sf_dir)
    return people.select("id", *(clean_text(F.col(c)).alias(c) for c in ("department", "notes")))


def null_token_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = dirty_people(spark, sf_dir)
    return people.select("id", *(null_tokens(F.col(c)).alias(c) for c in ("salary", "department")))


def every_null_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each token, padded ones and ordinary text, by customer."""
    tokens = [F.lit(t) for t in (*NULL_TOKENS, " NA", "n/A", "x")]
    key = F.col("c_custkey")
    text = F.get(F.array(*tokens), (key % len(tokens)).cast("int"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", text.alias("text"))
    return customers.select("c_custkey", null_tokens(F.col("text")).alias("text"))


def date_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as delivered, and the same days in other centuries: no range unless one is asked for."""
    people = dirty_people(spark, sf_dir).select("id", "date_joined")
    early = F.regexp_replace("date_joined", "^20", "16")
    late = F.regexp_replace("date_joined", "/20([0-9]{2})$", "/30$1")
    other = F.when(F.col("date_joined").contains("/"), late).otherwise(early)
    people = people.unionByName(people.select("id", other.alias("date_joined")))
    return apply_rules(people, {"date": ("date_joined", Rule("date"))}).select("id", "date")


def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules as SQL functions over the people table."""
    register_functions(spark)
    return spark.sql(
        """select id, dq_fix_email(email) as email, dq_normalize_phone(phone) as phone,
          dq_clean_numeric(salary) as salary, dq_clean_date(date_joined) as date_joined,
          dq_clean_text(department) as department from {people}""",
        people=dirty_people(spark, sf_dir),
    )


def number_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices written in several ways and read back."""
    price = F.format_string("%.2f", F.col("l_extendedprice"))
    whole = F.floor("l_extendedprice").cast("string")
    text = (
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit(" $"), price, F.lit(" ")))
        .when(F.col("l_linenumber") == 2, F.concat(F.lit("-"), price))
        .when(F.col("l_linenumber") == 3, F.concat(F.lit("("), price, F.lit(")")))
        .when(F.col("l_linenumber") == 4, F.concat(whole, F.lit("_000")))
        .when(F.col("l_linenumber") == 5, F.concat(whole, F.lit("e2")))
        .when(F.col("l_linenumber") == 6, F.concat(whole, F.lit("f")))
        .otherwise(price)
    )
    written = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", text.alias("written")
    )
    return apply_rules(written, {"number": ("written", Rule("number"))}).drop("written")


def date_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in a different shape per priority and read back."""
    date, priority = F.col("o_orderdate"), F.col("o_orderpriority").substr(1, 1)

    def shaped(pattern: str):
        return F.date_format(date, pattern)

    # Day-first text is read back as the same day only where the day cannot be a month.
    day_first = F.when(F.dayofmonth(date) > 12, shaped("dd/MM/yyyy")).otherwise(
        shaped("d MMMM yyyy")
    )
    text = (
        F.when(priority == "1", shaped("M/d/yyyy"))
        .when(priority == "2", day_first)
        .when(priority == "3", shaped("dd-MMM-yyyy h:mm a"))
        .when(priority == "4", shaped("yyyyMMdd"))
        .otherwise(shaped("MMM d, yyyy"))
    )
    written = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("written"))
    return apply_rules(written, {"date": ("written", Rule("date"))}).select("o_orderkey", "date")


def header_alias_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    drifted = drifted_people(spark, sf_dir)
    return conform(normalize_headers(drifted, PEOPLE_BY_CLIENT), PEOPLE_BY_CLIENT)


def header_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every alias of the contract, in several spellings, as the header of one column."""
    customers = table(spark, sf_dir, "customer")
    parts = []
    for alias, target in sorted(PEOPLE.aliases.items()):
        for header in (alias, f" {alias.title()} "):
            named = customers.select(F.col("c_custkey").alias("ID"), F.col("c_name").alias(header))
            conformed = conform(normalize_headers(named, PEOPLE), PEOPLE)
            parts.append(
                conformed.select("id", F.lit(alias).alias("alias"), F.col(target).alias("value"))
            )
    return reduce(DataFrame.unionByName, parts)


def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required names written as headers are, with blanks, capitals and aliases."""
    path = shared_folder(spark)
    write_csv(drifted_people(spark, sf_dir), path)
    names = ["Date Joined", " ID", "Dept", "Remarks", "email"]
    people = load_csv(spark, path, contract=PEOPLE_BY_CLIENT, required=names)
    return people.select("id", "date_joined", "department", "notes", "email")


def schema_drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without phones and with an unexpected column: reported, not silently lost."""
    drifted = drifted_people(spark, sf_dir, without=("phone",))
    diff = schema_diff(normalize_headers(drifted, PEOPLE_BY_CLIENT), PEOPLE_BY_CLIENT)
    report = cleaning_report(flag_rows(drifted, PEOPLE_BY_CLIENT), PEOPLE_BY_CLIENT, drift=diff)
    lists = ("missing_required_columns", "extra_columns")
    return report.drop("cleaning_version").withColumns(
        {c: F.array_join(c, ",") for c in lists}
    )


def multi_source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ID"),
        F.col("c_name").alias("Name"),
        F.col("c_acctbal").alias("Salary"),
        F.col("c_mktsegment").alias("Dept"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias(" id"),
        F.col("s_name").alias("name "),
        F.col("s_acctbal").alias("SALARY"),
    )
    return union_sources({"customer": customers, "supplier": suppliers}, PEOPLE)


def dedup_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_counts(dirty_people(spark, sf_dir))


def dedup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_counts(table(spark, sf_dir, "lineitem"))


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_rows(dirty_people(spark, sf_dir), PEOPLE_BY_CLIENT)


def people_clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_rows(_flagged(spark, sf_dir)).select(*COLUMNS)


def all_rows_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept rows when copies are not dropped."""
    flagged = flag_rows(dirty_people(spark, sf_dir), PEOPLE_BY_CLIENT, drop_duplicates=False)
    return clean_rows(flagged).select(*COLUMNS)


def invalid_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = _flagged(spark, sf_dir)
    return flagged.select("row.id", *(bad(c) for c in PEOPLE.rules), "kept", "copies")


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reject_rows(_flagged(spark, sf_dir))
    return rows.select(*COLUMNS, F.array_join("reject_reasons", ",").alias("reject_reasons"))


def extra_columns_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the table that bear names the cleaner uses itself."""
    contract = replace(PEOPLE_BY_CLIENT, extra="keep", optional=())
    names = ("_email", "copies", "kept", "raw", "row", "bad_email")
    people = dirty_people(spark, sf_dir).drop("department", "notes")
    people = people.withColumns({n: F.concat(F.lit(f"{n} "), "id") for n in names})
    return clean_rows(flag_rows(people, contract)).select("id", "email", *names)


def empty_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a table without rows: zeros, and nothing to divide by."""
    nobody = dirty_people(spark, sf_dir).where("client_id = 'none'")
    return score(cleaning_report(flag_rows(nobody, PEOPLE_BY_CLIENT), PEOPLE_BY_CLIENT))


def malformed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV lines with a field too many (also between two stray quotes) or an open quote, counted
    beside the other failures."""
    path = shared_folder(spark)
    key = F.col("c_custkey")
    line = F.concat_ws(
        ",",
        key.cast("string"),
        F.when(key % 7 == 0, F.concat(F.lit('"open '), "c_name"))
        .when(key % 11 == 0, F.lit('7" by 9", and more'))
        .when(key % 13 == 0, F.lit('"one, ""two"" and 3"'))
        .otherwise(F.col("c_name")),
        F.when(key % 5 == 0, F.lit("x@y.zz,surplus")).otherwise(F.lit("x@y.zz")),
        F.when(key % 3 == 0, F.lit("12")).otherwise(F.lit('"+254712000000"')),
        F.lit('5" pipe'),
    )
    rows = table(spark, sf_dir, "customer").select(line.alias("value"))
    # lines as single fields, below the header line
    named = rows.withColumnRenamed("value", "id,name,email,phone,notes")
    writer = named.write.option("header", True).option("quote", "").option("escape", "")
    writer.option("sep", "\x01").csv(path)
    contract = TableContract(
        required=("id", "name", "email", "phone", "notes"),
        rules={"email": Rule("email"), "phone": Rule("phone")},
    )
    people = load_csv(spark, path, contract=contract, on_malformed="reject", null_tokens=False)
    return cleaning_report(flag_rows(people, contract), contract)


def report_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(cleaning_report(_flagged(spark, sf_dir), PEOPLE_BY_CLIENT))


def report_by_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(cleaning_report(_flagged(spark, sf_dir), PEOPLE_BY_CLIENT, by=["client_id"]))


def severity_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = flag_rows(table(spark, sf_dir, "customer"), CUSTOMERS)
    return score(cleaning_report(flagged, CUSTOMERS, by=["c_nationkey"]))


def _alerted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts(report_by_client(spark, sf_dir), thresholds(spark))


def threshold_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerted(spark, sf_dir)


def nation_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of a contract without the rules of the people table."""
    return alerts(severity_by_nation(spark, sf_dir), nation_limits(spark), ["c_nationkey"])


def alert_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outbox(_alerted(spark, sf_dir))


def summary_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(_alerted(spark, sf_dir))


def metadata_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_metadata(_alerted(spark, sf_dir), run_id="20240101_000000")


def empty_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part of a profile without rows: no row in any of them."""
    nothing = table(spark, sf_dir, "lineitem").where("l_orderkey < 0")
    parts = {
        "summary": profile_summary(nothing).select(F.col("row_count").cast("double").alias("value")),
        "missing": profile_missing(nothing).select(F.col("missing").cast("double").alias("value")),
        "statistics": profile_stats(nothing).select("value"),
        "correlation": profile_correlation(nothing).select(F.col("corr").alias("value")),
    }
    counted = [
        part.agg(F.count("value").alias("values")).select(F.lit(name).alias("part"), "values")
        for name, part in parts.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def stats_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys beyond 2^53, where doubles skip numbers, and prices as decimals."""
    lineitem = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") + F.lit(2**53 + 1)).alias("order_key"),
        (F.col("l_partkey") - F.lit(2**60)).alias("part_key"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("price"),
    )
    return profile_exact(lineitem).withColumn("exact", F.col("exact").cast("string"))


def missing_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned columns of all distinct rows, kept or not."""
    rows = _flagged(spark, sf_dir).select("row.*")
    return profile_missing(rows.select(*COLUMNS))


def lineitem_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = profile_summary(table(spark, sf_dir, "lineitem"))
    return summary.drop("analysis_version").withColumn(
        "numeric_columns", F.array_join("numeric_columns", ",")
    )


def _rounded(df: DataFrame, digits: int) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


def _stats(name: str, columns: list[str] | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(profile_stats(table(spark, sf_dir, name), columns), 4)

    return query


def lineitem_stats_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return _rounded(stats_wide(profile_stats(lineitem), numeric_columns(lineitem)), 4)


def lineitem_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile_correlation(table(spark, sf_dir, "lineitem")), 9)


def events_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a constant column and one that is null in places."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "value",
        F.when(F.col("event_type") != "click", F.col("user_id")).alias("user_id"),
        F.lit(0.1).alias("constant"),
    )
    return _rounded(profile_correlation(events), 9)


def wide_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fourteen columns, some with gaps, one far from zero."""
    lineitem = table(spark, sf_dir, "lineitem")
    whole = F.col("l_linenumber")
    lineitem = lineitem.select(
        *numeric_columns(lineitem),
        F.when(whole != 2, F.col("l_quantity")).alias("gap_quantity"),
        F.when(whole > 3, F.col("l_discount")).alias("gap_discount"),
        (F.col("l_tax") + F.col("l_discount")).alias("charges"),
        (F.col("l_partkey") + F.lit(10**6)).alias("far_key"),
        (F.col("l_quantity") * -2).alias("negative"),
        F.sqrt("l_extendedprice").alias("root"),
    )
    return _rounded(profile_correlation(lineitem), 7)


def csv_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with letters outside ASCII, written and read in Latin-1."""
    path = shared_folder(spark)
    names = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.concat(F.lit("é ü "), "c_name", F.lit(' "ß", ñ')).alias("name"),
    )
    write_csv(names, path, encoding="ISO-8859-1")
    return load_csv(spark, path, "ISO-8859-1")


def csv_roundtrip_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People written as CSV, read back as text and cleaned."""
    path = shared_folder(spark)
    write_csv(dirty_people(spark, sf_dir), path)
    people = load_csv(spark, path, contract=PEOPLE_BY_CLIENT, null_tokens=False)
    return clean_rows(flag_rows(people, PEOPLE_BY_CLIENT)).select(*COLUMNS)


def _sheet(df: DataFrame, sheet: str, key: str | None, values: dict[str, str]) -> DataFrame:
    """Cells of a sheet as text: (sheet, key, item, value)."""
    cells = F.array(
        *(
            F.struct(F.lit(item).alias("item"), F.expr(value).cast("string").alias("value"))
            for item, value in values.items()
        )
    )
    name = F.col(key) if key else F.lit("")
    return df.select(F.lit(sheet).alias("sheet"), name.cast("string").alias("key"), F.inline(cells))


def report_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sheet of a whole run, cell by cell."""
    template = "${missing_required_columns} ${extra_columns} ${SEVERITY} ${ROWS_LOADED}"
    paths = run_batch(
        dirty_people(spark, sf_dir),
        PEOPLE_BY_CLIENT,
        shared_folder(spark),
        "r1",
        thresholds=thresholds(spark),
        template=template,
    )
    sheets = {name: spark.read.parquet(path) for name, path in paths.items() if name != "rows"}
    counters = [c for c in sheets["report"].columns if c.endswith(("_rows", "_dropped"))]
    drift = {c: f"array_join({c}, ',')" for c in ("missing_required_columns", "extra_columns")}
    key = "client_id"
    pairs = [
        sheets[name].select(
            F.lit(name).alias("sheet"), key, F.col("key").alias("item"), "value"
        ).withColumnRenamed(key, "key")
        for name in ("metadata", "summary")
    ]
    wide = sheets["statistics"]
    return reduce(
        DataFrame.unionByName,
        [
            _sheet(sheets["report"], "report", key, {c: c for c in counters} | drift),
            *pairs,
            _sheet(sheets["meta"], "meta", None, {"rows": "row_count", "columns": "column_count"}),
            _sheet(sheets["missing"], "missing", "column", {"missing": "missing"}),
            _sheet(wide, "statistics", "statistic", {"salary": "cast(round(salary) as bigint)"}),
            _sheet(sheets["correlation"], "correlation", "col_a", {"corr": "corr"}),
            _sheet(sheets["outbox"], "outbox", key, {"subject": "subject", "body": "body"}),
            _sheet(sheets["runs"], "runs", "run", {"rows": "original_rows", "label": "drop_rate_pct"}),
        ],
    )


def run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history row of a run; its counts come from the pass that wrote the rows."""
    paths = run_batch(
        dirty_people(spark, sf_dir),
        PEOPLE_BY_CLIENT,
        shared_folder(spark),
        "r1",
        time=datetime(2024, 1, 5, 10, 30),
    )
    record = spark.read.parquet(paths["runs"])
    return record.select(
        "run",
        "time",
        F.regexp_extract("report_path", "[^/]+/[^/]+$", 0).alias("report_path"),
        "original_rows",
        "final_rows",
        "drop_rate",
        "drop_rate_pct",
        "severity",
    )


def checked_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report that was checked to hold rows, though none of them was kept."""
    people = dirty_people(spark, sf_dir).withColumn("email", F.lit("none"))
    paths = run_batch(people, PEOPLE_BY_CLIENT, shared_folder(spark), "r1")
    report = check_not_empty(spark.read.parquet(paths["report"]), "report")
    return report.select("client_id", "original_rows", "final_rows")


def _deliveries(spark: SparkSession, sf_dir: str, ledger: bool = False) -> str:
    """Two CSV deliveries, everyone, then the copies again; each a whole run below the folder."""
    folder = shared_folder(spark)
    people = people_with_copies(spark, sf_dir)
    for delivery in (people, people.where("copies > 1")):
        write_csv(delivery.select(*COLUMNS), f"{folder}/in", mode="append")
        stream = stream_csv(
            spark, f"{folder}/in", list(COLUMNS), contract=PEOPLE_BY_CLIENT, null_tokens=False
        )
        clean_incremental(
            stream,
            PEOPLE_BY_CLIENT,
            f"{folder}/out",
            f"{folder}/checkpoint",
            thresholds=thresholds(spark),
            template="${CLIENT_NAME} ${ROWS_LOADED} ${ROWS_CLEANED} ${extra_columns}",
            ledger=f"{folder}/ledger" if ledger else None,
        ).awaitTermination()
    return f"{folder}/out"


def incremental_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summed reports of all deliveries per client."""
    reports = spark.read.parquet(f"{_deliveries(spark, sf_dir)}/report")
    return score(sum_reports(reports, by=["client_id"]))


def incremental_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of each delivery."""
    messages = spark.read.parquet(f"{_deliveries(spark, sf_dir)}/outbox")
    return messages.select("client_id", "recipient", "subject", "body", "drop_rate_alert")


def incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of each delivery."""
    records = spark.read.parquet(f"{_deliveries(spark, sf_dir)}/runs")
    return records.select("original_rows", "final_rows", "severity")


def incremental_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of deliveries whose rows are compared with all earlier ones."""
    reports = read_runs(spark, _deliveries(spark, sf_dir, ledger=True), "report")
    counters = [c for c in reports.columns if c.endswith(("_rows", "_dropped"))]
    return reports.select(F.col("run_id").cast("long").alias("delivery"), "client_id", *counters)


def incremental_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of three deliveries from the states stored with each; one lacks a column."""
    folder = shared_folder(spark)
    lineitem = table(spark, sf_dir, "lineitem")
    line = F.col("l_linenumber")
    parts = [lineitem.where(line < 3), lineitem.where(line == 3), lineitem.where(line > 3).drop("l_tax")]
    for number, part in enumerate(parts):
        run = f"{number:03d}"
        begin_run(spark, folder, run)
        sheets = {"profile": profile_columns(part), "pairs": pair_states(part)}
        commit_run(spark, folder, run, list(write_report(sheets, folder, run)))
    profile = merge_profiles(read_runs(spark, folder, "profile"))
    pairs = merge_pairs(read_runs(spark, folder, "pairs"))
    none = F.lit("")
    cells = [
        stats_of(profile).select("statistic", F.col("column").alias("col_a"), none.alias("col_b"), "value"),
        missing_of(profile).select(
            F.lit("missing").alias("statistic"),
            F.col("column").alias("col_a"),
            none.alias("col_b"),
            F.col("missing").cast("double").alias("value"),
        ),
        correlation_of(pairs).select(
            F.lit("correlation").alias("statistic"), "col_a", "col_b", F.col("corr").alias("value")
        ),
    ]
    digits = F.when(F.col("statistic") == "correlation", F.round("value", 7)).otherwise(F.round("value", 4))
    return reduce(DataFrame.unionByName, cells).withColumn("value", digits)


def whole_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of finished runs: one is whole, one was written again, one stopped midway."""
    folder = shared_folder(spark)
    people = dirty_people(spark, sf_dir)
    run_batch(people, PEOPLE_BY_CLIENT, folder, "r1")
    for _ in range(2):
        run_batch(people, PEOPLE_BY_CLIENT, folder, "r2", where=F.col("client_id") == "BUILDING")
    begin_run(spark, folder, "r3")
    write_report({"report": read_runs(spark, folder, "report").drop("run_id")}, folder, "r3")
    reports = read_runs(spark, folder, "report")
    return reports.select("run_id", "client_id", "original_rows", "final_rows")


ROW_RULES = TableContract(
    keys=("client_id",),
    required=("id", "badge", "notes", "email"),
    rules={"badge": Rule("unique"), "notes": Rule("not_null"), "email": Rule("email")},
)


def row_rules_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Badges must be unique, though a third of all people share one; notes must be there."""
    people = dirty_people(spark, sf_dir)
    key = F.col("id").cast("long")
    badge = (
        F.when(key % 3 == 0, "shared")
        .when(key % 7 == 0, F.concat(F.lit("pair "), F.floor(key / 14).cast("string")))
        .when(key % 5 != 0, F.concat(F.lit("own "), "id"))
    )
    flagged = flag_rows(people.withColumn("badge", badge), ROW_RULES)
    return score(cleaning_report(flagged, ROW_RULES, by=["client_id"]))


def reject_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects with the file and line they begin in; some notes span lines, and there are copies."""
    path = shared_folder(spark)
    key = F.col("id").cast("long")
    notes = F.when(key % 10 == 0, F.lit("two\nlines")).otherwise(F.col("notes"))
    people = dirty_people(spark, sf_dir).withColumns({"notes": notes, "client": F.col("client_id")})
    people = people.repartition("client").sortWithinPartitions("client", key)
    people.write.partitionBy("client").option("header", True).option("escape", '"').csv(path)
    read = load_csv(
        spark,
        path,
        contract=PEOPLE_BY_CLIENT,
        on_malformed="reject",
        with_source="file",
        with_line="line",
        null_tokens=False,
    )
    rows = reject_rows(flag_rows(read, PEOPLE_BY_CLIENT, place=["file", "line"]))
    file = F.regexp_extract("file", "client=([^/]+)/", 1)
    return rows.select(file.alias("file"), "line", "id", F.array_join("reject_reasons", ",").alias("reasons"))


def mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three headers in one directory, one of them in Latin-1."""
    folder = shared_folder(spark)
    customers = table(spark, sf_dir, "customer")
    key, third = F.col("c_custkey").cast("string"), F.col("c_custkey") % 3
    name = F.concat(F.lit("é "), "c_name")
    people = customers.where(third == 0).select(key.alias("ID"), name.alias("Name"), F.col("c_mktsegment").alias("Dept"))
    write_csv(people, f"{folder}/a")
    people = customers.where(third == 1).select(F.col("c_nationkey").cast("string").alias("phone"), key.alias(" id "), name.alias("NAME"))
    write_csv(people, f"{folder}/b", encoding="ISO-8859-1")
    people = customers.where(third == 2).select(key.alias("id"), F.col("c_mktsegment").alias("division"))
    write_csv(people, f"{folder}/c")
    read = load_csv_files(spark, folder, ["UTF-8", "ISO-8859-1"], contract=PEOPLE, with_source="file")
    return read.withColumn("file", F.regexp_extract("file", "/([abc])/[^/]*$", 1))


def messages_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of four runs: one is repeated, one has nothing new, one has news for one client."""
    path = shared_folder(spark)
    people = dirty_people(spark, sf_dir)
    fewer = people.where("client_id <> 'BUILDING' or cast(id as bigint) % 2 = 0")
    for run, rows in (("r1", people), ("r1", people), ("r2", people), ("r3", fewer)):
        flagged = flag_rows(rows, PEOPLE_BY_CLIENT)
        report = score(cleaning_report(flagged, PEOPLE_BY_CLIENT, by=["client_id"]))
        post_messages(outbox(alerts(report, thresholds(spark))), path, run)
    return spark.read.parquet(path).select(F.col("batch").alias("run"), "client_id", "body")


def schema_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries: a column comes, one goes, one changes its type, with the rows concerned."""
    folder = shared_folder(spark)
    people = dirty_people(spark, sf_dir)
    number = F.expr("try_cast(salary as double)")
    for run, rows in (
        ("001", people),
        ("002", people.withColumn("badge", F.lit(1)).drop("notes")),
        ("003", people.withColumns({"badge": F.lit(1), "salary": number})),
    ):
        run_batch(rows, PEOPLE_BY_CLIENT, folder, run)
    rows = read_runs(spark, folder, "runs").select("run_id", "original_rows")
    return schema_changes(read_runs(spark, folder, "schema")).join(rows, "run_id")


QUERIES: dict[str, Query] = {
    "email_fix": _rule("email", "email", "fixed"),
    "email_valid": email_valid,
    "phone_normalize": _rule("phone", "phone", "normalized"),
    "phone_valid": phone_valid,
    "numeric_clean": _rule("number", "salary", "number"),
    "number_shapes": number_shapes,
    "date_clean": date_years,
    "date_shapes": date_shapes,
    "text_clean": text_clean,
    "null_tokens": null_token_columns,
    "null_tokens_all": every_null_token,
    "sql_functions": sql_functions,
    "header_alias_conform": header_alias_conform,
    "header_aliases": header_aliases,
    "required_columns": required_columns,
    "schema_drift_report": schema_drift_report,
    "multi_source_union": multi_source_union,
    "dedup_counts": dedup_people,
    "dedup_lineitem": dedup_lineitem,
    "invalid_flags": invalid_flags,
    "clean_rows": people_clean_rows,
    "all_rows_clean": all_rows_clean,
    "rejects": rejects,
    "extra_columns_kept": extra_columns_kept,
    "empty_report": empty_report,
    "malformed_report": malformed_report,
    "cleaning_report": report_total,
    "cleaning_report_by_client": report_by_client,
    "severity_by_nation": severity_by_nation,
    "threshold_alerts": threshold_alerts,
    "nation_alerts": nation_alerts,
    "alert_outbox": alert_outbox,
    "summary_sheet": summary_sheet,
    "metadata_sheet": metadata_sheet,
    "profile_missing": missing_people,
    "profile_summary": lineitem_profile,
    "profile_stats": _stats("lineitem"),
    "profile_stats_orders": _stats("orders"),
    "profile_stats_events": _stats("events", ["value", "user_id", "event_type"]),
    "profile_stats_wide": lineitem_stats_wide,
    "profile_stats_exact": stats_exact,
    "profile_empty": empty_profile,
    "profile_correlation": lineitem_correlation,
    "profile_correlation_gaps": events_correlation,
    "profile_correlation_wide": wide_correlation,
    "csv_encoding": csv_encoding,
    "csv_roundtrip_clean": csv_roundtrip_clean,
    "report_tables": report_tables,
    "run_record": run_record,
    "checked_report": checked_report,
    "incremental_clean": incremental_clean,
    "incremental_outbox": incremental_outbox,
    "incremental_runs": incremental_runs,
    "incremental_dedup": incremental_dedup,
    "incremental_profile": incremental_profile,
    "whole_runs": whole_runs,
    "row_rules_report": row_rules_report,
    "reject_places": reject_places,
    "mixed_files": mixed_files,
    "messages_once": messages_once,
    "schema_history": schema_history,
}
