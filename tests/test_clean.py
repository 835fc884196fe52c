"""Cleaning: invariants on the fixture, boundaries, skew, plans."""

import contextlib
import io
import re

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from dqtable import (
    PEOPLE,
    ContractError,
    Rule,
    TableContract,
    clean_data,
    clean_rows,
    cleaning_report,
    dedup_counts,
    flag_rows,
    load_csv,
    reject_rows,
    sum_reports,
)
from dqtable.plans.people import COLUMNS, PEOPLE_BY_CLIENT, dirty_people


@pytest.fixture(scope="module")
def dirty(spark):
    return dirty_people(spark, SF_DIR).cache()


@pytest.fixture(scope="module")
def flagged(dirty):
    return flag_rows(dirty, PEOPLE_BY_CLIENT).cache()


def test_every_row_is_accounted_for(flagged):
    report = cleaning_report(flagged, PEOPLE_BY_CLIENT).first()
    rejected = reject_rows(flagged).count()
    assert report.original_rows == report.duplicates_dropped + rejected + report.final_rows == 158
    assert report.final_rows == clean_rows(flagged).count() == 29


def test_rejects_and_kept_rows_are_the_distinct_input(dirty, flagged):
    ids = reject_rows(flagged).select("id").union(clean_rows(flagged).select("id"))
    assert ids.exceptAll(dirty.select("id").distinct()).isEmpty()
    assert ids.count() == dirty.distinct().count()


def test_reasons_name_the_failed_columns(flagged):
    wrong = flagged.where(
        F.array_contains("reject_reasons", "email") != F.col("bad_email")
    ).count() + flagged.where((F.size("reject_reasons") == 0) != F.col("kept")).count()
    assert wrong == 0


def test_cleaning_clean_rows_changes_nothing(flagged):
    once = clean_rows(flagged)
    texts = once.select(*(F.col(c).cast("string").alias(c) for c in COLUMNS))
    twice = clean_rows(flag_rows(texts, PEOPLE_BY_CLIENT))
    assert once.count() == twice.count()
    assert once.exceptAll(twice.select(*once.columns)).isEmpty()


def test_partitions_do_not_matter(dirty, flagged):
    def report(rows):
        return sorted(cleaning_report(rows, PEOPLE_BY_CLIENT, ["client_id"]).collect())

    for parts in (1, 13):
        assert report(flag_rows(dirty.repartition(parts), PEOPLE_BY_CLIENT)) == report(flagged)


def test_key_reports_add_up_to_the_total(flagged):
    parts = cleaning_report(flagged, PEOPLE_BY_CLIENT, ["client_id"])
    assert sum_reports(parts).first() == cleaning_report(flagged, PEOPLE_BY_CLIENT).first()


def test_one_row_that_is_a_third_of_the_table(spark):
    df = spark.range(90_000).select(
        F.when(F.col("id") < 30_000, -1).otherwise(F.col("id")).cast("string").alias("id")
    )
    contract = TableContract(required=("id",), rules={"id": Rule("number")})
    flagged = flag_rows(df, contract)
    report = cleaning_report(flagged, contract).first()
    assert (report.original_rows, report.duplicates_dropped) == (90_000, 29_999)
    assert (report.invalid_numbers_dropped, report.final_rows) == (1, 60_000)
    # The copies meet in the map tasks: no task hands on more than one of them.
    plan = explained(dedup_counts(df))
    assert plan.index("partial_count") > plan.index("Exchange")


def test_copies_are_compared_before_cleaning(spark):
    contract = TableContract(required=("email",), rules={"email": Rule("email")})
    df = spark.createDataFrame([(" A@x.co",), ("a@x.co",), ("a@x.co",)], ["email"])
    rows, report = clean_data(df, contract)
    assert [r.email for r in rows.collect()] == ["a@x.co", "a@x.co"]
    assert report.first().duplicates_dropped == 1
    kept, report = clean_data(df, contract, drop_duplicates=False)
    assert (kept.count(), report.first().duplicates_dropped) == (3, 0)


def test_report_lists_schema_drift(spark):
    df = spark.createDataFrame([("1", "b")], ["ID", "badge"])
    report = clean_data(df, PEOPLE)[1].first()
    assert report.missing_required_columns == ["date_joined", "email", "name", "phone", "salary"]
    assert report.extra_columns == ["badge"]


def test_empty_table(spark):
    df = spark.createDataFrame([], ", ".join(f"{c} string" for c in COLUMNS))
    flagged = flag_rows(df, PEOPLE_BY_CLIENT)
    assert tuple(cleaning_report(flagged, PEOPLE_BY_CLIENT).first()) == (0,) * 7
    assert cleaning_report(flagged, PEOPLE_BY_CLIENT, ["client_id"]).isEmpty()


def test_rules_that_share_a_label_share_a_counter(spark):
    contract = TableContract(
        required=("a", "b"), rules={"a": Rule("number"), "b": Rule("number")}
    )
    df = spark.createDataFrame([("x", "1"), ("x", "y"), ("1", "2")], ["a", "b"])
    assert cleaning_report(flag_rows(df, contract), contract).first().invalid_numbers_dropped == 3


def test_names_of_the_cleaner_in_the_table(spark):
    """Columns that are called as ours are kept as they are; where a result needs the name, an error."""
    names = ("_email", "__email", "copies", "kept", "raw", "row", "bad_email")
    contract = TableContract(required=("email",), rules={"email": Rule("email")}, extra="keep")
    df = spark.createDataFrame(
        [(" A@x.co", *names), ("none", *names), ("none", *names)], ["email", *names]
    )
    flagged = flag_rows(df, contract)
    kept, rejected = clean_rows(flagged).first(), reject_rows(flagged).first()
    assert kept.email == "a@x.co" and rejected.email == "none"
    assert all(kept[n] == n and rejected[n] == n for n in names)
    assert flagged.agg(F.sum("copies")).first()[0] == 3
    taken = flag_rows(df.withColumnRenamed("raw", "reject_reasons"), contract)
    with pytest.raises(ContractError, match="reject_reasons"):
        reject_rows(taken)
    with pytest.raises(ContractError, match="copies"):
        dedup_counts(df)


def test_rejects_are_as_delivered(spark):
    contract = TableContract(required=("email", "salary"), rules={"email": Rule("email"), "salary": Rule("number")})
    df = spark.createDataFrame([("N/A", "NaN"), ("null", "NaN"), ("a@x.co", "1")], ["email", "salary"])
    flagged = flag_rows(df, contract)
    assert sorted((r.email, r.salary) for r in reject_rows(flagged).collect()) == [("N/A", "NaN"), ("null", "NaN")]
    assert clean_rows(flagged).count() == 1


def test_malformed_records_are_counted(spark, scratch):
    with open(f"{scratch}/in.csv", "w") as file:
        file.write('id,email\n1,a@x.co\n2,a@x.co,c\n3,"open\n4,x\n1,a@x.co\n')
    contract = TableContract(required=("id", "email"), rules={"email": Rule("email")})
    rows = load_csv(spark, scratch, contract=contract, on_malformed="reject", null_tokens=False)
    flagged = flag_rows(rows, contract)
    report = cleaning_report(flagged, contract).first()
    assert (report.original_rows, report.duplicates_dropped, report.final_rows) == (5, 1, 1)
    assert (report.malformed_dropped, report.invalid_emails_dropped) == (2, 1)
    assert report.original_rows == report.duplicates_dropped + reject_rows(flagged).count() + report.final_rows


def test_key_filter_reaches_the_scan(spark, scratch):
    dirty_people(spark, SF_DIR).write.parquet(f"{scratch}/people")
    people = spark.read.parquet(f"{scratch}/people")
    rows = clean_rows(flag_rows(people, PEOPLE_BY_CLIENT, where=F.col("client_id") == "BUILDING"))
    logical, physical = explained(rows, "extended").split("== Optimized Logical Plan ==")[1].split(
        "== Physical Plan =="
    )
    assert "EqualTo(client_id,BUILDING)" in physical
    for pattern in ("@[A-Za-z0-9.-]+", r"{7,15}", "(?:inity)", r"3[2-9]"):
        assert logical.count(pattern) == 1
    whole = clean_rows(flag_rows(people, PEOPLE_BY_CLIENT)).where("client_id = 'BUILDING'")
    assert sorted(rows.collect()) == sorted(whole.collect())


def test_contract_without_rules(spark):
    contract = TableContract(required=("a",))
    df = spark.createDataFrame([("x",), ("x",)], ["a"])
    flagged = flag_rows(df, contract)
    assert flagged.first().reject_reasons == [] and clean_rows(flagged).count() == 1


def explained(df, mode=None):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def test_one_scan_one_shuffle_no_python_and_rules_run_once(spark, scratch):
    dirty_people(spark, SF_DIR).write.parquet(f"{scratch}/people")
    flagged = flag_rows(spark.read.parquet(f"{scratch}/people"), PEOPLE_BY_CLIENT)
    report = cleaning_report(flagged, PEOPLE_BY_CLIENT, ["client_id"])
    for df, shuffles in ((clean_rows(flagged), 1), (reject_rows(flagged), 1), (report, 2)):
        logical, physical = explained(df, "extended").split("== Optimized Logical Plan ==")[1].split(
            "== Physical Plan =="
        )
        assert physical.count("FileScan") == 1 and physical.count("Exchange") == shuffles
        assert "Python" not in physical
        # Each pattern occurs once: no filter was copied below the rules.
        for pattern in ("@[A-Za-z0-9.-]+", r"{7,15}", "(?:inity)", r"3[2-9]"):
            assert logical.count(pattern) == 1


def test_generated_code_stays_small_enough_to_be_compiled(spark, scratch):
    """The JVM leaves methods of more than 8000 bytes uncompiled."""
    dirty_people(spark, SF_DIR).write.parquet(f"{scratch}/people")
    flagged = flag_rows(spark.read.parquet(f"{scratch}/people"), PEOPLE_BY_CLIENT)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        code = explained(flagged, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000
