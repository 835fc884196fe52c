"""Whole runs: written tables, repeats, deliveries."""

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from dqtable import (
    PEOPLE,
    EmptyResultError,
    cleaning_report,
    flag_rows,
    load_csv,
    run_batch,
    sum_reports,
)
from dqtable.plans.people import (
    CUSTOMERS,
    PEOPLE_BY_CLIENT,
    dirty_people,
    nation_limits,
    table,
    thresholds,
)
from dqtable.session import session_options
from dqtable.sinks.tables import check_not_empty, shared_folder
from dqtable.streaming.incremental import clean_incremental


def test_run_writes_every_sheet_and_can_be_repeated(spark, scratch):
    people = dirty_people(spark, SF_DIR)
    for _ in range(2):
        paths = run_batch(people, PEOPLE_BY_CLIENT, scratch, "r1", thresholds=thresholds(spark))
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    assert set(tables) == {
        "rows", "report", "profile", "alerts", "metadata", "meta", "missing", "statistics", "correlation", "summary",
        "outbox", "runs", "pairs", "schema",
    }
    assert tables["rows"].count() == 150 and tables["rows"].where("kept = 'true'").count() == 29
    assert tables["report"].agg(F.sum("final_rows")).first()[0] == 29
    record = tables["runs"].first()
    assert (record.original_rows, record.final_rows, record.severity) == (158, 29, "HIGH")
    assert tables["summary"].count() == 50 and tables["outbox"].count() == 5
    assert tables["correlation"].isEmpty()


def test_run_without_survivors(spark, scratch):
    people = dirty_people(spark, SF_DIR).withColumn("email", F.lit("none"))
    paths = run_batch(people, PEOPLE_BY_CLIENT, scratch, "r1")
    record = spark.read.parquet(paths["runs"]).first()
    assert (record.final_rows, record.drop_rate, record.severity) == (0, 1.0, "HIGH")
    assert spark.read.parquet(paths["statistics"]).isEmpty()


@pytest.mark.parametrize("by", [("client_id",), ()])
def test_run_over_no_rows_is_an_error(spark, scratch, by):
    nobody = dirty_people(spark, SF_DIR).where("false")
    with pytest.raises(EmptyResultError, match="report"):
        run_batch(nobody, PEOPLE_BY_CLIENT, scratch, "r1", by=by)


def test_run_of_another_contract(spark, scratch):
    customers = table(spark, SF_DIR, "customer")
    template = "${MEAN_VALUES} ${MIN_VALUES} ${missing_required_columns} ${extra_columns} ${x}"
    paths = run_batch(
        customers, CUSTOMERS, scratch, "r1", by=["c_nationkey"],
        thresholds=nation_limits(spark), template=template,
    )
    box = {r.c_nationkey: r for r in spark.read.parquet(paths["outbox"]).collect()}
    assert box[0].invalid_numbers_alert == "OK" and box[3].invalid_numbers_alert is None
    assert box[0].body.startswith("{'c_acctbal': ") and "${x}" in box[0].body
    assert "[] ['c_address'" in box[0].body or "[] ['c_mktsegment'" in box[0].body
    items = {r.key for r in spark.read.parquet(paths["summary"]).collect()}
    assert "Invalid Numbers Alert" in items and "Invalid Emails Alert" not in items
    record = spark.read.parquet(paths["runs"]).first()
    assert record.report_path == paths["report"] and record.time is not None


def test_run_needs_few_jobs(spark, scratch):
    people = dirty_people(spark, SF_DIR)
    spark.sparkContext.setJobGroup("run", "a whole run")
    run_batch(people, PEOPLE_BY_CLIENT, scratch, "r1", thresholds=thresholds(spark))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("run")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 25


def test_run_for_one_client_with_malformed_records(spark, scratch):
    with open(f"{scratch}/in.csv", "w") as file:
        file.write("ID,Name,Email,Phone,Salary,Date,badge\n1,n,a@x.co,1234567,5,2024-01-05,b\n")
        file.write("2,n,a@x.co,1234567,5,2024-01-05,b,c,d\n3,n,a@x,1234567,5,2024-01-05,b\n")
    people = load_csv(spark, f"{scratch}/in.csv", contract=PEOPLE, on_malformed="reject")
    paths = run_batch(people, PEOPLE, scratch, "r1", by=(), client_name="Acme", clean_csv=True)
    report = spark.read.parquet(paths["report"]).first()
    assert (report.client_id, report.original_rows, report.final_rows) == ("Acme", 3, 1)
    assert (report.invalid_emails_dropped, report.extra_columns) == (1, ["badge"])
    assert [r.id for r in load_csv(spark, paths["clean_csv"]).collect()] == ["1"]
    assert spark.read.parquet(paths["outbox"]).first().body.startswith("Dear Acme,")


def test_deliveries(spark, scratch):
    people = dirty_people(spark, SF_DIR)

    def clean():
        stream = spark.readStream.schema(people.schema).parquet(f"{scratch}/in")
        clean_incremental(stream, PEOPLE_BY_CLIENT, f"{scratch}/out", f"{scratch}/state").awaitTermination()
        return spark.read.parquet(f"{scratch}/out/report")

    def deliver(part):
        part.write.mode("append").parquet(f"{scratch}/in")

    split = F.col("client_id") < "FURNITURE"
    deliver(people.where(split))
    clean()
    assert clean().select("run_id").distinct().count() == 1
    deliver(people.where(~split))
    reports = clean()
    assert reports.select("run_id").distinct().count() == 2
    whole = cleaning_report(flag_rows(people, PEOPLE_BY_CLIENT), PEOPLE_BY_CLIENT, ["client_id"])
    assert sorted(sum_reports(reports, ["client_id"]).collect()) == sorted(whole.collect())
    kept = spark.read.parquet(f"{scratch}/out/rows").where("kept = 'true'").select("row.*")
    assert kept.count() == 29


def test_helpers(spark):
    with pytest.raises(EmptyResultError, match="runs"):
        check_not_empty(spark.range(0), "runs")
    with pytest.raises(EmptyResultError):
        check_not_empty(spark.range(3), "runs", F.col("id") > 2)
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    large = session_options(100 * 10**12, 5000)
    assert large["spark.sql.shuffle.partitions"] == "50000"
    assert large["spark.sql.files.maxPartitionBytes"] == "2000000000"
    assert session_options(10**6, 8)["spark.sql.shuffle.partitions"] == "8"
