"""What several runs leave behind: the ledger of rows, states that add up, commit records."""

import random
from dataclasses import replace
from pathlib import Path

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from dqtable import (
    EmptyResultError,
    Rule,
    TableContract,
    clean_rows,
    cleaning_report,
    flag_rows,
    merge_profiles,
    profile_columns,
    read_runs,
    reject_rows,
    run_batch,
)
from dqtable.operators import clean
from dqtable.operators.clean import bad
from dqtable.operators.ledger import delivered_digests
from dqtable.plans import batch
from dqtable.plans.people import PEOPLE_BY_CLIENT, dirty_people
from dqtable.sinks.tables import finished_runs

ITEMS = TableContract(required=("id", "name"), optional=("note",), rules={"id": Rule("number")})
ROWS = [("1", "a", None), ("2", "b", "x"), ("2", "b", "x"), ("bad", "c", None), ("3", None, "-")]


def items(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, note string")


def files(folder):
    return {p: p.stat().st_mtime_ns for p in Path(folder).rglob("part-*")}


def counters(spark, path, run):
    r = spark.read.parquet(f"{path}/report/run_id={run}").first()
    assert r.original_rows == r.duplicates_dropped + r.invalid_numbers_dropped + r.final_rows
    return r.original_rows, r.duplicates_dropped, r.final_rows


def test_rows_survive_once_across_deliveries(spark, scratch):
    ledger = f"{scratch}/ledger"

    def deliver(run, rows):
        run_batch(items(spark, rows), ITEMS, scratch, run, by=(), ledger=ledger)
        return counters(spark, scratch, run)

    assert deliver("a", ROWS) == (5, 1, 3)
    before = files(ledger)
    more = [("2", "b", "x"), ("bad", "c", None), ("2", "b", None), ("4", "d", "2:")]
    assert deliver("b", more) == (4, 2, 2)
    # what a delivery has brought is not looked at as seen when it is delivered again
    assert deliver("b", more) == (4, 2, 2)
    assert {p: t for p, t in files(ledger).items() if p in before} == before
    assert deliver("a", ROWS) == (5, 1, 3)
    assert deliver("c", ROWS * 2 + more) == (14, 14, 0)
    assert delivered_digests(spark, ledger, "none").count() == 6
    assert delivered_digests(spark, ledger, "c").distinct().count() == 6
    kept = read_runs(spark, scratch, "rows").where("kept = 'true'").select("run_id", "row.*")
    assert kept.groupBy("run_id").count().collect().__len__() == 2 and kept.count() == 5
    again = reject_rows(spark.read.parquet(f"{scratch}/rows/run_id=c").withColumn("kept", F.col("kept") == "true"))
    assert {tuple(r.reject_reasons) for r in again.collect()} == {("delivered_before",)}


def test_digests_tell_rows_apart(spark):
    rows = [("1", "2", None), ("12", "", None), ("12", None, None), (None, "12", None), ("1", None, "2"), ("1:2", "", "")]
    flagged = flag_rows(items(spark, rows), ITEMS, seen=spark.createDataFrame([], "digest binary"))
    assert flagged.select("digest").distinct().count() == len(rows)


def test_a_run_that_stops_midway_is_no_run(spark, scratch, monkeypatch):
    people = dirty_people(spark, SF_DIR)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_runs(spark, scratch, "report")
    run_batch(people, PEOPLE_BY_CLIENT, scratch, "r1")
    write, calls = batch.write_report, []

    def stops(tables, path, run_id):
        calls.append(run_id)
        if len(calls) % 3 == 0:
            raise OSError("stopped")
        return write(tables, path, run_id)

    monkeypatch.setattr(batch, "write_report", stops)
    for run in ("r2", "r1"):  # a new run, and one that was whole before
        with pytest.raises(OSError, match="stopped"):
            run_batch(people.where("client_id = 'BUILDING'"), PEOPLE_BY_CLIENT, scratch, run)
        assert spark.read.parquet(f"{scratch}/report").where(f"run_id = '{run}'").count() == 1
    assert finished_runs(spark, scratch).isEmpty()
    with pytest.raises(EmptyResultError, match="no finished run"):
        read_runs(spark, scratch, "report")
    monkeypatch.setattr(batch, "write_report", write)
    run_batch(people, PEOPLE_BY_CLIENT, scratch, "r2")
    assert {r.run_id for r in read_runs(spark, scratch, "report").collect()} == {"r2"}
    assert read_runs(spark, scratch, "rows").count() == 150


def test_profiles_of_parts_give_that_of_the_whole(spark):
    rng = random.Random(4)
    rows = [
        (i, rng.choice([None, rng.random()]), rng.choice([None, "x"]), rng.randint(0, 9), 2**62 if i < 2 else None)
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "a long, b double, c string, d int, e long")
    # the last part lacks a column
    parts = [df.where("a < 10"), df.where("a >= 10 and a < 120"), df.where("a >= 120").drop("d")]
    whole = df.withColumn("d", F.when(F.col("a") < 120, F.col("d")))
    profiles = [profile_columns(p).withColumn("run_id", F.lit(str(i))) for i, p in enumerate(parts)]
    merged = merge_profiles(profiles[0].unionByName(profiles[1]).unionByName(profiles[2]))
    want = {r.column: r for r in profile_columns(whole).collect()}
    got = {r.column: r for r in merged.collect()}
    assert got.keys() == want.keys()
    for name, r in want.items():
        for field in ("numeric", "rows", "missing", "n", "min", "max", "exact"):
            assert got[name][field] == r[field], (name, field)
        for field in ("mean", "sum"):
            assert got[name][field] == (None if r[field] is None else pytest.approx(r[field], rel=1e-12))


def test_a_column_called_statistic(spark, scratch):
    contract = replace(PEOPLE_BY_CLIENT, extra="keep")
    people = dirty_people(spark, SF_DIR).withColumns({"statistic": F.lit(1.5), "_statistic": F.lit(2)})
    paths = run_batch(people, contract, scratch, "r1")
    wide = spark.read.parquet(paths["statistics"])
    assert set(wide.columns) == {"__statistic", "salary", "statistic", "_statistic"} and wide.count() == 4


KEYED = TableContract(
    required=("id", "name"),
    optional=("note",),
    rules={"id": Rule("unique"), "name": Rule("not_null"), "note": Rule("unique", "notes")},
)


@pytest.mark.parametrize("frequent", [1000, 1, 0])
@pytest.mark.parametrize("copies", [True, False])
def test_rules_that_look_at_other_rows(spark, monkeypatch, frequent, copies):
    """A third of the rows under one key, few frequent values or none, copies dropped or not."""
    monkeypatch.setattr(clean, "FREQUENT", frequent)
    rng = random.Random(frequent)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(150)}", rng.choice([None, "NA", "n"]), f"{i}") for i in range(300)]
    rows += [(None, "x", None), (None, "y", None), ("NA", "z", "1000"), ("alone", "z", "1001")] + [("twice", "t", "t")] * 2
    flagged = flag_rows(items(spark, rows).repartition(6), KEYED, drop_duplicates=copies)
    distinct = list(dict.fromkeys(rows)) if copies else rows
    ids = [r[0] for r in distinct]
    notes = [r[2] for r in distinct]
    want = []
    for r in distinct:
        shared = r[0] not in (None, "NA") and ids.count(r[0]) > 1
        noted = r[2] is not None and notes.count(r[2]) > 1
        want.append((*r, shared, r[1] in (None, "NA"), noted))
    got = flagged.select("raw.*", bad("id"), bad("name"), bad("note"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    report = cleaning_report(flagged, KEYED).first()
    assert report.original_rows == len(rows) and report.invalid_nulls_dropped == sum(w[4] for w in want)
    assert report.invalid_repeats_dropped == sum(w[3] for w in want)
    assert report.invalid_notes_dropped == sum(w[5] for w in want)
    kept = sum(not any(w[3:]) for w in want)
    assert report.final_rows == kept == clean_rows(flagged).count()
    assert report.original_rows == report.duplicates_dropped + reject_rows(flagged).count() + kept
