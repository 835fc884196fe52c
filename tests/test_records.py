"""Records that span lines, in files of many blocks, against a reader that takes a file whole."""

import csv as reader
import io
import random
from pathlib import Path
from urllib.parse import unquote

import numpy as np
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from dqtable import (
    PEOPLE,
    Rule,
    TableContract,
    clean_rows,
    flag_rows,
    load_csv,
    load_csv_files,
    read_runs,
    reject_rows,
    run_batch,
)
from dqtable.plans.people import table
from dqtable.sources.records import states

OPTIONS = {"header": True, "multiLine": True, "escape": '"'}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.booleans()), min_size=1, max_size=30), st.booleans())
def test_states(flags, first):
    state, want = first, []
    for outside, inside in flags:
        state = inside if state else outside
        want.append(state)
    outside, inside = (np.array(x, bool) for x in zip(*flags, strict=True))
    assert states(outside, inside, first).tolist() == want


def plain(text):
    """(line, record) of a file, the header first."""
    out, lines = [], io.StringIO(text, newline="")
    rows = reader.reader(lines)
    before = 0
    for row in rows:
        if row:
            out.append((before + 1, [v or None for v in row]))
        before = rows.line_num
    return out


FIELDS = ["x", "", "two\nlines", 'a "quoted" word', "a,b\n\n\nc,d", "\n", '""\n"', "é\n世", "long " * 60, ",\n,"]


def written(rng, count, end="\n"):
    out = io.StringIO(newline="")
    writer = reader.writer(out, lineterminator=end)
    writer.writerow(["a", "b", "c"])
    for i in range(count):
        writer.writerow([f"{i}", rng.choice(FIELDS), rng.choice([*FIELDS, "x" * rng.randrange(300)])])
    return out.getvalue()


@pytest.mark.parametrize("block", [251, 5000, 1 << 20])
def test_blocks_anywhere(spark, scratch, block):
    """Blocks that begin at any byte give the rows and lines of a plain reader."""
    rng = random.Random(block)
    texts = {f"{k}.csv": written(rng, 120) for k in range(3)}
    texts["empty.csv"] = "a,b,c\n"
    for name, text in texts.items():
        with open(f"{scratch}/{name}", "w", newline="") as f:
            f.write(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = load_csv(spark, scratch, multi_line=True, with_source="file", with_line="line", null_tokens=False)
        got = sorted((r.file.rsplit("/", 1)[1], r.line, r.a, r.b, r.c) for r in df.collect())
        parts = spark.read.text(scratch).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = [(name, line, *row) for name, text in texts.items() for line, row in plain(text)[1:]]
    assert got == sorted(want, key=lambda r: r[:2])
    assert block > 251 or parts > 30


def test_the_rows_of_sparks_own_reader(spark, scratch):
    with open(f"{scratch}/f.csv", "w", newline="") as f:
        f.write(written(random.Random(1), 200, "\r\n"))
    own = load_csv(spark, f"{scratch}/f.csv", multi_line=True, null_tokens=False)
    spark_rows = spark.read.options(**OPTIONS).csv(f"{scratch}/f.csv")
    assert sorted(map(str, own.collect())) == sorted(map(str, spark_rows.collect()))


def test_quotes_within_fields_and_open_ends(spark, scratch):
    with open(f"{scratch}/f.csv", "w") as f:
        f.write('a,b\n1,5" x\n2,"y\nz"\n3,"never closed\n4,5\n')
    df = load_csv(spark, f"{scratch}/f.csv", multi_line=True, on_malformed="reject", with_line="line")
    got = sorted((r.line, r.a, r.b, r._corrupt_record) for r in df.collect())
    assert got[:2] == [(2, "1", '5" x', None), (3, "2", "y\nz", None)]
    assert got[2][0] == 5 and got[2][3] == '3,"never closed\n4,5'


def test_another_header_is_an_error(spark, scratch):
    for name, header in (("a", "x,y"), ("b", "x,z")):
        with open(f"{scratch}/{name}.csv", "w") as f:
            f.write(f"{header}\n1,2\n")
    with pytest.raises(Exception, match="header"):
        load_csv(spark, scratch, multi_line=True).collect()


def test_latin_1(spark, scratch):
    with open(f"{scratch}/f.csv", "wb") as f:
        f.write("né,b\né,\"ü\nß\"\n".encode("latin-1"))
    df = load_csv(spark, f"{scratch}/f.csv", "ISO-8859-1", multi_line=True)
    assert df.columns == ["né", "b"] and [tuple(r) for r in df.collect()] == [("é", "ü\nß")]


def test_a_column_of_customers(spark, scratch):
    """Many tasks over one file."""
    names = table(spark, SF_DIR, "customer").selectExpr("c_custkey", "concat(c_name, chr(10), c_name) as n")
    names.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{scratch}/one")
    df = load_csv(spark, f"{scratch}/one", multi_line=True)
    assert sorted(tuple(r) for r in df.collect()) == sorted((str(a), b) for a, b in names.collect())


def test_files_of_several_headers_and_encodings(spark, scratch):
    files = {
        "a.csv": ("Dept,id\nx,1\né,2\n", "utf-8"),
        "b c.csv": ("id, Remarks\n3,ü\n", "latin-1"),
        "deep+er/d%20.csv": ("id, Remarks\n4,ß\n5,\"a\nb\"\n", "utf-8"),
        "e.csv": ("Dept,id\ny,6\n", "ascii"),
    }
    for name, (text, encoding) in files.items():
        path = Path(scratch, name)
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(text.encode(encoding))
    df = load_csv_files(
        spark, scratch, ["UTF-8", "ISO-8859-1"], contract=PEOPLE, multi_line=True, with_source="file", with_line="line"
    )
    got = sorted((r.id, r.department, r.notes, unquote(r.file).rsplit("/", 1)[1], r.line) for r in df.collect())
    assert got == [
        ("1", "x", None, "a.csv", 2), ("2", "é", None, "a.csv", 3), ("3", None, "ü", "b c.csv", 2),
        ("4", None, "ß", "d%20.csv", 2), ("5", None, "a\nb", "d%20.csv", 3), ("6", "y", None, "e.csv", 2),
    ]
    with pytest.raises(ValueError, match="UTF-8"):
        load_csv_files(spark, scratch, ["ISO-8859-1", "UTF-8"])


def test_places_of_copies(spark, scratch):
    """The first place of each row, in the rejects and in those of a run."""
    for name, text in (("a", "id,email\n1,x\n2,u@v.ww\n1,x\n"), ("b", "id,email\n7,y,z\n1,x\n3,q\n")):
        Path(scratch, f"{name}.csv").write_text(text)
    contract = TableContract(required=("id", "email"), rules={"email": Rule("email")})
    df = load_csv(spark, scratch, on_malformed="reject", with_source="file", with_line="line", contract=contract)
    want = [("1", "a.csv", 2, "email"), ("3", "b.csv", 4, "email"), (None, "b.csv", 2, "malformed")]

    def shown(rows):
        cells = ((r.id if not r._corrupt_record else None, r.file.rsplit("/", 1)[1], r.line, *r.reject_reasons) for r in rows)
        return sorted(cells, key=str)

    flagged = flag_rows(df, contract, place=["file", "line"])
    assert shown(reject_rows(flagged).collect()) == sorted(want, key=str)
    assert clean_rows(flagged).columns == ["id", "email"]
    run_batch(df, contract, f"{scratch}/out", "r1", by=(), place=["file", "line"])
    rows = read_runs(spark, f"{scratch}/out", "rows").where("kept = 'false'").select("raw.*", "place.*", "reject_reasons")
    assert shown(rows.collect()) == sorted(want, key=str)
    assert read_runs(spark, f"{scratch}/out", "report").first().original_rows == 6
