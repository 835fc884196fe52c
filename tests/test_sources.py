import pytest

from dqtable import (
    PEOPLE,
    ContractError,
    TableContract,
    clean_rows,
    flag_rows,
    load_csv,
    load_parquet,
    reject_rows,
    union_sources,
)
from dqtable.sinks.tables import write_csv

PLAIN = TableContract(required=("a", "b"))


@pytest.fixture
def csv(scratch):
    def write(text, encoding="utf-8", name="t.csv"):
        with open(f"{scratch}/{name}", "w", encoding=encoding, newline="") as file:
            file.write(text)
        return f"{scratch}/{name}"

    return write


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_text_only_quotes_blanks_and_null_tokens(spark, csv):
    path = csv('A, B \n007,"say ""hi"", ok"\nNA, x \n"",N/A\n1\n')
    df = load_csv(spark, path)
    assert df.dtypes == [("a", "string"), ("b", "string")]
    assert rows(df) == [("007", 'say "hi", ok'), (None, " x "), (None, None), ("1", None)]


def test_rows_can_be_counted(spark, csv):
    path = csv("a,b\n1,2\n3\n")
    assert load_csv(spark, path).count() == load_csv(spark, path, on_malformed="reject").count() == 2


def test_quoted_newlines(spark, csv):
    path = csv('a,b\n1,"x\ny"\n2,z\n')
    assert rows(load_csv(spark, path, multi_line=True)) == [("1", "x\ny"), ("2", "z")]
    with pytest.raises(Exception, match="multi_line"):
        load_csv(spark, path).collect()
    found = load_csv(spark, path, on_malformed="reject").where("_corrupt_record is not null")
    assert [r[-1] for r in rows(found)] == ['1,"x']


def test_a_stray_quote_does_not_stop_splitting(spark, csv, scratch):
    lines = "".join(f"{i},{'x' * 100}\n" for i in range(3000))
    path = csv(f'a,b\n5" pipe,2\n{lines}')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = load_csv(spark, path)
        assert df.rdd.getNumPartitions() > 1
        assert df.count() == 3001 and df.where("a = '5\" pipe'").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_long_quoted_fields(spark, csv):
    path = csv('a,b\n"' + 'x""' * 200_000 + '",2\n')
    assert len(load_csv(spark, path).first().a) == 400_000


def test_encoding(spark, csv):
    path = csv("a,b\né,1\n", "latin-1")
    assert rows(load_csv(spark, path, encoding="ISO-8859-1")) == [("é", "1")]
    path = csv("a,b\né,1\n", "utf-16", name="u.csv")
    assert rows(load_csv(spark, path, encoding="UTF-16")) == [("é", "1")]


def test_too_many_fields(spark, csv):
    path = csv('a,b\n1,2\n1,2,3\n"x,y",4\n5\n')
    with pytest.raises(Exception, match="too many fields"):
        load_csv(spark, path).collect()
    with pytest.raises(Exception, match="too many fields"):
        load_csv(spark, path).select("b").collect()
    kept = load_csv(spark, path, on_malformed="reject")
    assert kept.select("_corrupt_record").where("_corrupt_record is not null").count() == 1
    assert [r[-1] for r in rows(kept)] == [None, "1,2,3", None, None]
    flagged = flag_rows(kept, PLAIN)
    assert clean_rows(flagged).columns == ["a", "b"] and clean_rows(flagged).count() == 3
    reject = reject_rows(flagged).first()
    assert (reject["_corrupt_record"], reject.reject_reasons) == ("1,2,3", ["malformed"])


def test_quotes_within_fields_hide_no_comma(spark, csv):
    path = csv('a,b,c\n1,5" x,2" y,extra\n1,5" x,2" y\n"x ""y"", z",2,3\n"","a,b",\n')
    found = load_csv(spark, path, on_malformed="reject")
    assert [r[-1] for r in rows(found)].count(None) == 3
    assert found.where("_corrupt_record is not null").first()._corrupt_record == '1,5" x,2" y,extra'


def test_headers(spark, csv, scratch):
    with pytest.raises(ContractError, match="more than once"):
        load_csv(spark, csv("a,a\n1,2\n"))
    with pytest.raises(ContractError, match="email"):
        load_csv(spark, csv("a,b\n1,2\n", name="b.csv"), required=["email"])
    path = csv("Date Joined,x\n1,2\n", name="d.csv")
    assert load_csv(spark, path, required=["Date Joined", " X"]).columns == ["date_joined", "x"]
    assert load_csv(spark, path, contract=PEOPLE, required=["JoinDate"]).count() == 1
    path = csv("Dept,JoinDate\nx,2024\n", name="c.csv")
    assert load_csv(spark, path, contract=PEOPLE).columns == ["department", "date_joined"]


def test_write_and_read_back(spark, scratch):
    values = [(" a ", 'q"q'), ("x,y", "line\nbreak"), (None, "\\"), ("  ", "z")]
    df = spark.createDataFrame(values, "a string, b string")
    write_csv(df, f"{scratch}/out")
    back = load_csv(spark, f"{scratch}/out", multi_line=True)
    assert sorted(map(str, rows(back))) == sorted(map(str, values))


def test_sources_meet_by_name(spark, scratch):
    first = spark.createDataFrame([("1", "x")], ["ID", "Dept"])
    second = spark.createDataFrame([("n", "2")], ["name", "id"])
    first.write.parquet(f"{scratch}/first")
    union = union_sources({"first": load_parquet(spark, f"{scratch}/first"), "second": second}, PEOPLE)
    got = {r.source: (r.id, r.department, r.name) for r in union.collect()}
    assert got == {"first": ("1", "x", None), "second": ("2", None, "n")}


def test_a_source_column_is_not_overwritten(spark, csv):
    df = spark.createDataFrame([("1", "x")], ["id", "Source"])
    with pytest.raises(ContractError, match="source"):
        union_sources({"a": df})
    assert union_sources({"a": df}, tag="origin").columns == ["id", "source", "origin"]
    path = csv("a,source\n1,x\n")
    with pytest.raises(ContractError, match="source"):
        load_csv(spark, path, with_source=True)
    assert load_csv(spark, path, with_source="file").first().source == "x"


def test_directory_with_the_file_of_each_row(spark, csv, scratch):
    csv("a,b\n1,x\n")
    csv("a,b\n2,y\n", name="u.csv")
    df = load_csv(spark, scratch, with_source=True)
    assert {(r.a, r.source.rsplit("/", 1)[1]) for r in df.collect()} == {("1", "t.csv"), ("2", "u.csv")}
    csv("b,a\n3,z\n", name="v.csv")
    with pytest.raises(Exception, match="header"):
        load_csv(spark, scratch).collect()
