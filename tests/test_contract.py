import pytest

from dqtable import (
    PEOPLE,
    ContractError,
    Rule,
    TableContract,
    conform,
    normalize_headers,
    schema_diff,
)
from dqtable.operators.headers import require_columns


def test_aliases_and_blanks_in_headers(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], [" ID ", "Date Joined", "Dept", "Remarks"])
    assert normalize_headers(df, PEOPLE).columns == ["id", "date_joined", "department", "notes"]


def test_joindate_alias(spark):
    df = spark.createDataFrame([(1,)], ["JoinDate"])
    assert normalize_headers(df, PEOPLE).columns == ["date_joined"]


def test_two_headers_for_one_column(spark):
    df = spark.createDataFrame([(1, 2)], ["Date", "date_joined"])
    with pytest.raises(ContractError, match="Date.*date_joined"):
        normalize_headers(df, PEOPLE)


def test_diff_and_conform(spark):
    df = spark.createDataFrame([("1", "n", "b")], ["id", "notes", "badge"])
    missing = ["date_joined", "email", "name", "phone", "salary"]
    assert schema_diff(df, PEOPLE) == (missing, ["badge"])
    row = conform(df, PEOPLE).first()
    assert row.__fields__ == list(PEOPLE.columns)
    assert (row.id, row.notes, row.email) == ("1", "n", None)


def test_strict_and_keeping_contracts(spark):
    df = spark.createDataFrame([("1", "x")], ["a", "b"])
    with pytest.raises(ContractError, match="c"):
        conform(df, TableContract(required=("a", "c"), on_missing="error"))
    assert conform(df, TableContract(required=("a",), extra="keep")).columns == ["a", "b"]
    with pytest.raises(ContractError, match="k"):
        conform(df, TableContract(required=("a",), keys=("k",)))


def test_required_list(spark):
    df = spark.createDataFrame([("1",)], ["a"])
    assert require_columns(df, [" A "]) is df
    with pytest.raises(ContractError, match="b"):
        require_columns(df, ["a", "B"])


def test_contract_checks_itself():
    with pytest.raises(ValueError, match="twice"):
        TableContract(required=("a", "a"))
    with pytest.raises(ValueError, match="outside"):
        TableContract(required=("a",), rules={"b": Rule("email")})
    with pytest.raises(ValueError, match="on_missing"):
        TableContract(required=("a",), on_missing="ignore")
