"""Dirty people tables derived from `customer`, so that every rule passes, fails and meets nulls."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqtable.contract import PEOPLE, Rule, TableContract

PEOPLE_BY_CLIENT = replace(PEOPLE, keys=("client_id",))
COLUMNS = (
    "client_id",
    "id",
    "name",
    "email",
    "phone",
    "salary",
    "date_joined",
    "department",
    "notes",
)

# Runs unchanged in Spark SQL and in DuckDB; `k` is the customer key, `copies` 2 for every 20th.
PEOPLE_SQL = """
with k as (
  select c_custkey as k, c_name, c_mktsegment, cast(round(c_acctbal * 100) as bigint) as cents
  from customer
)
select k,
  c_mktsegment as client_id,
  cast(k as string) as id,
  c_name as name,
  case k % 11 when 0 then '  USER' || cast(k as string) || '@Example.COM '
              when 1 then 'user' || cast(k as string) || '.example.com'
              when 2 then null
              when 3 then 'user' || cast(k as string) || '@example'
              else 'user' || cast(k as string) || '@mail.example.com' end as email,
  case k % 7 when 0 then ' (+254) 712-' || lpad(cast(k as string), 6, '0')
             when 1 then '12345'
             when 2 then null
             when 3 then '07+12' || lpad(cast(k as string), 6, '0')
             else '0712 ' || lpad(cast(k as string), 6, '0') end as phone,
  case k % 13 when 0 then ' $1,' || lpad(cast(k % 1000 as string), 3, '0') || ' '
              when 1 then 'abc'
              when 2 then '1_000'
              when 3 then 'NaN'
              when 4 then null
              when 5 then '1d'
              else cast(cents as string) end as salary,
  case k % 5 when 0 then lpad(cast(k % 12 + 1 as string), 2, '0') || '/'
                  || lpad(cast(k % 31 + 1 as string), 2, '0') || '/20'
                  || lpad(cast(k % 25 as string), 2, '0')
             when 1 then 'not a date'
             else '20' || lpad(cast(k % 25 as string), 2, '0') || '-'
                  || lpad(cast(k % 12 + 1 as string), 2, '0') || '-'
                  || lpad(cast(k % 31 + 1 as string), 2, '0') end as date_joined,
  case k % 4 when 0 then '   ' when 1 then ' ' || c_mktsegment || ' ' when 2 then null
             else c_mktsegment end as department,
  case k % 6 when 0 then null else 'row ' || cast(k % 3 as string) end as notes,
  case k % 20 when 0 then 2 else 1 end as copies
from k
"""

CUSTOMERS = TableContract(
    required=("c_custkey", "c_nationkey", "c_acctbal"), rules={"c_acctbal": Rule("number")}
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def people_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        PEOPLE_SQL.replace("from customer", "from {customer}"),
        customer=table(spark, sf_dir, "customer"),
    )


def dirty_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`copies` written out, in one scan."""
    people = people_with_copies(spark, sf_dir)
    repeated = people.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*COLUMNS)


def drifted_people(spark: SparkSession, sf_dir: str, without: tuple[str, ...] = ()) -> DataFrame:
    """The same rows under other headers, with one unexpected column."""
    headers = (
        "client_id",
        " ID ",
        "Name",
        "Email",
        "Phone",
        "Salary",
        "Date Joined",
        "Dept",
        "Remarks",
    )
    renamed = dirty_people(spark, sf_dir).drop(*without)
    names = [h for h, c in zip(headers, COLUMNS, strict=True) if c not in without]
    return renamed.toDF(*names).withColumn("badge", F.lit("B"))


def nation_limits(spark: SparkSession) -> DataFrame:
    """Limits per nation for the customer contract."""
    return spark.sql(
        """select * from values
        (0L, 0.01D, 0L, 'zero@example.com'), (1L, 0.5D, 100000L, 'one@example.com'),
        (1L, 0.2D, null, 'one@example.com'), (2L, null, 1L, null)
        as t(c_nationkey, max_drop_rate, max_invalid_numbers, recipient)"""
    )


def thresholds(spark: SparkSession) -> DataFrame:
    """Limits for three clients, one of them twice; the others run on the defaults."""
    return spark.sql(
        """select * from values
        ('AUTOMOBILE', 0.9D, 10L, null, 'automobile@example.com'),
        ('AUTOMOBILE', 0.95D, 2000L, 100L, 'second@example.com'),
        ('BUILDING', 0.5D, null, null, 'building@example.com'),
        ('MACHINERY', null, 100L, 50L, 'machinery@example.com')
        as t(client_id, max_drop_rate, max_invalid_emails, max_invalid_phones, recipient)"""
    )
