"""WARC archives: round trips, and magic where no record is."""

import duckdb
import numpy as np
import pytest
import pyarrow as pa
from compare import duck_rows, spark_rows
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from dqtable.llm import warc
from dqtable.llm.common import read_table
from dqtable.llm.queries import WARC_SQL

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [
    (1, None, None), (2, "http://x/ \r\nWARC/1.0", "a" * 1000), (3, "u", "a" * 1000), (3, "u", "a" * 1000),
    (None, "u", "a" * 1000), (5, "u", f"é\r\n\r\n{FAKE * 30}"), (6, "u", "a" * 999), (7, "u", "a" * 999),
    (None, None, "z" * 2000), (None, None, "z" * 2000), (-4, "", ""), (2**60 + 1, "u", FAKE), (9, "u", "é" * 500),
    (10, "u", "é" * 500), (11, "u", "\r\n\r\n"), (12, "u", "x" * 3_000_000),
]


def by_sql(pages):
    con = duckdb.connect()
    con.register(
        "pages",
        pa.table({"page_id": pa.array([p[0] for p in pages], pa.int64()), "html": [p[2] for p in pages]}),
    )
    return duck_rows(con, WARC_SQL)


def test_round_trip(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as digest")
    for parts in (1, 5):
        assert spark_rows(warc.archive_round_trip(df.coalesce(parts))) == by_sql(PAGES)
    assert warc.archive_round_trip(df.where("false")).isEmpty()


def test_magic_in_payloads_is_no_record(spark, scratch):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(df, f"{scratch}/w")
    found = warc.candidates(spark, f"{scratch}/w")
    # 31 in payloads, and the url that ends like the magic
    assert found.count() == len(PAGES) + 32
    assert warc.read_archives(spark, f"{scratch}/w").count() == len(PAGES)


def test_a_damaged_record_ends_the_chain(spark, scratch):
    content = FAKE.encode() + b"WARC/1.0\r\nContent-Length: 99\r\n\r\nshort" + FAKE.encode()
    (spark.createDataFrame([(content.decode(),)], ["value"]).coalesce(1).write.option("lineSep", "\r\n").text(f"{scratch}/w"))
    rows = warc.read_archives(spark, f"{scratch}/w").collect()
    assert [r.payload_bytes for r in rows] == [3]


@pytest.mark.parametrize(
    "field, value",
    [
        ("Content-Length", "9" * 5000),
        ("Content-Length", "-9"),
        ("WARC-Payload-Length", "9" * 30),
        ("WARC-Record-ID", f"<urn:page:{'9' * 19}>"),
        ("WARC-Record-ID", f"<urn:page:-{'9' * 25}>"),
        ("WARC-Refers-To", f"<urn:page:{2**63}>"),
        ("Content-Length", "é"),
    ],
)
def test_fake_records_in_pages(spark, field, value):
    """Records inside html, with numbers that no record has."""
    fake = f"x\r\n\r\nWARC/1.0\r\nWARC-Type: revisit\r\n{field}: {value}\r\n"
    fake += "" if field == "Content-Length" else "Content-Length: 3\r\n"
    pages = [(1, "u", fake + "\r\nabc\r\n\r\n" + "end"), (2, "u", "plain"), (3, "u", fake * 20)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert spark_rows(warc.archive_round_trip(df)) == by_sql(pages)


def test_files_are_bounded_by_bytes(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 50_000)
    pages = [(i, "u", f"{i} " + "x" * (i % 9 * 2500)) for i in range(200)] + [(900, "u", "y" * 400_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(2)
    warc.write_archives(df, f"{scratch}/w")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{scratch}/w")
    sizes = sorted(r.length for r in files.select("length").collect())
    assert len(sizes) > 30 and sizes[-2] < 50_000 + 21_000 and sizes[-1] > 400_000
    assert spark_rows(warc.read_archives(spark, f"{scratch}/w")) == by_sql(pages)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=40), st.randoms())
def test_pointer_jumping_follows_the_links(steps, random):
    at = np.cumsum([0, *steps])
    after = at + np.array([random.choice([s, s, 2, 5]) for s in [*steps, 1]])
    place, want = 0, set()
    known = dict(zip(at.tolist(), after.tolist(), strict=True))
    while place in known and place not in want:
        want.add(place)
        place = known[place]
    order = list(range(len(at)))
    random.shuffle(order)
    reached = warc.on_chain(at[order], after[order])
    assert set(at[order][reached].tolist()) == want


def test_pages(spark):
    pages = read_table(spark, SF_DIR, "pages")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert spark_rows(warc.archive_round_trip(pages)) == by_sql(rows)
