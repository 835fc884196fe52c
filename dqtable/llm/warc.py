"""WARC archives: write pages as records, and read archives back by verified boundaries.

Reading takes nothing for a record because it looks like one. A task emits every place where the
magic occurs as a candidate, with the offset at which its length says the next record starts.
Pointer jumping from the file's start then follows these links; only candidates on the chain are
records, so a magic inside a payload is rejected.

Pages: one record per row. A null html is an empty payload, a null url leaves its field out.
Rows of equal payloads that share the largest page_id are all responses; where none of the equal
payloads has a page_id, all are. Empty tables give an empty archive. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dqtable.llm.common import fill, stored, work_folder

#: Fixed values of the format.
MAGIC = b"WARC/1.0\r\n"
END = "\r\n\r\n"
#: Bytes of an archive file, beyond which the next record starts a new one: a task reads files whole.
FILE_BYTES = 32 << 20
#: Files that a writing task may keep open.
OPEN_FILES = 64
_OPEN = "spark.sql.maxConcurrentOutputFileWriters"
#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000
DATE = "2000-01-01T00:00:00Z"


def _fields(pairs: list[tuple[str, Column]]) -> Column:
    """Header lines; a field without a value is left out."""
    lines = [F.concat(F.lit(f"{name}: "), value.cast("string")) for name, value in pairs]
    return F.concat_ws("\r\n", F.lit("WARC/1.0"), *lines)


def records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES, date: str = DATE) -> DataFrame:
    """(value): the text of one record per page, without its closing blank lines.

    The payload's digest, not the payload, is grouped; only digests that occur twice come back to
    the pages, and copies meet in the map tasks first. Those are written, so that Spark knows their
    size and shuffles payloads only where they are too many to broadcast.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", fill("html").alias("html"))
    rows = rows.withColumn("n", F.octet_length("html")).withColumn("digest", F.sha1("html"))
    large = rows.where(F.col("n") >= revisit_bytes).groupBy("digest")
    repeated = large.agg(F.max("page_id").alias("kept"), F.count("*").alias("copies"))
    repeated = repeated.where("copies > 1 and kept is not null").drop("copies")
    repeated = stored(repeated, work_folder(pages.sparkSession, "warc-digests"))
    rows = rows.join(repeated, "digest", "left")
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("n").cast("string"),
        F.lit(END),
    )
    block = F.when(revisit, F.lit("")).otherwise(F.concat(head, F.col("html")))
    url = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    to = F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("kept").cast("string"), F.lit(">")))
    same = F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")
    header = _fields(
        [
            ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            ("WARC-Record-ID", name),
            ("WARC-Target-URI", url),
            ("WARC-Date", F.lit(date)),
            ("WARC-Profile", F.when(revisit, same)),
            ("WARC-Refers-To", to),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("WARC-Payload-Length", F.col("n")),
            ("Content-Type", F.lit("application/http; msgtype=response")),
            ("Content-Length", F.octet_length(block)),
        ]
    )
    return rows.select(F.concat(header, F.lit(END), block).alias("value"))


def write_archives(pages: DataFrame, folder: str, revisit_bytes: int = REVISIT_BYTES) -> None:
    """Archive files below `folder`, one or more per task.

    A task fills one file after another, each with FILE_BYTES and the rest of its last record. Spark
    keeps the files of a task open, so that it need not sort the records by file.
    """
    limit = FILE_BYTES

    def dealt(batches):
        before = 0
        for batch in batches:
            value = batch.column("value")
            size = pc.binary_length(value).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = before + np.cumsum(size + len(END))
            file = pa.array(np.r_[before, ends[:-1]] // limit, pa.int64())
            before = int(ends[-1]) if len(ends) else before
            yield pa.RecordBatch.from_arrays([value, file], names=["value", "file"])

    rows = records(pages, revisit_bytes).mapInArrow(dealt, "value string, file long")
    conf = pages.sparkSession.conf
    usual = conf.get(_OPEN, None)
    conf.set(_OPEN, str(OPEN_FILES))
    try:
        writer = rows.write.mode("overwrite").partitionBy("file").option("lineSep", END)
        writer.text(folder)
    finally:
        if usual is None:
            conf.unset(_OPEN)
        else:
            conf.set(_OPEN, usual)


def _header(text: bytes) -> dict[bytes, bytes]:
    pairs = (line.split(b":", 1) for line in text.split(b"\r\n")[1:] if b":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def _number(text: bytes) -> int | None:
    """A whole number of 64 bits, else none: payloads hold headers of any kind."""
    if len(text) > 20 or not text.removeprefix(b"-").isdigit():
        return None
    return number if -(2**63) <= (number := int(text)) < 2**63 else None


def _page(name: bytes | None) -> int | None:
    return _number((name or b"").removeprefix(b"<urn:page:").removesuffix(b">"))


def candidate(content: bytes, at: int) -> tuple:
    """What a magic at `at` would be: its successor's offset (-1: no record), and its fields."""
    stop = content.find(b"\r\n\r\n", at)
    header = _header(content[at:stop]) if stop >= 0 else {}
    length = _number(header.get(b"content-length", b""))
    end = stop + 4 + length if length is not None and 0 <= length <= len(content) else -1
    if stop < 0 or end < 0 or content[end : end + 4] != b"\r\n\r\n":
        return (at, -1, None, None, None, None, None)
    kind = header.get(b"warc-type", b"").decode("latin-1")
    digest = header.get(b"warc-payload-digest", b"").decode("latin-1").removeprefix("sha1:")
    size = _number(header.get(b"warc-payload-length", b""))
    if kind == "response":
        body = content.find(b"\r\n\r\n", stop + 4, end)
        payload = memoryview(content)[body + 4 if body >= 0 else stop + 4 : end]
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    refers = _page(header.get(b"warc-refers-to"))
    return (at, end + 4, _page(header.get(b"warc-record-id")), size, digest, kind, refers)


def on_chain(at: np.ndarray, successor: np.ndarray) -> np.ndarray:
    """Which candidates the links reach from offset 0, by pointer jumping.

    In round k every reached candidate also marks the one 2^k links on; both the marks and the
    links double, so the rounds grow with the logarithm of the chain.
    """
    count = len(at)
    order = np.argsort(at, kind="stable")
    place = np.searchsorted(at[order], successor)
    known = place < count
    known[known] = at[order][place[known]] == successor[known]
    jump = np.full(count + 1, count)
    jump[:count][known] = order[place[known]]
    reached = np.zeros(count + 1, bool)
    reached[:count] = at == 0
    for _ in range(max(1, count).bit_length() + 1):
        reached[jump[reached]] = True
        jump = jump[jump]
    return reached[:count]


_CANDIDATE = (
    "at long, successor long, page_id long, payload_bytes long, payload_digest string,"
    " record_type string, refers_to long"
)


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """(path, at, successor, fields) for every magic in every file below `folder`."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt")
    files = files.option("recursiveFileLookup", "true").load(folder)

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                data, at, found = content.as_py(), -1, []
                while (at := data.find(MAGIC, at + 1)) >= 0:
                    found.append(candidate(data, at))
                if found:
                    frame = [pa.array([path.as_py()] * len(found))]
                    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
                    frame += [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)]
                    names = ["path", *(f.split()[0] for f in _CANDIDATE.split(","))]
                    yield pa.RecordBatch.from_arrays(frame, names=names)

    return files.select("path", "content").mapInArrow(run, f"path string, {_CANDIDATE}")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all records.

    A file's candidates meet in one task, without payloads; the file size bounds them. Records
    behind a damaged one are not reached.
    """

    def chain(rows: pa.Table) -> pa.Table:
        return rows.filter(pa.array(on_chain(rows["at"].to_numpy(), rows["successor"].to_numpy())))

    rows = candidates(spark, folder)
    kept = rows.groupBy("path").applyInArrow(chain, rows.schema)
    return kept.where("successor >= 0").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def archive_round_trip(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write `pages` as archives and read them back: one row per page."""
    folder = work_folder(pages.sparkSession, "warc")
    write_archives(pages, folder, revisit_bytes)
    return read_archives(pages.sparkSession, folder)
