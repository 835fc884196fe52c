import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.debug.maxToStringFields", "1000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch():
    """A new folder, left behind on purpose."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def texts(spark):
    """A one-column table of texts."""

    def build(values):
        return spark.createDataFrame([(v,) for v in values], "v string")

    return build


@pytest.fixture
def evaluate(texts):
    """Apply a Column function to texts: {text: result}."""

    def run(function, values):
        df = texts(values)
        return {r[0]: r[1] for r in df.select("v", function(df["v"]).alias("r")).collect()}

    return run
