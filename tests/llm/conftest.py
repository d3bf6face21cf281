import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, h string, word string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty texts, ties, repeated rows, a very long text, and extra columns whose names operators use inside."""
    long = " ".join(f"w{k % 4001}x{k % 7}" for k in range(30000))
    base = " ".join(f"alpha{k} beta" for k in range(200))
    rows = [(1, base, "en", "a", 1, 5, "x", "y"), (1, base, "en", "a", 1, 5, "x", "y"), (2, base, "en", None, 1, 5, None, "y"), (3, None, None, "b", None, None, None, None), (4, "", "en", "b", 0, 1, "x", "y"), (5, " \t\n ", "en", "c", 0, 1, "x", "y"), (6, long, "en", "c", 0, 1, "x", "y"), (None, base + " tail", "en", "c", 0, 1, "x", "y"), (7, "é\u00a0ß \U0001f600 naïve text", "fr", "d", 3, 1, "x", "y"), (8, long[:5000], "en", "c", 0, 1, "x", "y"), (9, "tok " * 300, "en", "c", 0, 1, "x", "y")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
