import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wordloom.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


def pytest_addoption(parser):
    parser.addoption("--slow", action="store_true", help="also run tests marked slow")


def pytest_configure(config):
    config.addinivalue_line("markers", "slow: long trainings")


def pytest_collection_modifyitems(config, items):
    if not config.getoption("--slow"):
        for item in items:
            if "slow" in item.keywords:
                item.add_marker(pytest.mark.skip(reason="needs --slow"))


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]", "wordloom-tests", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Apply a Column function to a list of strings."""
    from pyspark.sql import functions as F

    def run(fn, values):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i int, x string").withColumn("y", fn(F.col("x")))
        return [r.y for r in df.orderBy("i").collect()]

    return run


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
