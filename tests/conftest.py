import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from estatelens.session import build_session

    session = build_session(
        "local[4]", "tests", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("work")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Evaluates a column function over one string column; NULL input allowed."""

    def run(values, fn):
        from pyspark.sql import functions as F

        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i int, v string").select("i", fn(F.col("v")).alias("r"))
        return [r["r"] for r in sorted(df.collect(), key=lambda r: r["i"])]

    return run
