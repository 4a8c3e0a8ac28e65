import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session("tests", "local[8]", spark__ui__enabled="false", spark__driver__memory="4g",
                            spark__sql__shuffle__partitions="4", spark__default__parallelism="2", spark__checkpoint__dir=str(shared),
                            spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
                            spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from tidemark.catalog import Tables

    return Tables(spark, DATA)


@pytest.fixture
def rows():
    """Collect as a sorted list of tuples."""
    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

    return collect


@pytest.fixture
def plan():
    """Formatted physical plan as text."""
    def text(df, run=False):
        if run:
            df.collect()
        return df._jdf.queryExecution().explainString(
            df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))

    return text
