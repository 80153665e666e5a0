import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from barmill.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="barmill-test-")
    session = build_session(
        "barmill-test",
        spark__master="local[4]",
        spark__driver__memory="4g",
        spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=f"{scratch}/shared",
        spark__sql__warehouse__dir=f"{scratch}/warehouse",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def sf_dir():
    return SMALL


@pytest.fixture
def lines_of(spark):
    def make(*lines):
        return spark.createDataFrame([(line,) for line in lines], "value string")

    return make


@pytest.fixture
def bars_of(spark):
    """Bars from (time, close, volume); the other prices follow the close."""

    def make(*rows):
        values = [(t, c, c, c, c, v) for t, c, v in rows]
        texts = spark.createDataFrame(
            values, "tstamp string, open double, high double, low double, close double, volume bigint"
        )
        return texts.withColumn("tstamp", texts.tstamp.try_cast("timestamp_ntz"))

    return make


def plan(df, mode="formatted"):
    """Text of the physical plan."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
