import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from grabqc.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("grabqc-tests", "local[8]", {
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""
    def collect(df, *columns):
        got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(got, key=lambda r: tuple((v is not None, str(v)) for v in r))
    return collect


@pytest.fixture(params=["one range", "many ranges"])
def ranges(request, spark):
    """Rows laid out in ranges: all in one, as few rows are, or in as many as there are shuffle partitions."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, str(request.param == "one range").lower())
    yield request.param
    spark.conf.unset(name)
