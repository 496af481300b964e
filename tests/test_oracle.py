"""Every registered query against its SQL in another engine, on the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

from grabqc.plans import catalog, oracle

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "lineitem", "customer"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(SF, name)}.parquet'")
    return con


def plain(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple("~" if pd.isna(v) else f"{float(v):.5f}" if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)
                        for v in row) for row in frame.itertuples(index=False, name=None))


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


def test_core_queries_stay_where_an_optional_module_is_missing():
    """In a fresh process in which a package of the optional operators cannot be imported."""
    code = ("import sys; sys.modules['sentencepiece'] = None\n"
            "import __spark_entry__ as entry; from grabqc.plans import catalog\n"
            "assert set(entry.queries()) == set(catalog.queries()) == set(entry.oracle_sql())")
    done = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_equals_sql(spark, duck, name):
    got = catalog.queries()[name](spark, SF).toPandas()
    want = duck.execute(oracle.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)
