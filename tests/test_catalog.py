"""Every query against its SQL twin, on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from labharm import catalog

SF = "/root/testdata/sf0.001"


def cell(v):
    if v is None or pd.isna(v):
        return "null"
    return f"{v:.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def rows(df):
    return sorted(tuple(cell(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_against_sql(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), duck.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
    spark.catalog.clearCache()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(catalog.QUERIES) <= set(e.queries())


def test_without_the_training_data_operators(monkeypatch):
    import sys

    import __spark_entry__ as e

    monkeypatch.setitem(sys.modules, "labharm.llm", None)  # importing it, or anything in it, fails
    monkeypatch.delitem(sys.modules, "labharm.llm.catalog", raising=False)
    assert e.queries().keys() == catalog.QUERIES.keys() == e.oracle_sql().keys()
