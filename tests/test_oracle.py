"""Every catalogue key against its DuckDB oracle on the smallest data set."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from shoplens.plans.catalog import QUERIES
from shoplens.sources.testdata import TABLES

KEYS = sorted(QUERIES)


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item"):
        return v.item()
    return v


def _multiset(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    sdf = entry.queries()[key](spark, SF_SMALL)
    got = [r.asDict() for r in sdf.collect()]
    want_df = duck.execute(entry.oracle_sql()[key]).df()
    assert sorted(sdf.columns) == sorted(want_df.columns)
    cols = sorted(sdf.columns)
    assert _multiset(got, cols) == _multiset(want_df.to_dict("records"), cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["area", "area_level", "pid", "city_infos", "click_count", "product_name",
                          "product_status"]
    assert df.count() > 0
