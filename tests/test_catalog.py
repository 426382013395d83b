"""Every catalog query against its SQL oracle, on the small tables."""

import math
from decimal import Decimal

import duckdb
import numpy as np
import pandas as pd
import pytest

from lodestack.plans import catalog
from lodestack.plans.base import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, (list, np.ndarray)):
        return tuple(plain(x) for x in v)
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (int, float, np.integer, np.floating, Decimal)):
        return f"{float(v):.9g}"
    return str(v)


def rows(df):
    return sorted(tuple(plain(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_oracle(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    want = duck.execute(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_rows_only(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
