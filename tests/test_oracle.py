"""queries() against oracle_sql() on the smallest scale (the driver runs the
same comparison at sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as e
from citesight.plans.catalog import QUERIES
from citesight.plans.oracle import ORACLE
from conftest import SF_SMALL

KEYS = sorted(k for k in ORACLE if k in QUERIES)


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(round(v, 6) + 0.0)
    try:
        import pandas as pd
        if pd.isna(v):
            return "NULL"
    except (TypeError, ValueError):
        pass
    return str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    got = e.queries()[key](spark, SF_SMALL).toPandas()
    want = con.execute(e.oracle_sql()[key]).df()
    assert _rows(got) == _rows(want)
