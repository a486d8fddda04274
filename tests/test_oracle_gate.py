"""Every registered query equals its DuckDB SQL on the sf0.001 tables
(row count, column names, all values) — the driver's gate, inside pytest."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted(repr(tuple(_plain(r[c]) for c in cols)) for r in df[cols].to_dict("records"))


def _plain(v):
    """Same value, same form on both sides: pandas turns nullable integer
    columns into floats on one side and nullable ints on the other."""
    if hasattr(v, "tolist"):
        v = v.tolist()
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if v != v:
            return None
        if v.is_integer():
            return int(v)
    return v


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    g_cols, g_rows = _rows(got)
    w_cols, w_rows = _rows(want)
    assert g_cols == w_cols
    assert len(g_rows) == len(w_rows)
    assert g_rows == w_rows
