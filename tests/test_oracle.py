"""Every query with SQL gives the same rows in DuckDB; the others have rows and tests of their own."""

import math
from decimal import Decimal

import duckdb
import numpy as np
import pandas as pd
import pytest

from civicflow.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    """A value of either engine in one form; texts stay texts, so that '1.0' is not '1', and neither is the number 1."""
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, str):
        return ("text", v)
    if isinstance(v, (bool, np.bool_)):
        return ("bool", bool(v))
    if isinstance(v, (int, float, Decimal, np.number)):
        x = float(v)
        return ("number", int(x) if x == int(x) else round(x, 6))
    if isinstance(v, (list, tuple, np.ndarray)):
        return ("list", tuple(map(plain, v)))
    if isinstance(v, dict):
        return ("struct", tuple((k, plain(x)) for k, x in v.items()))
    if hasattr(v, "isoformat"):
        return ("time", pd.Timestamp(v).isoformat())
    return (type(v).__name__, str(v))


def rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(map(plain, r)) for r in df.itertuples(index=False)), key=repr)


def test_texts_are_no_numbers():
    assert plain("144449.0") != plain("144449") and plain("1") != plain(1) and plain(True) != plain("True") and plain(1) == plain(1.0) == plain(Decimal("1.00"))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, sf_dir, duck, name):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
