"""Every registered query against its SQL oracle on the smallest driver tables."""

import decimal
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tableload.plans import registered

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def _norm(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if hasattr(v, "item") and not isinstance(v, (list, tuple)):
        v = v.item()
    if isinstance(v, float):
        return int(v) if v.is_integer() and abs(v) < 2 ** 53 else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    return v


def _multiset(pdf):
    cols = sorted(pdf.columns)
    return sorted(repr(tuple(_norm(x) for x in r)) for r in pdf[cols].itertuples(index=False, name=None))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    out = df.collect()
    assert df.columns == ["part", "subpart", "rows"] and len(out) == 5


def test_every_query_has_an_oracle():
    assert set(registered.QUERIES) == set(registered.ORACLES)
    assert set(registered.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    s = entry.queries()[name](spark, SF_SMALL).toPandas()
    o = duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    assert _multiset(s) == _multiset(o)
