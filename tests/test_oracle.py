"""Every registered query against its DuckDB oracle on the sf0.001 tables
(row multiset equality, column names equal)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from talentlake.plans import catalog
from conftest import SF_SMALL

TABLES = ["orders", "customer", "documents"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 6)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = catalog.QUERIES[name](spark, SF_SMALL).toPandas()
    odf = con.execute(catalog.ORACLE[name]).df()
    sc, sr = _rows(sdf)
    oc, orr = _rows(odf)
    assert sc == oc
    assert len(sr) == len(orr)
    assert sr == orr


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["profil", "famille", "competence", "nb_offres_mentionnent", "pct_offres_total",
                          "rang_dans_profil"]
