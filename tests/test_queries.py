"""Every query against its SQL on the smallest tables."""

import importlib
import os

import duckdb
import pandas as pd
import pytest

from nightloom.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def text(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int | float) or type(v).__name__ == "Decimal":
        return f"{float(v):.5f}"
    if type(v).__name__ in ("datetime", "date", "Timestamp"):
        return str(pd.Timestamp(v))
    return str(list(v)) if isinstance(v, list) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_rows(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(text(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(catalog.ORACLE_SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = sorted(tuple(text(dict(zip(names, r, strict=True))[c]) for c in columns) for r in result.fetchall())
    assert got == want


#: Operators that SQL does not express, each with the test that holds it against plain loops.
WITHOUT_SQL = {
    "order_location": "test_frames.test_lit_pixels_against_dense_solution",
    "optimal_extract_profile": "test_fits.test_extraction_with_an_estimated_profile",
    "straylight_columns": "test_frames.test_nearest_filled_against_a_loop",
}


def test_other_queries_have_a_test_of_their_own():
    assert set(catalog.QUERIES) - set(catalog.ORACLE_SQL) == set(WITHOUT_SQL)
    for where in WITHOUT_SQL.values():
        module, name = where.split(".")
        assert hasattr(importlib.import_module(f"tests.{module}"), name)


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_rows_without_sql(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
