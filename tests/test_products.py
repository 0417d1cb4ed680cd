"""Observations by a catalog, and an ingest that reads them so."""

import pytest

from nightloom.operators import ingest
from nightloom.sources import products

SCHEMA = "obs long, level string, extension string, keyword string, place int, value string"
CATALOG = [
    products.Keyword("exptime", "float", "L0", "PRIMARY", "EXPTIME", "a"),
    products.Keyword("junk", "bool", "L0", "PRIMARY", "JUNK", "a"),
    products.Keyword("reads", "int", "L1", "PRIMARY", "READS", "b"),
    products.Keyword("made", "datetime", "2D", "PRIMARY", "MADE", "b"),
    products.Keyword("name", "string", "L0", "PRIMARY", "OBJECT", "a"),
    products.Keyword("temp", "float", "L0", "TELEMETRY", "T1", "c", "mean"),
]
ROWS = [
    (1, "L0", "PRIMARY", "EXPTIME", 1, "10"), (1, "L0", "PRIMARY", "EXPTIME", 2, " 12.5 "), (1, "L0", "PRIMARY", "JUNK", 1, "T"), (1, "L0", "PRIMARY", "OTHER", 1, "x"),
    (1, "L1", "PRIMARY", "READS", 1, "7"), (1, "L1", "TELEMETRY", "READS", 9, "8"), (1, "2D", "PRIMARY", "MADE", 1, "2024-02-03 04:05:06"), (1, "L0", "PRIMARY", "OBJECT", 1, " HD 1 "),
    (1, "L0", "TELEMETRY", "T1", 1, "1.0"), (1, "L0", "TELEMETRY", "T1", 2, "-nan"), (1, "L0", "TELEMETRY", "T1", 3, "2.0"),
    (2, "L0", "PRIMARY", "EXPTIME", 1, "-999"), (2, "L0", "PRIMARY", "JUNK", 1, "maybe"), (2, "L1", "PRIMARY", "READS", 1, "seven"), (2, "2D", "PRIMARY", "MADE", 1, "soon"), (2, "L0", "PRIMARY", "OBJECT", 1, "nan"),
    (3, "L2", "PRIMARY", "NOTHING", 1, "x"),
]


def test_types_levels_and_places(spark):
    out = {r.obs: r for r in products.observations(spark.createDataFrame(ROWS, SCHEMA), "obs", CATALOG).collect()}
    one = out[1]
    assert (one.exptime, one.junk, one.reads, str(one.made), one.name, one.temp) == (12.5, True, 7, "2024-02-03 04:05:06", "HD 1", 1.5)
    assert (one.has_L0, one.has_2D, one.has_L1, one.has_L2) == (True, True, True, False)
    assert [out[2][k.name] for k in CATALOG] == [None] * 6 and [out[3][k.name] for k in CATALOG] == [None] * 6
    assert out[3].has_L2 and not out[3].has_L0


def test_tables(spark):
    wide = products.observations(spark.createDataFrame(ROWS, SCHEMA), "obs", CATALOG)
    assert {t: df.columns for t, df in products.tables(wide, "obs", CATALOG).items()} == {"a": ["obs", "exptime", "junk", "name"], "b": ["obs", "reads", "made"], "c": ["obs", "temp"]}


def test_catalogs(spark):
    schema = "name string, kind string, level string, extension string, keyword string, `table` string, many string"
    rows = [("b", "int", "L1", "PRIMARY", "B", "t", "last"), ("a", "float", "L0", "PRIMARY", "A", "t", "mean")]
    assert [k.name for k in products.catalog_of(spark.createDataFrame(rows, schema))] == ["a", "b"]
    for bad in (rows + rows[:1], [("c", "number", "L0", "P", "C", "t", "last")]):
        with pytest.raises(ValueError):
            products.catalog_of(spark.createDataFrame(bad, schema))


def test_ingest_by_a_catalog(spark):
    """Stale observations are read by the catalog; the others stay as they were."""
    files = spark.createDataFrame(ROWS, SCHEMA)
    listing = spark.createDataFrame([(1, "2024-01-02"), (2, "2024-01-01")], "obs long, l0 string").selectExpr("obs", "cast(l0 as timestamp_ntz) as l0")
    stored = spark.createDataFrame([(1, "2024-01-01", 1.0), (2, "2024-01-01", 99.0)], "obs long, read string, exptime double").selectExpr("obs", "cast(read as timestamp_ntz) as read", "exptime")

    def extract(rows):
        wide = products.observations(files.join(rows.select("obs"), "obs", "left_semi"), "obs", CATALOG)
        return rows.join(wide, "obs").selectExpr("obs", "l0 as read", "exptime")

    out = ingest.Ingest("obs", ["l0"], ["read"], extract).run(listing, stored)
    assert {r.obs: (r.exptime, r.done) for r in out.collect()} == {1: (12.5, "updated"), 2: (99.0, "kept")}
