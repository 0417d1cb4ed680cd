"""Results that neither the order of rows nor the last bit of a sum may change."""

import pytest
from pyspark.sql import functions as F

from nightloom.operators import extraction, quality, registry, spectra

#: Taxes with a variance of 25 pixels^2; added up in this order their deviation comes out below 5.
TAXES = [0.03, 0.03, 0.04, 0.0, 0.08, 0.06, 0.04, 0.02, 0.04, 0.0, 0.0, 0.03, 0.02, 0.04, 0.0, 0.08, 0.03, 0.01, 0.08, 0.01, 0.03, 0.06, 0.05, 0.06]


def test_scatter_of_exactly_the_limit_is_wild_in_any_order(spark):
    for values in (TAXES, sorted(TAXES), TAXES[::-1]):
        rows = spark.createDataFrame([(1, 1, x * 200) for x in values], "obs int, ord int, pixels double").coalesce(1)
        assert [r["pass"] for r in quality.not_wild(rows, ["obs"], "ord", "pixels").collect()] == [False]


def test_equally_late_rows_are_settled_by_their_values(spark):
    stored = spark.createDataFrame([(1, 0, 0.0, "s")], "k int, cid int, n double, note string")
    late = [(1, 7, 12.0), (1, 7, None), (1, 7, 30.0), (1, 6, 99.0)]
    for rows in (late, late[::-1]):
        new = spark.createDataFrame(rows, "k int, cid int, n double").coalesce(1)
        assert [tuple(r) for r in registry.upsert(stored, new, ["k"], "cid").collect()] == [(1, 7, 30.0, "s")]


def test_rejection_reads_the_pixels_once(spark):
    """Sums of a second reading, whose rows a cluster may deliver in another order, do not equal those of the first."""
    pixels = spark.range(80).select((F.col("id") % 10).alias("col"), F.floor(F.col("id") / 10).cast("int").alias("row"))
    data = F.when(F.col("row") == 3, 5000.0).otherwise(100.0)
    pixels = pixels.withColumns({"data": data, "sky": F.lit(0.0), "variance": F.lit(4.0), "profile": F.lit(0.125), "mask": F.lit(1.0)})
    out = spectra.optimally_extracted(pixels, ["col"], 3.0, 2)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    assert [round(r.flux, 3) for r in out.collect()] == [800.0] * 10


def test_pixels_alike_but_for_their_data(spark):
    """Two pixels are left, equally far from their mean; the sums of the method, term by term, say which one goes."""
    rows = [
        (2, 2357.0814331783204, 0.06333333333333334, 475.7854071658916, 1.0, 0.15, 1), (3, 1396.864510897692, 0.02, 258.9843225544885, 1.0, 0.2, 1), (4, 140.86064547168368, 0.06, 8.704303227358418, 1.0, 0.25, 1),
        (5, 1094.5751018010687, 0.02, 257.47287550900535, 1.0, 0.2, 1), (6, 1245.6116106107904, 0.03333333333333333, 374.2280580530539, 1.0, 0.15, 0), (7, 528.3222142126046, 0.09, 54.641611071063025, 0.0, 0.1, 1),
    ]
    pixels = spark.createDataFrame(rows, "row int, data double, sky double, variance double, weight double, profile double, mask int").withColumn("col", F.lit(39))
    out = extraction.optimally_extracted(pixels, ["col"], 3.0, 200.0).collect()
    assert [(r.rounds, r.n_masked) for r in out] == [(4, 4)]
    assert out[0].flux == pytest.approx(5472.7755, abs=1e-3)
