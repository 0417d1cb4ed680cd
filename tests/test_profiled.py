"""Extraction with an estimated profile, all rounds of an order in one task, against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightloom.operators import extraction
from nightloom.plans import catalog

from .test_fits import SCHEMA, made, plain_profile

SF = "/root/testdata/sf0.001"


def plain_rounds(x, clip, width, knots):
    d, s, v, w, m, _ = x
    m = np.where(w > 0, m, 0)
    f, v0, rounds, hit = (m * (d - s) * w).sum(axis=0), v - np.abs(d), 0, True
    while hit:
        rounds, hit = rounds + 1, False
        p = plain_profile(d, s, w, f, width, knots, 5.0)
        var = v0 + np.abs(f * p + s)
        r = (d - f * p - s) ** 2 / var
        for c in range(d.shape[1]):
            k = int(np.argmax(r[:, c] * m[:, c]))
            if r[k, c] * m[k, c] > clip * clip:
                m[k, c], hit = 0, True
        norm = (m * p * p * w / var).sum(axis=0)
        f, out = (m * p * (d - s) * w / var).sum(axis=0) / norm, (m * p * w).sum(axis=0) / norm
    return f, out, rounds


def test_orders_run_to_their_end_in_a_task(spark):
    """36 orders of three kinds, in batches that begin and end inside of orders; more pixels than are worked on at once."""
    rng = np.random.default_rng(8)
    kinds = [made(rng, 100) for _ in range(3)]
    kinds[1] = (kinds[1][5] * 3000 + kinds[1][1], *kinds[1][1:])  # without noise
    d, s, v, *_ = kinds[2]
    for k in range(6):  # seven bad pixels in a column, one of which goes in a round
        d[1 + k, 50] += 30_000 * (k + 1)
    v[:, 50] = np.abs(d[:, 50]) + 9.0
    want = [plain_rounds(x, 5.0, 11, 5) for x in kinds]
    rows = [(o, r, c, *[float(a[r, c]) for a in kinds[o % 3][:4]], int(kinds[o % 3][4][r, c]), 0.0) for o in range(36) for r in range(9) for c in range(100)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 700)
    try:
        out = extraction.profiled_to_end(spark.createDataFrame(rows, SCHEMA).drop("profile").coalesce(1), ["o"], 5.0, 11, 5).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {(r.o, r.col): r for r in out}
    assert len(out) == len(got) == 3600
    for (o, c), r in got.items():
        f, var, rounds = want[o % 3]
        assert r.rounds == rounds
        assert r.flux == pytest.approx(f[c], rel=1e-5) and r.variance == pytest.approx(var[c], rel=1e-5)
    assert want[1][2] < want[2][2] > 5


def test_gaps_and_empty_columns_as_in_rounds_over_spark(spark):
    """Missing pixels, pixels and columns without data, orders without a name or without any weight."""
    p = spark.range(4 * 9 * 40).select((F.col("id") % 4).alias("o"), (F.col("id") / 4 % 9).cast("int").alias("row"), (F.col("id") / 36).cast("int").alias("col"))
    h = F.abs(F.hash("o", "row", "col") % 1000)
    p = p.filter(h % 7 != 0).withColumns({"data": F.when((h % 11 != 0) & (F.col("col") != 7), F.when(h % 13 == 0, 9000.0).otherwise(h % 90 + F.lit(500.0))), "sky": F.lit(1.0), "variance": F.lit(600.0)})
    p = p.withColumns({"weight": F.when((F.col("o") == 3) | (F.col("row") == 8), 0.0).otherwise(1.0), "mask": F.when(h % 17 == 0, 0).otherwise(1), "o": F.concat(F.lit("order "), F.col("o").cast("string"))}).localCheckpoint()
    want = {(r.o, r.col): r for r in extraction.extracted_with_profile(p, ["o"], 5.0, lambda df: df.localCheckpoint(), 11, 5).collect()}
    got = extraction.profiled_to_end(p, ["o"], 5.0, 11, 5).collect()
    assert len(got) == len(want) == 160
    for r in got:
        assert r.rounds == want[r.o, r.col].rounds, r
        for a, b in ((r.flux, want[r.o, r.col].flux), (r.variance, want[r.o, r.col].variance)):
            assert a == b if b is None else a == pytest.approx(b, rel=1e-6)
    assert extraction.profiled_to_end(p.filter("o is null"), ["o"], 5.0).collect() == []


def test_the_query_stops_no_order_before_its_end(spark):
    """Its orders need eight rounds or more; five were made."""
    assert catalog.QUERIES["optimal_extract_profile"](spark, SF).agg(F.min("rounds")).first()[0] > 5
