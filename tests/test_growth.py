"""Steps whose work may grow no faster than their rows: what their plans hold."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from nightloom.operators import combs, extraction, frames, selection
from nightloom.operators import statistics as A
from nightloom.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_files_meet_the_one_id_that_they_can_contain(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(selection, "first_match", lambda *a: seen.append(a) or spark.range(0))
    catalog.QUERIES["select_obs_first_match"](spark, SF)
    files, ids, _, _, bucket, id_bucket, _ = seen[0]
    pairs = files.withColumn("_b", bucket).join(ids.withColumn("_b", id_bucket), "_b").count()
    assert 0 < pairs <= files.count()


def test_intervals_make_no_pairs(spark):
    assert "Join Inner" not in plan(catalog.QUERIES["clear_interval_stats"](spark, SF))


def test_intervals_against_a_loop(spark):
    rng = random.Random(4)
    samples = [(rng.randrange(-300, 900), rng.choice([None, float("nan"), *[round(rng.uniform(0, 100), 2) for _ in range(40)]])) for _ in range(400)] + [(100, 5.0), (200, 7.0)]
    intervals = [(i, rng.randrange(-400, 1000)) for i in range(60)] + [(60, 100), (61, 200), (62, 0), (63, None), (64, 100_000)]
    out = A.interval_stats(spark.createDataFrame(samples, "at long, v double"), spark.createDataFrame(intervals, "k int, a long"), "k", "a", "at", "v", 100, 90)
    got = {r.k: r for r in out.collect()}
    want = {k: inside for k, a in intervals if a is not None and (inside := [v for t, v in samples if a <= t < a + 100])}
    assert got.keys() == want.keys()
    for k, inside in want.items():
        v = [x for x in inside if x is not None]
        r = got[k]
        assert r.n == len(inside) and r.clear == (all(x < 90 for x in v) if v else None)
        if v:
            assert r.mean == pytest.approx(statistics.fmean(v), nan_ok=True)
            assert r.std == pytest.approx(statistics.pstdev(v) if not any(x != x for x in v) else float("nan"), abs=1e-9, nan_ok=True)
        else:
            assert r.mean is None and r.std is None


def test_clipped_groups_are_not_dealt_out(spark):
    """A few groups of very many rows stay where they are: what is joined to them is a row for each group."""
    rows = spark.createDataFrame([(k, float(x), 1.0) for k in range(3) for x in [*range(1, 40), 5000]], "k int, x double, w double").repartition(3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = A.weighted_clip(rows, ["k"], "x", "w", 3, 3.0)
        assert "SortMergeJoin" not in plan(out, "executedPlan")
        assert sorted(tuple(r) for r in out.collect()) == [(k, 20.0, 39) for k in range(3)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_an_observation_is_grouped_once(spark):
    assert plan(catalog.QUERIES["catalog_extract"](spark, SF)).count("Aggregate [") == 1


def test_a_round_of_extraction_writes_its_pixels_once(spark):
    """Two tables of pixels a round, and as many joins, are what the bytes of a large run were made of."""
    kept = []
    pixels = spark.range(3 * 9 * 40).select((F.col("id") % 3).alias("o"), (F.col("id") / 3 % 9).cast("int").alias("row"), (F.col("id") / 27).cast("int").alias("col"))
    pixels = pixels.withColumns({"data": F.abs(F.hash("o", "row", "col") % 90) + F.lit(500.0), "sky": F.lit(1.0), "variance": F.lit(600.0), "weight": F.lit(1.0), "mask": F.lit(1)})
    pixels = pixels.withColumn("data", F.when((F.col("row") == 4) & (F.col("col") % 9 == 2), 5000.0).otherwise(F.col("data")))
    out = extraction.extracted_with_profile(pixels, ["o"], 5.0, lambda df: kept.append(df) or df.localCheckpoint(), 11, 5, 5.0, 1.0, 3)
    assert out.count() == 3 * 40
    assert len(kept) == out.agg(F.max("rounds")).first()[0]


def test_spacing_of_peaks_takes_one_pass_over_an_order(spark):
    """Neighbourhoods as arrays within Spark's windows took most of the time of a large run."""
    peaks = spark.createDataFrame([(0, float(10 * k), k + 0.1) for k in range(30) if k != 7], "g int, x double, rough double")
    out = combs.mode_numbers(peaks, ["g"], "x", "rough")
    assert "collect_list" not in plan(out)
    assert sorted((r.mode, r.x) for r in out.collect()) == [(k, 10.0 * k) for k in range(30) if k != 7]


def test_tiles_of_many_frames_share_a_call(spark):
    """Frames of two tiles, more rows than a batch holds; each has one cluster across the border and one of its own."""
    frames_of = spark.range(3000)
    lit = frames_of.select(F.col("id").alias("frame"), F.explode(F.expr("array(struct(1 as r, 3 as c), struct(2 as r, 4 as c), struct(2 as r, 5 as c), struct(0 as r, 7 as c), struct(7 as r, 0 as c))")).alias("p")).select("frame", "p.*")
    found = frames.clusters(lit, ["frame"], "r", "c", 8, 8, 4)
    assert "FlatMapGroups" not in plan(found)
    sizes = frames.cluster_sizes(found, ["frame"], "r", "c").groupBy("first_row", "first_col", "n_pixels").count().collect()
    assert sorted(tuple(r) for r in sizes) == [(0, 7, 1, 3000), (1, 3, 3, 3000), (7, 0, 1, 3000)]
    one = frames.clusters(lit.filter("frame = 0").drop("frame"), [], "r", "c", 8, 8, 4)
    assert one.select("first_row", "first_col").distinct().count() == 3
