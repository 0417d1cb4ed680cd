"""Exact percentiles against NumPy, windows against loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightloom.operators import asof, quantiles


def plain(values, f):
    v, at = sorted(map(float, values)), f * (len(values) - 1)
    a, b = v[int(at)], v[min(int(at) + (at > int(at)), len(v) - 1)]
    return a if a == b else a + (b - a) * (at - int(at))


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_percentiles_are_exact(spark, accuracy):
    rng = np.random.default_rng(1)
    groups = {
        "normal": rng.normal(size=5000), "ties": rng.integers(0, 4, 3000).astype(float), "one": np.array([3.0]), "two": np.array([1.0, 2.0]),
        "heavy": 1 / rng.uniform(1e-9, 1, 4000), "constant": np.full(500, 7.0), None: rng.uniform(size=999), "ends": np.r_[-np.inf, rng.normal(size=98), np.inf],
    }
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("none", None), ("none", float("nan")), ("two", float("nan"))]
    random.Random(2).shuffle(rows)
    fractions = [0.0, 0.16, 0.5, 0.84, 0.95, 1.0]
    out = quantiles.exact_percentiles(spark.createDataFrame(rows, "k string, v double").repartition(5), ["k"], "v", fractions, accuracy)
    got = {r.k: r for r in out.collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        assert got[k].n == len(vs)
        assert got[k].percentiles == pytest.approx([plain(vs, f) for f in fractions], rel=1e-12)


def test_without_keys_and_empty(spark):
    df = spark.range(10_001).select((F.col("id") * 7 % 10_001).cast("double").alias("v"))
    assert quantiles.exact_percentiles(df, [], "v", [0.25, 0.5]).first().percentiles == [2500.0, 5000.0]
    assert quantiles.exact_medians(df, [], "v").first()["median"] == 5000.0
    assert quantiles.exact_percentiles(df.filter("v < 0"), [], "v", [0.5]).count() == 0


def test_brackets_that_miss_are_taken_again(spark, monkeypatch):
    """A sketch that is wrong costs a second look, not the result."""
    real = F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda c, ends, accuracy: real(c, [min(e + 0.2, 1.0) for e in ends], accuracy))
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"))
    out = quantiles.exact_percentiles(df, ["k"], "v", [0.1, 0.5])
    assert {r.k: [round(v, 6) for v in r.percentiles] for r in out.collect()} == {0: [99.8, 499.0], 1: [100.8, 500.0]}


@pytest.mark.parametrize("bucket", [7, 1000])
def test_outside_windows_against_a_loop(spark, bucket):
    rng = random.Random(3)
    windows = [(a, a + rng.choice([0, 1, 3, 40])) for a in (rng.randrange(300) for _ in range(25))] + [(5, 250 if bucket == 7 else 60), (None, 3), (4, None), (90, 80)]
    times = [rng.randrange(-10, 350) for _ in range(400)] + [None]
    df = spark.createDataFrame(list(enumerate(times)), "i int, t int")
    out = asof.outside_windows(df, spark.createDataFrame(windows, "a int, b int"), "t", "a", "b", bucket)
    inside = lambda t: t is not None and any(a is not None and b is not None and a <= t <= b for a, b in windows)
    assert sorted(r.i for r in out.collect()) == [i for i, t in enumerate(times) if not inside(t)]
    assert "NestedLoop" not in out._jdf.queryExecution().toString()
