"""Hard negatives and whitening against brute force, ties, repeats and numbers that no double or long holds."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightloom.llm import hard_negatives as mining
from nightloom.llm import vectors, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, row int, x string, id int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def whole(v, width):
    return [min(max(math.floor(256 * c), -(1 << 63)), (1 << 63) - 1024) for c in v] + [0] * (width - len(v))


def taking_part(rows):
    return [r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]


def mined(rows, every, positives=5, k=3):
    """Anchor by anchor, with Python's numbers."""
    rows = taking_part(rows)
    width = max((len(r[1]) for r in rows), default=0)
    xs = [whole(r[1], width) for r in rows]
    clip = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    out = []
    for a, row in enumerate(rows):
        if row[0] % every:
            continue
        ranked = sorted(((-sum(map(int.__mul__, xs[a], xs[b])), rows[b][0], b) for b in range(len(rows)) if b != a))
        for p in [r for r in ranked if rows[r[2]][2] == row[2]][:positives]:
            fits = [n for n in ranked if rows[n[2]][2] != row[2] and 50 * -p[0] <= 100 * -n[0] <= 95 * -p[0]]
            out += [(row[0], p[1], i + 1, n[1], clip(-p[0]), clip(-n[0])) for i, n in enumerate(fits[:k])]
    return sorted(out)


def got(spark, rows, every):
    out = mining.hard_negatives(frame(spark, rows), F.col("vec_id") % every == 0)
    return sorted(tuple(r) for r in out.collect())


@pytest.fixture(params=["one block", "many blocks"])
def blocks(request, monkeypatch):
    if request.param == "many blocks":
        monkeypatch.setattr(mining, "ANCHORS", 7)
        monkeypatch.setattr(mining, "ROWS", 23)
        monkeypatch.setattr(mining, "STRIP", 3)


def test_random_rows(spark, blocks):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.2) + 0.2 for _ in range(6)], rng.randrange(4)) for i in range(200)]
    want = mined(rows, 5)
    assert len(want) > 300 and got(spark, rows, 5) == want


def test_ties_repeats_and_a_hot_label(spark, blocks):
    """Vectors of few values tie everywhere; ids and rows repeat; one label has most rows."""
    rng = random.Random(2)
    rows = [(rng.randrange(60), [rng.choice([0.0, 0.5, 1.0]) for _ in range(3)], rng.choice([1, 1, 1, 1, 2, 3])) for _ in range(150)]
    rows += rows[:40]
    want = mined(rows, 10)
    assert len(want) > 100 and got(spark, rows, 10) == want


def test_rows_that_take_no_part(spark):
    rng = random.Random(3)
    rows = [(i, [rng.random() for _ in range(4)], i % 2) for i in range(40)]
    rows += [(50, None, 1), (None, [1.0] * 4, 1), (60, [1.0] * 4, None), (70, [1.0, None], 0), (80, [float("nan")] * 4, 1), (90, [float("inf"), 0.0], 0)]
    rows += [(100, [], 1), (110, [0.5], 0), (120, [0.7, 0.1], 1)]
    assert got(spark, rows, 10) == mined(rows, 10)


@pytest.mark.parametrize("size", [1e6, 1e9, 1e30])
def test_scores_beyond_doubles_and_longs(spark, blocks, size):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(0, 1) * (size if rng.random() < 0.6 else 1) for _ in range(3)], rng.randrange(3)) for i in range(60)]
    rows += [(i + 60, [-c for c in v], q) for i, v, q in rows[:20]]
    assert got(spark, rows, 4) == mined(rows, 4)


def test_no_rows_no_anchors_few_positives(spark):
    assert got(spark, [], 50) == []
    assert got(spark, [(1, [1.0], 1), (2, [1.0], 2)], 50) == []
    assert got(spark, [(50, [1.0], 1), (2, [1.0], 2)], 50) == []  # without a positive
    assert got(spark, [(50, [1.0], 1), (1, [1.0], 1), (2, [0.75], 2)], 50) == [(50, 1, 1, 2, 65536, 49152)]


def test_order_of_numbers_as_text(spark):
    values = [-(10**25), -11, -3, 0, 2, 10, 9, 10**30, 10**30 + 1]
    df = spark.createDataFrame([(str(v),) for v in values], "s string").orderBy(*mining.falling("s"))
    assert [int(r.s) for r in df.collect()] == sorted(values, reverse=True)


# whitening


def whitened(spark, rows):
    return whitening.whitened(frame(spark, rows)).collect()


def checked(spark, rows):
    """Against NumPy's eigenvalues over the distinct vectors; components of any sign."""
    out = whitened(spark, rows)
    used = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    width = max((len(r[1]) for r in used), default=0)
    xs = [whole(r[1], width) for r in used]
    distinct = sorted({tuple(x) for x in xs})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    assert len(out) == len(used) * min(4, width) and {r.n for r in out} == {n}
    centred = np.array(distinct, float) - np.array(sums) / n
    values, turned = np.linalg.eigh(centred.T @ centred / n)
    values, turned = values[::-1], turned[:, ::-1]
    deviations = {}
    for r, x in zip(used, xs, strict=True):
        exact = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        deviations.setdefault(r[0], set()).add(exact if exact < 1 << 63 else None)
    for c in range(min(4, width)):
        mine = [r for r in out if r.component == c + 1]
        assert {round(r.explained, 9) for r in mine} == {round(values[c] / values.sum(), 9)}
        assert all(r.deviation in deviations[r.vec_id] and r.identity_error < 1e-4 for r in mine)
        if len({r[0] for r in used}) == len(used):
            by = {r.vec_id: r.whitened for r in mine}
            want = (np.array(xs, float) - np.array(sums) / n) @ turned[:, c] / math.sqrt(values[c])
            have = np.array([by[r[0]] for r in used])
            assert np.abs(have - want).max() < 1e-8 or np.abs(have + want).max() < 1e-8


def test_whitening_of_random_rows(spark):
    rng = np.random.default_rng(1)
    mixed = rng.normal(size=(9, 9)) * np.array([3, 2, 1, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02])[:, None]
    rows = [(i, (rng.normal(size=9) @ mixed).tolist(), 1) for i in range(300)]
    checked(spark, rows)


def test_whitening_counts_distinct_vectors_once(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1), rng.gauss(0, 2), rng.gauss(3, 0.5), rng.gauss(0, 0.2), 1.0], None) for i in range(60)]
    rows += [(100 + i, rows[3][1], 2) for i in range(200)]  # a hot vector
    rows += [(500, None, 1), (501, [float("nan")] * 5, 1), (502, [1.0, None], 1), (503, [float("-inf")], 1), (504, [2.0], 1), (505, [], 1)]
    checked(spark, rows)


def test_whitening_of_large_numbers(spark):
    rng = random.Random(3)
    for size in (1e5, 3e5):  # some deviations beyond a long
        checked(spark, [(i, [rng.uniform(-1, 1) * size for _ in range(3)], 1) for i in range(40)])
    far = whitened(spark, [(i, [rng.uniform(-1, 1) * 1e12 for _ in range(3)], 1) for i in range(40)])
    assert len(far) == 120 and {r.deviation for r in far} == {None} and all(r.identity_error < 1e-4 for r in far)


def test_without_variance(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, [], 1), (2, None, 1)]) == []
    one = whitened(spark, [(1, [0.5, 0.25], 1), (2, [0.5, 0.25], 1)])
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, 0.0, 0.0)] * 4
    line = whitened(spark, [(i, [i / 4, i / 2], 1) for i in range(5)])
    assert all((r.whitened is None) == (r.component == 2) for r in line)
    assert {round(r.explained, 6) for r in line if r.component == 1} == {1.0}


def test_jacobi():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 8, 17):
        a = rng.normal(size=(n, n))
        values, turned = whitening.jacobi(a @ a.T)
        assert np.allclose(turned @ np.diag(values) @ turned.T, a @ a.T) and np.allclose(turned.T @ turned, np.eye(n))
        assert (np.diff(values) <= 0).all()
    graded = np.diag(10.0 ** np.arange(0, -14, -2))
    mixer = np.eye(7) + 0.1 * rng.normal(size=(7, 7))
    scaled = graded @ (mixer @ mixer.T) @ graded  # small eigenvalues, to full relative accuracy
    values, _ = whitening.jacobi(scaled)
    assert np.isclose(np.prod(values), np.linalg.det(mixer) ** 2 * np.prod(np.diag(graded)) ** 2, rtol=1e-9)


def test_rounds_pair_all_places_once():
    for n in (0, 1, 2, 5, 8):
        pairs = [(int(a), int(b)) for p, q in whitening.rounds(n) for a, b in zip(p, q, strict=True)]
        assert sorted(pairs) == [(a, b) for a in range(n) for b in range(a + 1, n)]
        assert all(len({*p, *q}) == 2 * len(p) for p, q in whitening.rounds(n))


def test_products_do_not_round():
    for size in (10, 1 << 24, 1 << 29, 1 << 40):
        rng = random.Random(size)
        a = [[rng.randrange(-size, size) for _ in range(4)] for _ in range(3)]
        got = vectors.products(np.array(a), np.array(a))
        assert [[int(v) for v in row] for row in got] == [[sum(map(int.__mul__, x, y)) for y in a] for x in a]
