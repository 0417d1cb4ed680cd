"""Frame operators against plain loops on random masks and images."""

import math
import random

import numpy as np
import pytest

from nightloom.operators import frames


def flooded(mask):
    """Pixel -> first pixel of its cluster, by flooding in order of (row, column)."""
    first = {}
    for p in sorted(mask):
        if p in first:
            continue
        open_ = [p]
        first[p] = p
        while open_:
            r, c = open_.pop()
            for q in [(r + i, c + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]:
                if q in mask and q not in first:
                    first[q] = p
                    open_.append(q)
    return first


def random_mask(rng, height, width, share):
    return {(r, c) for r in range(height) for c in range(width) if rng.random() < share}


def spiral(n):
    """One cluster that passes every tile border many times."""
    out, r, c, d, left, turn = set(), 0, 0, 0, n - 1, 0
    steps = [n - 1, n - 1, n - 1] + [k for k in range(n - 3, 0, -2) for _ in range(2)]
    for k in steps:
        for _ in range(k):
            out.add((r, c))
            r, c = r + (0, 1, 0, -1)[d], c + (1, 0, -1, 0)[d]
        d = (d + 1) % 4
    out.add((r, c))
    return out


@pytest.mark.parametrize("tile", [4, 7, 64])
def test_clusters_against_flooding(spark, tile):
    rng = random.Random(tile)
    height, width = 33, 41
    masks = [random_mask(rng, height, width, share) for share in (0.15, 0.35, 0.5)] + [spiral(31), set(), {(32, 40)}]
    masks.append({(r, c) for r in range(height) for c in range(width)})
    rows = [(f, r, c) for f, m in enumerate(masks) for r, c in m] + [(0, *next(iter(masks[0])))]
    out = frames.clusters(spark.createDataFrame(rows, "frame int, r int, c int"), ["frame"], "r", "c", height, width, tile)
    got = sorted((x.frame, x.r, x.c, x.first_row, x.first_col) for x in out.collect())
    assert got == sorted((f, r, c, *p) for f, m in enumerate(masks) for (r, c), p in flooded(m).items())


def test_runs_joined_without_spark():
    rng = random.Random(1)
    for share in (0.1, 0.3, 0.4, 0.6, 0.9):
        for _ in range(20):
            mask = random_mask(rng, rng.randrange(1, 25), rng.randrange(1, 25), share)
            at = sorted(mask)
            if at:
                place = frames.runs_joined(np.array([r for r, _ in at]), np.array([c for _, c in at]))
                assert {p: at[k] for p, k in zip(at, place, strict=True)} == flooded(mask)


def test_large_clusters(spark):
    """Noise is small, or both narrow and low; the rest is numbered by last row and first column."""
    lit = [(0, r, 5) for r in range(30)] + [(0, 3, c) for c in range(50, 90)] + [(0, 50, 50), (0, 51, 51)] + [(0, 70 + r, 10 + c) for r in range(2) for c in range(2)]
    labelled = frames.clusters(spark.createDataFrame(lit, "f int, r int, c int"), ["f"], "r", "c", 200, 200, 32)
    sizes = frames.cluster_sizes(labelled, ["f"], "r", "c")
    assert sizes.count() == 4
    got = [(x.cluster, x.n_pixels, x.min_r, x.max_r, x.min_c, x.max_c) for x in frames.large_clusters(sizes, ["f"], "r", "c", 200, 200).orderBy("cluster").collect()]
    assert got == [(1, 40, 3, 3, 50, 89), (2, 30, 0, 29, 5, 5)]


def test_lit_pixels_against_dense_solution(spark):
    rng = np.random.default_rng(2)
    rows, want = [], set()
    for f in range(2):
        for c in range(70):
            n = 40 if c % 9 else 33
            v = rng.normal(0, 1 if f else 0.1, n) + 30 * (np.arange(n) % 8 == c % 3) * f + 0.4 * (np.arange(n) % 8 == 2)
            step = np.diff(np.eye(n), axis=0)
            above = v + 0.05 - np.linalg.solve(np.eye(n) + 20 * step.T @ step, v)
            middle = 0.5 * np.sort(np.maximum(above, 0))[int(n * 0.6)]
            level = middle if v.max() - v.min() <= 1 else middle + 1
            want |= {(f, r, c) for r in np.flatnonzero(above > level)}
            rows += [(f, r, c, float(x)) for r, x in enumerate(v)]
    rows += [(0, 100, 1, None), (0, 101, 1, float("nan"))]
    out = frames.lit_pixels(spark.createDataFrame(rows, "f int, r int, c int, v double"), ["f"], "r", "c", "v", noise=0.05, ratio=0.6)
    assert {(x.f, x.r, x.c) for x in out.collect()} == want


def test_cut_out_against_a_loop(spark):
    rng = random.Random(3)
    height, width = 50, 40
    traces = [(f, t, [rng.uniform(-3, 52), rng.uniform(-0.4, 0.4), rng.uniform(-0.005, 0.005)], rng.uniform(0, 4), rng.uniform(0, 4), 0, width - 1) for f in range(2) for t in range(6)]
    traces += [(0, 90, [10.0], 2.0, 3.0, 5, 20), (1, 91, [10.25], 0.1, 0.2, 0, 39), (1, 92, [0.0], 2.0, 2.5, 0, 39), (1, 93, [20.0], 0.0, 0.0, 0, 3)]
    want = {}
    for f, t, k, below, above, x1, x2 in traces:
        for c in range(x1, x2 + 1):
            mid = sum(a * c**i for i, a in enumerate(k))
            bottom, top = (min(max(v, 0.0), height - 1.0) for v in (mid - below, mid + above))
            for r in range(height):
                w = 1.0 if math.floor(bottom) < r < math.floor(top) else 0.0
                w = top - math.floor(top) if r == math.floor(top) else w
                w = 1 - (bottom - math.floor(bottom)) if r == math.floor(bottom) else w
                if r in (math.floor(bottom), math.floor(top)) or w:
                    want[f, t, r, c] = w
    pixels = spark.createDataFrame([(f, r, c) for f in range(2) for r in range(height) for c in range(width)], "f int, r int, c int")
    table = spark.createDataFrame(traces, "f int, t int, k array<double>, below double, above double, x1 int, x2 int")
    for tile in (8, 256):
        out = frames.cut_out(pixels, table, "r", "c", "k", "below", "above", height, ["f"], tile)
        got = {(x.f, x.t, x.r, x.c): x.weight for x in out.collect()}
        assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)
    assert "NestedLoop" not in out._jdf.queryExecution().toString() and "Cartesian" not in out._jdf.queryExecution().toString()


def test_nearest_filled_against_a_loop(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for f, share in enumerate((0.3, 0.9, 0.98, 1.0, 0.0)):
        v = {(r, c): math.nan if rng.random() < share else round(rng.random(), 3) for r in range(20) for c in range(17)}
        good = sorted(p for p in v if v[p] == v[p])
        for (r, c), x in v.items():
            rows.append((f, r, c, None if x != x and rng.random() < 0.5 else x))
            nearest = min(good, key=lambda p: ((p[0] - r) ** 2 + (p[1] - c) ** 2, p)) if good else None
            want[f, r, c] = x if x == x else v[nearest] if nearest else None
    out = frames.nearest_filled(spark.createDataFrame(rows, "f int, r int, c int, v double"), ["f"], "r", "c", "v").collect()
    assert len(out) == len(rows)
    for x in out:
        w = want[x.f, x.r, x.c]
        assert (x.v is None or x.v != x.v) if w is None else x.v == w


@pytest.mark.parametrize("sigma", [0.8, 3.0, 9.0])
def test_gaussian_against_loops(spark, sigma):
    rng = np.random.default_rng(5)
    image = rng.normal(size=(2, 19, 80))
    w = frames.gaussian_weights(sigma)
    half = len(w) // 2

    def along(v):
        n = len(v)
        turned = [i % (2 * n) for i in range(-half, n + half)]
        line = np.array([v[i] if i < n else v[2 * n - 1 - i] for i in turned])
        return np.array([line[i : i + 2 * half + 1] @ w for i in range(n)])

    want = np.array([np.apply_along_axis(along, 0, np.apply_along_axis(along, 1, f)) for f in image])
    rows = [(f, r, c, float(image[f, r, c])) for f in range(2) for r in range(19) for c in range(80)]
    out = frames.gaussian_smoothed(spark.createDataFrame(rows, "f int, r int, c int, v double"), ["f"], "r", "c", "v", sigma).collect()
    assert len(out) == len(rows)
    assert max(abs(x.v - want[x.f, x.r, x.c]) for x in out) < 1e-9
