"""Least squares and extraction against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightloom.operators import extraction, fits


def test_legendre_fits_against_lstsq(spark):
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for g in range(5):
        n = [3, 12, 40, 400, 7][g]
        x, w = rng.uniform(-1, 1, n), rng.uniform(0.1, 3, n)
        y = np.sin(3 * x) + rng.normal(0, 0.1, n)
        a = np.polynomial.legendre.legvander(x, 6)
        want[g] = np.linalg.lstsq(a * np.sqrt(w)[:, None], y * np.sqrt(w), rcond=None)[0]
        rows += [(g, *map(float, t)) for t in zip(x, y, w, strict=True)]
    fit = fits.least_squares(spark.createDataFrame(rows, "g int, x double, y double, w double"), ["g"], fits.legendre(F.col("x"), 6), "y", "w")
    for r in fit.collect():
        if r.g:
            assert np.allclose(r.coefficients, want[r.g], atol=1e-6), r.g
        else:  # three rows: any curve through them
            assert all(np.polynomial.legendre.legval(x, r.coefficients) == pytest.approx(y, abs=1e-6) for g, x, y, _ in rows if g == 0)
    few = fits.least_squares(spark.createDataFrame(rows, "g int, x double, y double, w double"), ["g"], fits.powers(F.col("x"), 6), "y", least=7)
    assert {r.g: r.coefficients is None for r in few.collect()} == {0: True, 1: False, 2: False, 3: False, 4: False}


@pytest.mark.parametrize("ridge", [0.0, 2.5, "auto"])
def test_surface(spark, ridge):
    rng = np.random.default_rng(2)
    z = rng.normal(size=(20, 30)) + np.linspace(0, 5, 30)
    rows = [(r, c, float(z[r, c])) for r in range(20) for c in range(30) if (r + c) % 5]
    a = np.array([[np.polynomial.legendre.legval(2 * c / 29 - 1, [0] * i + [1]) * np.polynomial.legendre.legval(2 * r / 19 - 1, [0] * j + [1]) for i in range(4) for j in range(4 - i)] for r, c, _ in rows])
    v = np.array([x for *_, x in rows])
    want = np.linalg.lstsq(a, v, rcond=None)[0]
    lam = v.var() / want.var() if ridge == "auto" else ridge
    if lam:
        want = np.linalg.solve(a.T @ a + lam * np.eye(a.shape[1]), a.T @ v)
    basis = fits.legendre_surface(fits.on_unit(F.col("c"), 30), fits.on_unit(F.col("r"), 20), 3)
    fit = fits.least_squares(spark.createDataFrame(rows, "r int, c int, v double"), [], basis, "v", ridge=ridge).first()
    assert fit.n == len(rows) and np.allclose(fit.coefficients, want, atol=1e-8)


def test_outlier_rounds(spark):
    rng = np.random.default_rng(3)
    rows, want, left = [], {}, {}
    for g in range(3):
        x = rng.uniform(-1, 1, 60)
        y = 1 + 2 * x - x * x + rng.normal(0, 0.01, 60) + (rng.random(60) < 0.1) * rng.normal(0, 3, 60)
        rows += [(g, float(a), float(b)) for a, b in zip(x, y, strict=True)]
        for _ in range(5):
            k = np.polynomial.legendre.legfit(x, y, 2)
            off = y - np.polynomial.legendre.legval(x, k)
            good = np.abs(off) <= 2.1 * off.std()
            x, y = x[good], y[good]
        want[g], left[g] = k, len(x)
    fit, kept = fits.clipped_least_squares(spark.createDataFrame(rows, "g int, x double, y double"), ["g"], fits.legendre(F.col("x"), 2), "y", None, 5, 2.1)
    assert all(np.allclose(r.coefficients, want[r.g]) for r in fit.collect())
    assert {r.g: r["count"] for r in kept.groupBy("g").count().collect()} == left


def spline_space(x, inner):
    return np.hstack([np.vander(x, 4), np.maximum(x[:, None] - inner, 0) ** 3])


def test_cubic_splines_span_the_splines_of_their_knots(spark):
    rng = np.random.default_rng(4)
    x = np.sort(rng.uniform(2, 38, 200))
    y = np.sin(x / 4) + rng.normal(0, 0.1, 200)
    knots = 8
    inner = np.linspace(x.min() + 1, x.max() - 1, knots)[1:-1]
    a = spline_space(x / 40, inner / 40)
    want = a @ np.linalg.lstsq(a, y, rcond=None)[0]
    rows = spark.createDataFrame([(float(p), float(q)) for p, q in zip(x, y, strict=True)], "x double, y double")
    at = fits.cubic_knots(F.lit(x.min()), F.lit(x.max()), F.array(*[F.lit(float(k)) for k in inner]))
    rows, basis = rows.withColumn("b", fits.cubic_splines(F.col("x"), at)), fits.entries("b", knots + 2)
    assert {r.n for r in rows.select(F.size("b").alias("n")).collect()} == {knots + 2}
    fit = fits.least_squares(rows, [], basis, "y")
    got = np.array([r.v for r in fits.joined(rows, fit, []).select("x", fits.evaluated(basis).alias("v")).orderBy("x").collect()])
    assert np.abs(got - want).max() < 1e-6


# extraction


def made(rng, columns, height=9):
    """Pixels of one order with cosmic rays: arrays by (row, column)."""
    y = np.arange(height)[:, None]
    profile = np.exp(-0.5 * ((y - height / 2 - 0.3 * np.sin(np.arange(columns) / 9)) / 1.6) ** 2)
    w = np.ones((height, columns))
    w[0], w[-1] = 0.4, 0.0
    profile /= (profile * w).sum(axis=0)
    flux = 4000 + 1500 * np.sin(np.arange(columns) / 7)
    s = np.full((height, columns), 5.0)
    d = rng.poisson(flux * profile + s) + rng.normal(0, 3, (height, columns))
    d += (rng.random(d.shape) < 0.04) * rng.uniform(300, 5000, d.shape)
    v = np.abs(d) + 9.0
    m = (rng.random(d.shape) > 0.03).astype(int)
    return d, s, v, w, m, profile


def plain_column(d, s, v, w, m, p, clip):
    """The method of one column, in rounds until one masks nothing."""
    m = np.where(w > 0, m, 0)
    f, v0, rounds = np.nansum(m * (d - s) * w), v - np.abs(d), 0
    while True:
        rounds += 1
        var = v0 + np.abs(f * p + s)
        r = (d - f * p - s) ** 2 / var
        k = int(np.nanargmax(r * m))
        hit = r[k] * m[k] > clip * clip
        if hit:
            m[k] = 0
        norm = np.nansum(m * p * p * w / var)
        f, out = (np.nansum(m * p * (d - s) * w / var) / norm, np.nansum(m * p * w) / norm) if norm else (None, None)
        if not hit or norm == 0:
            return f, out, rounds, int(((m == 0) & (w > 0)).sum())


SCHEMA = "o int, row int, col int, data double, sky double, variance double, weight double, mask int, profile double"


def test_optimal_extraction_runs_to_its_end(spark):
    rng = np.random.default_rng(5)
    orders = [made(rng, 40) for _ in range(2)]
    rows = [(o, r, c, *[float(a[r, c]) for a in x[:4]], int(x[4][r, c]), float(x[5][r, c])) for o, x in enumerate(orders) for r in range(9) for c in range(40)]
    out = {(r.o, r.col): r for r in extraction.optimally_extracted(spark.createDataFrame(rows, SCHEMA), ["o", "col"], 5.0).collect()}
    assert len(out) == 80
    seen = set()
    for o, x in enumerate(orders):
        for c in range(40):
            f, v, rounds, masked = plain_column(*[a[:, c].copy() for a in x], 5.0)
            r = out[o, c]
            seen.add(rounds)
            assert (r.rounds, r.n_masked) == (rounds, masked)
            assert r.flux == pytest.approx(f, rel=1e-9) and r.variance == pytest.approx(v, rel=1e-9)
    assert len(seen) >= 3  # columns end apart


def test_columns_without_anything_to_extract(spark):
    rows = [(0, r, 0, 5.0, 0.0, 1.0, 0.0, 1, 0.2) for r in range(3)] + [(0, r, 1, 5.0, 0.0, 1.0, 1.0, 0, 0.2) for r in range(3)] + [(0, r, 2, None, 0.0, None, 1.0, 1, 0.2) for r in range(3)]
    out = {r.col: (r.flux, r.variance) for r in extraction.optimally_extracted(spark.createDataFrame(rows, SCHEMA), ["o", "col"], 5.0).collect()}
    assert out == {0: (None, None), 1: (None, None), 2: (None, None)}


def plain_profile(d, s, w, f, width, knots, n_sigma):
    """The profile by rows, with splines in powers."""
    height, columns = d.shape
    x, half = np.arange(columns), width // 2
    p = (d - s) / f
    out = np.zeros_like(p)
    for i in range(height):
        running = np.array([np.median(p[i, max(0, c - half) : c + half + 1]) for c in x])
        off = p[i] - running
        spread = 1.482602218505602 * np.median(np.abs(off - np.median(off)))
        ok = np.abs(off) <= n_sigma * spread
        a, b = x[ok].min(), x[ok].max()
        inner = np.linspace(a + 1, b - 1, knots)[1:-1]
        basis = spline_space(x[ok] / columns, inner / columns)
        k = np.linalg.lstsq(basis, p[i][ok], rcond=None)[0]
        out[i] = spline_space(np.clip(x, a, b) / columns, inner / columns) @ k
    out = np.maximum(out, 0) * (w > 0)
    return out / (out * w).sum(axis=0)


def test_extraction_with_an_estimated_profile(spark, tmp_path):
    rng = np.random.default_rng(6)
    orders = [made(rng, 60) for _ in range(2)]
    orders[1] = (orders[1][5] * 3000 + orders[1][1], *orders[1][1:])  # without noise: one round
    rows = [(o, r, c, *[float(a[r, c]) for a in x[:4]], int(x[4][r, c]), 0.0) for o, x in enumerate(orders) for r in range(9) for c in range(60)]
    count = iter(range(1000))

    def keep(df):
        to = str(tmp_path / str(next(count)))
        df.write.parquet(to)
        return spark.read.parquet(to)

    out = extraction.extracted_with_profile(spark.createDataFrame(rows, SCHEMA).drop("profile"), ["o"], 5.0, keep, width=11, knots=5, n_sigma=5.0, most=4)
    got = {(r.o, r.col): r for r in out.collect()}
    assert len(got) == 120
    for o, (d, s, v, w, m, _) in enumerate(orders):
        m = np.where(w > 0, m, 0)
        f, v0 = (m * (d - s) * w).sum(axis=0), v - np.abs(d)
        for rounds in range(1, 5):
            p = plain_profile(d, s, w, f, 11, 5, 5.0)
            var = v0 + np.abs(f * p + s)
            r = (d - f * p - s) ** 2 / var
            hit = False
            for c in range(60):
                k = int(np.argmax(r[:, c] * m[:, c]))
                if r[k, c] * m[k, c] > 25:
                    m[k, c], hit = 0, True
            norm = (m * p * p * w / var).sum(axis=0)
            f, out_v = (m * p * (d - s) * w / var).sum(axis=0) / norm, (m * p * w).sum(axis=0) / norm
            if not hit:
                break
        for c in range(60):
            assert got[o, c].rounds == rounds
            assert got[o, c].flux == pytest.approx(f[c], rel=1e-5) and got[o, c].variance == pytest.approx(out_v[c], rel=1e-5)
    assert got[1, 0].rounds < got[0, 0].rounds
