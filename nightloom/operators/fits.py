"""Linear least squares on any basis, per group: sums of products by Spark, one small system a group.

A basis is a list of columns.  The normal equations of a group are the sums of the products of its basis columns, a
partial aggregation however many rows a group has; they are solved in batches of groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# bases


def powers(x: Column, degree: int) -> list[Column]:
    out = [F.lit(1.0)]
    for _ in range(degree):
        out.append(out[-1] * x)
    return out


def legendre(x: Column, degree: int) -> list[Column]:
    """Legendre polynomials 0 .. degree of x in -1 .. 1."""
    out = [F.lit(1.0), x][: degree + 1]
    for k in range(2, degree + 1):
        out.append((F.lit((2 * k - 1) / k) * x * out[-1]) - F.lit((k - 1) / k) * out[-2])
    return out


def legendre_surface(x: Column, y: Column, degree: int) -> list[Column]:
    """Products of Legendre polynomials in x and y of at most the degree together."""
    px, py = legendre(x, degree), legendre(y, degree)
    return [px[i] * py[j] for i in range(degree + 1) for j in range(degree + 1 - i)]


def on_unit(at: Column, size: int) -> Column:
    """Places 0 .. size - 1 as -1 .. 1."""
    return F.lit(2.0) * at / F.lit(max(size - 1, 1)) - F.lit(1.0)


def cubic_knots(low: Column, high: Column, inner: Column) -> Column:
    """The array of knots for cubic_splines(): the inner ones, an array in rising order, between four times each end."""
    return F.concat(F.array_repeat(low, 4), inner, F.array_repeat(high, 4))


def splines_at(v: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The cubic B-splines' values at each of v on its own row of knots t, between whose ends it lies.

    Degree by degree, each spline from two of the degree before; knots that fall together count as 0.
    """
    v = v[:, None]
    last = t.shape[1] - 5  # the last interval that is not empty; it holds its right end
    splines = ((v >= t[:, :-1]) & (v < t[:, 1:])).astype(float)
    splines[:, last] = (v[:, 0] >= t[:, last]) & (v[:, 0] <= t[:, last + 1]) & (t[:, last] < t[:, last + 1])
    for degree in (1, 2, 3):
        n = splines.shape[1] - 1
        run = t[:, degree : degree + n + 1] - t[:, : n + 1]
        share = np.divide(v - t[:, : n + 1], run, out=np.zeros_like(run), where=run > 0)
        left = np.where(run > 0, 1 - share, 0.0)
        splines = share[:, :n] * splines[:, :n] + left[:, 1:] * splines[:, 1:]
    return splines


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def cubic_splines(x: pd.Series, at: pd.Series) -> pd.Series:
    """The array of splines_at() x for the knots in the array `at`; null without knots.  All arrays of knots have one length."""
    out = pd.Series([None] * len(x), index=x.index, dtype=object)
    held = at.notna() & x.notna()
    if held.any():
        out[held] = pd.Series(list(splines_at(x[held].to_numpy(float), np.stack(at[held].to_numpy()))), index=x.index[held])
    return out


def entries(array: str, n: int) -> list[Column]:
    """An array column of n values as a basis."""
    return [F.get(array, F.lit(i)) for i in range(n)]


# fits


def systems(rows: DataFrame, by: list[str], basis: list[Column], value: str, weight: str | None) -> DataFrame:
    """by, _g (the upper triangle of the Gram matrix), _b (products with the value), _n, _y, _yy."""
    k, w = len(basis), F.col(weight) if weight else F.lit(1.0)
    named = rows.select(*by, F.col(value).cast("double").alias("_v"), w.cast("double").alias("_w"), *[c.alias(f"_{i}") for i, c in enumerate(basis)])
    w, v = F.col("_w"), F.col("_v")
    gram = [F.sum(w * F.col(f"_{i}") * F.col(f"_{j}")) for i in range(k) for j in range(i, k)]
    right = [F.sum(w * F.col(f"_{i}") * v) for i in range(k)]
    return named.groupBy(*by).agg(F.array(*gram).alias("_g"), F.array(*right).alias("_b"), F.count("*").alias("_n"), F.avg("_v").alias("_y"), F.var_pop("_v").alias("_yy"))


def solution(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The coefficients of each system, scaled to ones on the diagonal, which bounds what rounding does to the smallest ones."""
    size = np.sqrt(np.maximum(np.einsum("gii->gi", gram), np.finfo(float).tiny))
    flat = np.linalg.pinv(gram / size[:, :, None] / size[:, None, :], rcond=1e-13, hermitian=True)
    return np.einsum("gij,gj->gi", flat, right / size) / size


def solved(found: DataFrame, by: list[str], k: int, ridge: float | str, least: int) -> DataFrame:
    """by, coefficients (null for groups of fewer than least rows) and n, from systems()."""
    types = ", ".join(f"{c} {t}" for c, t in found.select(*by).dtypes)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = np.triu_indices(k)
        for b in batches:
            n = b["_n"].to_numpy()
            gram = np.zeros((len(n), k, k))
            gram[:, upper[0], upper[1]] = np.array(b["_g"].flatten()).reshape(-1, len(upper[0]))
            gram[:, upper[1], upper[0]] = gram[:, upper[0], upper[1]]
            right = np.array(b["_b"].flatten()).reshape(-1, k)
            ok = (n >= least) & np.isfinite(gram).all(axis=(1, 2)) & np.isfinite(right).all(axis=1)
            gram[~ok], right[~ok] = np.eye(k), 0.0
            c = solution(gram, right)
            if ridge:
                spread = c.var(axis=1)
                lam = b["_yy"].to_numpy() / np.where(spread > 0, spread, np.inf) if ridge == "auto" else np.full(len(n), float(ridge))
                c = np.linalg.solve(gram + lam[:, None, None] * np.eye(k), right[..., None])[..., 0]
            lists = pa.FixedSizeListArray.from_arrays(pa.array(c.ravel()), k).cast(pa.list_(pa.float64()))
            lists = pa.compute.if_else(pa.array(ok), lists, pa.scalar(None, lists.type))
            yield pa.record_batch([*[b[c] for c in by], lists, b["_n"]], [*by, "coefficients", "n"])

    return found.mapInArrow(solve, f"{types + ', ' if types else ''}coefficients array<double>, n long")


def evaluated(basis: list[Column], coefficients: str = "coefficients") -> Column:
    out = F.get(coefficients, F.lit(0)) * basis[0]
    for i, c in enumerate(basis[1:], 1):
        out = out + F.get(coefficients, F.lit(i)) * c
    return out


def least_squares(rows: DataFrame, by: list[str], basis: list[Column], value: str, weight: str | None = None, ridge: float | str = 0.0, least: int = 1) -> DataFrame:
    """by, coefficients and n: per group the combination of the basis that is nearest to the value.

    Squares count by their weight.  Where the basis is dependent one of the nearest combinations is taken.  ridge adds so much
    times the coefficients' squares; "auto" is the variance of the values over that of the plain coefficients.
    Without keys there is one group; null values, weights or basis values must be left out before.
    """
    if not isinstance(ridge, str) and ridge < 0:
        raise ValueError("ridge must not be negative")
    keys = by or ["_all"]
    rows = rows if by else rows.withColumn("_all", F.lit(1))
    out = solved(systems(rows, keys, basis, value, weight), keys, len(basis), ridge, least)
    return out if by else out.drop("_all")


def joined(rows: DataFrame, fit: DataFrame, by: list[str]) -> DataFrame:
    return rows.join(fit, by) if by else rows.crossJoin(F.broadcast(fit))  # without keys the fit is one row


def clipped_least_squares(rows: DataFrame, by: list[str], basis: list[Column], value: str, weight: str | None, rounds: int, n_sigma: float, least: int = 1) -> tuple[DataFrame, DataFrame]:
    """The fit after so many rounds, each on what lies within n_sigma standard deviations of the fit before it.

    The deviations are those of the residuals of the rows that a round was fitted on.  Also the rows that are left
    after the last round's own clip, with their residual.
    """
    names = rows.columns
    fit = None
    for _ in range(rounds):
        fit = least_squares(rows.select(*names), by, basis, value, weight, least=least)
        off = joined(rows.select(*names), fit.select(*by, "coefficients"), by).withColumn("residual", F.col(value) - evaluated(basis)).drop("coefficients")
        spread = off.groupBy(*by).agg(F.stddev_pop("residual").alias("_s"))
        rows = joined(off, spread, by).filter(F.abs("residual") <= F.lit(n_sigma) * F.col("_s")).select(*names, "residual")
    return fit, rows
