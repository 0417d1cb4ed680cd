"""Operators on ordered sequences: running frames, runs, gradients, filters, bins."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Savitzky-Golay smoothing of order 3 over 21 points has the weights 3 * (3 m^2 + 3 m - 1 - 5 i^2) / norm for |i| <= m.
SAVGOL_HALF = 10


def ordered(by: list[str], order: list[str]) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(*order)


def running_median(value: str, w: WindowSpec, half: int) -> Column:
    """Median of half values before, the value itself and half - 1 after; short at the ends."""
    return F.percentile(value, F.lit(0.5)).over(w.rowsBetween(-half, half - 1))


def running_std(value: str, w: WindowSpec, half: int) -> Column:
    return F.stddev_pop(value).over(w.rowsBetween(-half, half - 1))


def monotonic(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """Whether each group's sequence never falls."""
    step = F.col(value) - F.lag(value).over(ordered(by, order))
    return df.withColumn("_step", step).groupBy(*by).agg(F.bool_and(F.coalesce(F.col("_step") >= 0, F.lit(True))).alias("monotonic"))


def islands(df: DataFrame, by: list[str], order: list[str], flag: Column) -> DataFrame:
    """Runs of consecutive flagged rows: number of the first and last row (from 1) and length."""
    w = ordered(by, order)
    rows = df.withColumn("_n", F.row_number().over(w)).filter(flag)
    rows = rows.withColumn("_island", F.col("_n") - F.row_number().over(w))
    return rows.groupBy(*by, "_island").agg(F.min("_n").alias("first_row"), F.max("_n").alias("last_row"), F.count("*").alias("length")).drop("_island")


def has_run(df: DataFrame, by: list[str], order: list[str], flag: Column, length: int) -> DataFrame:
    """Whether each group has a run of at least so many flagged rows."""
    runs = islands(df, by, order, flag).groupBy(*by).agg(F.max("length").alias("longest"))
    return df.select(*by).distinct().join(runs, by, "left").select(*by, (F.coalesce("longest", F.lit(0)) >= length).alias("has_run"))


def last_run(df: DataFrame, by: list[str], order: list[str], flag: Column) -> DataFrame:
    """The last run of flagged rows of each group."""
    runs = islands(df, by, order, flag)
    return runs.groupBy(*by).agg(F.max_by(F.struct("first_row", "last_row", "length"), "first_row").alias("r")).select(*by, "r.*")


def gradient(value: str, w: WindowSpec) -> Column:
    """Half the difference of the neighbours; one-sided at the ends."""
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    return F.when(before.isNull(), after - F.col(value)).when(after.isNull(), F.col(value) - before).otherwise((after - before) / 2)


def savgol(value: str, w: WindowSpec, half: int = SAVGOL_HALF) -> Column:
    """Cubic Savitzky-Golay smoothing; null where the window is not full."""
    norm = (2 * half + 3) * (2 * half + 1) * (2 * half - 1)
    terms = None
    for i in range(-half, half + 1):
        weight = 3 * (3 * half * half + 3 * half - 1 - 5 * i * i) / norm
        x = F.col(value) if i == 0 else F.lag(value, -i).over(w) if i < 0 else F.lead(value, i).over(w)
        terms = x * F.lit(weight) if terms is None else terms + x * F.lit(weight)
    return terms


def cumulative(value: str, w: WindowSpec) -> Column:
    return F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))


def cumulative_with_gaps(df: DataFrame, by: list[str], begin: str, end: str, value: str) -> DataFrame:
    """Counts summed up to the end of each exposure; a gap between exposures adds its length at their mean rate."""
    w = ordered(by, [begin])
    length = F.col(end) - F.col(begin)
    rate = F.col(value) / F.nullif(length, F.lit(0.0))
    rows = df.withColumn("_rate", rate).withColumn("_gap", F.col(begin) - F.lag(end).over(w))
    rows = rows.withColumn("_filled", F.coalesce(F.col("_gap") * (F.lag("_rate").over(w) + F.col("_rate")) / 2, F.lit(0.0)))
    return rows.withColumn("total", F.sum(F.col(value) + F.col("_filled")).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_rate", "_gap", "_filled")


def local_maxima(df: DataFrame, by: list[str], order: list[str], value: str, least: float) -> DataFrame:
    """Rows above both neighbours and at least so high."""
    w = ordered(by, order)
    x = F.col(value)
    rows = df.withColumn("_b", F.lag(value).over(w)).withColumn("_a", F.lead(value).over(w))
    return rows.filter((x > F.col("_b")) & (x > F.col("_a")) & (x >= least)).drop("_b", "_a")


def neighbour_outliers(value: str, w: WindowSpec, half: int, factor: float) -> Column:
    """Whether a value is beyond factor times the largest of its neighbours on either side."""
    before, after = F.max(value).over(w.rowsBetween(-half, -1)), F.max(value).over(w.rowsBetween(1, half))
    return F.col(value) > F.lit(factor) * F.greatest(before, after)


def greedy_bins(df: DataFrame, by: list[str], at: str, value: str, error: str, width: float) -> DataFrame:
    """Inverse-variance means over bins that begin at the first row not in a bin yet and are width wide, half-open.

    Where a bin begins depends on all bins before it, which no frame expresses.  But after a gap of a width a new bin
    begins whatever came before; so a group is first cut into islands, runs of stretches of one width that hold rows,
    and the bin starts of each island are found one from the other in its sorted times.  The means are a plain grouping.
    """
    stretch = F.floor(F.col(at).cast("double") / F.lit(width))
    held = df.filter(F.col(error) > 0).withColumn("_stretch", stretch)
    over = Window.partitionBy(*by).orderBy("_stretch")
    runs = held.select(*by, "_stretch").distinct().withColumn("_island", F.col("_stretch") - F.row_number().over(over))  # a row for each stretch
    t = held.join(runs, [*by, "_stretch"]).drop("_stretch")
    inside = [*by, "_island"]
    times = t.select(*inside, F.col(at).cast("double").alias("bin_start")).filter("bin_start is not null")
    types = ", ".join(f"{k} {kind}" for k, kind in times.dtypes)

    def begins(table: pa.Table) -> pa.Table:
        table = table.sort_by("bin_start")
        times, places, i = np.asarray(table["bin_start"]), [], 0
        while i < len(times):
            places.append(i)
            i = int(np.searchsorted(times, times[i] + width))
        return table.take(pa.array(places, pa.int64()))

    bins = times.groupBy(*inside).applyInArrow(begins, types)
    bins = bins.withColumn("bin", (F.row_number().over(Window.partitionBy(*by).orderBy("bin_start")) - 1).cast("int"))  # a row for each bin
    nearest = t.withColumn("_t", F.col(at).cast("double")).unionByName(bins.select(*inside, F.col("bin_start").alias("_t"), "bin", "bin_start"), allowMissingColumns=True)
    w = Window.partitionBy(*inside).orderBy(F.col("_t"), F.col("bin").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    placed = nearest.withColumn("_bin", F.last("bin", ignorenulls=True).over(w)).filter(F.col("bin").isNull())
    weight = F.lit(1.0) / F.pow(F.col(error), 2)
    total = F.sum(weight)
    return placed.groupBy(*by, F.col("_bin").alias("bin")).agg((F.sum(weight * F.col("_t")) / total).alias("time"), (F.sum(weight * F.col(value)) / total).alias("mean"), (F.lit(1.0) / F.sqrt(total)).alias("error"), F.count("*").alias("n"))


def sliding_quadratic(df: DataFrame, at_seconds: str, value: str, width: int, slide: int, least: int) -> DataFrame:
    """Per sliding window the quality of a quadratic fit, the sum of squared residuals over the mean of the model.

    The normal equations need only sums of powers, so each window is one partial aggregation; the fit is solved by
    Cramer's rule in time centred on the window.
    """
    starts = F.sequence(F.floor((F.col(at_seconds) - width) / slide) * slide + slide, F.floor(F.col(at_seconds) / slide) * slide, F.lit(slide).cast("long"))
    rows = df.select(F.col(at_seconds).alias("_s"), F.col(value).cast("double").alias("_y"), F.explode(starts).alias("window_start"))
    x = (F.col("_s") - F.col("window_start") - F.lit(width / 2)) / F.lit(width / 2)
    y = F.col("_y")
    s = rows.groupBy("window_start").agg(
        F.count("*").cast("double").alias("n"), F.sum(x).alias("x1"), F.sum(x * x).alias("x2"), F.sum(x * x * x).alias("x3"), F.sum(x * x * x * x).alias("x4"), F.sum(y).alias("y0"), F.sum(x * y).alias("y1"), F.sum(x * x * y).alias("y2"), F.sum(y * y).alias("yy")
    ).filter(F.col("n") >= least)
    c = {k: F.col(k) for k in ("n", "x1", "x2", "x3", "x4", "y0", "y1", "y2", "yy")}

    def det(a, b, d, e, f, g, h, i, j):
        return a * (f * j - g * i) - b * (e * j - g * h) + d * (e * i - f * h)

    d0 = F.nullif(det(c["n"], c["x1"], c["x2"], c["x1"], c["x2"], c["x3"], c["x2"], c["x3"], c["x4"]), F.lit(0.0))
    s = s.withColumn("_d", d0)
    p0 = det(c["y0"], c["x1"], c["x2"], c["y1"], c["x2"], c["x3"], c["y2"], c["x3"], c["x4"]) / F.col("_d")
    p1 = det(c["n"], c["y0"], c["x2"], c["x1"], c["y1"], c["x3"], c["x2"], c["y2"], c["x4"]) / F.col("_d")
    p2 = det(c["n"], c["x1"], c["y0"], c["x1"], c["x2"], c["y1"], c["x2"], c["x3"], c["y2"]) / F.col("_d")
    s = s.withColumns({"p0": p0, "p1": p1, "p2": p2})
    residual = c["yy"] - F.col("p0") * c["y0"] - F.col("p1") * c["y1"] - F.col("p2") * c["y2"]
    return s.select("window_start", c["n"].cast("long").alias("n"), (residual / F.nullif(c["y0"] / c["n"], F.lit(0.0))).alias("quality"))


def photon_midpoint(df: DataFrame, by: list[str], begin: str, end: str, value: str) -> DataFrame:
    """Time at which half of a group's photons have come, linear within the exposure that holds it."""
    rows = cumulative_with_gaps(df, by, begin, end, value).withColumn("_half", F.max("total").over(Window.partitionBy(*by)) / 2)
    inside = rows.filter((F.col("total") >= F.col("_half")) & (F.col("total") - F.col(value) <= F.col("_half")))
    part = (F.col("_half") - (F.col("total") - F.col(value))) / F.nullif(F.col(value), F.lit(0.0))
    return inside.groupBy(*by).agg(F.min(F.col(begin) + part * (F.col(end) - F.col(begin))).alias("midpoint"))


def spacing_outliers(df: DataFrame, by: list[str], order: list[str], value: str, half: int, share: float) -> DataFrame:
    """Rows whose step to the next differs by more than a share from the median step of the neighbourhood."""
    w = ordered(by, order)
    rows = df.withColumn("_step", F.lead(value).over(w) - F.col(value))
    rows = rows.withColumn("_usual", F.percentile("_step", F.lit(0.5)).over(w.rowsBetween(-half, half)))
    return rows.filter(F.abs(F.col("_step") - F.col("_usual")) > F.lit(share) * F.abs("_usual")).drop("_usual").withColumnRenamed("_step", "step")


def without_close_neighbours(df: DataFrame, by: list[str], value: str, window: float, rank: Column) -> DataFrame:
    """Of two neighbours closer than a window only the one of lower rank (then lower value) stays."""
    w = Window.partitionBy(*by).orderBy(value, rank)
    rows = df.withColumn("_r", rank)
    prior, later = F.struct(F.lag("_r").over(w).alias("r"), F.lag(value).over(w).alias("v")), F.struct(F.lead("_r").over(w).alias("r"), F.lead(value).over(w).alias("v"))
    rows = rows.withColumns({"_p": prior, "_l": later})
    beaten_by_prior = (F.col(value) - F.col("_p.v") < window) & (F.col("_p.r") <= F.col("_r"))
    beaten_by_later = (F.col("_l.v") - F.col(value) < window) & (F.col("_l.r") < F.col("_r"))
    return rows.filter(~F.coalesce(beaten_by_prior, F.lit(False)) & ~F.coalesce(beaten_by_later, F.lit(False))).drop("_p", "_l", "_r")


def tracked(df: DataFrame, by: list[str], step: str, value: str, start: Column, tolerance: float) -> DataFrame:
    """A position followed from step to step: to the nearest value of each step (the smaller of two equally near) if that is within the tolerance.

    What a step does depends on all steps before it; the steps of one group are folded on the JVM.  start is the
    first position of a group, an aggregate.
    """
    steps = df.groupBy(*by, step).agg(F.sort_array(F.collect_list(value)).alias("_v"))
    groups = steps.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(F.col(step).alias("step"), F.col("_v").alias("v")))).alias("_all")).join(df.groupBy(*by).agg(start.alias("_start")), by)
    empty = F.array().cast(f"array<struct<step: {dict(df.dtypes)[step]}, position: double, met: boolean>>")

    def advance(acc, s):
        near = F.array_min(F.transform(s["v"], lambda x: F.struct(F.abs(x - acc["position"]).alias("d"), x.cast("double").alias("x"))))
        met = near["d"] <= tolerance
        position = F.when(met, near["x"]).otherwise(acc["position"])
        return F.struct(position.alias("position"), F.concat(acc["track"], F.array(F.struct(s["step"].alias("step"), position.alias("position"), met.alias("met")))).alias("track"))

    folded = F.aggregate("_all", F.struct(F.col("_start").cast("double").alias("position"), empty.alias("track")), advance, lambda acc: acc["track"])
    return groups.select(*by, F.explode(folded).alias("t")).select(*by, "t.step", "t.position", "t.met")


MAD_SIGMA = 1.482602218505602  # standard deviation of a normal sample over its median absolute deviation
REACH = 3  # neighbours on either side among which a value must be the largest or smallest


def outlier_limit(n: int) -> float:
    """Standard deviations that one in n normal values exceeds, times 3."""
    return -3 * NormalDist().inv_cdf(1 / (2 * n))


def deviations(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each value is off from its neighbours, the smallest of three (two at the ends) by size, and what it would be without.

    Inside these are the mean of both neighbours and each of them, at the ends the mean of the next two and the next
    one; the first of equally small ones counts.  Inside, the mean takes a value's place.
    """
    mean = np.empty(len(v))
    mean[1:-1], mean[0], mean[-1] = (v[:-2] + v[2:]) / 2, (v[1] + v[2]) / 2, (v[-2] + v[-3]) / 2
    before, after = np.r_[v[1], v[:-1]], np.r_[v[1:], v[-2]]
    off = v - np.stack([mean, before, after])
    smallest = off[np.abs(off).argmin(axis=0), np.arange(len(v))]
    mean[[0, -1]] = (v - smallest)[[0, -1]]
    return smallest, mean


def without_outliers(v: np.ndarray) -> np.ndarray:
    """The sequence with its worst value replaced, again and again, at most for a quarter of the values.

    It ends where no deviation is beyond the limit, in robust standard deviations of the deviations, or where the
    worst one is part of a plateau: neither the largest nor the smallest of its neighbourhood.
    """
    v = v.copy()
    for _ in range(len(v) // 4):
        off, instead = deviations(v)
        worst = int(np.abs(off).argmax())
        sigma = MAD_SIGMA * np.median(np.abs(off - np.median(off)))
        near = v[max(0, worst - REACH) : worst + REACH + 1]
        if abs(off[worst]) <= outlier_limit(len(v)) * sigma or v[worst] not in (near.min(), near.max()):
            break
        v[worst] = instead[worst]
    return v


def neighbours_replaced(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """by, order, the value and `settled`, the value with outliers replaced by what their neighbours say.

    Which value is replaced depends on all replacements before it, so that a group, the readings of one exposure, is
    settled in one task, and the groups in parallel.  Null and NaN readings stay what they are and are no neighbours.
    """
    rows = df.select(*by, *order, F.col(value).cast("double").alias(value))
    types = ", ".join(f"{k} {t}" for k, t in rows.dtypes)

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order, kind="stable")
        held = frame[value].notna()
        frame["settled"] = frame[value]
        frame.loc[held, "settled"] = without_outliers(frame.loc[held, value].to_numpy(float))
        return frame

    return rows.groupBy(*by).applyInPandas(settle, f"{types}, settled double")
