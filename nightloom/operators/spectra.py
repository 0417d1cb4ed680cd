"""Image and spectrum operators in long form: one row per pixel, extraction and correlation as joins and sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .statistics import finite
from .sizes import broadcast_small

#: Lines shifted to velocities, of some 50 bytes, up to which they are broadcast.
SHIFTED_ROWS = 500_000


def less_row_median(pixels: DataFrame, by: list[str], value: str, overscan: Column) -> DataFrame:
    """Pixels outside the overscan less the median of their row's overscan pixels."""
    level = pixels.filter(overscan).groupBy(*by).agg(F.median(value).alias("_o"))
    return pixels.filter(~overscan).join(level, by, "left").withColumn(value, F.col(value) - F.col("_o")).drop("_o")


def less_clipped_mean(pixels: DataFrame, by: list[str], value: str, overscan: Column, n_sigma: float) -> DataFrame:
    """Pixels outside the overscan less the mean of their amplifier's overscan, of the values within n sigma of its median; sigma is half of p84 - p16."""
    strip = pixels.filter(overscan).select(*by, finite(F.col(value)).alias("_v"))
    p = strip.groupBy(*by).agg(F.percentile("_v", F.array(F.lit(0.16), F.lit(0.5), F.lit(0.84))).alias("_p"))
    near = F.abs(F.col("_v") - F.col("_p")[1]) <= F.lit(n_sigma) * (F.col("_p")[2] - F.col("_p")[0]) / 2
    level = strip.join(p, by).filter(near).groupBy(*by).agg(F.avg("_v").alias("_o"))
    return pixels.filter(~overscan).join(level, by, "left").withColumn(value, F.col(value) - F.col("_o")).drop("_o")


#: How a channel of each orientation key is read out: whether its rows, and its columns, are turned around.
ORIENTATIONS = {1: (False, True), 2: (True, True), 3: (True, False), 4: (False, False)}


def turned(pixels: DataFrame, row: str, col: str, key: str, rows: int, cols: int) -> DataFrame:
    """Pixels of channels of rows x cols with the places that their orientation key says; the same step turns them back."""
    upside = F.col(key).isin([k for k, (r, _) in ORIENTATIONS.items() if r])
    mirrored = F.col(key).isin([k for k, (_, c) in ORIENTATIONS.items() if c])
    return pixels.withColumns({row: F.when(upside, rows - 1 - F.col(row)).otherwise(F.col(row)), col: F.when(mirrored, cols - 1 - F.col(col)).otherwise(F.col(col))})


def assembled(pixels: DataFrame, row: str, col: str, channel_row: str, channel_col: str, rows: int, cols: int) -> DataFrame:
    """Pixels of channels as pixels of the full frame; channels are numbered from 1 down and to the right."""
    return pixels.withColumns({row: F.col(row) + (F.col(channel_row) - 1) * rows, col: F.col(col) + (F.col(channel_col) - 1) * cols})


def ccf_skew(ccf: DataFrame, by: list[str], value: str) -> DataFrame:
    """Skewness of a correlation function's values, third moment over the second's power of 3/2; a scaled function has the same."""
    return ccf.groupBy(*by).agg(F.skewness(value).alias("skew"))


def less_line_fit(pixels: DataFrame, row: str, value: str, overscan: Column) -> DataFrame:
    """Pixels outside the overscan less the straight line through the overscan means of the rows."""
    means = pixels.filter(overscan).groupBy(row).agg(F.avg(value).alias("_m"))
    line = means.agg(F.regr_slope("_m", F.col(row).cast("double")).alias("_s"), F.regr_intercept("_m", F.col(row).cast("double")).alias("_i"))  # one row
    return pixels.filter(~overscan).crossJoin(F.broadcast(line)).withColumn(value, F.col(value) - F.col("_s") * F.col(row) - F.col("_i")).drop("_s", "_i")


def calibrated(raw: DataFrame, on: list[str], bias: DataFrame, dark: DataFrame, flat: DataFrame, exposure: Column, skip_bias: Column) -> DataFrame:
    """(raw - bias - dark * exposure) / flat per pixel; a zero flat gives null, bias frames keep their bias."""
    df = raw.join(bias, on, "left").join(dark, on, "left").join(flat, on, "left")
    x = F.when(skip_bias, F.col("data")).otherwise(F.col("data") - F.coalesce("bias", F.lit(0.0)))
    x = (x - F.coalesce("dark", F.lit(0.0)) * exposure) / F.nullif(F.coalesce("flat", F.lit(1.0)), F.lit(0.0))
    return df.select(*[c for c in raw.columns if c != "data"], x.alias("data"))


def masked_out(pixels: DataFrame, mask: DataFrame, on: list[str], value: str) -> DataFrame:
    """Pixels of mask 0 become NaN."""
    out = pixels.join(mask, on, "left")
    return out.withColumn(value, F.when(F.coalesce("mask", F.lit(1)) == 0, F.lit(float("nan"))).otherwise(F.col(value))).drop("mask")


def box_extracted(pixels: DataFrame, by: list[str]) -> DataFrame:
    """Sums of mask * (data - sky) * weight and of mask * variance * weight."""
    w = F.col("mask") * F.col("weight")
    return pixels.groupBy(*by).agg(F.sum(w * (F.col("data") - F.col("sky"))).alias("flux"), F.sum(w * F.col("variance")).alias("variance"))


def profile_extracted(pixels: DataFrame, by: list[str]) -> DataFrame:
    """Optimal sums for a known profile: sum(M P D / V) / sum(M P^2 / V), and its variance."""
    v = F.nullif(F.col("variance"), F.lit(0.0))
    norm = F.nullif(F.sum(F.col("mask") * F.pow("profile", 2) / v), F.lit(0.0))
    return pixels.groupBy(*by).agg((F.sum(F.col("mask") * F.col("profile") * (F.col("data") - F.col("sky")) / v) / norm).alias("flux"), (F.sum(F.col("mask") * F.col("profile")) / norm).alias("variance"))


def worst_rejected(pixels: DataFrame, by: list[str], clip: float) -> DataFrame:
    """One round of rejection: of each column the pixel furthest from flux * profile is masked if beyond clip sigma.

    A column is as many pixels as the trace is wide.  Its flux and its worst residual are window values over the very
    rows that they are compared with: a second reading of the pixels could add up their sums in another order.
    """
    column = Window.partitionBy(*by)
    v = F.nullif(F.col("variance"), F.lit(0.0))
    norm = F.nullif(F.sum(F.col("mask") * F.pow("profile", 2) / v).over(column), F.lit(0.0))
    flux = F.sum(F.col("mask") * F.col("profile") * (F.col("data") - F.col("sky")) / v).over(column) / norm
    rows = pixels.withColumn("_f", flux)
    r = F.pow(F.col("data") - F.col("sky") - F.col("_f") * F.col("profile"), 2) / v
    rows = rows.withColumn("_r", F.when(F.col("mask") > 0, r)).withColumn("_w", F.max("_r").over(column))
    return rows.withColumn("mask", F.when((F.col("_r") == F.col("_w")) & (F.col("_w") > clip * clip), 0.0).otherwise(F.col("mask"))).select(*pixels.columns)


def optimally_extracted(pixels: DataFrame, by: list[str], clip: float, rounds: int) -> DataFrame:
    """Optimal extraction after a number of rounds of rejecting the worst pixel of each column."""
    for _ in range(rounds):
        pixels = worst_rejected(pixels, by, clip)
    return profile_extracted(pixels, by)


def tiled_background(pixels: DataFrame, row: str, col: str, value: str, height: int, width: int, n_sigma: float) -> DataFrame:
    """Per tile the median of the values within n sigma of the tile's median."""
    rows = pixels.withColumn("tile_row", F.floor(F.col(row) / height)).withColumn("tile_col", F.floor(F.col(col) / width)).withColumn("_x", finite(F.col(value)))
    first = rows.groupBy("tile_row", "tile_col").agg(F.median("_x").alias("_m"), F.stddev_pop("_x").alias("_s"))
    near = rows.join(first, ["tile_row", "tile_col"]).filter(F.abs(F.col("_x") - F.col("_m")) <= F.lit(n_sigma) * F.col("_s"))
    return near.groupBy("tile_row", "tile_col").agg(F.median("_x").alias("background"), F.count("*").alias("n"))


def correlated(pixels: DataFrame, lines: DataFrame, velocities: DataFrame, by: list[str], light: float) -> DataFrame:
    """Cross-correlation with a line mask: per velocity the sum of flux * weight * overlap of line and pixel.

    The product of lines and velocities, parameters of the method, is spread over wavelength cells that the pixels
    share, so that the join is an equi-join; it is broadcast only where their counts say that it is small.  Where two lines cover a pixel
    the later one counts.
    """
    cell = 16.0
    small = lines.limit(SHIFTED_ROWS).count() * velocities.limit(SHIFTED_ROWS).count() <= SHIFTED_ROWS
    shifted = lines.crossJoin(broadcast_small(velocities)).withColumns({"_lo": F.col("start") * (1 + F.col("velocity") / light), "_hi": F.col("stop") * (1 + F.col("velocity") / light)})
    shifted = shifted.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_lo") / cell), F.floor(F.col("_hi") / cell))))
    cells = pixels.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("lo") / cell), F.floor(F.col("hi") / cell))))
    met = cells.join(F.broadcast(shifted) if small else shifted, "_cell").filter((F.col("_lo") < F.col("hi")) & (F.col("_hi") > F.col("lo")))
    overlap = (F.least("_hi", "hi") - F.greatest("_lo", "lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))
    one = met.groupBy(*by, "velocity", "pixel", "flux").agg(F.max_by(F.col("weight") * overlap, "line").alias("_w"))
    return one.groupBy(*by, "velocity").agg(F.sum(F.col("flux") * F.col("_w")).alias("ccf"))


def velocity_error(ccf: DataFrame, by: list[str], step: float, pixel: float) -> DataFrame:
    """Photon error of a velocity from the slope of its correlation function; 0 if that is nowhere positive."""
    w = Window.partitionBy(*by).orderBy("velocity")
    slope = F.coalesce((F.lead("ccf").over(w) - F.lag("ccf").over(w)) / (2 * step), (F.lead("ccf").over(w) - F.col("ccf")) / step, (F.col("ccf") - F.lag("ccf").over(w)) / step)
    s = ccf.withColumn("_d", slope).groupBy(*by).agg(F.sum(F.pow("_d", 2) / F.nullif(F.col("ccf"), F.lit(0.0))).alias("_q"), F.sum("ccf").alias("_t"), F.min("ccf").alias("_l"))
    q = F.sqrt(F.col("_q")) / F.sqrt(F.col("_t")) * F.sqrt(F.lit(step / pixel))
    bad = (F.col("_l") < 0) | (F.col("_t") <= 0) | (F.col("_q") <= 0)
    return s.select(*by, F.when(bad, 0.0).otherwise(F.lit(1.0) / (q * F.sqrt("_t"))).alias("error"))


def reweighted(ccf: DataFrame, ratios: DataFrame, by: list[str], on: str) -> DataFrame:
    """Each order scaled to its ratio of the largest, by the order's own largest value; orders without ratio go."""
    top = ccf.groupBy(*by, on).agg(F.max("ccf").alias("_top"))
    whole = top.groupBy(*by).agg(F.max("_top").alias("_all"))
    scale = F.col("_all") * F.col("ratio") / F.nullif(F.col("_top"), F.lit(0.0))
    return ccf.join(top, [*by, on]).join(whole, by).join(broadcast_small(ratios), on).withColumn("ccf", F.col("ccf") * scale).drop("_top", "_all", "ratio")


def centre_of(ccf: DataFrame, by: list[str], depth: float) -> DataFrame:
    """Velocity of the deepest point, and the weighted centre of what lies below a share of the depth."""
    ends = ccf.groupBy(*by).agg(F.min_by("velocity", "ccf").alias("deepest"), F.min("ccf").alias("_lo"), F.max("ccf").alias("_hi"))
    w = F.greatest(F.col("_hi") - F.lit(1 - depth) * (F.col("_hi") - F.col("_lo")) - F.col("ccf"), F.lit(0.0))
    return ccf.join(ends, by).groupBy(*by, "deepest").agg((F.sum(w * F.col("velocity")) / F.nullif(F.sum(w), F.lit(0.0))).alias("centre"))


def lag_correlation(a: DataFrame, b: DataFrame, by: list[str], at: str, value: str, most: int) -> DataFrame:
    """Sum of products at each lag of at most so many places."""
    lags = F.explode(F.sequence(F.lit(-most), F.lit(most)))
    left = a.select(*by, F.col(value).alias("_a"), lags.alias("lag"), F.col(at).alias("_i")).withColumn(at, F.col("_i") + F.col("lag"))
    return left.join(b.select(*by, at, F.col(value).alias("_b")), [*by, at]).groupBy(*by, "lag").agg(F.sum(F.col("_a") * F.col("_b")).alias("correlation"))


def wavelength_shift(new: DataFrame, reference: DataFrame, by: list[str], at: str) -> DataFrame:
    """Median and standard deviation, in pixels, of the difference of two wavelength solutions."""
    both = new.select(*by, at, F.col("wave").alias("_n")).join(reference.select(*by, at, F.col("wave").alias("_r")), [*by, at])
    w = Window.partitionBy(*by).orderBy(at)
    step = F.coalesce(F.lead("_r").over(w) - F.col("_r"), F.col("_r") - F.lag("_r").over(w))
    shift = (F.col("_n") - F.col("_r")) / F.nullif(step, F.lit(0.0))
    return both.withColumn("_d", shift).groupBy(*by).agg(F.median("_d").alias("median"), F.stddev_pop("_d").alias("std"), F.count("_d").alias("n"))


def between_solutions(a: DataFrame, b: DataFrame, on: list[str], fraction: float) -> DataFrame:
    """A wavelength solution between two, linear in time; the fraction is not clamped."""
    return a.select(*on, F.col("wave").alias("_a")).join(b.select(*on, F.col("wave").alias("_b")), on).select(*on, (F.col("_a") + fraction * (F.col("_b") - F.col("_a"))).alias("wave"))


def interpolated(samples: DataFrame, grid: DataFrame, by: list[str], at: str, value: str) -> DataFrame:
    """Values on a new grid, linear between the neighbouring samples and null outside; one sorted pass per group."""
    rows = samples.select(*by, at, F.col(value).cast("double").alias("_v"), F.lit(False).alias("_g")).unionByName(grid.select(*by, at, F.lit(None).cast("double").alias("_v"), F.lit(True).alias("_g")))
    known = F.when(~F.col("_g"), F.struct(F.col(at).alias("x"), F.col("_v").alias("y")))
    w = Window.partitionBy(*by).orderBy(at, "_g")
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*by).orderBy(F.col(at).desc(), F.col("_g").asc()).rowsBetween(Window.unboundedPreceding, 0)  # a frame that only grows
    rows = rows.withColumn("_b", F.last(known, ignorenulls=True).over(back)).withColumn("_a", F.last(known, ignorenulls=True).over(ahead)).filter("_g")
    run = F.nullif(F.col("_a.x") - F.col("_b.x"), F.lit(0.0))
    return rows.select(*by, at, F.when(F.col("_a.x") == F.col("_b.x"), F.col("_b.y")).otherwise(F.col("_b.y") + (F.col(at) - F.col("_b.x")) / run * (F.col("_a.y") - F.col("_b.y"))).alias(value))


def sliding_clipped_mean(pixels: DataFrame, by: list[str], at: str, value: str, half: int, n_sigma: float) -> DataFrame:
    """Mean of the values within half places that lie within n sigma of their median, sigma from p16 and p84.

    Both the percentiles and the values are taken over one window frame of each row of places, which is sorted once.
    """
    frame = Window.partitionBy(*by).orderBy(at).rangeBetween(-half, half)
    x = finite(F.col(value))
    p = pixels.select(*by, at, F.percentile(x, F.array(F.lit(0.16), F.lit(0.5), F.lit(0.84))).over(frame).alias("_p"), F.collect_list(x).over(frame).alias("_all"))  # 2 * half + 1 values
    middle, spread = F.get("_p", F.lit(1)), (F.get("_p", F.lit(2)) - F.get("_p", F.lit(0))) / 2
    kept = F.filter("_all", lambda v: F.abs(v - middle) <= F.lit(n_sigma) * spread)
    return p.select(*by, at, (F.aggregate(kept, F.lit(0.0), lambda total, v: total + v) / F.nullif(F.size(kept), F.lit(0))).alias(value))


def repaired(pixels: DataFrame, by: list[str], at: str, value: str) -> DataFrame:
    """NaN and null values replaced on the line between their nearest good neighbours; at the ends by the nearest one."""
    good = F.when(finite(F.col(value)).isNotNull(), F.struct(F.col(at).alias("x"), F.col(value).alias("y")))
    back, ahead = (Window.partitionBy(*by).orderBy(c).rowsBetween(Window.unboundedPreceding, 0) for c in (F.col(at).asc(), F.col(at).desc()))
    rows = pixels.withColumns({"_b": F.last(good, ignorenulls=True).over(back), "_a": F.last(good, ignorenulls=True).over(ahead)})
    line = F.col("_b.y") + (F.col(at) - F.col("_b.x")) / F.nullif(F.col("_a.x") - F.col("_b.x"), F.lit(0)) * (F.col("_a.y") - F.col("_b.y"))
    out = F.when(F.col("_b").isNull(), F.col("_a.y")).when(F.col("_a").isNull() | (F.col("_a.x") == F.col("_b.x")), F.col("_b.y")).otherwise(line)
    return rows.withColumn(value, out).drop("_b", "_a")


def dilated(pixels: DataFrame, by: list[str], at: str, flag: str, reach: int) -> DataFrame:
    """A flag spread to so many neighbours on either side."""
    w = Window.partitionBy(*by).orderBy(at).rangeBetween(-reach, reach)
    return pixels.withColumn(flag, F.bool_or(flag).over(w))


def good_pixels(pixels: DataFrame, by: list[str], value: str, n_sigma: float) -> DataFrame:
    """Whether each pixel is finite and within n robust sigmas (1.4826 median absolute deviations) of its group."""
    x = pixels.withColumn("_x", finite(F.col(value)))
    m = x.groupBy(*by).agg(F.median("_x").alias("_m"))
    x = x.join(m, by)
    s = x.groupBy(*by).agg(F.median(F.abs(F.col("_x") - F.col("_m"))).alias("_s"))
    good = F.coalesce(F.abs(F.col("_x") - F.col("_m")) < F.lit(n_sigma * 1.4826) * F.col("_s"), F.lit(False))
    return x.join(s, by).withColumn("good", good).drop("_x", "_m", "_s")


def peak_of(correlation: DataFrame, by: list[str]) -> DataFrame:
    """Lag of the highest correlation, to a fraction of a place by the parabola through it and its neighbours."""
    w = Window.partitionBy(*by).orderBy("lag")
    rows = correlation.withColumns({"_b": F.lag("correlation").over(w), "_a": F.lead("correlation").over(w)})
    top = rows.groupBy(*by).agg(F.max_by(F.struct("lag", "_b", "_a", "correlation"), F.struct("correlation", -F.col("lag"))).alias("t"))
    bend = F.col("t._b") - 2 * F.col("t.correlation") + F.col("t._a")
    return top.select(*by, (F.col("t.lag") + F.coalesce((F.col("t._b") - F.col("t._a")) / (2 * F.nullif(bend, F.lit(0.0))), F.lit(0.0))).alias("shift"))


def bisector_span(ccf: DataFrame, by: list[str], upper: tuple[float, float], lower: tuple[float, float]) -> DataFrame:
    """Difference of the mean velocities of the points between two ranges of depth, the shallow less the deep one."""
    ends = ccf.groupBy(*by).agg(F.min("ccf").alias("_lo"), F.max("ccf").alias("_hi"))
    depth = (F.col("_hi") - F.col("ccf")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))
    rows = ccf.join(ends, by).withColumn("_d", depth)
    mean = lambda r: F.avg(F.when(F.col("_d").between(*r), F.col("velocity")))
    return rows.groupBy(*by).agg((mean(upper) - mean(lower)).alias("span"))


def velocity_precision(residuals: DataFrame, by: list[str], wave: str, residual: str, light: float) -> DataFrame:
    """Scatter of wavelength residuals as a velocity, over the root of their number."""
    v = F.col(residual) / F.col(wave) * F.lit(light)
    return residuals.groupBy(*by).agg((F.stddev_pop(v) / F.sqrt(F.count(residual))).alias("precision"), F.count(residual).alias("n"))


def pixel_drift(a: DataFrame, b: DataFrame, by: list[str], light: float) -> DataFrame:
    """Median velocity of the drift in pixels between two solutions with the same wavelengths (by, wave, pixel)."""
    w = Window.partitionBy(*by).orderBy("wave")
    one = a.withColumn("_slope", (F.col("wave") - F.lag("wave").over(w)) / F.nullif(F.col("pixel") - F.lag("pixel").over(w), F.lit(0.0)))
    both = one.join(b.select(*by, "wave", F.col("pixel").alias("_p")), [*by, "wave"])
    alpha = (F.col("_p") - F.col("pixel")) * F.col("_slope") / F.col("wave")
    v = (alpha * alpha + 2 * alpha) / (alpha * alpha + 2 * alpha + 2) * F.lit(light)
    return both.groupBy(*by).agg(F.median(v).alias("drift"))
