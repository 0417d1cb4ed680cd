"""Master frames: a stack of calibrated frames brought to the shape that science frames are divided by."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sizes import broadcast_small
from .statistics import clipped_stack

#: Flats outside of these are set to 1; a pixel of a stack should have so many samples.
LEAST_FLAT, MOST_FLAT, SAMPLES = 0.1, 2.5, 10
BINS = 100  # of a unit, in which the most frequent value is looked for


def most_frequent(rows: DataFrame, by: list[str], value: str, bins: int = BINS) -> DataFrame:
    """by and mode: the most frequent value, to the nearest 1 / bins, of equally frequent ones the smallest."""
    counted = rows.groupBy(*by, F.rint(F.col(value) * bins).alias("_bin")).agg(F.count("*").alias("_n")).filter("_bin is not null")
    return counted.groupBy(*by).agg((F.min_by("_bin", F.struct(-F.col("_n"), "_bin")) / bins).alias("mode"))


def master_flat(frames: DataFrame, bias: DataFrame, dark: DataFrame, lamp: DataFrame, orderlets: DataFrame, pixel: list[str], low_light: float, n_sigma: float, by: list[str] = ()) -> DataFrame:
    """by, pixel, flat, uncertainty, n and stack from frames (by, frame, pixel, data, exptime).

    The clipped stack of the rates over the smooth lamp is scaled so that its most frequent value is 1 in each
    orderlet, where its light is above low_light.  All other pixels are 1: those outside of orderlets (orderlet 0 or
    none), with less light, without lamp, or with a flat that is no flat's.
    Bias, dark, lamp and orderlets have the keys of a pixel only; pixels without bias are left out.
    """
    keys = [*by, *pixel]
    # counts a second: less the bias, over the exposure time, less the dark rate
    rows = frames.join(bias, pixel).join(dark, pixel, "left")
    rate = (F.col("data") - F.col("bias")) / F.nullif(F.col("exptime"), F.lit(0.0)) - F.coalesce("dark", F.lit(0.0))
    stack = clipped_stack(rows.select(*keys, rate.alias("rate")), keys, "rate", n_sigma)
    lamp_light = F.nullif(F.col("lamp"), F.lit(0.0))
    flat = stack.join(lamp, pixel, "left").join(orderlets, pixel, "left")
    flat = flat.withColumns({"_flat": F.col("mean") / lamp_light, "_unc": F.col("uncertainty") / lamp_light, "_in": F.coalesce("orderlet", F.lit(0)) > 0})
    bright = F.col("_in") & (F.col("mean") > low_light)
    scale = most_frequent(flat.filter(bright), [*by, "orderlet"], "_flat")
    scaled = flat.join(broadcast_small(scale), [*by, "orderlet"], "left").withColumn("_scale", F.when(bright, F.nullif(F.col("mode"), F.lit(0.0))).otherwise(1.0))
    value = F.when(F.col("_in") & (F.col("mean") >= low_light), F.col("_flat") / F.col("_scale"))
    value = F.when(value.between(LEAST_FLAT, MOST_FLAT), value).otherwise(1.0)
    return scaled.select(*keys, value.alias("flat"), (F.col("_unc") / F.col("_scale")).alias("uncertainty"), "n", F.col("mean").alias("stack"))


def few_samples(master: DataFrame, by: list[str] = (), least: int = SAMPLES, percent: float = 1.0) -> DataFrame:
    """Whether more than so many percent of the pixels have fewer samples than they should."""
    share = 100.0 * F.count_if(F.col("n") < least) / F.count("*")
    return master.groupBy(*by).agg(share.alias("percent"), (share > percent).alias("few"))
