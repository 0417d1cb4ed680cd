"""Combs of lines: peaks of an order with the number of the comb's mode that each one is.

Peaks of an order are a few hundred rows; everything is window values and groups of an order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HALF = 8  # neighbours on either side
OFF_COMB = 0.15  # of a spacing, from which a peak is none of the comb's


def middle(values: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lower median of the values of each row that are held, and whether there is any."""
    n = held.sum(axis=1)
    values = np.sort(np.where(held, values, np.nan), axis=1)  # what is not held comes last
    return values[np.arange(len(values)), np.maximum(n - 1, 0) // 2], n > 0


def with_spacing(peaks: DataFrame, by: list[str], at: str, half: int) -> DataFrame:
    """Peaks with the usual step between neighbours around them, and how far they are off the comb of these, in steps.

    A peak that is missing or false changes few of the steps of a neighbourhood, so that their median stays the
    comb's.  A peak of the comb is a whole number of steps from most of its neighbours.
    """

    def spaced(table: pa.Table) -> pa.Table:
        table = table.sort_by(at)
        x = np.asarray(table[at])
        place = np.arange(len(x))[:, None] + np.arange(-half, half + 1)
        held = (place >= 0) & (place < len(x))
        place = np.clip(place, 0, len(x) - 1)
        step = np.diff(x, prepend=np.nan)
        usual, known = middle(step[place], held & (place > 0))
        near = x[place]
        with np.errstate(all="ignore"):
            steps = (x[:, None] - near) / usual[:, None]
            off = np.abs(steps - np.rint(steps))
        same = (near == x[:, None]) | (np.isnan(near) & np.isnan(x[:, None]))
        off, some = middle(off, held & ~same & (known & (usual != 0))[:, None])
        for name, value, ok in (("_usual", usual, known), ("off_comb", off, some)):
            table = table.append_column(name, pa.array(value, pa.float64(), mask=~ok))
        return table

    types = ", ".join(f"`{k}` {t}" for k, t in peaks.dtypes)
    return peaks.groupBy(*by).applyInArrow(spaced, f"{types}, _usual double, off_comb double")


def mode_numbers(peaks: DataFrame, by: list[str], at: str, rough: str, half: int = HALF, off_comb: float = OFF_COMB) -> DataFrame:
    """by, at, mode and off_comb of the peaks that belong to the comb.

    rough is what a coarse wavelength solution says about a peak's mode, a number with a fraction that may be wrong by
    less than half for most peaks; it may rise or fall along the order.  Numbers are counted from peak to peak,
    several at once where peaks are missing; the count is anchored where most peaks' rough numbers have it, so
    that neither end of the order counts more than the other.  Of peaks with one number the one nearest to the comb stays, of equally
    near ones the first.  Peaks without position are left out; an order with one peak only has no spacing and
    keeps none.
    """
    held = peaks.filter(F.col(at).isNotNull() & F.col(rough).isNotNull()).select(*by, F.col(at).cast("double").alias(at), F.col(rough).cast("double").alias(rough))
    true = with_spacing(held, by, at, half).filter(F.col("off_comb") <= off_comb).drop("_usual", "off_comb")
    w = Window.partitionBy(*by).orderBy(at)
    rows = with_spacing(true, by, at, half)
    step = F.round((F.col(at) - F.lag(at).over(w)) / F.nullif(F.col("_usual"), F.lit(0.0)))
    rows = rows.withColumn("_n", F.coalesce(step, F.lit(0.0)))
    rows = rows.withColumn("_n", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    order = Window.partitionBy(*by)
    rising = F.coalesce(F.covar_pop(rough, "_n").over(order) >= 0, F.lit(True))
    rows = rows.withColumn("_n", F.when(rising, F.col("_n")).otherwise(-F.col("_n")))
    # how many peaks say so, for each place of the first mode; the smallest of the most frequent ones
    rows = rows.withColumn("_says", F.round(F.col(rough) - F.col("_n")))
    rows = rows.withColumn("_votes", F.count("*").over(Window.partitionBy(*by, "_says")))
    first = F.min_by("_says", F.struct(-F.col("_votes"), "_says")).over(order)
    numbered = rows.withColumn("mode", (F.col("_n") + first).cast("long"))
    best = F.min_by(F.struct(F.col(at).alias("at"), F.col("off_comb").alias("off")), F.struct("off_comb", at)).alias("p")
    return numbered.filter("off_comb is not null").groupBy(*by, "mode").agg(best).select(*by, F.col("p.at").alias(at), "mode", F.col("p.off").alias("off_comb"))
