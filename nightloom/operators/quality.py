"""Quality checks and diagnostics of observations: one wide projection over grouped results.

A check is a named condition for some levels and sources of data.  Its result is true, false, or null where the
check does not apply; what a condition cannot decide (null inputs) fails.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Check:
    keyword: str
    condition: Callable[[], Column]
    levels: list[str] = field(default_factory=lambda: ["all"])
    sources: list[str] = field(default_factory=lambda: ["all"])
    description: str = ""


def applied(df: DataFrame, checks: list[Check], key: list[str], level: str = "level", source: str = "source") -> DataFrame:
    """A column per check."""
    out = []
    for c in checks:
        fits = F.lit(True)
        if c.levels != ["all"]:
            fits = fits & F.col(level).isin(c.levels)
        if c.sources != ["all"]:
            fits = fits & F.col(source).isin(c.sources)
        out.append(F.when(fits, F.coalesce(c.condition(), F.lit(False))).alias(c.keyword))
    return df.select(*key, *out)


def long_form(matrix: DataFrame, key: list[str]) -> DataFrame:
    """keyword and pass per row of a matrix of checks; checks that do not apply are left out."""
    names = [c for c in matrix.columns if c not in key]
    return matrix.unpivot(key, names, "keyword", "pass").filter(F.col("pass").isNotNull())


def summary(matrix: DataFrame, key: list[str]) -> DataFrame:
    """Per check how often it applied and passed, and the whole percent passed."""
    rows = long_form(matrix, key).groupBy("keyword").agg(F.count("*").alias("n"), F.count_if("pass").alias("n_pass"))
    return rows.withColumn("percent", F.floor(100.0 * F.col("n_pass") / F.col("n")).cast("long"))


# conditions shared by many checks


def younger_than(age: Column, days: int) -> Column:
    """The absolute age is known (not -99) and at most so many days."""
    return (age != -99) & (F.abs(age) <= days)


def near(value: Column, set_point: Column, tolerance: float) -> Column:
    return F.abs(value - set_point) <= tolerance


def within(value: Column, least: float | None = None, most: float | None = None) -> Column:
    out = F.lit(True)
    if least is not None:
        out = out & (value >= least)
    return out & (value <= most) if most is not None else out


#: Largest mean flux of a chip in a bias and in a dark frame.
LOW_FLUX = {"Bias": {"green": 10.0, "red": 10.0}, "Dark": {"green": 11.0, "red": 13.0}}
#: Seconds by which dates of a header, and those of the exposure meter, may differ.
DATE_TOLERANCE, METER_TOLERANCE = 0.1, 1.0
#: Pixels by which a wavelength solution may scatter about its reference in any order.
WILD_PIXELS = 5.0
#: Per source and chip the percentile whose flux in the trace must exceed a limit, whether a frame that
#: does not reach it fails, and the percentiles of which one's ratio of flux in and out of the trace must exceed a limit.
FLUX_RULES = {
    ("ThAr", "green"): ("99", 50.0, False, ("99", "98", "95"), 2.0),
    ("ThAr", "red"): ("98", 50.0, False, ("99", "98", "95", "90"), 1.4),
    ("Etalon", "green"): ("99.5", 50.0, True, ("99.5", "99", "98", "95"), 1.5),
    ("Etalon", "red"): ("99.5", 50.0, True, ("99", "98", "95", "90"), 1.5),
    ("LFC", "green"): ("99.5", 50.0, True, ("99.5", "99", "98", "95"), 1.5),
    ("LFC", "red"): ("99.5", 50.0, True, ("99", "98", "95", "90"), 3.0),
    ("Flat", "green"): ("99.5", 100.0, True, ("99.5", "99", "98", "95"), 3.0),
    ("Flat", "red"): ("99.5", 100.0, True, ("99", "98", "95", "90"), 3.0),
    ("Star", "green"): ("99.5", 30.0, False, ("99.5", "99", "98", "95"), 1.5),
    ("Star", "red"): ("99.5", 30.0, False, ("99", "98", "95", "90"), 1.5),
    ("Sun", "green"): ("99.5", 100.0, False, ("99.5", "99", "98", "95"), 3.0),
    ("Sun", "red"): ("99.5", 100.0, False, ("99", "98", "95", "90"), 3.0),
}


def low_flux(kind: str, green: Column, red: Column) -> Column:
    """The mean flux of both chips is low for a frame of this kind."""
    return (green <= LOW_FLUX[kind]["green"]) & (red <= LOW_FLUX[kind]["red"])


def dates_agree(begin: Column, middle: Column, end: Column, elapsed: Column, starts: list[Column] = (), stops: list[Column] = (), meter: tuple[Column, Column] | None = None) -> Column:
    """Times in seconds are in order and span the elapsed time; those of the chips agree with them and with each other, those of the exposure meter with the chips."""
    out = consistent(begin, middle, end, elapsed, DATE_TOLERANCE)
    for main, others, one in ((begin, starts, 0), (end, stops, 1)):
        for i, c in enumerate(others):
            out = out & (F.abs(main - c) <= DATE_TOLERANCE)
            for d in others[:i]:
                out = out & (F.abs(c - d) <= DATE_TOLERANCE)
            if meter is not None:
                out = out & (F.abs(meter[one] - c) <= METER_TOLERANCE)
    return out


def all_there(header: Column, keywords: list[str]) -> Column:
    """Every keyword is a key of the header, whatever it holds."""
    return F.forall(F.array(*[F.lit(k) for k in keywords]), lambda k: F.map_contains_key(header, k))


def not_wild(differences: DataFrame, by: list[str], order: str, pixels: str) -> DataFrame:
    """by and whether the differences to the reference, in pixels, scatter by less than WILD_PIXELS in every order.

    The scatter is taken to nine places, so that one of exactly WILD_PIXELS is none below it in whatever order its
    rows are added.
    """
    orders = differences.groupBy(*by, order).agg(F.round(F.stddev_pop(pixels), 9).alias("_s"))
    return orders.groupBy(*by).agg(F.bool_and(F.col("_s") < WILD_PIXELS).alias("pass"))


def flux_in_traces(source: Column, inside: dict[str, dict[str, Column]], outside: dict[str, dict[str, Column]]) -> Column:
    """FLUX_RULES for percentiles of flux in and out of the traces, by chip and name of the percentile; null for other sources."""
    out = F.lit(None).cast("boolean")
    for name in dict.fromkeys(s for s, _ in FLUX_RULES):
        good = F.lit(True)
        for chip in inside:
            at, least, needed, which, ratio = FLUX_RULES[name, chip]
            enough = inside[chip][at] > least
            apart = F.lit(False)
            for p in which:
                apart = apart | F.coalesce(F.abs(inside[chip][p] / F.nullif(outside[chip][p], F.lit(0.0))) > ratio, F.lit(False))
            good = good & (enough & apart if needed else ~enough | apart)
        out = F.when(source == name, F.coalesce(good, F.lit(False))).otherwise(out)
    return out


def complete(expected: Column, there: Column) -> Column:
    """Nothing expected is missing."""
    return F.size(F.array_except(expected, there)) == 0


def few(flag: Column, share: float) -> Column:
    """At most a share of the rows is flagged, as an aggregate."""
    return F.avg(F.when(flag, 1.0).otherwise(0.0)) <= share


def consistent(begin: Column, middle: Column, end: Column, elapsed: Column, tolerance: float) -> Column:
    """Times are in order and their span is the elapsed time."""
    return (begin <= middle) & (middle <= end) & (F.abs((end - begin) - elapsed) <= tolerance)
