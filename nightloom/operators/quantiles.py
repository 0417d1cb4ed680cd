"""Exact percentiles of large groups: a sketch brackets the ranks, and only what lies in the brackets is ranked.

Spark's percentile() and median() carry every distinct value of a group in the map of one task.  Here a task holds a
sketch for each group, of a size that ACCURACY sets, and the rows ranked in full are some four ACCURACY-ths of a group for each
fraction.  Groups of few rows, such as the pixels of a stack, are better off with percentile().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sizes import broadcast_small

ACCURACY = 10_000


def exact_percentiles(df: DataFrame, by: list[str], value: str, fractions: list[float], accuracy: int = ACCURACY) -> DataFrame:
    """by, percentiles (an array, one for each fraction, linear between neighbours) and n for each group with values.

    Null and NaN values are left out; groups without any other have no row.  A sketch gives for each fraction values
    that lie some ranks below and above it.  Rows below are counted, those between are counted by value and
    ranked.  The counts say whether a bracket holds its ranks; a group where one does not (no sketch should do that) is taken with percentile().
    """
    keys = [f"_k{i}" for i in range(max(len(by), 1))]
    named = [F.col(c).alias(k) for c, k in zip(by, keys, strict=True)] if by else [F.lit(0).alias(keys[0])]
    x = df.select(*named, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    margin = 3.0 / accuracy
    ends = [min(max(f + s * margin, 0.0), 1.0) for f in fractions for s in (-1, 1)]
    sketch = x.groupBy(*keys).agg(F.percentile_approx("_x", ends, accuracy).alias("_e"), F.count("*").alias("_n"), F.min("_x").alias("_min"), F.max("_x").alias("_max"))
    cut = []
    for i, f in enumerate(fractions):
        low = F.col("_min") if f <= margin else F.get("_e", F.lit(2 * i))
        high = F.col("_max") if f >= 1 - margin else F.get("_e", F.lit(2 * i + 1))
        cut.append(F.struct(F.lit(i).alias("q"), F.lit(float(f)).alias("f"), low.alias("low"), high.alias("high")))
    brackets = sketch.select(*[F.col(k).alias("b" + k) for k in keys], "_n", F.array(*cut).alias("_q"))
    rows = x.join(broadcast_small(brackets), [F.equal_null(F.col(k), F.col("b" + k)) for k in keys])

    # rows below each bracket, and those inside by value: one row for each value of a bracket and one for what is below
    def place(q: Column) -> Column:
        inside = F.col("_x").between(q["low"], q["high"])
        return F.struct(q["q"].alias("q"), q["f"].alias("f"), F.when(inside, F.col("_x")).alias("x"))

    placed = F.explode(F.transform(F.filter("_q", lambda q: F.col("_x") <= q["high"]), place)).alias("p")
    counted = rows.select(*keys, "_n", placed).groupBy(*keys, "_n", "p").agg(F.count("*").alias("_c"))
    upto = Window.partitionBy(*keys, "p.q").orderBy(F.col("p.x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_upto", F.sum("_c").over(upto))
    target = F.col("p.f") * (F.col("_n") - 1)
    at = [F.when(F.col("_upto") > r, F.struct(F.col("_upto").alias("upto"), F.col("p.x").alias("x"))) for r in (F.floor(target), F.ceil(target))]
    found = ranked.groupBy(*keys, "_n", F.col("p.q").alias("_i"), target.alias("_t")).agg(F.min(at[0])["x"].alias("_a"), F.min(at[1])["x"].alias("_b"))
    between = F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_t") - F.floor("_t"))
    exact = F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(between)
    lists = found.groupBy(*keys, F.col("_n").alias("n")).agg(F.sort_array(F.collect_list(F.struct("_i", exact.alias("v")))).alias("_l"))  # one for each fraction
    lists = lists.select(*keys, "n", F.transform("_l", lambda p: p["v"]).alias("percentiles"))
    whole = (F.size("percentiles") == len(fractions)) & ~F.exists("percentiles", lambda v: v.isNull())
    missed = lists.filter(~whole).select(*[F.col(k).alias("m" + k) for k in keys])
    again = x.join(broadcast_small(missed), [F.equal_null(F.col(k), F.col("m" + k)) for k in keys], "left_semi")
    again = again.groupBy(*keys).agg(F.count("*").alias("n"), F.percentile("_x", F.array(*[F.lit(float(f)) for f in fractions])).alias("percentiles"))
    out = lists.filter(whole).unionByName(again)
    return out.select(*[F.col(k).alias(c) for c, k in zip(by, keys, strict=False)], "percentiles", "n")


def exact_medians(df: DataFrame, by: list[str], value: str, out: str = "median") -> DataFrame:
    return exact_percentiles(df, by, value, [0.5]).select(*by, F.get("percentiles", F.lit(0)).alias(out))
