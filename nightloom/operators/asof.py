"""Joins in time: nearest, before, after, between, within validity intervals and outside of windows.

Both sides of an as-of join are put into one sorted sequence per key; what stands before or after a row is then a
window value and no pair of rows is ever made.  A key's sequence is cut into time buckets that are sorted apart,
and the last (first) value of each bucket is carried over the empty ones, so one hot key does not hold one task.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import seconds

DAY = 86400


def _clock(schema: T.StructType, path: str) -> Column:
    """The time of a column or of a struct's field: seconds of a timestamp, numbers as they are."""
    kind = schema
    for part in path.split("."):
        kind = kind[part].dataType
    return F.col(path).cast("double") if isinstance(kind, T.NumericType) else seconds(F.col(path))


def _sides(left: DataFrame, right: DataFrame, by: list[str], at: str, value: str, bucket: int, tie: int, before: str | None, after: str | None) -> DataFrame:
    """left with the struct value of the last right row before each row as the column before, and of the first after it as after.

    right has the columns by, at and value (a struct); left has by and at.  tie says where right rows stand that have
    the time of a left row: -1 before, 1 after it.  Both sides come into one sequence per key, which is cut into buckets of time; a bucket is
    sorted apart, once for each direction, and what it hands on to the others is one row.
    """
    rows = left.withColumn("_left", F.lit(True)).withColumn("_rank", F.lit(0)).withColumn("_value", F.lit(None).cast(right.schema[value].dataType))
    other = right.select(*by, at, F.col(value).alias("_value"), F.lit(False).alias("_left"), F.lit(tie).alias("_rank"))
    rows = rows.unionByName(other, allowMissingColumns=True).withColumn("_bucket", F.floor(_clock(left.schema, at) / bucket))
    key = [*by, "_bucket"]
    known = F.when(~F.col("_left"), F.struct(F.col(at).alias("t"), F.col("_value").alias("v")))
    ends = rows.groupBy(*key).agg(F.max(known).alias("_last"), F.min(known).alias("_first"))
    near, carried, out = {}, {}, {}
    # a frame that grows from one end is kept as it goes, one that shrinks is computed anew for each row; so rows after
    # a row are those before it in the reverse order
    for name, end, turn in ((before, "_last", lambda c: c.asc_nulls_first()), (after, "_first", lambda c: c.desc_nulls_first())):
        if name:
            over = Window.partitionBy(*by).orderBy(turn(F.col("_bucket"))).rowsBetween(Window.unboundedPreceding, -1)
            carried[f"_carried{end}"] = F.last(f"{end}.v", ignorenulls=True).over(over)
            inside = Window.partitionBy(*key).orderBy(turn(F.col(at)), turn(F.col("_rank")), turn(F.col("_value"))).rowsBetween(Window.unboundedPreceding, 0)
            near[f"_near{end}"] = F.last("_value", ignorenulls=True).over(inside)
            out[name] = F.coalesce(f"_near{end}", f"_carried{end}")
    rows = rows.withColumns(near).filter("_left").join(ends.select(*key, *[c.alias(k) for k, c in carried.items()]), key, "left")
    return rows.withColumns(out).drop("_left", "_rank", "_value", "_bucket", *near, *carried)


def asof_before(left: DataFrame, right: DataFrame, by: list[str], at: str, value: str, out: str = "before", strict: bool = True, bucket: int = 30 * DAY) -> DataFrame:
    """The latest right row before each left row; of equal times, the largest value."""
    return _sides(left, right, by, at, value, bucket, 1 if strict else -1, out, None)


def asof_after(left: DataFrame, right: DataFrame, by: list[str], at: str, value: str, out: str = "after", strict: bool = True, bucket: int = 30 * DAY) -> DataFrame:
    """The earliest right row after each left row; of equal times, the smallest value."""
    return _sides(left, right, by, at, value, bucket, -1 if strict else 1, None, out)


def asof_nearest(left: DataFrame, right: DataFrame, by: list[str], at: str, value: str, value_time: str, out: str = "nearest", tolerance: float | None = None, bucket: int = 30 * DAY) -> DataFrame:
    """The right row nearest in time on either side; of two equally near the earlier, null beyond tolerance seconds.

    value_time is the field of the struct that repeats its time.  at may be a number; bucket and tolerance have its unit.
    """
    both = _sides(left, right, by, at, value, bucket, -1, "_b", "_a")  # what has the row's own time counts as before it
    t = _clock(left.schema, at)
    gap_b, gap_a = t - _clock(both.schema, f"_b.{value_time}"), _clock(both.schema, f"_a.{value_time}") - t
    near = F.when(F.col("_a").isNull() | (gap_b <= gap_a), F.col("_b")).otherwise(F.col("_a"))
    if tolerance is not None:
        near = F.when(F.coalesce(F.least(gap_b, gap_a), gap_b, gap_a) <= tolerance, near)
    both = both.withColumn(out, near)
    return both.drop("_a", "_b")


VALIDITY_ROWS = 1_000_000  # rows of a validity list, which is read whole on the driver
NESTED_ROWS = 256  # steps of a validity list up to which rows are held against each of them


def validity_steps(rows: list[tuple], lower: str, upper: str) -> list[tuple]:
    """(from, to, at, after) for each end of intervals (start, stop, order, value): what is valid at that end, and from it until the next.

    Of overlapping intervals the one with the largest order is valid.
    """
    rows = [r for r in rows if r[0] is not None and r[1] is not None]
    ends = sorted({r[0] for r in rows} | {r[1] for r in rows})
    begins, stops = {}, {}
    for i, (start, stop, _, _) in enumerate(rows):
        begins.setdefault(start, []).append(i)
        stops.setdefault(stop, []).append(i)
    heap: list[tuple] = []  # intervals that have begun; those that are over go when they come to the top
    out = []

    def best(over) -> tuple | None:
        while heap and over(rows[heap[0][1]]):
            heapq.heappop(heap)
        return rows[heap[0][1]] if heap else None

    for i, t in enumerate(ends):
        begun = [(Descending(rows[k][2]), k) for k in begins.get(t, ())]
        if lower == ">=":
            for x in begun:
                heapq.heappush(heap, x)
        at = best(lambda r, t=t: r[1] < t or (r[1] == t and upper == "<"))
        if lower == ">":
            for x in begun:
                heapq.heappush(heap, x)
        after = best(lambda r, t=t: r[1] <= t)
        out.append((t, ends[i + 1] if i + 1 < len(ends) else None, None if at is None else at[3], None if after is None else after[3]))
    return out


class Descending:
    """An order that heaps turn around."""

    __slots__ = ("value",)

    def __init__(self, value):
        self.value = value

    def __lt__(self, other: Descending) -> bool:
        return self.value > other.value


def within_interval(df: DataFrame, intervals: DataFrame, at: str, start: str, stop: str, value: str, out: str, default=None, lower: str = ">=", upper: str = "<", order: str = "row") -> DataFrame:
    """The rows of df with the value of the last interval (by order) that holds each row's time.

    intervals is a dimension kept by hand, at most VALIDITY_ROWS rows; the driver makes disjoint steps of it.  A
    row lies in one step at most, so rows are neither multiplied nor gathered: short lists are broadcast and rows
    held against their steps, longer ones are met in time order.
    """
    rows = intervals.select(start, stop, order, value).limit(VALIDITY_ROWS + 1).collect()
    if len(rows) > VALIDITY_ROWS:
        raise ValueError(f"a validity list of more than {VALIDITY_ROWS} rows")
    steps = validity_steps([tuple(r) for r in rows], lower, upper)
    time, kind = intervals.schema[start].dataType, intervals.schema[value].dataType
    schema = T.StructType([T.StructField(c, k) for c, k in (("_from", time), ("_to", time), ("_at", kind), ("_after", kind))])
    table = df.sparkSession.createDataFrame(steps, schema)
    if len(steps) <= NESTED_ROWS:
        found = df.join(F.broadcast(table), (F.col(at) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(at) < F.col("_to"))), "left")
    else:
        step = table.select(F.col("_from").alias(at), F.struct("_from", "_at", "_after").alias("_value"))
        found = asof_before(df, step, [], at, "_value", "_step", False).select(*df.columns, "_step._from", "_step._at", "_step._after")
    held = F.when(F.col(at) == F.col("_from"), F.col("_at")).otherwise(F.col("_after"))
    return found.select(*df.columns, (held if default is None else F.coalesce(held, F.lit(default))).alias(out))


def outside_windows(df: DataFrame, windows: DataFrame, at: str, start: str, stop: str, bucket: int = 30 * DAY) -> DataFrame:
    """Rows whose time lies in none of the windows, ends included; rows without a time lie in none.

    Of the windows that begin at or before a row the one that ends last decides.  Windows are met in time order, in
    buckets: each knows how far the windows of its bucket up to it reach, and a bucket hands on how far all before it do.
    """
    open_ = windows.filter(F.col(start).isNotNull() & F.col(stop).isNotNull()).groupBy(F.col(start).alias(at)).agg(F.max(stop).alias("_stop"))
    part = F.floor(_clock(open_.schema, at) / bucket)
    open_ = open_.withColumn("_part", part)
    so_far = Window.partitionBy("_part").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    reach = open_.groupBy("_part").agg(F.max("_stop").alias("_most"))
    reach = reach.withColumn("_carried", F.max("_most").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))  # a row a bucket
    reached = open_.withColumn("_here", F.max("_stop").over(so_far)).join(reach.select("_part", "_carried"), "_part")
    value = F.struct(F.greatest("_here", "_carried").alias("until"))
    met = asof_before(df, reached.select(at, value.alias("_value")), [], at, "_value", "_window", False, bucket)
    return met.filter(F.col("_window").isNull() | F.col(at).isNull() | (F.col("_window.until") < F.col(at))).drop("_window")
