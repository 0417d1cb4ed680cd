"""Hard negatives: per anchor, scores sorted in full and read from each positive's upper limit down.

Anchors stand against all rows, in blocks: anchors are dealt into blocks of about ANCHORS rows and rows into groups of
about ROWS, and each task takes one block with one group.  It computes the integer scores, sorts each anchor's by
(score falling, id rising), and hands on what can still matter: the first `positives` rows of the anchor's label, or
for each positive the first k rows of another label from its upper limit, found by binary search, down to its lower
one.  First rows of first rows are first rows, so the results of all groups merge into the exact ones.

A task holds one block, one group and the scores of STRIP anchors.  Each row goes once to every block of anchors, which
is the size of the question: scores are as many as anchors times rows.

Defined results: rows with a null id or label, a null vector, or a null or non-finite component take no part; vectors
shorter than the longest are filled up with zeros; each row counts for itself, so that a row may be the positive of
one that repeats it, and anchors that repeat a row give their results each; of equal scores and ids the order is that of the rows;
scores are compared without overflow and shown as the nearest long; an empty table gives an empty result; extra
columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import vectors
from .workspace import Workspace

ANCHORS, ROWS, STRIP = 4096, 8192, 64
TASKS = 50_000
LONG = np.iinfo(np.int64)
NEAREST = "row long, id long, score long, exact string, other long, other_id long"


def dealt(key: str, into: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(into)).cast("int")


def descending(scores: np.ndarray) -> np.ndarray:
    """Each line's order by falling score; columns lie by (id, row), which decides between equal scores."""
    if scores.dtype == object:
        return np.array([sorted(range(len(line)), key=lambda i: -line[i]) for line in scores]).reshape(scores.shape)
    return np.argsort(-scores, axis=1, kind="stable")  # scores of longs are above -2**63 by products()' bound


def shown(scores: list[int]) -> list[int]:
    return [min(max(int(s), LONG.min), LONG.max) for s in scores]


def _sides(key: tuple, left: pa.Table, right: pa.Table) -> tuple[list, list]:
    """Anchors and rows as (row, id, label, matrix), the rows by (id, row)."""
    width = len(left["anchor_x"][0]) if len(left) else 0
    right = right.sort_by([("id", "ascending"), ("row", "ascending")])
    sides = ((left, "anchor_"), (right, ""))
    return [[*[np.asarray(t[p + c]) for c in ("row", "id", "label")], vectors.matrix(t[p + "x"], width)] for t, p in sides]


def _strips(anchors: list, rows: list, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(places of anchors of one label, places of rows of that label or of all others, scores, order of each line)."""
    for label in np.unique(anchors[2]):
        mine = np.flatnonzero(anchors[2] == label)
        theirs = np.flatnonzero((rows[2] == label) == same)
        for at in range(0, len(mine), STRIP):
            some = mine[at : at + STRIP]
            scores = vectors.products(anchors[3][some], rows[3][theirs])
            yield some, theirs, scores, descending(scores)


def nearest_rows(first: int):
    """For cogroups of anchors and rows: each anchor's first rows of its own label but itself, as NEAREST."""

    def of(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(left) and len(right):
            anchors, rows = _sides(key, left, right)
            for some, theirs, scores, order in _strips(anchors, rows, True):
                for a, line, by in zip(some, scores, order, strict=True):
                    head = by[: first + 1]
                    head = head[rows[0][theirs[head]] != anchors[0][a]][:first]
                    for p, s in zip(theirs[head], line[head], strict=True):
                        out.append((anchors[0][a], anchors[1][a], s, rows[0][p], rows[1][p]))
        row, ids, score, other, other_id = zip(*out, strict=True) if out else [[]] * 5
        longs = [pa.array(np.array(x, np.int64)) for x in (row, ids, shown(score), other, other_id)]
        exact = pa.array([str(int(s)) for s in score], pa.string())
        return pa.table([*longs[:3], exact, *longs[3:]], ["row", "id", "score", "exact", "other", "other_id"])

    return of


NEGATIVES = "row long, nth int, negative_score long, exact string, negative long, negative_id long"


def negatives_below(k: int, percent: tuple[int, int]):
    """For cogroups of anchors with their positives' exact scores and rows: the first k rows of another label
    whose score lies within percent of the positive's, as NEGATIVES."""
    least, most = percent

    def of(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if len(left) and len(right):
            anchors, rows = _sides(key, left, right)
            scores_of = left["exact"].to_pylist()
            for some, theirs, scores, order in _strips(anchors, rows, False):
                for a, line, by in zip(some, scores, order, strict=True):
                    falling = line[by]
                    rising = falling[::-1]
                    for nth, exact in enumerate(scores_of[a]):
                        low, high = -(-least * int(exact) // 100), most * int(exact) // 100
                        if falling.dtype != object:
                            if low > LONG.max or high < LONG.min:
                                continue
                            low, high = max(low, LONG.min), min(high, LONG.max)
                        at = len(rising) - int(np.searchsorted(rising, high, "right"))
                        for p in by[at : at + k]:
                            if line[p] < low:
                                break
                            out.append((anchors[0][a], nth, line[p], rows[0][theirs[p]], rows[1][theirs[p]]))
        row, nth, score, other, other_id = zip(*out, strict=True) if out else [[]] * 5
        longs = [pa.array(np.array(x, np.int64)) for x in (row, shown(score), other, other_id)]
        exact = pa.array([str(int(s)) for s in score], pa.string())
        return pa.table(
            [longs[0], pa.array(np.array(nth, np.int32)), longs[1], exact, *longs[2:]],
            ["row", "nth", "negative_score", "exact", "negative", "negative_id"],
        )

    return of


def falling(exact: str) -> list[Column]:
    """Sort keys for whole numbers of any size that are given as text: highest first."""
    minus = F.col(exact).startswith("-")
    digits = F.length(exact)
    return [minus.asc(), F.when(minus, -digits).otherwise(digits).desc(), F.when(minus, F.col(exact)).asc(), F.col(exact).desc()]


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, k: int = 3, percent: tuple[int, int] = (50, 95)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (vec_id, label, embedding).

    anchor says which rows are anchors.  Its positives are the first rows of its label by score; the negatives of a
    positive are the first k rows of other labels whose score is between percent of the positive's.
    """
    vector, spark = F.col("embedding"), rows.sparkSession
    work = Workspace(spark, "negatives")
    usable = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vectors.usable(vector))
    part = usable.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"),
        anchor.alias("anchor"),
        vectors.whole_numbers(vector).alias("x"),
    )
    part = work.keep(part, "rows")  # numbers of rows hold once they are written
    n, asked, width = part.agg(F.count("*"), F.count_if("anchor"), F.max(F.size("x"))).first()
    blocks, groups = max(1, -(-asked // ANCHORS)), max(1, -(-n // ROWS))
    part = part.withColumn("x", vectors.padded(F.col("x"), width or 0))
    # under names of their own: cogroup() mixes up sides that share columns of one table
    anchors = part.filter("anchor").select(dealt("row", blocks).alias("block"), *[F.col(c).alias(f"anchor_{c}") for c in ("row", "id", "label", "x")])
    everything = part.drop("anchor").withColumn("group", dealt("row", groups))
    everything = everything.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    each_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")

    tasks = min(blocks * groups, TASKS)  # set, since the work of a pair does not show in its bytes

    def facing(left: DataFrame, of, schema: str) -> DataFrame:
        pairs = [df.repartition(tasks, "block", "group").groupBy("block", "group") for df in (left.select("*", each_group), everything)]
        return pairs[0].cogroup(pairs[1]).applyInArrow(of, schema)

    near = facing(anchors, nearest_rows(positives), NEAREST)
    first = Window.partitionBy("row").orderBy(*falling("exact"), "other_id", "other")
    near = near.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= positives).withColumn("nth", F.col("nth") - 1)
    near = work.keep(near, "positives")
    lists = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("nth", "exact"))).alias("p"))  # of at most `positives`
    lists = lists.select(F.col("row").alias("anchor_row"), F.transform("p", lambda x: x["exact"]).alias("exact"))
    below = facing(anchors.join(lists, "anchor_row"), negatives_below(k, percent), NEGATIVES)
    order = Window.partitionBy("row", "nth").orderBy(*falling("exact"), "negative_id", "negative")
    below = below.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("exact")
    named = near.select("row", "nth", F.col("id").alias("anchor_id"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = below.join(named, ["row", "nth"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
