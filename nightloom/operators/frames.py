"""Frames as long tables, one row per pixel: clusters of lit pixels, cut-outs along traces, filling and smoothing.

Work on neighbouring pixels is done tile by tile, row by row or column by column: groups that the detector bounds, so
that a frame of any size is many tasks.  Null and NaN pixels count as absent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .statistics import finite

TILE = 256
BAND = 64  # rows or columns that one task works on at a time

# clusters


def merged(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For places 0 .. n-1 joined by the edges (a, b) the smallest place that each is joined with."""
    low = np.arange(n)
    while len(a):
        before = low.copy()
        np.minimum.at(low, a, low[b])
        np.minimum.at(low, b, low[a])
        np.minimum.at(low, before[a], low[a])  # so that what a place stood for moves with it
        np.minimum.at(low, before[b], low[b])
        while (low[low] != low).any():
            low = low[low]
        if (low == before).all():
            break
    return low


def runs_joined(row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """For distinct pixels in order of (row, col): the place of the first pixel of each one's cluster.

    Runs of a row that touch a run of the row before, at an edge or a corner, are one cluster.
    """
    begins = np.ones(len(row), bool)
    begins[1:] = (np.diff(row) != 0) | (np.diff(col) != 1)
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(row)) - 1
    wide = int(col.max()) + 3 if len(col) else 1
    left, right = row[first] * wide + col[first], row[first] * wide + col[last]  # runs are in order of both
    # runs of the row before whose right end is not before this one's left neighbour, and whose left end is not behind its right
    lo = np.searchsorted(right, left - wide - 1, "left")
    hi = np.searchsorted(left, right - wide + 1, "right")
    count = np.maximum(hi - lo, 0)
    a = np.repeat(np.arange(len(first)), count)
    b = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
    return first[merged(len(first), a, b)][np.cumsum(begins) - 1]


def in_groups(rows: DataFrame, keys: list[str], order: list[str], use: Callable[[pa.Table, np.ndarray], pa.Table], types: str) -> DataFrame:
    """use(table, group) of whole groups of rows in order, a batch's at once, as small groups are too many for a call each.

    group numbers the rows' groups from 0; a group that a batch cuts waits for the next one.
    """

    def numbers(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        for k in keys:
            code = np.asarray(table[k].combine_chunks().dictionary_encode(null_encoding="encode").indices)
            new[1:] |= code[1:] != code[:-1]
        return np.cumsum(new)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
            if held.num_rows:
                group = numbers(held)
                whole = int(np.searchsorted(group, group[-1]))
                if whole:
                    yield from use(held.slice(0, whole), group[:whole]).to_batches()
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield from use(held, np.zeros(held.num_rows, np.int64)).to_batches()

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(task, types)


def clusters(lit: DataFrame, by: list[str], row: str, col: str, height: int, width: int, tile: int = TILE) -> DataFrame:
    """Lit pixels with the row and column of the first pixel of their cluster, by (row, column); neighbours touch at edges or corners.

    Frames have at most height x width pixels.  Each tile joins its own runs.  Then clusters that touch across a
    border are merged level by level, of four tiles into one: a group of a level holds the border inside its square
    only, and later levels read the labels that the level before gave.
    """
    place = F.col(row).cast("long") * width + F.col(col)
    pixels = lit.select(*by, F.col(row).alias("_row"), F.col(col).alias("_col"), place.alias("_at")).distinct()
    pixels = pixels.withColumns({"_tr": F.floor(F.col("_row") / tile).cast("int"), "_tc": F.floor(F.col("_col") / tile).cast("int")})
    keys = ", ".join(f"{k} {t}" for k, t in pixels.select(*by).dtypes)
    keys = keys and keys + ", "

    def label(table: pa.Table, group: np.ndarray) -> pa.Table:
        at = np.asarray(table["_at"])
        return table.append_column("_label", pa.array(at[runs_joined(group * (height + 1) + at // width, at % width)]))  # tiles lie a row apart

    types = ", ".join(f"{k} {t}" for k, t in pixels.dtypes)
    local = in_groups(pixels, [*by, "_tr", "_tc"], ["_at"], label, f"{types}, _label long")

    # pixels at the border of their tile and the neighbours that lie in another one
    edge = F.lit(False)
    for c in ("_row", "_col"):
        edge = edge | (F.col(c) % tile).isin(0, tile - 1)
    rim = local.filter(edge)
    steps = F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in ((0, 1), (1, -1), (1, 0), (1, 1))]))
    ahead = rim.select(*by, "_row", "_col", "_tr", "_tc", F.col("_label").alias("_a"), steps.alias("s"))
    ahead = ahead.withColumns({"_row": F.col("_row") + F.col("s.r"), "_col": F.col("_col") + F.col("s.c")}).drop("s")
    other = rim.select(*by, "_row", "_col", F.col("_tr").alias("_or"), F.col("_tc").alias("_oc"), F.col("_label").alias("_b"))
    touching = ahead.join(other, [*by, "_row", "_col"]).filter((F.col("_tr") != F.col("_or")) | (F.col("_tc") != F.col("_oc")))
    edges = touching.select(*by, "_tr", "_tc", "_or", "_oc", "_a", "_b").distinct()

    labels = edges.select(*by, F.explode(F.array("_a", "_b")).alias("_label")).distinct().withColumn("_now", F.col("_label"))

    def union(table: pa.Table, group: np.ndarray) -> pa.Table:
        places = np.stack([np.asarray(table["_x"]), np.asarray(table["_y"])], 1) + group[:, None] * (height * width)
        known, first, found = np.unique(places, return_index=True, return_inverse=True)
        a, b = found.reshape(-1, 2).T
        out = table.select([*by, "_sr"]).take(pa.array(first // 2))
        for name, place in (("_now", known), ("_next", known[merged(len(known), a, b)])):
            out = out.append_column(name, pa.array(place % (height * width)))
        return out.drop_columns("_sr")

    level, side = 0, max(-(-height // tile), -(-width // tile))
    while (1 << level) < side:
        level += 1
        square = lambda c, k: F.shiftright(F.col(c), k)
        together = (square("_tr", level) == square("_or", level)) & (square("_tc", level) == square("_oc", level))
        apart = (square("_tr", level - 1) != square("_or", level - 1)) | (square("_tc", level - 1) != square("_oc", level - 1))
        now = labels.select(*by, F.col("_label").alias("_a"), F.col("_now").alias("_x"))
        then = labels.select(*by, F.col("_label").alias("_b"), F.col("_now").alias("_y"))
        mine = edges.filter(together & apart).join(now, [*by, "_a"]).join(then, [*by, "_b"])
        mine = mine.select(*by, square("_tr", level).alias("_sr"), square("_tc", level).alias("_sc"), "_x", "_y").distinct()
        moved = in_groups(mine, [*by, "_sr", "_sc"], [], union, f"{keys}_now long, _next long")
        labels = labels.join(moved, [*by, "_now"], "left").select(*by, "_label", F.coalesce("_next", "_now").alias("_now"))
    out = local.join(labels, [*by, "_label"], "left").withColumn("_label", F.coalesce("_now", "_label"))
    first = F.floor(F.col("_label") / width).cast("int"), (F.col("_label") % width).cast("int")
    return out.select(*by, F.col("_row").alias(row), F.col("_col").alias(col), first[0].alias("first_row"), first[1].alias("first_col"))


def cluster_sizes(labelled: DataFrame, by: list[str], row: str, col: str) -> DataFrame:
    """Pixels and extent of each cluster."""
    ends = [f(c).alias(f"{n}_{c}") for c in (row, col) for n, f in (("min", F.min), ("max", F.max))]
    return labelled.groupBy(*by, "first_row", "first_col").agg(F.count("*").alias("n_pixels"), *ends)


def large_clusters(sizes: DataFrame, by: list[str], row: str, col: str, height: int, width: int) -> DataFrame:
    """Clusters that are no noise, numbered from 1 in each frame by their last row, then by their first column.

    Noise has no more pixels than (height / 800) * (width / 100), each taken whole and 1 at least, or is neither
    wider nor higher than a hundredth of the frame.
    """
    least = max(height // 800, 1) * max(width // 100, 1)
    wide = F.col(f"max_{col}") - F.col(f"min_{col}") + 1
    high = F.col(f"max_{row}") - F.col(f"min_{row}") + 1
    kept = sizes.filter((F.col("n_pixels") > least) & ((wide > max(width // 100, 1)) | (high > max(height // 100, 1))))
    order = Window.partitionBy(*by).orderBy(f"max_{row}", f"min_{col}", "first_row", "first_col")
    return kept.withColumn("cluster", F.row_number().over(order))


def smoothed_columns(values: np.ndarray, ends: np.ndarray, strength: float) -> np.ndarray:
    """Each column f that minimises sum (f - v)^2 + strength * sum (steps of f)^2; column j has ends[j] rows.

    The normal equations are tridiagonal and are eliminated for all columns at once.
    """
    rows, cols = values.shape
    at = np.arange(rows)[:, None]
    inside = at < ends
    off = np.where((at[1:] < ends), -strength, 0.0)  # between row i and i + 1
    diagonal = np.ones((rows, cols))
    diagonal[:-1] -= off
    diagonal[1:] -= off
    right = np.where(inside, values, 0.0)
    for i in range(1, rows):
        factor = off[i - 1] / diagonal[i - 1]
        diagonal[i] -= factor * off[i - 1]
        right[i] -= factor * right[i - 1]
    right[-1] /= diagonal[-1]
    for i in range(rows - 2, -1, -1):
        right[i] = (right[i] - off[i] * right[i + 1]) / diagonal[i]
    return right


def lit_pixels(pixels: DataFrame, by: list[str], row: str, col: str, value: str, strength: float = 20.0, noise: float = 0.0, ratio: float = 0.5) -> DataFrame:
    """Pixels that stand out of the smoothed values of their column.

    What a pixel has above the smooth line must be more than half of the column's value at a share `ratio` of its
    sorted excesses (those below the line count as 0), plus 1 where the column's values differ by more than 1.
    """
    rows = pixels.withColumn("_v", finite(F.col(value).cast("double"))).filter("_v is not null").select(*by, row, col, "_v")
    types = ", ".join(f"{k} {t}" for k, t in rows.drop("_v").dtypes)

    def lit(table: pa.Table) -> pa.Table:
        table = table.sort_by([(col, "ascending"), (row, "ascending")])
        c, v = np.asarray(table[col]), np.asarray(table["_v"])
        _, start, n = np.unique(c, return_index=True, return_counts=True)
        j = np.repeat(np.arange(len(start)), n)
        i = np.arange(len(c)) - start[j]
        square = np.zeros((n.max(), len(start)))
        square[i, j] = v
        above = v + noise - smoothed_columns(square, n, strength)[i, j]
        order = np.lexsort((np.maximum(above, 0), j))
        middle = np.maximum(above, 0)[order[start + np.minimum((n * ratio).astype(int), n - 1)]]
        spread = np.maximum.reduceat(v, start) - np.minimum.reduceat(v, start)
        return table.filter(pa.array(above > (0.5 * middle + (spread > 1))[j])).drop_columns("_v")

    band = F.floor(F.col(col) / BAND).alias("_band")
    return rows.groupBy(*by, band).applyInArrow(lit, types)


# cut-outs along traces


def tiles_met(pixels: DataFrame, traces: DataFrame, by: list[str], row: str, col: str, low: Column, high: Column, tile: int) -> DataFrame:
    """Pixels with the traces whose rows low .. high (columns of traces and `_c`) meet the tile that the pixel lies in.

    A trace is spread over the tiles that it passes, column by column, so that the join is one of equal tiles.
    """
    columns = traces.withColumn("_c", F.explode(F.sequence("x1", "x2")))
    reach = columns.withColumns({"_low": low, "_high": high}).filter(F.col("_high") >= F.col("_low"))
    reach = reach.withColumn("_tile", F.explode(F.sequence(F.floor(F.col("_low") / tile), F.floor(F.col("_high") / tile))))
    placed = pixels.withColumns({"_c": F.col(col).cast("int"), "_tile": F.floor(F.col(row) / tile)})
    return placed.join(reach, [*by, "_c", "_tile"])


def polynomial(coefficients: str, x: Column) -> Column:
    return F.aggregate(F.reverse(F.col(coefficients)), F.lit(0.0), lambda acc, k: acc * x + k)


def in_trace(pixels: DataFrame, traces: DataFrame, row: str, col: str, coefficients: str, below: str, above: str, by: list[str] = (), tile: int = TILE) -> DataFrame:
    """Pixels with the trace whose rows ceil(mid - below) .. floor(mid + above) - 1 hold them."""
    mid = polynomial(coefficients, F.col("_c").cast("double"))
    met = tiles_met(pixels, traces, list(by), row, col, F.ceil(mid - F.col(below)), F.floor(mid + F.col(above)) - 1, tile)
    return met.filter(F.col(row).between(F.col("_low"), F.col("_high"))).drop("_c", "_tile", "_low", "_high")


def cut_out(pixels: DataFrame, traces: DataFrame, row: str, col: str, coefficients: str, below: str, above: str, height: int, by: list[str] = (), tile: int = TILE) -> DataFrame:
    """Pixels of each trace with their weight: the share of the pixel that lies between mid - below and mid + above.

    Traces are kept on the detector, 0 .. height - 1.  The pixel of the upper edge has the fraction of that edge, the
    one of the lower edge one less its fraction, and the latter counts where both edges lie in one pixel.
    """
    mid = polynomial(coefficients, F.col("_c").cast("double"))

    def kept(c: Column) -> Column:
        return F.least(F.greatest(c, F.lit(0.0)), F.lit(height - 1.0))

    bottom, top = kept(mid - F.col(below)), kept(mid + F.col(above))
    met = tiles_met(pixels, traces, list(by), row, col, F.floor(bottom), F.greatest(F.floor(bottom), F.floor(top)), tile)
    met = met.withColumns({"_bottom": bottom, "_top": top})
    r = F.col(row)
    share = F.when(r == F.floor("_bottom"), 1 - (F.col("_bottom") - F.floor("_bottom"))).when(r == F.floor("_top"), F.col("_top") - F.floor("_top")).otherwise(1.0)
    inside = met.withColumn("weight", share).filter(r.between(F.col("_low"), F.col("_high")))
    return inside.drop("_c", "_tile", "_low", "_high", "_bottom", "_top")


# filling and smoothing


def nearest_filled(pixels: DataFrame, by: list[str], row: str, col: str, value: str) -> DataFrame:
    """Null and NaN values replaced by the value of the nearest good pixel; of equally near ones by the first by (row, column).

    The nearest good pixels of each column come from window values; each row then takes the best of all columns.
    Frames without a good pixel keep their values.
    """
    good = F.when(finite(F.col(value)).isNotNull(), F.struct(F.col(row).alias("r"), F.col(value).cast("double").alias("v")))
    up, down = (Window.partitionBy(*by, col).orderBy(c).rowsBetween(Window.unboundedPreceding, 0) for c in (F.col(row).asc(), F.col(row).desc()))
    rows = pixels.select(*by, row, col, value).withColumns({"_u": F.last(good, ignorenulls=True).over(up), "_d": F.last(good, ignorenulls=True).over(down)})
    near_up = F.col("_d").isNull() | (F.col(row) - F.col("_u.r") <= F.col("_d.r") - F.col(row))
    rows = rows.withColumn("_n", F.when(F.col("_u").isNotNull() & near_up, F.col("_u")).otherwise(F.col("_d")))
    rows = rows.select(*by, row, col, F.col(value).cast("double").alias(value), F.col("_n.r").alias("_r"), F.col("_n.v").alias("_v"))
    types = ", ".join(f"{k} {t}" for k, t in rows.drop("_r", "_v").dtypes)

    def filled(table: pa.Table) -> pa.Table:
        v = table[value].to_numpy(zero_copy_only=False)
        bad = np.flatnonzero(np.isnan(v))
        r, c = np.asarray(table[row]), np.asarray(table[col])
        source = table["_r"].to_numpy(zero_copy_only=False).astype(float)
        there = np.flatnonzero(~np.isnan(source))
        out = v.copy()
        if len(there):
            taken = table["_v"].to_numpy(zero_copy_only=False)[there]
            by_place = np.lexsort((c[there], source[there]))  # the first of equally near ones is the first by (row, column)
            there, taken = there[by_place], taken[by_place]
            for at in range(0, len(bad), BAND):
                some = bad[at : at + BAND]
                far = (c[some, None] - c[there]) ** 2 + (r[some, None] - source[there]) ** 2
                out[some] = taken[far.argmin(axis=1)]
        place = table.column_names.index(value)
        return table.set_column(place, value, pa.array(out)).drop_columns(["_r", "_v"])

    return rows.groupBy(*by, row).applyInArrow(filled, types)


def gaussian_weights(sigma: float, truncate: float = 4.0) -> np.ndarray:
    half = int(truncate * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-half, half + 1) / sigma) ** 2)
    return w / w.sum()


def smoothed_along(pixels: DataFrame, by: list[str], line: str, at: str, value: str, sigma: float) -> DataFrame:
    """Gaussian smoothing of each line of a full frame; beyond its ends a line is reflected, its end pixel repeated."""
    weights = gaussian_weights(sigma)
    half = len(weights) // 2
    rows = pixels.select(*by, line, at, F.col(value).cast("double").alias(value))
    types = ", ".join(f"{k} {t}" for k, t in rows.dtypes)

    def smooth(table: pa.Table) -> pa.Table:
        table = table.sort_by([(line, "ascending"), (at, "ascending")])
        v = table[value].to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate([[True], np.diff(np.asarray(table[line])) != 0]))
        parts = [np.convolve(np.pad(x, half, mode="symmetric"), weights, "valid") for x in np.split(v, starts[1:])]
        return table.set_column(table.column_names.index(value), value, pa.array(np.concatenate(parts)))

    return rows.groupBy(*by, F.floor(F.col(line) / BAND).alias("_band")).applyInArrow(smooth, types)


def gaussian_smoothed(pixels: DataFrame, by: list[str], row: str, col: str, value: str, sigma: float) -> DataFrame:
    """Two-dimensional Gaussian smoothing as a pass along rows and one along columns."""
    return smoothed_along(smoothed_along(pixels, by, row, col, value, sigma), by, col, row, value, sigma)
