"""Connected components of a graph given as edges, by randomised contraction.

Every round gives all vertices a fresh random order and hangs each one on the first of itself and its neighbours.
Vertices that hang on the same one become one vertex, and edges that become loops go.  Whatever the graph looks
like, long paths and stars included, a constant share of the vertices goes with each round, so that all rounds
together cost about as much as the first two.  What is left when at most SMALL edges remain is finished by one task;
that bound does not depend on the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace

SMALL = 50_000  # edges, less than 1 MB, that one task finishes
HELD = 1 << 20  # edges that a task contracts at once before they are shuffled
SEED = 0x9E3779B9


def _forest(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """(vertex, smallest vertex that it reaches) for the edges a[i] - b[i], without the smallest ones themselves."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    while (root != root[root]).any():
        root = root[root]
    moved = np.flatnonzero(root != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[root[moved]])], ["u", "v"])


def _contracted(held: int):
    """Replaces runs of about held edges of a partition by the forest of what they connect."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            parts.append([batch.column(i).to_numpy() for i in (0, 1)])
            n += batch.num_rows
            if n >= held:
                yield _forest(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                parts, n = [], 0
        if n:
            yield _forest(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    return task


def _hung(edges: DataFrame, seed: int) -> DataFrame:
    """(u, m): what each vertex hangs on in the order of this round.  The first neighbour is a partial aggregate."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(seed)).alias("h"), F.col(c).alias("id"))
    first = both.groupBy("u").agg(F.min(order("v")).alias("first"))
    return first.select("u", F.least("first", order("u")).getField("id").alias("m"))


def components(edges: DataFrame, work: Workspace, small: int = SMALL) -> DataFrame:
    """(id, root) for each vertex of edges (a long, b long); root is the smallest id that it is connected with.

    Rows with a null end and loops are left out.  Edges are first contracted where they lie.  Every round is
    written to the shared folder, and only its two joins see whole edges; a vertex with very many neighbours has
    them spread over tasks, since both joins are plain ones that Spark may split.
    """
    a, b = edges.columns[:2]
    flat = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u <> v")
    now = work.keep(flat.mapInArrow(_contracted(HELD), "u long, v long").distinct(), "edges")
    hung: list[DataFrame] = []
    n = now.count()
    while n > small:
        maps = work.keep(_hung(now, SEED + len(hung)), "hung")
        hung.append(maps)
        moved = now.join(maps, "u").select("v", F.col("m").alias("a")).join(maps.withColumnRenamed("u", "v"), "v").filter("a <> m")
        left = work.keep(moved.select(F.greatest("a", "m").alias("u"), F.least("a", "m").alias("v")).distinct(), "edges")
        work.drop(now)
        now, n = left, left.count()
    end = work.keep(now.coalesce(1).mapInArrow(_contracted(1 << 62), "u long, v long"), "edges")  # at most small edges
    work.drop(now)
    if not hung:
        return _labels(end)
    # back through the rounds: what a vertex hung on says where the vertex belongs
    labels, old = end.select(F.col("u").alias("id"), F.col("v").alias("label")), [end, *hung]
    for maps in reversed(hung):
        labels = maps.join(labels.withColumnRenamed("id", "m"), "m", "left").select(F.col("u").alias("id"), F.coalesce("label", "m").alias("label"))
        labels = work.keep(labels, "labels")
        old.append(labels)
    roots = labels.groupBy("label").agg(F.min("id").alias("root"))
    out = work.keep(labels.join(roots, "label").select("id", "root"), "components")
    for step in old:
        work.drop(step)
    return out


def _labels(stars: DataFrame) -> DataFrame:
    out = stars.select(F.col("u").alias("id"), F.col("v").alias("root")).union(stars.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
    out._nightloom_path = stars._nightloom_path
    return out
