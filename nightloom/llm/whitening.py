"""Whitening of embeddings: the distributed centred scatter is diagonalised by cyclic Jacobi rotations.

Vectors are whole numbers, floor(256 * component).  Statistics are taken over the distinct vectors: their number and
exact sums first, then the scatter of x - mean, which each task sums over its rows and Spark over the tasks.  The
driver holds this one matrix of width * width and turns it by symmetric rotations, in rounds of disjoint pairs that
go through all pairs, until nothing is left off the diagonal; that keeps small eigenvalues accurate.  The sorted
components over the root of their eigenvalue are broadcast, and all rows are projected.

Defined results: rows with a null vector, or a null or non-finite entry, are left out; vectors shorter than the longest are
filled up with zeros; rows that repeat a vector or an id are projected each and count once for the statistics; a
component without variance (an eigenvalue within rounding of zero) gives null as `whitened`; a deviation beyond a long
is null; there are at most as many components as entries; extra columns are not used; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors
from .workspace import Workspace

COMPONENTS = 4
SWEEPS = 60  # at most; some ten are usual
LONG_MAX = (1 << 63) - 1


def rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n places, in rounds of disjoint pairs: a tournament in which one place stays and the others turn."""
    ring = list(range(n + n % 2))
    for _ in range(len(ring) - 1):
        pairs = [(min(a, b), max(a, b)) for a, b in zip(ring[: len(ring) // 2], ring[::-1], strict=False) if max(a, b) < n]
        yield np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def jacobi(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns of a symmetric matrix, by cyclic Jacobi rotations."""
    a = np.array(matrix, np.float64)
    n = len(a)
    turned = np.eye(n)
    for _ in range(SWEEPS):
        rotated = False
        for p, q in rounds(n):
            off = a[p, q]
            # a rotation is due where the entry still counts against both of its diagonal entries
            due = np.abs(off) > 1e-16 * np.sqrt(np.abs(a[p, p] * a[q, q]))
            due &= np.abs(off) > np.finfo(float).tiny
            if not due.any():
                continue
            rotated = True
            p, q, off = p[due], q[due], off[due]
            with np.errstate(over="ignore"):  # then the tangent is 0
                theta = (a[q, q] - a[p, p]) / (2 * off)
                t = np.where(theta >= 0, 1.0, -1.0) / (np.abs(theta) + np.sqrt(theta * theta + 1))
            c = 1 / np.sqrt(t * t + 1)
            s = t * c
            diagonal = a[p, p] - t * off, a[q, q] + t * off
            a[p], a[q] = c[:, None] * a[p] - s[:, None] * a[q], s[:, None] * a[p] + c[:, None] * a[q]
            a[:, p], a[:, q] = a[:, p] * c - a[:, q] * s, a[:, p] * s + a[:, q] * c
            turned[:, p], turned[:, q] = turned[:, p] * c - turned[:, q] * s, turned[:, p] * s + turned[:, q] * c
            a[p, p], a[q, q] = diagonal
            a[p, q] = a[q, p] = 0.0
        if not rotated:
            break
    values = np.diag(a)
    order = np.argsort(-values, kind="stable")
    return values[order], turned[:, order]


@dataclass(frozen=True)
class Whitening:
    """Number and sums of the distinct vectors, and the leading components of their covariance."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray  # [entry, component]
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def degenerate(self) -> np.ndarray:
        return ~(self.eigenvalues > len(self.sums) * 2.0**-50 * self.trace)

    def projected(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; a component without variance gives zeros."""
        flat = self.degenerate()
        scale = np.where(flat, 0.0, 1 / np.sqrt(np.where(flat, 1.0, self.eigenvalues)))
        return (x - self.mean) @ (self.components * scale)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum of (n * x - sums)^2 of each row, if a long holds it."""
        most = self.n * vectors.largest(x) + max(map(abs, self.sums), default=0)
        if most * most * max(len(self.sums), 1) <= LONG_MAX:
            return (((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1)).tolist()
        exact = ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(axis=1)
        return [int(v) if v <= LONG_MAX else None for v in exact]


def scattered(rows: DataFrame, width: int, centre) -> tuple[np.ndarray, int]:
    """Sum over the rows of the outer products of centre(x) with itself, and their number; each task sums its rows."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for b in batches:
            y = centre(vectors.matrix(b["x"], width))
            total = y.T @ y if total is None else total + y.T @ y
            n += len(y)
        if n:
            upper = total[np.triu_indices(len(total))]
            yield pa.record_batch([np.arange(len(upper) + 1), np.concatenate([upper, [float(n)]])], ["at", "part"])

    added = rows.select("x").mapInArrow(sums, "at long, part double").groupBy("at").agg(F.sum("part").alias("part"))
    *upper, n = [r.part for r in added.orderBy("at").collect()]  # width * (width + 1) / 2 sums
    size = int((np.sqrt(8 * len(upper) + 1) - 1) / 2)
    out = np.zeros((size, size))
    out[np.triu_indices(size)] = upper
    return np.triu(out) + np.triu(out, 1).T, int(n)


def fit(distinct: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of rows (x) that differ from each other; None without any."""
    entry = F.posexplode("x").alias("at", "v")
    added = distinct.select(entry).groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"))
    found = added.orderBy("at").collect()  # one row for each of the width entries
    n, sums = (found[0].n, [int(r.s) for r in found]) if found else (distinct.count(), [])
    if not n:
        return None
    if not width:
        return Whitening(n, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    mean = np.array([s / n for s in sums])
    scatter, _ = scattered(distinct, width, lambda x: x - mean)
    values, turned = jacobi(scatter / n)
    k = min(components, width)
    return Whitening(n, sums, np.maximum(values[:k], 0.0), turned[:, :k], float(np.trace(scatter)) / n)


def identity_error(distinct: DataFrame, width: int, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, over the components that have variance."""
    alive = np.flatnonzero(~model.degenerate())
    if not len(alive):
        return 0.0
    # first the mean of the whitened rows, then their scatter around it
    ones, n = scattered(distinct, width, lambda x: np.hstack([np.ones((len(x), 1)), model.projected(x)[:, alive]]))
    mean = ones[0, 1:] / n
    scatter, _ = scattered(distinct, width, lambda x: model.projected(x)[:, alive] - mean)
    return float(np.abs(scatter / n - np.eye(len(alive))).max())


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for rows (vec_id, embedding)."""
    spark = rows.sparkSession
    work = Workspace(spark, "whitening")
    part = rows.filter(vectors.usable(F.col("embedding"))).select("vec_id", vectors.whole_numbers(F.col("embedding")).alias("x"))
    width = vectors.widest(part, "x")
    part = part.withColumn("x", vectors.padded(F.col("x"), width))
    distinct = work.keep(part.select("x").distinct(), "distinct")
    model = fit(distinct, width, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not width:
        return spark.createDataFrame([], schema)
    error = identity_error(distinct, width, model)
    work.drop(distinct)
    sent = spark.sparkContext.broadcast(model)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        k, alive = len(m.eigenvalues), ~m.degenerate()
        explained = m.eigenvalues / m.trace if m.trace else np.zeros(k)
        for b in batches:
            x = vectors.matrix(b["x"], width)
            rows = len(x)
            ids = b["vec_id"].cast(pa.int64()).take(pa.array(np.repeat(np.arange(rows), k)))
            deviation = pa.array(m.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k)))
            values = pa.array(m.projected(x).ravel(), mask=~np.tile(alive, rows))
            columns = [
                ids,
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, m.n, np.int64)),
                deviation,
                values,
                pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * k, error)),
            ]
            yield pa.record_batch(columns, [f.split(" ")[0] for f in schema.split(", ")])

    return part.mapInArrow(projected, schema)
