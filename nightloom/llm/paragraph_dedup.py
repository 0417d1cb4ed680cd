"""Substring deduplication by paragraphs with MinHash banding.

A paragraph is a line of a document that has words.  Paragraphs of equal words (A-Z lower-cased) are
one class.  Each class of at least SHORTEST words has a MinHash signature of its 5-word shingles, cut into bands; their number is tuned so
that two paragraphs at the threshold collide with the recall asked.  Each class is compared with the
smallest members of the cells that it shares most.  Rounds follow that compare only pairs which would join what is
still apart in a cell.  Then the prefixes of the classes' shingles, rare ones first, give every pair that is apart and
may reach the threshold, whether the bands met or not (jaccard_join), so no pair is missed.  Candidates that the parity
sketches do not rule out are verified by exact Jaccard similarity on their whole texts, and each connected component
of classes keeps one occurrence, the first by (doc_id, paragraph).

Passages inside longer paragraphs: windows of WINDOW words are fingerprinted and the smallest fingerprint of every
REACH neighbours is chosen, so that any passage of WINDOW + REACH - 1 = 50 words that two documents share, wherever
it stands, has a chosen window in common.  Windows that stand in several documents are joined to passages where
they overlap, and each keeps its first document.

Defined results: null and empty texts have no paragraphs; repeats within one document only are left alone; rows
that repeat a doc_id are one document; rows without doc_id are not searched; extra columns are not used; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .jaccard_join import _counted, apart_pairs, may_link, overlaps, parity_sketches, shingle_counts, sketch_distance
from .kernels import distinct, mix, slices, words
from .workspace import Workspace

WORDS = 5
LEAST = 75  # hundredths
SHORTEST = WORDS  # words of a paragraph that is compared with paragraphs that differ; one of fewer has one shingle, so that only equal ones are alike
ROWS = 4  # hashes of a band
RECALL = 0.98  # of a pair at the threshold
BANDS = math.ceil(math.log(1 - RECALL) / math.log(1 - (LEAST / 100) ** ROWS))
WINDOW, REACH = 32, 19  # words

_P = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
ROUNDS = 2  # in which only pairs that would join something are compared
LEADERS = 2  # smallest members of its cells that a class is compared with first
UNITS = "passage boolean, doc_id long, place int, n int, k1 long, k2 long, bands array<long>, sketch binary"


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


def windows(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word, and fingerprint, of the chosen windows of all texts."""
    n = len(h) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(h), _P, np.uint64))))
    back = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, np.uint64(_inverse(int(_P))), np.uint64))))
    total = np.concatenate(([np.uint64(0)], np.cumsum(h * power[: len(h)])))
    fp = mix((total[WINDOW:] - total[:-WINDOW]) * back)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    whole = text[:n] == text[WINDOW - 1 :]
    fp = np.where(whole, fp, np.uint64(2**64 - 1))
    low = fp.copy()  # the smallest of REACH fingerprints that begin here, by doubling
    span = 1
    while span < REACH:
        step = min(span, REACH - span)
        low[: max(0, n - step)] = np.minimum(low[: max(0, n - step)], low[step:])
        span += step
    high, span = low.copy(), 1  # the largest of the smallest of all stretches that hold the window
    while span < REACH:
        step = min(span, REACH - span)
        high[step:] = np.maximum(high[step:], high[: max(0, n - step)].copy())
        span += step
    chosen = fp == high
    chosen &= whole
    place = np.flatnonzero(chosen)
    return place, fp[place]


def paragraphs(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per line that has words: text, line number there, and range of words."""
    breaks = np.flatnonzero(data == 10)
    cuts = np.unique(np.concatenate([offsets, breaks + 1]))
    first = np.searchsorted(starts, cuts)
    i = np.flatnonzero(np.diff(first))
    text = np.searchsorted(offsets, cuts[i], "right") - 1
    return text, np.searchsorted(breaks, cuts[i]) - np.searchsorted(breaks, offsets[text]), first[i], first[i + 1]


def _class_keys(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """Two keys of the words h[a:b] of each paragraph."""
    long = b - a
    place = np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long)
    word = h[place + np.repeat(a, long)]
    return [mix(np.add.reduceat(mix(word + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(c)), np.cumsum(long) - long) + long.astype(np.uint64)).view(np.int64) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["passage", "doc_id", "place", "n", "k1", "k2", "bands", "sketch"]
    for batch in batches:
        ids = batch["doc_id"].to_numpy()
        for base, data, offsets in slices(batch["text"]):
            h, starts, _, at = words(data, offsets)
            found = np.stack(paragraphs(data, offsets, starts), 1)
            short = found[:, 3] - found[:, 2] < SHORTEST
            few, found = found[short], found[~short].tolist()
            if len(few):
                keys = _class_keys(h, few[:, 2], few[:, 3])
                none = [pa.nulls(len(few), t) for t in (pa.list_(pa.int64()), pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(few), bool)), pa.array(ids[base + few[:, 0]]), pa.array(few[:, 1].astype(np.int32)), pa.array(np.zeros(len(few), np.int32)), *[pa.array(k) for k in keys], *none], names)
            if found:
                run = np.zeros(len(h) - WORDS + 1, np.uint64)
                for i in range(WORDS):
                    run = mix(run + h[i : len(h) - WORDS + 1 + i] * _P + np.uint64(i + 1))
                spans = np.array(found)
                size = spans[:, 3] - spans[:, 2] - WORDS + 1
                begin = np.concatenate(([0], np.cumsum(size)))
                flat, begin = distinct(run.take(np.arange(begin[-1]) + np.repeat(spans[:, 2] - begin[:-1], size)), begin)
                band = np.zeros((len(found), BANDS), np.uint64)
                for k in range(BANDS * ROWS):
                    low = np.minimum.reduceat(flat * _SEEDS[k], begin[:-1])  # shingles are mixed already, an odd factor orders them anew
                    band[:, k // ROWS] = mix(band[:, k // ROWS] * _P + low + np.uint64(k))
                keys = _class_keys(h, spans[:, 2], spans[:, 3])
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * BANDS), pa.array(band.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.zeros(len(found), bool)), pa.array(ids[[base + t for t, *_ in found]]), pa.array([p for _, p, *_ in found], pa.int32()), pa.array(np.diff(begin).astype(np.int32)),
                        pa.array(keys[0]), pa.array(keys[1]), bands, parity_sketches(flat, begin, 8),
                    ],
                    names,
                )
            place, fp = windows(h, at)
            if len(place):
                text = np.searchsorted(at, place, "right") - 1
                order = np.lexsort((fp, text))  # stable, so the first of equal ones comes first
                one = np.sort(order[np.concatenate(([True], (fp[order][1:] != fp[order][:-1]) | (text[order][1:] != text[order][:-1])))])
                place, fp, text = place[one], fp[one], text[one]
                none = pa.nulls(len(place), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(len(place), bool)), pa.array(ids[base + text]), pa.array((place - at[text]).astype(np.int32)), pa.array(np.full(len(place), WINDOW, np.int32)), pa.array(fp.view(np.int64)), none, pa.nulls(len(place), pa.list_(pa.int64())), pa.nulls(len(place), pa.binary())],
                    names,
                )


def _forest(least: int):
    """For each cell of a partition's rows (cell, id, root, n, sketch, other) pairs that would join its roots.

    A pair joins two roots if their sketches do not rule it out and it has not been refused; roots that a pair
    before it joins already need no other.  Rows with other are pairs (id, other) that were refused.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, refused = [], set()
        for batch in batches:
            for cell, a, root, n, sketch, b in zip(*[batch[c].to_pylist() for c in ("cell", "id", "root", "n", "sketch", "other")], strict=True):
                if b is None:
                    rows.append((cell, n, a, root, sketch))
                else:
                    refused.add((a, b))
        rows.sort(key=lambda r: r[:3])
        pairs, begin = set(), 0
        for i in range(1, len(rows) + 1):
            if i < len(rows) and rows[i][0] == rows[begin][0]:
                continue
            up: dict[int, int] = {}

            def find(r, up=up):
                while up.setdefault(r, r) != r:
                    up[r] = r = up[up[r]]
                return r

            for x in range(begin, i):
                _, n, a, root, sketch = rows[x]
                mine = find(root)
                for y in range(x + 1, i):
                    _, m, b, other, other_sketch = rows[y]
                    if 100 * n < least * m:
                        break
                    if (its := find(other)) != mine and (pair := (min(a, b), max(a, b))) not in refused and sketch_distance(sketch, other_sketch) <= (n + m) * (100 - least) // (100 + least):
                        pairs.add(pair)
                        up[its] = mine
            begin = i
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])

    return task


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id: class id, text) of wanted lines [(place, id)] of each document."""
    for batch in batches:
        ids, texts = [], []
        for wanted, text in zip(batch["wanted"].to_pylist(), batch["text"].to_pylist(), strict=True):
            lines = text.split("\n")
            for w in wanted:
                if w["place"] < len(lines):
                    ids.append(w["id"])
                    texts.append(lines[w["place"]])
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])


def repeated_paragraphs(docs: DataFrame, units: DataFrame, work: Workspace, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What is kept of it, two tables, and (doc_id, place, group_id, keep_doc_id, keep_place) for each paragraph whose group stands in several documents.

    units, a kept table, is dropped as soon as its classes are known: tables that no later step reads make room on the disk.
    """
    lines = units.filter("not passage")
    stands = work.keep(lines.select("doc_id", "place", F.col("k1").alias("id")), "stands")
    classes = lines.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.first("bands").alias("bands"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = work.keep(classes.withColumn("id", F.col("k1")).drop("k1", "k2"), "classes")
    work.drop(units)
    members = classes.select("id", F.explode(F.transform("bands", lambda b, i: F.xxhash64(b, i))).alias("cell"))
    cells = members.groupBy("cell").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low <> high")
    cells = work.keep(members.join(cells.select("cell", "low"), "cell"), "cells")
    banded, classes = classes, work.keep(classes.drop("bands"), "classes")
    work.drop(banded)
    sketches = classes.select("id", "n", "sketch")
    # each class first meets those smallest members with which it shares most bands
    met = cells.filter("id <> low").groupBy("id", "low").agg(F.count("*").alias("n")).groupBy("id").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "low")), asc=False), 1, LEADERS).alias("low"))
    met = met.select(F.col("id").alias("b"), F.explode("low.low").alias("a")).select("a", "b")
    stars = work.keep(may_link(met, sketches, least), "stars")

    # the texts of all classes that are compared, once for each
    wanted = classes.filter("n > 0").select("first.doc_id", F.struct("first.place", "id").alias("w")).groupBy("doc_id").agg(F.collect_list("w").alias("wanted"))  # lines of one document
    texts = work.keep(docs.join(wanted, "doc_id").select("wanted", "text").mapInArrow(_lines, "doc_id long, text string"), "texts")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        return work.keep(overlaps(pairs, texts, WORDS).filter(100 * F.col("common") >= least * F.col("total")).select("a", "b").distinct(), name)

    inner = verified(stars, "inner")
    groups = components(inner, work)
    refused = work.keep(stars.join(inner, ["a", "b"], "left_anti").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "refused")
    work.drop(stars)
    linked = inner
    for rounds in range(ROUNDS):
        # only cells that still hold several roots have pairs to look at
        rooted = cells.join(groups, "id", "left").select("cell", "id", F.coalesce("root", "id").alias("root"))
        open_cells = rooted.groupBy("cell").agg(F.min("root").alias("r"), F.max("root").alias("s")).filter("r <> s").select("cell")
        left = work.keep(rooted.join(open_cells, "cell").join(sketches, "id").select("cell", "id", "root", "n", "sketch", F.lit(None).cast("long").alias("other")), "open")
        both = left.select("cell", F.col("id").alias("a")).join(refused, "a").join(left.select("cell", F.col("id").alias("b")), ["cell", "b"])
        both = both.select("cell", F.col("a").alias("id"), F.lit(None).cast("long").alias("root"), F.lit(None).cast("int").alias("n"), F.lit(None).cast("binary").alias("sketch"), F.col("b").alias("other"))
        pairs = work.keep(left.unionByName(both).repartition("cell").mapInArrow(_forest(least), "a long, b long").distinct(), "pairs")
        work.drop(left)
        if pairs.isEmpty():
            break
        found = verified(pairs, f"round{rounds}")
        done = [pairs, found, refused, linked]
        refused = work.keep(refused.union(pairs.join(found, ["a", "b"], "left_anti")), "refused")
        linked = work.keep(linked.union(found), "linked")
        for table in done:
            work.drop(table)
        groups = components(linked, work)
    work.drop(cells)
    # what no band has joined: every pair of different groups that its prefixes let reach the threshold
    counts = docs.sparkSession.sparkContext.broadcast(shingle_counts(texts.select("text").mapInArrow(_counted(WORDS), "sketch binary, block int")))  # COUNTERS counters
    rooted = texts.join(groups, texts["doc_id"] == groups["id"], "left").select("doc_id", "text", F.coalesce("root", "doc_id").alias("root"))
    pairs = work.keep(apart_pairs(rooted, counts, WORDS, least).join(refused, ["a", "b"], "left_anti"), "pairs")
    counts.destroy()
    if not pairs.isEmpty():
        groups = components(linked.union(verified(may_link(pairs, sketches, least), "apart")), work)
    for table in (texts, classes, pairs, refused, linked):
        work.drop(table)
    placed = stands.join(groups, "id", "left").select("doc_id", "place", F.coalesce("root", "id").alias("group_id"))
    placed = work.keep(placed, "placed")
    several = placed.groupBy("group_id").agg(F.min(F.struct("doc_id", "place")).alias("keep"), F.max("doc_id").alias("last")).filter("keep.doc_id <> last")
    several = work.keep(several, "several")  # both sides of the join are dealt out for it, so that a large group can be split
    return placed, several, placed.join(several, "group_id").select("doc_id", "place", "group_id", F.col("keep.doc_id").alias("keep_doc_id"), F.col("keep.place").alias("keep_place"))


def repeated_passages(units: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What is kept of it, two tables, and (doc_id, place, n_words, group_id, keep_doc_id, removed): runs of overlapping windows that several documents hold."""
    chosen = units.filter("passage").select("doc_id", "place", F.col("k1").alias("fp"))
    several = chosen.groupBy("fp").agg(F.min("doc_id").alias("keep_doc_id"), F.max("doc_id").alias("last")).filter("keep_doc_id <> last").drop("last")
    shared = chosen.join(several, "fp")
    order = Window.partitionBy("doc_id").orderBy("place", "fp")
    last = F.lag("place").over(order)
    shared = shared.withColumn("removed", F.col("keep_doc_id") < F.col("doc_id"))
    joined = F.col("place") <= last + WINDOW
    runs = shared.withColumn("before", F.when(joined, F.lag("fp").over(order)))
    runs = runs.withColumn("new", F.when(joined & (F.col("removed") == F.lag("removed").over(order)), 0).otherwise(1))
    runs = work.keep(runs.withColumn("run", F.sum("new").over(order)), "runs")
    groups = components(runs.filter("before is not null").select(F.col("fp").alias("a"), F.col("before").alias("b")).distinct(), work)
    grouped = runs.groupBy("doc_id", "run", "removed").agg(F.min("place").alias("place"), (F.max("place") + WINDOW - F.min("place")).alias("n_words"), F.min("fp").alias("fp"), F.min("keep_doc_id").alias("keep_doc_id"))
    return runs, groups, grouped.join(groups, grouped["fp"] == groups["id"], "left").select("doc_id", "place", "n_words", F.coalesce("root", "fp").alias("group_id"), "keep_doc_id", "removed")


def repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per occurrence of a paragraph or passage that several documents hold.

    doc_id, kind (paragraph: place is a line; passage: place is a word), place, n_words, group_id, keep_doc_id (the
    document whose occurrence stays) and removed.
    """
    work = Workspace(docs.sparkSession, "paragraphs")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null and text is not null")
    units = work.keep(plain.mapInArrow(_units, UNITS), "units")
    *more, passages = repeated_passages(units, work)
    *needed, lines = repeated_paragraphs(plain, units, work, least)
    lines = lines.select("doc_id", F.lit("paragraph").alias("kind"), "place", F.lit(None).cast("int").alias("n_words"), "group_id", "keep_doc_id", (~((F.col("doc_id") == F.col("keep_doc_id")) & (F.col("place") == F.col("keep_place")))).alias("removed"))
    work.only(*needed, *more)
    passages = passages.select("doc_id", F.lit("passage").alias("kind"), "place", "n_words", "group_id", "keep_doc_id", "removed")
    return lines.unionByName(passages)
