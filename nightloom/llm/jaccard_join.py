"""Exact self-join of texts by the Jaccard similarity of their word-shingle sets, as connected groups.

Jaccard distance is a metric, and the join works on it in three steps:

1. Pivots and regions.  Min-hash cells gather texts that are likely near each other; the smallest document of a
   cell is its pivot.  Every member's exact distance to its pivots is computed.  Within eps = 1 - t of a pivot it
   belongs to the pivot's region, and a region is connected through its pivot: its inner pairs, the part that
   grows with the square of a group, are never looked at again.
2. What lies between regions and outside of all of them is joined exactly: pairs that may reach t must share at
   least l shingles among the first n - ceil(t * n) + l of each under one order of all shingles, rare ones first.
   Texts of one group never meet here.  Pairs whose known distances to a common pivot differ by more than eps are dropped
   by the triangle inequality; so are those whose parity sketches differ in more bits than their sets may differ in
   elements.  All others are verified on their whole texts.
3. Regions that such a pair connects merge, by connected components.

The order of shingles and the choice of pivots only steer the cost; every pair at t or above is linked or
connected through links.

Defined results: null texts and texts without words have an empty set and link with nothing, not even each
other; a doc_id is one node, so rows that repeat it are connected and each returned; rows without doc_id follow
the rows of equal set, if any, and have a null component_id otherwise; extra columns are not used; an empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .kernels import mix, set_key, shingle_lists, shingle_sets
from .workspace import Workspace

WORDS = 5
LEAST = 75  # hundredths
CELLS = 4
COUNTERS = 1 << 22  # cells in which all shingles of all texts are counted, for the order
COUNT_BLOCK = 1 << 16
SHARED = 6  # shingles that the prefixes of a pair must share where the larger set has LARGE or more
LARGE, NEARLY_LARGE = 16, 12  # a set of LARGE can only link with sets of NEARLY_LARGE or more
HELD = 1 << 21  # shingles that a task counts at once
CARRIED = 1024  # shingles of a set up to which its sketch, of 512 bytes at most, travels with its frequent shingles
SALTS = 16

SIGNED = "doc_id long, n_shingles long, k1 long, k2 long, cells array<long>, sketch binary, block int"


def parity_sketch(s: np.ndarray, cells: int = 2) -> bytes:
    """A bit for each of cells * n cells or more: whether an odd number of the n elements falls into it.

    More cells rule out more pairs that only just miss the threshold.  Two sets' sketches differ in at most as many bits as the sets differ in elements; a longer sketch folds onto
    a shorter one by exclusive or of its halves.
    """
    m = max(64, 1 << (cells * len(s) - 1).bit_length()) if len(s) else 64
    odd = np.bincount((s & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def parity_sketches(flat: np.ndarray, begin: np.ndarray, cells: int = 2) -> pa.Array:
    """parity_sketch() of each of the sets flat[begin[i]:begin[i + 1]]."""
    n = np.diff(begin)
    m = np.array([max(64, 1 << (cells * x - 1).bit_length()) if x else 64 for x in n.tolist()], np.int64)
    at = np.concatenate(([0], np.cumsum(m)))
    cell = (flat & np.repeat(m - 1, n).astype(np.uint64)).astype(np.int64) + np.repeat(at[:-1], n)
    bits = np.packbits((np.bincount(cell, minlength=at[-1]) & 1).astype(np.uint8), bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((at // 8).astype(np.int32)), pa.py_buffer(bits)])


def sketch_distance(a: bytes, b: bytes) -> int:
    """A lower bound of the size of the symmetric difference of two sets."""
    if len(a) < len(b):
        a, b = b, a
    x, y, bits = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * len(a)
    while bits > 8 * len(b):
        bits //= 2
        x = (x >> bits) ^ (x & ((1 << bits) - 1))
    return (x ^ y).bit_count()


def _signatures(k: int):
    """A row for each text, and from each task the blocks of its counters (block is null for texts)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "k1", "k2", "cells", "sketch", "block"]
        seeds = mix(np.arange(1, CELLS + 1, dtype=np.uint64) * np.uint64(0x51ED270B))
        counts = np.zeros(COUNTERS, np.uint32)
        held, size = [], 0
        for batch in batches:
            n, keys, cells, sketches = [], [], [], []
            for s in shingle_sets(batch["text"], k):
                n.append(len(s))
                keys.append(set_key(s) if len(s) else (0, 0))
                cells.append([int(mix(s ^ seed).min().view(np.int64)) for seed in seeds] if len(s) else [])
                sketches.append(parity_sketch(s))
                held.append(s)
                size += len(s)
                if size >= HELD:
                    counts += np.bincount((np.concatenate(held) & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array([a for a, _ in keys], pa.int64()), pa.array([b for _, b in keys], pa.int64()), pa.array(cells, pa.list_(pa.int64())), pa.array(sketches, pa.binary()), pa.nulls(len(n), pa.int32())], names)
        if held:
            counts += np.bincount((np.concatenate(held) & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
        blocks, at = _blocks(counts)
        none = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.nulls(len(at), pa.list_(pa.int64())), blocks, at], names)

    return task


def _blocks(counts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    blocks = [zlib.compress(x.tobytes(), 1) for x in counts.reshape(-1, COUNT_BLOCK) if x.any()]
    at = [i for i, x in enumerate(counts.reshape(-1, COUNT_BLOCK)) if x.any()]
    return pa.array(blocks, pa.binary()), pa.array(at, pa.int32())


def _counted(k: int):
    """The blocks of each task's counters alone, of texts that need no signatures."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint32)
        held, size = [], 0
        for batch in batches:
            for flat, _ in shingle_lists(batch["text"], k):
                held.append(flat)
                size += len(flat)
                if size >= HELD:
                    counts += np.bincount((np.concatenate(held) & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
                    held, size = [], 0
        if held:
            counts += np.bincount((np.concatenate(held) & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
        yield pa.RecordBatch.from_arrays(list(_blocks(counts)), ["sketch", "block"])

    return task


def _summed(table: pa.Table) -> pa.Table:
    total = np.zeros(COUNT_BLOCK, np.uint32)
    for x in table["sketch"]:
        total += np.frombuffer(zlib.decompress(x.as_py()), np.uint32)
    return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int32()), "sketch": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def shingle_counts(signed: DataFrame) -> np.ndarray:
    """COUNTERS counts over all texts: each shingle's cell holds its frequency and that of those it shares it with.

    The tasks' blocks are summed in two rounds, and what reaches the driver has the counters' size whatever is read.
    """
    blocks = signed.filter("block is not null").select("block", "sketch").withColumn("part", F.pmod(F.xxhash64("sketch"), F.lit(SALTS)))
    once = blocks.groupBy("block", "part").applyInArrow(_summed, "block int, sketch binary")
    counts = np.zeros((COUNTERS // COUNT_BLOCK, COUNT_BLOCK), np.uint32)
    for r in once.groupBy("block").applyInArrow(_summed, "block int, sketch binary").collect():
        counts[r["block"]] = np.frombuffer(zlib.decompress(bytes(r["sketch"])), np.uint32)
    return counts.ravel()


PREFIX = "token long, doc_id long, shape long, root long, sketch binary"


def _prefixes(k: int, least: int, counts):
    """Rows of PREFIX: shape is set size << 32 | place in the order, rare shingles first.

    Rows of shingles that are far more frequent than a counter's share of all shingles carry the set's sketch.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often_from = 4 * int(counts.value.mean()) + 16
        for batch in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
            ids, roots = batch["doc_id"].to_numpy(), batch["root"].to_numpy()
            base = 0
            for s, begin in shingle_lists(batch["text"], k):
                n = np.diff(begin)
                need = np.minimum(n, n - (n * least + 99) // 100 + np.where(n >= NEARLY_LARGE, SHARED, 1))
                often = np.minimum(counts.value[(s & np.uint64(COUNTERS - 1)).astype(np.int64)], (1 << 20) - 1).astype(np.uint64)
                rank = (often << np.uint64(44)) | (s >> np.uint64(20))
                first = [rank[a:b].argsort(kind="stable")[:w] for a, b, w in zip(begin[:-1].tolist(), begin[1:].tolist(), need.tolist(), strict=True)]
                text = np.repeat(np.arange(len(n)), need)
                if len(text):
                    first = np.concatenate(first) + begin[text]
                    known = (often[first] >= often_from) & (n[text] <= CARRIED)
                    carry = np.unique(text[known])  # texts whose sketches travel
                    of = np.repeat(np.isin(np.arange(len(n)), carry), n)
                    sketches = parity_sketches(s[of], np.concatenate(([0], np.cumsum(n[carry]))), 4)
                    sketch = sketches.take(pa.array(np.searchsorted(carry, text), mask=~known))
                    place = np.arange(len(text)) - np.repeat(np.cumsum(need) - need, need)
                    at = base + text
                    root = pa.array(roots[at], mask=roots[at] == ids[at])  # null where a text stands alone
                    yield pa.RecordBatch.from_arrays([pa.array(s[first].view(np.int64)), pa.array(ids[at]), pa.array((n[text] << 32) + place), root, sketch], ["token", "doc_id", "shape", "root", "sketch"])
                base += len(n)

    return task


class Sketches:
    """Lower bounds of the set differences of the rows of one long list, by their sketches; 0 where one is missing."""

    def __init__(self, sketches: list[bytes | None]):
        self.size = np.array([len(x) if x else 0 for x in sketches])
        self.rows = {}
        for c in np.unique(self.size[self.size > 0]).tolist():
            at = np.flatnonzero(self.size >= c)
            place = np.full(len(sketches), -1)
            place[at] = np.arange(len(at))
            folded = [np.bitwise_xor.reduce(np.frombuffer(sketches[i], np.uint8).reshape(-1, c), axis=0) for i in at]
            self.rows[c] = place, np.stack(folded).view(np.uint64)

    def distance(self, i: int, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(j), np.int64)
        size = np.minimum(self.size[i], self.size[j])
        for c in np.unique(size[size > 0]).tolist():
            mine = size == c
            place, bits = self.rows[c]
            out[mine] = np.bitwise_count(bits[place[j[mine]]] ^ bits[place[i]]).sum(axis=1)
        return out


def _met(least: int):
    """(a, b, shared, needed): how many tokens each pair that may reach the threshold shares in this partition."""

    def possible(x, y, n, place, index, root):
        """x is the smaller of each pair: size and place bounds, different roots."""
        both = n[x] + n[y]
        alpha = -((-least * both) // (100 + least)) - np.where(n[y] >= LARGE, SHARED - 1, 0)
        left = np.minimum(n[x] - place[x], n[y] - place[y])
        return (100 * n[x] >= least * n[y]) & index[x] & (left >= alpha) & (root[x] != root[y])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, carried = [], []
        for batch in batches:
            parts.append([batch[c].to_numpy() for c in ("token", "doc_id", "shape")] + [pc.coalesce(batch["root"], batch["doc_id"]).to_numpy()])
            carried.append(batch["sketch"])
        if not parts:
            return
        carried = pa.chunked_array(carried)
        token, doc, shape, root = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        n, place = shape >> 32, shape & 0xFFFFFFFF
        order = np.lexsort((doc, n, token))
        token, doc, n, place, root = (x[order] for x in (token, doc, n, place, root))
        largest_difference = lambda x, y: (n[x] + n[y]) * (100 - least) // (100 + least)
        need = -((-2 * least * n) // (100 + least))  # the common part of a set and a larger one
        index = place < n - need + np.where(n >= NEARLY_LARGE, SHARED, 1)
        begin = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        length = np.diff(np.append(begin, len(token)))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        last = np.repeat(begin + length, length)
        short = np.repeat(length <= 64, length)
        x = np.flatnonzero(short)
        step = 1
        while len(x):  # each row with the one step rows later, while that is of the same token and not too large
            x = x[x + step < last[x]]
            y = x + step
            fits = 100 * n[x] >= least * n[y]
            x, y = x[fits], y[fits]
            ok = possible(x, y, n, place, index, root)
            found.append((x[ok], y[ok]))
            step += 1
        for b, m in zip(begin[length > 64].tolist(), length[length > 64].tolist(), strict=True):
            r = root[b : b + m]
            kinds, count = np.unique(r, return_counts=True)
            if len(kinds) == 1:
                continue
            largest = kinds[count.argmax()]
            sketches = Sketches(carried.take(pa.array(order[b : b + m])).to_pylist())
            for i in (np.flatnonzero(r != largest) + b).tolist():  # at least one of two different roots is not the largest
                j = np.arange(b, b + m)
                j = j[(r == largest) | (j > i)]
                small, large = np.minimum(i, j), np.maximum(i, j)
                ok = (small != large) & possible(small, large, n, place, index, root)
                if ok.any():
                    small, large, j = small[ok], large[ok], j[ok]
                    ok = sketches.distance(i - b, j - b) <= largest_difference(small, large)
                if ok.any():
                    found.append((small[ok], large[ok]))
        if not found:
            return
        x, y = (np.concatenate(z) for z in zip(*found, strict=True))
        if not len(x):
            return
        needed = np.where(n[y] >= LARGE, SHARED, 1)
        x, y = doc[x], doc[y]
        a, b = np.minimum(x, y), np.maximum(x, y)
        order = np.lexsort((b, a))
        a, b, needed = a[order], b[order], needed[order]
        first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        yield pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first]), pa.array(np.diff(np.append(first, len(a)))), pa.array(needed[first])], ["a", "b", "shared", "needed"])

    return task


def _overlaps(k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, total = [], []
            same = batch["text_a"].dictionary_encode()
            one = list(shingle_sets(same.dictionary, k))
            for i, s in zip(same.indices.to_pylist(), shingle_sets(batch["text_b"], k), strict=True):
                shared = len(np.intersect1d(one[i], s, assume_unique=True))
                common.append(shared)
                total.append(len(one[i]) + len(s) - shared)
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(common, pa.int64()), pa.array(total, pa.int64())], ["a", "b", "common", "total"])

    return task


def _may_link(least: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = (batch["n_a"].to_numpy() + batch["n_b"].to_numpy()) * (100 - least) // (100 + least)
            ok = [sketch_distance(a, b) <= most for a, b, most in zip(batch["sketch_a"].to_pylist(), batch["sketch_b"].to_pylist(), n.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return task


def may_link(pairs: DataFrame, sketches: DataFrame, least: int = LEAST) -> DataFrame:
    """The pairs (a, b) that the sketches (id, n, sketch) of their sets do not rule out."""
    one = sketches.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    two = sketches.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(_may_link(least), "a long, b long").distinct()


def overlaps(pairs: DataFrame, texts: DataFrame, k: int = WORDS) -> DataFrame:
    """(a, b, common, total) for pairs (a, b) of keys of texts (doc_id, text); sizes of intersection and union.

    A key that stands in very many pairs is dealt out with salts of its partners.
    """
    salted = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int").alias("salt"))
    wanted = salted.select("a", "salt").distinct()
    one = texts.join(wanted, texts["doc_id"] == wanted["a"]).select("a", "salt", F.col("text").alias("text_a"))
    half = salted.join(one, ["a", "salt"]).select("a", "b", "text_a")
    whole = half.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return whole.select("a", "b", "text_a", "text_b").mapInArrow(_overlaps(k), "a long, b long, common long, total long")


def apart_pairs(rooted: DataFrame, counts, k: int = WORDS, least: int = LEAST) -> DataFrame:
    """Every pair (a, b) of rooted texts (doc_id, text, root) of different roots that may reach the threshold, by prefixes; counts are broadcast."""
    width = int(rooted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = rooted.mapInArrow(_prefixes(k, least, counts), PREFIX).repartition(width, "token").mapInArrow(_met(least), "a long, b long, shared long, needed long")
    return pairs.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("needed").alias("needed")).filter("shared >= needed").select("a", "b")


def similarity_groups(docs: DataFrame, k: int = WORDS, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs (doc_id, text)."""
    spark = docs.sparkSession
    work = Workspace(spark, "jaccard")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = work.keep(plain.mapInArrow(_signatures(k), SIGNED), "signatures")
    rows = signed.filter("block is null").drop("block")
    # texts of equal sets are one class, whose smallest document stands for it
    classes = rows.filter("n_shingles > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("cells").alias("cells"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    classes = work.keep(classes, "classes")
    reps = classes.filter("rep is not null")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = "nightloom_" + work.path.rsplit("-", 1)[1]
    chosen = plain.join(reps.select(F.col("rep").alias("doc_id")).distinct(), "doc_id")
    # kept in buckets by document: pairs are brought to the texts, the texts are shuffled this once
    chosen.write.bucketBy(width, "doc_id").sortBy("doc_id").option("compression", "zstd").option("path", f"{work.path}/texts").saveAsTable(name)
    texts = spark.table(name)

    members = reps.select("rep", F.posexplode("cells").alias("hash", "cell"))
    cells = members.groupBy("hash", "cell").agg(F.min("rep").alias("pivot"), F.count("*").alias("size")).filter("size > 1")
    stars = members.join(cells, ["hash", "cell"]).filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    sketches = reps.select(F.col("rep").alias("id"), "n", "sketch")
    distances = work.keep(overlaps(may_link(stars, sketches, least), texts, k), "distances")
    near = F.lit(100) * F.col("common") >= F.lit(least) * F.col("total")
    inner = distances.filter(near).select("a", "b")
    regions = work.keep(components(inner, work), "regions")

    counts = spark.sparkContext.broadcast(shingle_counts(signed))  # COUNTERS counters
    rooted = texts.join(regions, texts["doc_id"] == regions["id"], "left").select("doc_id", "text", F.coalesce("root", "doc_id").alias("root"))
    pairs = work.keep(apart_pairs(rooted, counts, k, least), "pairs")
    # windows: a pivot that is nearer to one of the two by more than eps keeps them apart
    far = distances.select(F.col("a").alias("pivot"), F.col("b").alias("member"), (1 - F.col("common") / F.col("total")).alias("d"))
    apart = pairs.join(far.select(F.col("member").alias("a"), "pivot", F.col("d").alias("d_a")), "a").join(far.select(F.col("member").alias("b"), "pivot", F.col("d").alias("d_b")), ["b", "pivot"])
    apart = apart.filter(F.abs(F.col("d_a") - F.col("d_b")) > 1 - least / 100 + 1e-9).select("a", "b").distinct()
    known = distances.select("a", "b").union(distances.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = pairs.join(apart.union(known).distinct(), ["a", "b"], "left_anti")
    outer = work.keep(overlaps(may_link(pairs, sketches, least), texts, k).filter(near).select("a", "b"), "links")

    placed = rows.join(classes.select("k1", "k2", "rep"), ["k1", "k2"], "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id")).alias("rep"))
    placed = work.keep(placed, "placed")
    several = placed.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low <> high")
    same = placed.join(several, "doc_id").select(F.col("low").alias("a"), F.col("rep").alias("b"))  # classes that a repeated doc_id holds together
    groups = components(regions.select(F.col("root").alias("a"), F.col("id").alias("b")).union(outer).union(same), work)
    work.only(placed, groups)
    spark.sql(f"drop table {name}")
    work.delete(f"{work.path}/texts")
    counts.destroy()
    return placed.join(groups, placed["rep"] == groups["id"], "left").select("doc_id", "n_shingles", F.coalesce("root", "rep", "doc_id").alias("component_id"))
