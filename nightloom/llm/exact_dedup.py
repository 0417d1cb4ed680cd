"""Exact deduplication by composable polynomial fingerprints.

A text's fingerprint is its byte length and three polynomial hashes modulo primes below 2^31.  Hashes compose:
H(ab) = H(a) * B^len(b) + H(b), so the chunks of a huge text are hashed in parallel by different tasks and
combined afterwards.  Texts with equal fingerprints are then compared chunk by chunk, byte for byte.

Defined results: a null text counts as empty; equal means identical after each run of ASCII white space has
become one space; a null doc_id is an ordinary id that sorts last; rows that repeat both doc_id and text are
each returned, one of them kept; extra columns are not used.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import slices
from .workspace import Workspace

PRIMES = np.array([2147483647, 2147483629, 2147483587], np.uint64)
BASES = np.array([1000003019, 1442695041, 1779033703], np.uint64)
CHUNK = 1 << 16  # bytes of a chunk, or up to three less where a character would be cut
HUGE = 1 << 16  # bytes from which a text is hashed chunk by chunk
WHITE = r"[\x20\x09-\x0D]+"


def _powers(n: int) -> np.ndarray:
    """BASES ** 0 .. n-1 modulo PRIMES, by doubling."""
    out = np.ones((len(PRIMES), max(n, 1)), np.uint64)
    for k in range(len(PRIMES)):
        done, step = 1, BASES[k]
        while done < n:
            more = min(done, n - done)
            out[k, done : done + more] = out[k, :more] * step % PRIMES[k]
            step = step * step % PRIMES[k]
            done += more
    return out


def polynomials(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte length, hash under each base, and BASES ** length, for each text."""
    length, hashed, shift = [], [], []
    power = _powers(1 << 12)
    for _, data, offsets in slices(texts):
        n = np.diff(offsets)
        longest = int(n.max(initial=0)) + 1
        if power.shape[1] < longest:
            power = _powers(longest)
        full = n > 0
        place = np.repeat(offsets[1:], n) - 1 - np.arange(len(data))
        value = data.astype(np.uint64) + np.uint64(1)
        h = np.zeros((len(PRIMES), len(n)), np.uint64)
        for k in range(len(PRIMES)):
            # 39-bit products: a text of up to 2^24 bytes sums without overflow, a longer one is reduced first
            product = value * power[k][place]
            if longest > 1 << 24:
                product %= PRIMES[k]
            if full.any():
                h[k, full] = np.add.reduceat(product, offsets[:-1][full]) % PRIMES[k]
        length.append(n)
        hashed.append(h)
        shift.append(power[:, n])
    if not length:
        none = np.zeros((len(PRIMES), 0), np.uint64)
        return np.zeros(0, np.int64), none, none
    return np.concatenate(length), np.concatenate(hashed, 1), np.concatenate(shift, 1)


PART = "doc_id long, text_sha256 string, chunk int, n_bytes long, h array<long>, b array<long>"


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, h, b = polynomials(batch["part"])
        arrays = [batch["doc_id"], batch["text_sha256"], batch["chunk"], pa.array(n)]
        for x in (h, b):
            flat = pa.array(np.ascontiguousarray(x.T.astype(np.int64)).ravel())
            arrays.append(pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * len(PRIMES)), flat))
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_sha256", "chunk", "n_bytes", "h", "b"])


def cut(text: bytes, size: int) -> Iterator[bytes]:
    """The chunks of a UTF-8 text in order, in one pass; no character is cut, and an empty text has one chunk."""
    at = 0
    while len(text) - at > size:
        end = at + size
        while text[end] & 0xC0 == 0x80:
            end -= 1
        yield text[at:end]
        at = end
    yield text[at:]


def normalised(docs: DataFrame) -> DataFrame:
    """(doc_id, huge, text, text_sha256); huge is told by the bytes as they stand, so that a filter on it, which Spark moves to the scan, does not normalise texts."""
    huge = F.coalesce(F.octet_length("text") >= HUGE, F.lit(False))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), huge.alias("huge"), F.regexp_replace(F.coalesce("text", F.lit("")), WHITE, " ").alias("text"))
    # never null, and known not to be: Spark would filter by it before a join and hash each text twice
    return plain.withColumn("text_sha256", F.coalesce(F.sha2("text", 256), F.lit("")))


def chunks(rows: DataFrame, keep: list[str], size: int = CHUNK) -> DataFrame:
    """The columns keep, chunk and part for each chunk of the rows' text; texts that are not huge stay in the JVM as one chunk.

    A huge text that normalising makes short is one chunk as well, so equal texts are cut alike.
    """
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                parts = list(cut(batch["text"][i].as_py().encode("utf-8", "surrogatepass"), size))
                for at in range(0, len(parts), 64):  # a few MB at once, however long the text is
                    some = [p.decode("utf-8", "surrogatepass") for p in parts[at : at + 64]]
                    same = pa.array(np.full(len(some), i))
                    arrays = [*[batch[c].take(same) for c in keep], pa.array(np.arange(at, at + len(some), dtype=np.int32)), pa.array(some, pa.string())]
                    yield pa.RecordBatch.from_arrays(arrays, [*keep, "chunk", "part"])

    whole = rows.filter("not huge").select(*keep, F.lit(0).alias("chunk"), F.col("text").alias("part"))
    return whole.unionByName(rows.filter("huge").select(*keep, "text").mapInArrow(task, f"{kinds}, chunk int, part string"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_sha256, n_bytes, fp array<long>) for each row of docs (doc_id, text)."""
    plain = normalised(docs)
    short = plain.filter("not huge").select("doc_id", "text_sha256", F.lit(0).alias("chunk"), F.col("text").alias("part"))
    done = short.mapInArrow(_hash_chunks, PART).select("doc_id", "text_sha256", "n_bytes", F.col("h").alias("fp"))
    # parts of huge texts are dealt to all tasks, so that one text does not hold one task
    parts = chunks(plain.filter("huge").withColumn("row", F.monotonically_increasing_id()), ["doc_id", "text_sha256", "row"])
    parts = parts.withColumn("text_sha256", F.concat("text_sha256", F.lit(":"), "row")).drop("row").repartition("text_sha256", "chunk")
    folded = parts.mapInArrow(_hash_chunks, PART).groupBy("doc_id", "text_sha256").agg(F.sort_array(F.collect_list(F.struct("chunk", "n_bytes", "h", "b"))).alias("all"))
    prime = F.array(*[F.lit(int(p)) for p in PRIMES])
    start = F.array(*[F.lit(0).cast("long") for _ in PRIMES])
    combined = F.aggregate("all", start, lambda acc, x: F.zip_with(F.zip_with(F.zip_with(acc, x["b"], lambda p, q: p * q), x["h"], lambda p, q: p + q), prime, lambda p, q: p % q))
    huge = folded.select("doc_id", F.split("text_sha256", ":")[0].alias("text_sha256"), F.aggregate("all", F.lit(0).cast("long"), lambda acc, x: acc + x["n_bytes"]).alias("n_bytes"), combined.alias("fp"))
    return done.unionByName(huge)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_bytes for each row of docs (doc_id, text)."""
    spark = docs.sparkSession
    work = Workspace(spark, "exact")
    # equal rows are one record with a count from here on: no group of copies is ever held together
    found = fingerprints(docs).groupBy("doc_id", "text_sha256", "n_bytes", "fp").agg(F.count("*").alias("copies"))
    found = work.keep(found, "fingerprints")
    key = F.struct("n_bytes", "fp")
    groups = found.groupBy(key.alias("key")).agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"), F.count("*").alias("records"), F.max("n_bytes").alias("bytes"))
    groups = work.keep(groups, "groups")
    several = groups.filter("records > 1").select("key", F.col("keep_id").alias("group_id"))
    members = found.select("doc_id", "text_sha256", key.alias("key")).join(several, "key").select("doc_id", "text_sha256", "key")
    members = members.withColumnsRenamed({"doc_id": "m_id", "text_sha256": "m_sha256"})
    texts = normalised(docs).join(members, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_sha256") == F.col("m_sha256")))
    # chunk by chunk, the smallest and largest of a group must be the same bytes; partial results meet, not texts
    seen = chunks(texts.select("key", "huge", "text"), ["key"]).groupBy("key", "chunk").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    clash = work.keep(seen.filter("low <> high").select("key").distinct(), "clashes")
    result = found.select("*", key.alias("key")).join(groups.drop("bytes", "records"), "key")
    if not clash.isEmpty():
        # different texts under one fingerprint: their groups are made from the whole texts instead
        split = texts.join(clash, "key").groupBy("key", "text").agg(F.min("doc_id").alias("real_id"), F.first("text_sha256").alias("text_sha256"))
        count = found.select(key.alias("key"), "text_sha256", "copies").join(clash, "key").groupBy("key", "text_sha256").agg(F.sum("copies").alias("real_size"))
        split = split.drop("text").join(count, ["key", "text_sha256"])
        result = result.join(split, ["key", "text_sha256"], "left")
        result = result.withColumn("keep_id", F.when(F.col("real_size").isNotNull(), F.col("real_id")).otherwise(F.col("keep_id"))).withColumn("group_size", F.coalesce("real_size", "group_size"))
    result = result.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return result.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), kept.alias("kept"), "text_sha256", "n_bytes")
