"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of slots, thousands of them; the bytes of each slot are summed, and a
small versioned table maps slots to shards.  Rebalancing edits that table only: whole slots move, records are
never hashed anew.  A map that exists is used again: its newest version is edited for the slots' present sizes, and
what comes of that is appended as the next version if any slot moved or is new.

Groups are equal texts.  A group may hold a third of all rows, so no group is kept on one shard: its records are
spread over the slots by their ids, and a row that is repeated many times by the numbers of its copies.

Defined results: a null text has no bytes; size is UTF-8 bytes plus 8; a row without doc_id is hashed by its text
alone; rows that repeat doc_id and text are separate records; extra columns are not used; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .workspace import Workspace

SLOTS = 8192
PARTS = 8  # parts of a slot, in which its records are numbered side by side
ALIKE = 64  # copies of one row that are hashed to one place

MAP = "version int, virtual_slot int, shard int, slot_bytes long, slot_rows long"


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, copy, virtual_slot, part for each row; copy numbers the rows that are the same."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"))
    same = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))  # partial sums: no row is repeated in a shuffle
    rows = same.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")
    code = F.xxhash64("doc_id", "text_crc32", "size", F.floor(F.col("copy") / ALIKE))
    return rows.withColumn("virtual_slot", F.pmod(code, F.lit(slots)).cast("int")).withColumn("part", F.pmod(F.shiftright(code, 40), F.lit(PARTS)).cast("int"))


def first_map(sizes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Version 1 of the map from (slot, bytes, rows): heavy slots first, each to the lightest shard so far."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for slot, size, rows in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, shard))
        out.append((1, slot, shard, size, rows))
    return out


def rebalanced(old: list[tuple[int, int, int, int, int]], sizes: list[tuple[int, int, int]], shards: int, slack: float = 0.02) -> list[tuple[int, int, int, int, int]]:
    """The next version of a map for new slot sizes or another number of shards; only overfull shards give slots away.

    Slots of shards that no longer exist move, new slots go to the lightest shard, and then the lightest fitting
    slots leave each shard above (1 + slack) times the mean.
    """
    where = {slot: shard for _, slot, shard, _, _ in old}
    size = {slot: (b, r) for slot, b, r in sizes}
    load = dict.fromkeys(range(shards), 0)
    loose = []
    held: dict[int, list[int]] = {s: [] for s in range(shards)}
    for slot, (b, _) in size.items():
        s = where.get(slot, -1)
        if 0 <= s < shards:
            load[s] += b
            held[s].append(slot)
        else:
            loose.append(slot)
    mean = sum(b for b, _ in size.values()) / shards
    for s in range(shards):
        for slot in sorted(held[s], key=lambda x: (-size[x][0], x)):
            if load[s] <= mean * (1 + slack):
                break
            if load[s] - size[slot][0] >= mean * (1 - slack):
                load[s] -= size[slot][0]
                loose.append(slot)
                where.pop(slot)
    heap = [(b, s) for s, b in load.items()]
    heapq.heapify(heap)
    for slot in sorted(loose, key=lambda x: (-size[x][0], x)):
        b, s = heapq.heappop(heap)
        where[slot] = s
        heapq.heappush(heap, (b + size[slot][0], s))
    version = max((m[0] for m in old), default=0) + 1
    return [(version, slot, where[slot], *size[slot]) for slot in sorted(size)]


def slot_sizes(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(slot, bytes, rows): as many rows as there are slots, whatever the table holds."""
    return [tuple(r) for r in rows.groupBy("virtual_slot").agg(F.sum("size"), F.count("*")).collect()]


def save_map(spark: SparkSession, entries: list[tuple[int, int, int, int, int]], path: str) -> None:
    """Appends one version of the map to the table at path."""
    spark.createDataFrame(entries, MAP).coalesce(1).write.mode("append").parquet(path)


def has_map(spark: SparkSession, path: str) -> bool:
    """Whether any version of a map has been saved at path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at) and not spark.read.schema(MAP).parquet(path).isEmpty()


def load_map(spark: SparkSession, path: str, version: int | None = None) -> list[tuple[int, int, int, int, int]]:
    """A version of the map, by default the newest."""
    table = spark.read.schema(MAP).parquet(path)
    version = version or table.agg(F.max("version")).first()[0]
    return [tuple(r) for r in table.filter(F.col("version") == version).collect()]


def next_map(spark: SparkSession, path: str, sizes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int, int, int]]:
    """The map at path for slots of these sizes: the first one, the newest one, or its next version where slots have to move."""
    if not has_map(spark, path):
        new = first_map(sizes, shards)
    else:
        old = load_map(spark, path)
        new = rebalanced(old, sizes, shards)
        where = {slot: shard for _, slot, shard, _, _ in old}
        if all(where.get(slot) == shard for _, slot, shard, _, _ in new):
            return old
    if new:
        save_map(spark, new, path)
    return new


def shard_documents(docs: DataFrame, shards: int = 24, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, virtual_slot, map_version for each row of docs.

    map_path holds the versions of the map; where there is one, it is used and edited, else the first is made.

    slot numbers the records of a shard from 0 without gaps: the records of a (virtual slot, part) are numbered
    by doc_id, and each such piece starts where the one before it in the shard ends.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "shards")
    rows = work.keep(records(docs, slots), "records")
    path = map_path or f"{work.path}/slot-map"
    table = next_map(spark, path, slot_sizes(rows), shards)
    shard_of = {slot: shard for _, slot, shard, _, _ in table}
    pieces = [tuple(r) for r in rows.groupBy("virtual_slot", "part").agg(F.count("*")).collect()]  # slots * PARTS rows at most
    begin, filled = [], dict.fromkeys(range(shards), 0)
    for slot, part, n in sorted(pieces):
        shard = shard_of[slot]
        begin.append((slot, part, shard, filled[shard]))
        filled[shard] += n
    version = table[0][0] if table else 1
    places = spark.createDataFrame(begin, "virtual_slot int, part int, shard int, begin long").withColumn("map_version", F.lit(version))
    order = Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "text_crc32", "size", "copy")
    placed = rows.withColumn("nth", F.row_number().over(order).cast("long") - 1).join(F.broadcast(places), ["virtual_slot", "part"])  # slots * PARTS rows at most
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("begin") + F.col("nth")).alias("slot"), "virtual_slot", "map_version")
