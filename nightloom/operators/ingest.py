"""Ingest of observations: find what has changed, read it, register it whole, and count what was done.

The same steps serve a date range, a list of ids, a full rescan and the micro-batches of a stream.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import registry


def in_dates(listing: DataFrame, datecode: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows of directories named by eight digits, from first to last, both included; names compare as text."""
    rows = listing.filter(F.col(datecode).rlike(r"^\d{8}$"))
    if first is not None:
        rows = rows.filter(F.col(datecode) >= first)
    return rows if last is None else rows.filter(F.col(datecode) <= last)


def with_ids(listing: DataFrame, ids: DataFrame, key: str, pattern: str | None = None) -> DataFrame:
    """Rows whose key stands in the first column of ids, where that matches the pattern."""
    first = F.trim(F.col(ids.columns[0]))
    wanted = ids.filter(first.rlike(pattern)) if pattern else ids
    return listing.join(wanted.select(first.cast(listing.schema[key].dataType).alias(key)).distinct(), key, "left_semi")


@dataclass
class Ingest:
    """How a registry is kept.

    key names an observation; modified are the listing's file times and read the registry's times of the last
    reading, level by level; extract makes registry rows of listing rows.
    """

    key: str
    modified: list[str]
    read: list[str]
    extract: Callable[[DataFrame], DataFrame]

    def changed(self, listing: DataFrame, stored: DataFrame, force: bool = False) -> DataFrame:
        """Rows of the listing that are to be read: new ones, and ones of which a file is newer; all of them on a forced rescan."""
        if force:
            return listing
        return listing.join(registry.stale(listing, stored.select(self.key, *self.read), self.key, self.modified, self.read), self.key, "left_semi")

    def run(self, listing: DataFrame, stored: DataFrame, force: bool = False) -> DataFrame:
        """The registry afterwards, with done: new, updated or kept."""
        rows = self.extract(self.changed(listing, stored, force))
        return registry.replaced(stored, rows, [self.key])

    def counts(self, registered: DataFrame) -> DataFrame:
        """(done, n): what became of the registry's rows."""
        return registered.groupBy("done").agg(F.count("*").alias("n"))

    def batches(self, spark: SparkSession, path: str, schema) -> Callable[[DataFrame, int], None]:
        """A foreachBatch function that keeps the registry at path, a folder of versions named by their batch.

        A batch that is repeated after a failure starts from the version before it and writes the same one again.
        """

        def each(batch: DataFrame, number: int) -> None:
            before = registry.newest_version(spark, path, schema, number - 1)
            self.run(batch, before).drop("done").write.mode("overwrite").parquet(f"{path}/version={number}")

        return each
