"""Tables written between the steps of an operator, in the folder that the whole cluster shares.

A written table cuts the lineage: when an executor is lost, later steps read the table again instead of
computing everything before it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; on one machine, where that is unset, one inside the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"


BATCH_ROWS = 2000


def bound_batches(spark: SparkSession) -> None:
    """Long texts go to Python in batches of at most BATCH_ROWS rows, where the session has no smaller bound; Spark bounds their bytes itself."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def free_shuffles(spark: SparkSession) -> None:
    """A step's shuffle files go as soon as its table is written, not when the driver happens to collect its garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


class Workspace:
    """One operator run's tables: keep() writes a DataFrame and returns it as read from there."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        bound_batches(spark)
        free_shuffles(spark)
        self.path = f"{shared_folder(spark).rstrip('/')}/nightloom/{name}-{uuid.uuid4().hex}"
        self.count = 0
        self.tables: set[str] = set()

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        to = f"{self.path}/{self.count}-{name}"
        df.write.option("compression", "zstd").parquet(to)
        kept = self.spark.read.schema(df.schema).parquet(to)
        kept._nightloom_path = to
        self.tables.add(to)
        return kept

    def delete(self, at: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.tables.discard(at)

    def drop(self, kept: DataFrame) -> None:
        """Deletes a kept table that nothing reads any more."""
        self.delete(kept._nightloom_path)

    def only(self, *needed: DataFrame) -> None:
        """Deletes all kept tables but those that the result still reads."""
        for at in self.tables - {df._nightloom_path for df in needed}:
            self.delete(at)
