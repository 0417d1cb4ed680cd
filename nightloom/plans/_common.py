"""What the query modules share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class Queries:
    """Collects named queries with the SQL that gives the same rows."""

    def __init__(self):
        self.queries: dict = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def put(f):
            self.queries[name] = f
            if sql:
                self.oracles[name] = sql
            return f

        return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark, name):
    """A folder that driver and executors share; on one machine, where none is set, one inside the warehouse."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    top = top or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
    return f"{top.rstrip('/')}/nightloom-work/{name}-{uuid.uuid4().hex}"
