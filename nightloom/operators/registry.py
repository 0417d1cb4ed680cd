"""Registering rows: insert or update, delete by date, propagation to derived rows, night windows, staleness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def upsert(stored: DataFrame, incoming: DataFrame, key: list[str], order: str) -> DataFrame:
    """Incoming rows replace stored rows of the same key, column by column where they have a value.

    Of several incoming rows of one key the last by order counts, of equally late ones that with the largest values,
    column by column; a value is larger than none.  Columns that incoming lacks keep their stored values.
    """
    newest = incoming.groupBy(*key).agg(F.max_by(F.struct(*incoming.columns), F.struct(order, *incoming.columns)).alias("_in"))
    both = stored.join(newest, key, "full_outer")
    values = [c for c in stored.columns if c not in key]
    return both.select(*key, *[F.coalesce(F.col(f"_in.{c}"), F.col(c)).alias(c) if c in incoming.columns else F.col(c) for c in values])


def replaced(stored: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Incoming rows take the place of stored rows of the same key as a whole, nulls included; done says new, updated or kept.

    incoming has one row per key and the columns of stored.
    """
    rows = F.struct(*stored.columns)
    both = stored.select(*key, rows.alias("_old")).join(incoming.select(*key, rows.alias("_new")), key, "full_outer")
    done = F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "kept").otherwise("updated")
    return both.select(F.coalesce("_new", "_old").alias("_row"), done.alias("done")).select("_row.*", "done")


def replace_date(stored: DataFrame, incoming: DataFrame, date: str, day: Column) -> DataFrame:
    """The stored rows of all other days, and the incoming ones, which are that day's."""
    return stored.filter(~F.col(date).eqNullSafe(day)).unionByName(incoming)


def backfilled(stored: DataFrame, found: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Stored rows whose empty columns take what was found for their key; what is there stays."""
    both = stored.join(found.select(*key, *[F.col(c).alias(f"_f_{c}") for c in columns]), key, "left")
    return both.select(*[F.coalesce(c, f"_f_{c}").alias(c) if c in columns else F.col(c) for c in stored.columns])


def newest_version(spark: SparkSession, path: str, schema, last: int) -> DataFrame:
    """The registry at path as of its newest version up to last; empty where there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    known = spark.read.schema(schema).option("basePath", path).parquet(f"{path}/version=*").select("*", F.regexp_extract("_metadata.file_path", r"version=(\d+)", 1).cast("int").alias("_version"))
    newest = known.filter(F.col("_version") <= last).agg(F.max("_version")).first()[0]
    return spark.createDataFrame([], schema) if newest is None else spark.read.schema(schema).parquet(f"{path}/version={newest}")


def delete_by(tables: dict[str, DataFrame], base: str, key: str, doomed: Column) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables without the rows of doomed base rows, and (table, n_deleted) for each."""
    gone = tables[base].filter(doomed).select(key).distinct()
    counts = None
    for name, df in tables.items():
        n = df.join(gone, key, "left_semi").agg(F.count("*").alias("n_deleted")).select(F.lit(name).alias("table_name"), "n_deleted")
        counts = n if counts is None else counts.unionByName(n)
    return {name: df.join(gone, key, "left_anti") for name, df in tables.items()}, counts


def inherit(derived: DataFrame, parents: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Derived rows take their parent's columns; what has no parent keeps its own."""
    renamed = parents.select(*key, *[F.col(c).alias(f"_p_{c}") for c in columns])
    both = derived.join(renamed, key, "left")
    return both.select(*[F.coalesce(f"_p_{c}", c).alias(c) if c in columns else F.col(c) for c in derived.columns])


def night_window(df: DataFrame, mjd: str, midnight: float, hours_before: float, hours_after: float) -> DataFrame:
    """Rows strictly between so many hours before and after a midnight."""
    return df.filter((F.col(mjd) > midnight - hours_before / 24) & (F.col(mjd) < midnight + hours_after / 24))


def stale(files: DataFrame, stored: DataFrame, key: str, modified: list[str], read: list[str]) -> DataFrame:
    """Keys of which a file is newer than what was read of it; a missing file is older than anything, an unread one newer."""
    both = files.join(stored, key, "left")
    never = F.lit("1000-01-01").cast("timestamp_ntz")
    newer = None
    for m, r in zip(modified, read, strict=True):
        one = F.coalesce(F.col(m), never) > F.coalesce(F.col(r), never)
        newer = one if newer is None else newer | one
    return both.filter(newer).select(key)


def first_of(df: DataFrame, wanted: Column, order: list[str]) -> DataFrame:
    """The first row by order among the wanted ones."""
    return df.filter(wanted).orderBy(*order).limit(1)


def latest_definitions(bits: DataFrame, created: str) -> DataFrame:
    """One row per (bit, definition) with the time it was last made."""
    return bits.groupBy("bit", "definition").agg(F.max(created).alias(created))


def status(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """rows, columns, first, last and number of distinct dates of each table (table, date column)."""
    out = None
    for name, (df, date) in tables.items():
        one = df.agg(F.count("*").alias("n_rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.count_distinct(date).alias("n_dates"))
        one = one.select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"), "first_date", "last_date", "n_dates")
        out = one if out is None else out.unionByName(one)
    return out


def error_messages(lines: DataFrame, line: str, mark: str = "[ERROR]:") -> DataFrame:
    """How often each message stands after the mark, most frequent first."""
    message = F.trim(F.get(F.split(F.col(line), mark.replace("[", r"\[").replace("]", r"\]"), 2), F.lit(1)))
    return lines.filter(F.contains(F.col(line), F.lit(mark))).groupBy(message.alias("message")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "message")


def next_in_type(df: DataFrame, by: list[str], order: list[str], columns: list[str], bucket: Column | None = None) -> DataFrame:
    """Each row with the columns of the row that follows it, as next_<column>; rows without a follower go.

    bucket, which never falls along the order, cuts the rows of a type: each bucket is sorted apart, and what a bucket
    hands to the one before it is its first row.
    """
    key = [*by, "_bucket"]
    rows = df.withColumn("_bucket", F.lit(0) if bucket is None else bucket)
    follower = F.struct(*[F.col(c).alias(f"next_{c}") for c in columns])
    inside = F.lead(follower).over(Window.partitionBy(*key).orderBy(*order))
    if bucket is None:
        return rows.withColumn("_next", inside).filter("_next is not null").select(*df.columns, "_next.*")
    firsts = rows.groupBy(*key).agg(F.min_by(follower, F.struct(*order)).alias("_first"))
    firsts = firsts.withColumn("_after", F.lead("_first").over(Window.partitionBy(*by).orderBy("_bucket")))  # a row for each bucket
    firsts = firsts.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(key)], "_after")
    same = [F.equal_null(F.col(c), F.col(f"_{i}")) for i, c in enumerate(key)]
    out = rows.withColumn("_inside", inside).join(firsts, same).withColumn("_next", F.coalesce("_inside", "_after"))
    return out.filter("_next is not null").select(*df.columns, "_next.*")
