"""Whole observations read by a keyword catalog: all levels, telemetry and velocity tables in one pass of grouped rows.

A scan of files gives long rows, one for each keyword of a header, reading of a telemetry or cell of a table:
(observation, level, extension, keyword, value as text).  The catalog says for each column of the registry where it comes from,
what type it has, and which table of the registry it belongs to.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import loose_boolean
from ..operators.sizes import broadcast_small
from .observations import MISSING_NUMBERS, TYPES, clean_number

#: Levels of products, in the order in which they are made.
LEVELS = ("L0", "2D", "L1", "L2")


@dataclass(frozen=True)
class Keyword:
    """A column of the registry: its name, its type, where it stands, and the table that has it.

    many says what is made of several values of one observation: "last" (by place) for headers, "mean" for telemetry.
    """

    name: str
    kind: str
    level: str
    extension: str
    keyword: str
    table: str
    many: str = "last"


def catalog_of(rows: DataFrame) -> list[Keyword]:
    """Keywords from a catalog table (name, kind, level, extension, keyword, table, many); the catalog is a file kept by hand."""
    found = [Keyword(**r.asDict()) for r in rows.orderBy("table", "name").collect()]
    unknown = {k.kind for k in found} - set(TYPES)
    names = [k.name for k in found]
    if unknown or len(set(names)) < len(names):
        raise ValueError(f"unknown types {sorted(unknown)} or repeated names {sorted({n for n in names if names.count(n) > 1})}")
    return found


def typed(value: Column, kind: str) -> Column:
    """Text as a catalog type: marks of missing values, and what cannot be read as the type, are null."""
    if kind == "float":
        return clean_number(value)
    if kind == "int":
        return clean_number(value).try_cast(TYPES["int"])
    if kind == "bool":
        return loose_boolean(value)
    if kind == "datetime":
        return F.trim(value).try_cast(TYPES["datetime"])
    return F.when(~F.trim(value).isin([m for m in MISSING_NUMBERS if not m.startswith("-9")]), F.trim(value))


def observations(scanned: DataFrame, key: str, catalog: list[Keyword]) -> DataFrame:
    """One row per observation: key, a column for each keyword of the catalog, and has_<level> for each level.

    scanned has key, level, extension, keyword, place and value.  Rows that the catalog does not name are left out
    before anything is grouped, except that they tell that their level is there.  A keyword that stands several times
    has the value of its last place, of equal places the largest text.
    """
    spark = scanned.sparkSession
    wanted = spark.createDataFrame(sorted({(k.level, k.extension, k.keyword) for k in catalog}), "level string, extension string, keyword string")
    named = scanned.join(broadcast_small(wanted.withColumn("_wanted", F.lit(True))), ["level", "extension", "keyword"], "left")
    # a row for each observation leaves a task: its keywords side by side, each with the place it was read at
    value = F.when(F.col("_wanted"), F.col("value"))
    cells = named.select(key, "level", *[F.when(F.col("_wanted"), F.col(c)).alias(f"_{c}") for c in ("extension", "keyword", "place")], value.alias("_value"))
    columns, out = [], []
    for i, k in enumerate(catalog):
        here = (F.col("level") == k.level) & (F.col("_extension") == k.extension) & (F.col("_keyword") == k.keyword)
        if k.many == "mean":
            columns.append(F.avg(F.when(here, clean_number(F.col("_value")))).alias(f"_{i}"))
            out.append(F.col(f"_{i}").alias(k.name))
        else:
            columns.append(F.max(F.when(here, F.struct(F.col("_place").alias("p"), F.col("_value").alias("v")))).alias(f"_{i}"))
            out.append(typed(F.col(f"_{i}.v"), k.kind).alias(k.name))
    there = [F.bool_or(F.col("level") == level).alias(f"has_{level}") for level in LEVELS]
    return cells.groupBy(key).agg(*columns, *there).select(key, *out, *[f"has_{level}" for level in LEVELS])


def tables(wide: DataFrame, key: str, catalog: list[Keyword]) -> dict[str, DataFrame]:
    """The tables of the registry, each with the key and its own columns, from observations()."""
    names = sorted({k.table for k in catalog})
    return {t: wide.select(key, *[k.name for k in catalog if k.table == t]) for t in names}
