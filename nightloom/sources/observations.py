"""Reading and writing observation tables: validity lists, keyword catalogs, header and telemetry scans, JSON, checksums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What telemetry and headers write for a missing number, and the fill value.
MISSING_NUMBERS = ["-nan", "nan", "-999", "-999.0", "", "null", "None"]
#: Catalog datatypes and the Spark types that hold them.
TYPES = {"int": "bigint", "float": "double", "bool": "boolean", "datetime": "timestamp_ntz", "string": "string"}


def read_list(spark: SparkSession, path: str, sep: str = ",", comment: str | None = None, schema: str | None = None) -> DataFrame:
    """A text list kept by hand: header line, blanks around the separator, optional comment lines."""
    reader = spark.read.option("header", True).option("sep", sep).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    if comment:
        reader = reader.option("comment", comment)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_validity(spark: SparkSession, path: str) -> DataFrame:
    """A validity list: row (its order), start, stop and the other columns; times as written, without zone."""
    rows = read_list(spark, path)
    start, stop = rows.columns[1], rows.columns[2]
    return rows.withColumn("row", F.monotonically_increasing_id()).withColumnsRenamed({start: "start", stop: "stop"}).withColumns({"start": F.col("start").cast("timestamp_ntz"), "stop": F.col("stop").cast("timestamp_ntz")})


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """keyword, datatype, description and unit of a table's columns, from a list separated by bars."""
    return read_list(spark, path, "|", schema="keyword string, datatype string, description string, unit string")


def problems_of_catalog(catalog: DataFrame) -> DataFrame:
    """Rows that break the catalog's rules: a blank field, an unknown type, a keyword that stands twice."""
    blank = F.lit(False)
    for c in catalog.columns:
        blank = blank | F.coalesce(F.trim(c) == "", F.lit(True))
    n = catalog.groupBy("keyword").agg(F.count("*").alias("n"))
    rows = catalog.join(n, "keyword")
    what = F.when(blank, "blank field").when(~F.col("datatype").isin(*TYPES), "unknown type").when(F.col("n") > 1, "repeated keyword")
    return rows.select("keyword", what.alias("problem")).filter("problem is not null")


def clean_number(c: Column) -> Column:
    """A number as written in a header; missing marks and what is no number are null."""
    return F.when(~F.trim(c).isin(MISSING_NUMBERS), F.trim(c).try_cast("double"))


def header_columns(headers: DataFrame, key: str, catalog: dict[str, str]) -> DataFrame:
    """One row per observation from a map of keywords to text: typed columns, absent keywords null."""
    made = []
    for keyword, kind in catalog.items():
        raw = F.try_element_at(F.col("header"), F.lit(keyword))
        value = clean_number(raw) if kind == "float" else F.trim(raw).try_cast(TYPES[kind]) if kind != "string" else raw
        made.append(value.alias(keyword))
    return headers.select(key, *made)


def pivoted(long: DataFrame, key: str, name: str, value: str, wanted: list[str]) -> DataFrame:
    """Long telemetry (key, name, value as text) to one column per wanted name; the average of several readings."""
    return long.filter(F.col(name).isin(wanted)).groupBy(key).pivot(name, wanted).agg(F.avg(clean_number(F.col(value))))


def numbered(table: DataFrame, key: str, row: str, columns: list[str], rows: int) -> DataFrame:
    """A table of so many rows per observation to one value per (column, row), named <column><row, two digits>.

    An observation that lacks any of its values has none at all.
    """
    long = table.unpivot([key, row], columns, "column", "value")
    long = long.select(key, F.concat("column", F.lpad(F.col(row).cast("string"), 2, "0")).alias("name"), "value")
    whole = long.groupBy(key).agg((F.count("value") == rows * len(columns)).alias("whole"))
    return long.join(whole, key).select(key, "name", F.when(F.col("whole"), F.col("value")).alias("value"))


def checksums(files: DataFrame, stored: DataFrame, path: str = "path") -> DataFrame:
    """path and whether the digest of the content is the stored one; files as binaryFile gives them."""
    return files.select(path, F.md5("content").alias("digest")).join(stored, path, "left").select(path, "digest", (F.col("digest") == F.col("checksum")).alias("matches"))


def shifted_time(c: Column, hours: float) -> Column:
    """Local times of a logger to UTC."""
    return F.timestamp_add("SECOND", F.lit(int(hours * 3600)), c)


def filtered_map(c: Column, bad: list[str]) -> Column:
    """A map without the entries of bad keys."""
    return F.map_filter(c, lambda k, v: ~k.isin(bad))


def write_report(df: DataFrame, path: str) -> None:
    """A report as JSON lines, one file per partition."""
    df.write.mode("overwrite").json(path)
