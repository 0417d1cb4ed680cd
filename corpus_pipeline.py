"""A training corpus from documents: toxic documents go, repeated lines go, one of each group of near copies stays,
documents with benchmark items go, and the rest is packed into training sequences.

Each stage takes all rows that the stage before it kept and returns the columns of documents; the last returns the
pieces of the packed sequences.

Defined results: null and empty texts are not toxic, have no lines, are no one's copies and hold no item; they stay,
and the last stage gives them the closing id only.  Rows without doc_id are scored, searched and packed like others,
lose no lines and are no one's copies.  Of rows that repeat doc_id and text one stays after the third stage; rows that
repeat a doc_id with other texts are one document.  Extra columns are kept up to the last stage, whatever they are
called.  Empty tables give an empty result; without labels or benchmark nothing is rejected by them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightloom.llm import decontamination, jaccard_join, line_dedup, packing, toxicity
from nightloom.llm.queries import table, tokenizer_path
from nightloom.llm.workspace import Workspace


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    others = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")  # whatever they are called
    kept = toxicity.score(docs.select("doc_id", "text", others), model, ("text", "row")).filter("predicted = 0")
    return kept.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document, or an earlier place, has; without those left empty by that."""
    return line_dedup.without_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_copy_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies, once; documents without words or id are no one's copies."""
    groups = jaccard_join.similarity_groups(docs)
    copies = groups.filter("component_id < doc_id").select("doc_id").distinct()
    kept = docs.join(copies, "doc_id", "left_anti").select(*docs.columns)
    twice = groups.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1").select("doc_id")
    if twice.isEmpty():
        return kept
    # only rows of repeated ids are compared with each other
    again = kept.join(twice, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return kept.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(again)


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    return packing.pack(docs, tokenizer_path(), ids=False).drop("ids")


STAGES = [("toxicity", toxicity_filter), ("line_dedup", line_filter), ("ngram_jaccard_join", near_copy_filter), ("benchmark_decontamination", benchmark_filter), ("packing", pack)]

#: Training, tokenisation and packing have no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return docs
