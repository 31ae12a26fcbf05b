"""The corpus pipeline: documents pass the stages in order, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dialstat.llm import decontaminate, mixing, near_dedup, personal_data, quality_lm
from dialstat.llm.common import read_table, stage

#: Bytes of texts that Spark hands to Python at a time, for the stages' lazy results too (Spark's own limit is 64 MB).
BATCH_BYTES = 4 << 20


def bounded(spark: SparkSession) -> None:
    """Sets the session's limit on Arrow batches: executors keep the memory that large batches once took."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose perplexity under the model of trusted text is within their language's limit."""
    bounded(spark)
    return quality_lm.accept(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least id of each group of documents alike in 80 % of their five-word shingles."""
    bounded(spark)
    return near_dedup.dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without a ten-word window of a benchmark item."""
    bounded(spark)
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind in brackets."""
    bounded(spark)
    return personal_data.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emits each document as often as its source's target asks: the documents' columns and copy."""
    return mixing.mix(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_duplicates),
    ("decontaminate", decontamination),
    ("personal_data", privacy),
    ("mix", mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: The stages are not expressible in SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None
