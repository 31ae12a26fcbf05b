"""A8, G13, Q11 from file footers: row counts and greatest numbers without reading a column.

Parquet keeps each row group's row count and the extremes of its columns. Spark's columnar reader
answers ``count`` and ``max`` of whole-number and date columns from there when the table is read through its
second interface and nothing is filtered; the work is one footer a file, whatever the table holds.
Times are kept beside the table's own column as whole microseconds (``LOADED_US``), as the reader
gives no extremes of timestamps.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.operators.quality import freshness_status
from dialstat.params import Params

LOADED_US = "_loaded_us"


def with_loaded_us(df: DataFrame, loaded_col: str = "_dbt_loaded_at") -> DataFrame:
    """``df`` with the load time as whole microseconds, for the footers."""
    return df.withColumn(LOADED_US, F.unix_micros(F.col(loaded_col)))


def footer_scan(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet table read so that aggregates without filters come from the footers."""
    name = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(name)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")  # of no effect on other reads
    spark.conf.set(name, ",".join(x for x in before.split(",") if x.strip() != "parquet"))
    try:
        return spark.read.parquet(path)  # the interface is chosen here, not when the query runs
    finally:
        spark.conf.set(name, before)


def row_count(spark: SparkSession, path: str) -> DataFrame:
    """The stored table's row count (no footer with rows: 0)."""
    counted = footer_scan(spark, path).agg(F.count(F.lit(1)).alias("n"))
    none = spark.range(1).select(F.lit(0).cast("long").alias("n"))  # a table without footers has no count at all
    return counted.unionAll(none).agg(F.sum("n").alias("row_count"))


def freshness(spark: SparkSession, path: str, as_of: _dt.datetime, p: Params | None = None) -> DataFrame:
    """Q11 of a table stored with :func:`with_loaded_us`."""
    newest = footer_scan(spark, path).agg(F.max(LOADED_US).alias("us"))
    return freshness_status(newest.select(F.timestamp_micros("us").alias("max_loaded_at")), as_of, p)
