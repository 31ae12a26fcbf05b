"""J1 without an exchange: two tables stored in buckets of the same keys join bucket by bucket.

Both sides are written once in ``n`` buckets, sorted by the keys, and registered in the session catalog;
every later join (or aggregate) on those keys reads matching buckets side by side. A hot key stays in its
bucket: use it for keys whose largest group fits a task, else the plain join with its skew handling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from dialstat.operators.joins import equi_join
from dialstat.session import fresh_work_dir
from dialstat.sources.published import ensure_database


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], n: int, path: str | None = None) -> DataFrame:
    """Store ``df`` as ``table`` (database.name) in ``n`` buckets of ``keys``; one file a bucket. The stored table."""
    spark = df.sparkSession
    database, name = table.split(".")
    ensure_database(spark, database)
    (df.repartition(n, *keys).write.mode("overwrite").format("parquet").option("path", path or fresh_work_dir(spark, name))
     .bucketBy(n, *keys).sortBy(*keys).saveAsTable(table))
    return spark.table(table)


def join_buckets(spark: SparkSession, left: str, right: str, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Plain-equality join of two tables stored by :func:`write_bucketed` (NULL keys never match)."""
    return equi_join(spark.table(left), spark.table(right), list(keys), how)
