"""Sinks: overwrite loads, CSV export, range-partitioned tables, schema naming."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dialstat.operators.mart import range_bucket
from dialstat.session import remove

PARTITION_COL = "partition_bucket"
#: Shuffled data of one written file of a partitioned table, as Spark measures it.
TARGET_FILE_BYTES = 128 << 20
LEAST_PARTS = 509


def overwrite_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full-overwrite load (WRITE_TRUNCATE)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# Spark's CSV writer trims leading/trailing spaces unless told otherwise; text
# exports must keep values such as ' BUILDING ' exactly.
_CSV_OPTIONS = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str) -> None:
    """A5: CSV with a header (a directory of part files, written in parallel).

    Spaces are kept. NULL is an empty field and '' a quoted empty field, but a CSV
    reader treats both as NULL - the published export, too, writes both empty.
    """
    df.write.mode("overwrite").options(**_CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a CSV export back, with an explicit schema when given (no inference)."""
    reader = spark.read.options(**_CSV_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def loaded_row_count(spark: SparkSession, path: str) -> DataFrame:
    """Row count read back from the written table."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))


@contextmanager
def file_target(spark: SparkSession, target_bytes: int) -> Iterator[None]:
    """Writes started inside the block are split, and small parts merged, towards ``target_bytes`` of shuffled data."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(target_bytes))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def rebalanced(df: DataFrame, by: str) -> DataFrame:
    """Rows dealt by ``by`` for a partitioned write: Spark splits a heavy value over several tasks by its
    measured size and merges light ones, so neither value counts nor row counts are guessed beforehand.

    At least ``LEAST_PARTS`` partitions, so that light values rarely share one with a heavy value and are split with it.
    """
    spark = df.sparkSession
    parts = max(LEAST_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.sql(f"SELECT /*+ REBALANCE({parts}, `{by}`) */ * FROM {{rows}}", rows=df)


def write_partitioned(df: DataFrame, path: str, by: str, target_bytes: int = TARGET_FILE_BYTES, only_present: bool = False) -> None:
    """Overwrite a table with one folder a value of ``by``, in files of about ``target_bytes`` at most.

    A file is at most the target and what one map task holds of the value more (Spark splits between map
    outputs). With ``only_present`` the values that ``df`` holds are replaced and all other folders stay untouched.
    """
    with file_target(df.sparkSession, target_bytes):
        (rebalanced(df, by).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic" if only_present else "static")
         .partitionBy(by).parquet(path))


def write_range_partitioned(
    df: DataFrame, path: str, field: str = "contact_month_num", start: int = 1, end: int = 13, interval: int = 1,
    target_bytes: int = TARGET_FILE_BYTES,
) -> None:
    """Integer range partitioning; NULL and out-of-range values share the
    catch-all (Hive default) partition, the value column still tells them apart."""
    write_partitioned(df.withColumn(PARTITION_COL, range_bucket(field, start, end, interval)), path, PARTITION_COL, target_bytes)


def replace_ranges(
    df: DataFrame, path: str, buckets: Sequence[int], field: str = "contact_month_num", start: int = 1, end: int = 13,
    interval: int = 1, target_bytes: int = TARGET_FILE_BYTES,
) -> None:
    """Rebuild some range buckets of a stored table from ``df``; the other buckets' files are not touched.

    Rows of ``df`` outside ``buckets`` are left out, so a rebuild can be given the whole relation. A bucket without
    rows in ``df`` ends empty: its folder is removed once the others are written. ``df`` must not read the table itself.
    """
    seen, wanted = Observation(), sorted(set(buckets))
    rows = df.withColumn(PARTITION_COL, range_bucket(field, start, end, interval)).where(F.col(PARTITION_COL).isin(wanted))
    counted = rows.observe(seen, *[F.count_if(F.col(PARTITION_COL) == b).alias(f"n{b}") for b in wanted])
    write_partitioned(counted, path, PARTITION_COL, target_bytes, only_present=True)
    for b in wanted:
        if not seen.get[f"n{b}"]:
            remove(df.sparkSession, f"{path}/{PARTITION_COL}={b}")


def schema_name(custom: str | None, default_schema: str, target_name: str) -> str:
    """None -> default; prod -> custom; otherwise default_custom."""
    if custom is None:
        return default_schema
    if target_name == "prod":
        return custom.strip()
    return f"{default_schema}_{custom.strip()}"
