"""A4/J2 without a shared key: two stored tables combined by row position, as column-wise concatenation does.

A stored row's position is its place in its file behind the rows of the files before it, in the order of
the files' names. The place comes from the reader (``_metadata.row_index``), the files before it from
row counts per file, so no row is moved to number it and no window runs over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialstat.operators.joins import checked_small
from dialstat.session import stored

POSITION = "_position"


def with_position(spark: SparkSession, path: str, position: str = POSITION) -> DataFrame:
    """The Parquet table at ``path`` with each row's position, counted from 0 without gaps.

    The table of files (one row each) is the only thing numbered in one task; it is broadcast when its
    measured size allows.
    """
    table = spark.read.parquet(path)
    rows = table.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__index"))
    files = stored(rows.groupBy("__file").agg(F.count(F.lit(1)).alias("__rows")), "file_rows")
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets, _ = checked_small(files.select(F.col("__file").alias("__of"), F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before")))
    at = (F.col("__before") + F.col("__index")).alias(position)
    return rows.join(offsets, F.col("__file") == F.col("__of")).select(*[F.col(f"`{c}`") for c in table.columns], at)


def combine_by_position(spark: SparkSession, left_path: str, right_path: str, position: str = POSITION) -> DataFrame:
    """Rows of two stored tables side by side by position; where one table is shorter its columns are NULL."""
    left, right = (with_position(spark, p, position) for p in (left_path, right_path))
    twice = set(left.columns) & set(right.columns) - {position}
    if twice:
        raise ValueError(f"columns in both tables: {sorted(twice)}")
    return left.join(right, position, "full_outer")
