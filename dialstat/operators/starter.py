"""The starter project's two models: an inline constant relation and a filter on it.

They run on fixed literal rows only, so they are library functions with unit
tests rather than catalog queries; the first holds a NULL id, the ready-made
negative fixture of the not-null check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def first_model(spark: SparkSession) -> DataFrame:
    """``select 1 as id union all select null as id``."""
    one = spark.range(1).select(F.lit(1).cast("int").alias("id"))
    null = spark.range(1).select(F.lit(None).cast("int").alias("id"))
    return one.unionByName(null)


def second_model(first: DataFrame) -> DataFrame:
    """``select * from first_model where id = 1``."""
    return first.where(F.col("id") == 1)
