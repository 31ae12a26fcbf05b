"""Incremental cleaning of raw contact files with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from dialstat.operators.clean import contacts_clean
from dialstat.params import Params
from dialstat.schema import RAW_SCHEMA


def clean_stream(spark: SparkSession, raw_dir: str, p: Params | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of clean contacts over Parquet files landing in ``raw_dir``.

    The schema is explicit (file streams never infer); the stage has no state,
    so no watermark is needed.
    """
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return contacts_clean(reader.parquet(raw_dir), p)


def start_clean_stream(spark: SparkSession, raw_dir: str, out_dir: str, p: Params | None = None, *,
                       checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append clean rows to a Parquet table; the file sink with its own ``checkpoint`` folder (shared by the
    cluster, one a stream) is exactly-once across restarts and executor loss."""
    writer = (
        clean_stream(spark, raw_dir, p)
        .writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
