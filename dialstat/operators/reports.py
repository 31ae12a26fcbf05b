"""Reporting queries over the KPI mart (R1-R5, S1-S3) and small relation facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialstat.operators.metrics import exact_mean_of_fixed_point
from dialstat.params import PERFORMANCE_FLOOR

# Float averages of arbitrary doubles are reported at this many places so that
# results do not depend on summation order (partitioning) across runs.
FLOAT_AVG_DECIMALS = 6


def top_segments(kpis: DataFrame, min_contacts: int = 100, k: int = 10) -> DataFrame:
    """Best converting groups with enough volume (a top-k report).

    ``kpi_row_id`` already orders by (rate desc, group key), so it is the tie-break.
    """
    return (
        kpis.where(F.col("total_contacts") >= min_contacts)
        .orderBy(F.col("conversion_rate_pct").desc(), F.col("kpi_row_id").asc())
        .limit(k)
        .select("age_segment", "job", "education_level", "conversion_rate_pct", "total_contacts",
                "successful_contacts")
    )


def monthly_trend(kpis: DataFrame) -> DataFrame:
    """R2: totals and mean group rate per month, in calendar order."""
    return (
        kpis.groupBy("contact_month", "contact_month_num")
        .agg(
            F.sum("total_contacts").alias("total_contacts"),
            F.sum("successful_contacts").alias("total_conversions"),
            exact_mean_of_fixed_point("conversion_rate_pct", 2).alias("avg_conversion_rate"),
        )
        .orderBy(F.col("contact_month_num").asc_nulls_first(), F.col("contact_month"))
        .select("contact_month", "total_contacts", "total_conversions", "avg_conversion_rate")
    )


def weak_segments(kpis: DataFrame, min_contacts: int = 50) -> DataFrame:
    """Very-low-performance groups with volume, largest first."""
    return (
        kpis.where((F.col("performance_segment") == PERFORMANCE_FLOOR) & (F.col("total_contacts") >= min_contacts))
        .orderBy(F.col("total_contacts").desc(), F.col("kpi_row_id"))
        .select("age_segment", "job", "balance_segment", "conversion_rate_pct", "total_contacts",
                "performance_segment")
    )


def roi_by_duration(kpis: DataFrame) -> DataFrame:
    """Conversion and call efficiency per call-duration segment."""
    return (
        kpis.groupBy("call_duration_segment")
        .agg(
            F.sum("total_contacts").alias("total_calls"),
            F.sum("successful_contacts").alias("conversions"),
            exact_mean_of_fixed_point("conversion_rate_pct", 2).alias("avg_conversion_rate"),
            F.round(F.avg("avg_call_duration_min"), FLOAT_AVG_DECIMALS).alias("avg_duration_min"),
            exact_mean_of_fixed_point("conversions_per_call_minute", 4).alias("conversions_per_min"),
        )
        .orderBy(F.col("conversions_per_min").desc_nulls_last(), F.col("call_duration_segment"))
    )


def top_age_segments(kpis: DataFrame, k: int = 5) -> DataFrame:
    """S3: the k age segments with the highest mean group rate."""
    return (
        kpis.groupBy("age_segment")
        .agg(
            F.round(exact_mean_of_fixed_point("conversion_rate_pct", 2), 2).alias("conversion"),
            F.sum("total_contacts").alias("contacts"),
        )
        .orderBy(F.col("conversion").desc(), F.col("age_segment"))
        .limit(k)
    )


def avg_conversion(kpis: DataFrame) -> DataFrame:
    """Global mean group rate, 2 dp."""
    return kpis.agg(F.round(exact_mean_of_fixed_point("conversion_rate_pct", 2), 2).alias("avg_conversion"))


def row_count(df: DataFrame) -> DataFrame:
    """G13 as a one-row relation (not a driver-side number)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def layer_counts(raw: DataFrame, clean: DataFrame, kpis: DataFrame) -> DataFrame:
    """Rows per layer, as one union."""
    return (
        row_count(raw).select(F.lit("contacts_raw").alias("layer"), "row_count")
        .unionByName(row_count(clean).select(F.lit("contacts_clean").alias("layer"), "row_count"))
        .unionByName(row_count(kpis).select(F.lit("campaign_kpis").alias("layer"), "row_count"))
    )


def column_domain(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values, sorted; a relation of any size."""
    return df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct().orderBy("value")

