"""Explicit schemas of the three relations (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

L, S, B, D, I, T = LongType(), StringType(), BooleanType(), DoubleType(), IntegerType(), TimestampType()

RAW_SCHEMA = StructType([
    StructField("_row_id", L, False),
    StructField("age", L), StructField("job", S), StructField("marital", S), StructField("education", S),
    StructField("default", S), StructField("balance", L), StructField("housing", S), StructField("loan", S),
    StructField("contact", S), StructField("day_of_week", L), StructField("month", S),
    StructField("duration", L), StructField("campaign", L), StructField("pdays", L),
    StructField("previous", L), StructField("poutcome", S), StructField("y", S),
    StructField("_dbt_loaded_at", T, False),
])

CLEAN_SCHEMA = StructType([
    StructField("row_id", L), StructField("loaded_at", T), StructField("age", L),
    StructField("age_segment", S), StructField("job", S), StructField("marital_status", S),
    StructField("education_level", S), StructField("has_credit_default", B),
    StructField("account_balance_eur", L), StructField("balance_segment", S),
    StructField("has_housing_loan", B), StructField("has_personal_loan", B), StructField("has_any_loan", B),
    StructField("has_debt_indicators", B), StructField("contact_type", S), StructField("contact_day", L),
    StructField("contact_month", S), StructField("contact_month_num", I), StructField("contact_quarter", S),
    StructField("contact_duration_sec", L), StructField("contact_duration_min", D),
    StructField("call_duration_segment", S), StructField("num_contacts_campaign", L),
    StructField("campaign_intensity", S), StructField("days_since_last_contact", L),
    StructField("recently_contacted", B), StructField("num_contacts_previous", L),
    StructField("was_contacted_before", B), StructField("previous_campaign_outcome", S),
    StructField("previous_campaign_success", B), StructField("subscribed", B),
    StructField("dbt_updated_at", T),
])

# The columns of the mart, in order.
KPI_COLUMNS = (
    "kpi_row_id", "age_segment", "job", "marital_status", "education_level", "balance_segment",
    "has_any_loan", "has_debt_indicators", "contact_type", "contact_month", "contact_month_num",
    "contact_quarter", "call_duration_segment", "campaign_intensity", "previous_campaign_outcome",
    "was_contacted_before", "total_contacts", "successful_contacts", "unsuccessful_contacts",
    "conversion_rate_pct", "non_conversion_rate_pct", "conversions_per_call_minute",
    "avg_call_duration_sec", "avg_call_duration_min", "median_call_duration_sec",
    "total_call_duration_sec", "avg_contacts_per_client", "max_contacts_to_client", "avg_age",
    "avg_account_balance", "median_account_balance", "pct_previously_contacted",
    "avg_days_since_last_contact", "efficiency_index", "contact_quality_index",
    "conversion_rank_by_age", "conversion_rank_by_month", "conversion_percentile",
    "performance_vs_target", "performance_segment", "is_top_performer_in_age_segment",
    "total_contacts_in_segment", "total_conversions_in_segment", "avg_conversion_rate_in_segment",
    "best_month_for_segment", "share_of_contacts_in_segment_pct", "conversion_rate_vs_segment_avg",
    "dbt_updated_at", "dbt_run_timestamp",
)


def enforce(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns in order, cast to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
