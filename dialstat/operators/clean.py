"""Raw contacts -> clean contacts: rename, clean, derive, filter, order columns.

Every rule is a Catalyst column expression, so the whole stage is one
whole-stage-codegen span after the scan; no shuffle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialstat.functions.numeric import clamp, flag, keep_at_least, keep_between
from dialstat.functions.text import drop_sentinels, norm_text, whitelist, yes_no
from dialstat.params import (
    AGE_SEGMENTS,
    AGE_TOP,
    BALANCE_NEGATIVE,
    BALANCE_SEGMENTS,
    BALANCE_TOP,
    BALANCE_ZERO,
    CONTACT_TYPES,
    DAY_RANGE,
    DURATION_NONE,
    DURATION_SEGMENTS,
    DURATION_TOP,
    DURATION_UNDER_MINUTE,
    EDUCATION_LEVELS,
    INTENSITY_SEGMENTS,
    INTENSITY_SINGLE,
    INTENSITY_TOP,
    MONTHS,
    OUTCOMES,
    QUARTERS,
    RECENT_DAYS,
    UNKNOWN,
    Params,
)
from dialstat.schema import CLEAN_SCHEMA

# Raw name -> clean-stage name.
RENAMES = (
    ("_row_id", "row_id"), ("_dbt_loaded_at", "loaded_at"), ("age", "age"), ("job", "job"),
    ("marital", "marital"), ("education", "education"), ("default", "has_credit_default"),
    ("balance", "balance"), ("housing", "has_housing_loan"), ("loan", "has_personal_loan"),
    ("contact", "contact_type"), ("day_of_week", "contact_day"), ("month", "contact_month"),
    ("duration", "contact_duration_sec"), ("campaign", "num_contacts_campaign"),
    ("pdays", "days_since_last_contact"), ("previous", "num_contacts_previous"),
    ("poutcome", "previous_outcome"), ("y", "subscribed"),
)


def rename_contacts(raw: DataFrame) -> DataFrame:
    """Project and rename the 19 raw columns (``default`` is a reserved word)."""
    return raw.select(*[F.col(f"`{a}`").alias(b) for a, b in RENAMES])


# ---- P2-P10: one expression per cleaned column, over the renamed columns ----

def age_expr(p: Params) -> Column:
    return keep_between("age", p.min_age, p.max_age)


def balance_expr(p: Params) -> Column:
    return clamp("balance", p.min_balance, p.max_balance)


def cleaning_exprs(p: Params) -> dict[str, Column]:
    return {
        "row_id": F.col("row_id"),
        "loaded_at": F.col("loaded_at"),
        "age": age_expr(p),
        "job": drop_sentinels("job"),
        "marital_status": drop_sentinels("marital"),
        "education_level": whitelist("education", EDUCATION_LEVELS),
        "has_credit_default": yes_no("has_credit_default"),
        "account_balance_eur": balance_expr(p),
        "has_housing_loan": yes_no("has_housing_loan"),
        "has_personal_loan": yes_no("has_personal_loan"),
        "contact_type": whitelist("contact_type", CONTACT_TYPES),
        "contact_day": keep_between("contact_day", *DAY_RANGE),
        # No sentinel handling for the month: '' and 'unknown' survive.
        "contact_month": norm_text("contact_month"),
        "contact_duration_sec": keep_at_least("contact_duration_sec", 0),
        "num_contacts_campaign": keep_at_least("num_contacts_campaign", 1),
        "days_since_last_contact": keep_at_least("days_since_last_contact", 0),
        "num_contacts_previous": keep_at_least("num_contacts_previous", 0),
        "previous_campaign_outcome": whitelist("previous_outcome", OUTCOMES),
        "subscribed": yes_no("subscribed"),
    }


def clean_columns(renamed: DataFrame, p: Params) -> DataFrame:
    return renamed.select(*[e.alias(n) for n, e in cleaning_exprs(p).items()])


# ---- P12-P20: derived columns over the cleaned columns ----

def _ranges(x: Column, lead: Column, ranges, top) -> Column:
    """Chained CASE over inclusive ranges and an open top range; anything else is 'unknown'."""
    e = lead
    for lo, hi, label in ranges:
        e = e.when(x.between(lo, hi), label)
    above, label = top
    return e.when(x > above, label).otherwise(UNKNOWN)


def age_segment(c: Column | str = "age") -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return _ranges(x, F.when(x.isNull(), UNKNOWN), AGE_SEGMENTS, AGE_TOP)


def balance_segment(c: Column | str = "account_balance_eur") -> Column:
    # Integer gaps on purpose: 0.5 or 500.5 fall through to 'unknown'.
    x = F.col(c) if isinstance(c, str) else c
    lead = F.when(x.isNull(), UNKNOWN).when(x < 0, BALANCE_NEGATIVE).when(x == 0, BALANCE_ZERO)
    return _ranges(x, lead, BALANCE_SEGMENTS, BALANCE_TOP)


def duration_segment(c: Column | str = "contact_duration_sec") -> Column:
    x = F.col(c) if isinstance(c, str) else c
    short_below, short_label = DURATION_UNDER_MINUTE
    lead = F.when(x.isNull(), UNKNOWN).when(x == 0, DURATION_NONE).when(x < short_below, short_label)
    return _ranges(x, lead, DURATION_SEGMENTS, DURATION_TOP)


def campaign_intensity(c: Column | str = "num_contacts_campaign") -> Column:
    x = F.col(c) if isinstance(c, str) else c
    lead = F.when(x.isNull(), UNKNOWN).when(x == 1, INTENSITY_SINGLE)
    return _ranges(x, lead, INTENSITY_SEGMENTS, INTENSITY_TOP)


def month_number(c: Column | str = "contact_month") -> Column:
    x = F.col(c) if isinstance(c, str) else c
    e = None
    for i, m in enumerate(MONTHS, start=1):
        e = F.when(x == m, F.lit(i)) if e is None else e.when(x == m, F.lit(i))
    return e


def month_quarter(c: Column | str = "contact_month") -> Column:
    x = F.col(c) if isinstance(c, str) else c
    e = None
    for q, months in QUARTERS.items():
        e = F.when(x.isin(list(months)), F.lit(q)) if e is None else e.when(x.isin(list(months)), F.lit(q))
    return e


def duration_minutes(c: Column | str = "contact_duration_sec") -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x / F.lit(60.0), 2)


def derived_exprs() -> dict[str, Column]:
    return {
        "age_segment": age_segment(),
        "balance_segment": balance_segment(),
        "has_debt_indicators": flag((F.col("has_credit_default") == F.lit(True)) | (F.col("account_balance_eur") < 0)),
        "has_any_loan": flag((F.col("has_housing_loan") == F.lit(True)) | (F.col("has_personal_loan") == F.lit(True))),
        "contact_duration_min": duration_minutes(),
        "call_duration_segment": duration_segment(),
        "contact_month_num": month_number(),
        "contact_quarter": month_quarter(),
        "was_contacted_before": flag(F.col("num_contacts_previous") > 0),
        "recently_contacted": flag(F.col("days_since_last_contact").isNotNull() & (F.col("days_since_last_contact") < RECENT_DAYS)),
        "campaign_intensity": campaign_intensity(),
        "previous_campaign_success": flag(F.col("previous_campaign_outcome") == "success"),
    }


def enrich(cleaned: DataFrame) -> DataFrame:
    """SELECT *, derived columns."""
    return cleaned.withColumns(derived_exprs())


def quality_condition() -> Column:
    """Target, age and month present and at least one contact."""
    return (
        F.col("subscribed").isNotNull()
        & F.col("age").isNotNull()
        & (F.col("num_contacts_campaign") >= 1)
        & F.col("contact_month").isNotNull()
    )


def raw_prefilter(raw: DataFrame, p: Params) -> DataFrame:
    """Raw-column predicates implied by :func:`quality_condition`.

    They name stored columns directly, so Parquet statistics and row-group
    skipping can use them; the CASE-based filter after cleaning cannot.
    """
    return raw.where(
        F.col("age").between(p.min_age, p.max_age)
        & (F.col("campaign") >= 1)
        & F.col("month").isNotNull()
        & F.col("y").isNotNull()
    )


def contacts_clean(raw: DataFrame, p: Params | None = None, run_ts: _dt.datetime | None = None) -> DataFrame:
    """The 32-column clean relation (a lazy view: no sort, no write)."""
    p = p or Params()
    ts = run_ts or p.run_ts
    renamed = rename_contacts(raw_prefilter(raw, p))
    enriched = enrich(clean_columns(renamed, p)).where(quality_condition())
    enriched = enriched.withColumn("dbt_updated_at", ts_literal(ts))
    return enriched.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CLEAN_SCHEMA.fields])


def ts_literal(ts: _dt.datetime) -> Column:
    """A run timestamp as a literal, read in the session time zone (not the Python process's)."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def contacts_chronological(clean: DataFrame) -> DataFrame:
    """The view's chronological order, applied at the reader only (row_id breaks ties)."""
    return clean.orderBy(
        F.col("contact_month_num").asc_nulls_first(), F.col("contact_day").asc_nulls_first(), F.col("row_id")
    )
