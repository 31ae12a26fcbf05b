"""The query catalog: one callable per operator of the inventory, ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through the raw-contacts bridge) over
their whole extent; nothing is sampled, capped or filtered to keep it cheap.
Limits appear only where the limit is the feature (top-k reports, preview).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.functions.keys import surrogate_key
from dialstat.functions.numeric import cents_to_euros as _cents_to_euros
from dialstat.functions.numeric import rate_pct, safe_divide
from dialstat.operators import clean as C
from dialstat.operators import mart as M
from dialstat.operators import quality as Q
from dialstat.operators import reports as R
from dialstat.operators import sketches
from dialstat.operators.metrics import base_metrics as _base_metrics
from dialstat.operators.metrics import enriched_metrics
from dialstat.params import Params
from dialstat.plans import build as B
from dialstat.plans import models as model_builder
from dialstat.plans.models import Model
from dialstat.schema import RAW_SCHEMA
from dialstat.session import fresh_work_dir, prepare, stored
from dialstat.sources import bucketed, footers, positional, published
from dialstat.sources import ingest as I
from dialstat.sources import sinks as S
from dialstat.sources.bridge import contacts_raw
from dialstat.sources.faults import CLEAN_FAULTS, MART_FAULTS, RAW_FAULTS, TEXT_FAULTS, with_faults
from dialstat.sources.tables import read_table

P = Params()
Query = Callable[[SparkSession, str], DataFrame]
COARSE = ("age_segment", "job")
#: Floor of contacts for the reports at the 15-key grain; the published floors suit larger tables.
LOW_FLOOR = 2


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    return contacts_raw(spark, sf)


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return C.contacts_clean(_raw(spark, sf), P)


def _unfiltered(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned and derived columns before the row filter (for per-rule queries), over raw rows with
    planted faults, so that every rule has rows on which it acts."""
    return C.enrich(C.clean_columns(C.rename_contacts(_faulty_raw(spark, sf)), P))


def _faulty_raw(spark: SparkSession, sf: str) -> DataFrame:
    return with_faults(_raw(spark, sf), RAW_FAULTS, "_row_id")


def _faulty_clean(spark: SparkSession, sf: str) -> DataFrame:
    return with_faults(_clean(spark, sf), CLEAN_FAULTS, "row_id")


def _faulty_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return with_faults(_kpis(spark, sf), MART_FAULTS, "kpi_row_id")


def _groups(spark: SparkSession, sf: str) -> DataFrame:
    """The mart's groups without ranks and segments, for reports that use neither."""
    return M.kpi_groups(_clean(spark, sf), P, checkpoint=False)


def _kpis(spark: SparkSession, sf: str) -> DataFrame:
    return M.campaign_kpis(_clean(spark, sf), P)


def _coarse(spark: SparkSession, sf: str, dims=COARSE) -> DataFrame:
    return enriched_metrics(_base_metrics(_clean(spark, sf), dims), P)


def _checks_relations(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The three layers, each written once, as the ordered build does: the checks read stored tables."""
    raw = stored(_raw(spark, sf), "contacts_raw")
    clean = stored(C.contacts_clean(raw, P), "contacts_clean")
    return {"contacts_raw": raw, "contacts_clean": clean,
            "campaign_kpis": stored(M.campaign_kpis(clean, P), "campaign_kpis")}


def _check(name: str) -> Q.Check:
    return next(c for c in Q.published_checks() if c.name == name)


def _dq(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        c = _check(name)
        rel = {"contacts_raw": _raw, "contacts_clean": _faulty_clean, "campaign_kpis": _faulty_kpis}[c.relation](spark, sf)
        return Q.failing_rows(rel, c)
    return run


# ---- 2.1 scans, sources, sinks ----

def scan_contacts(spark, sf):
    return _raw(spark, sf)


def combine_features_target(spark, sf):
    x, y = I.split_features_target(_raw(spark, sf))
    return I.combine_features_target(x, y)


def required_field_nulls(spark, sf):
    return I.required_field_nulls(_raw(spark, sf))


def loaded_row_count(spark, sf):
    raw = _raw(spark, sf)
    path = fresh_work_dir(spark, "contacts_raw")
    S.overwrite_parquet(raw, path)
    return S.loaded_row_count(spark, path)


def csv_export(spark, sf):
    """A5: the raw relation written as CSV with a header and read back with its schema."""
    path = fresh_work_dir(spark, "contacts_raw_csv")
    S.write_csv(_raw(spark, sf), path)
    return S.read_csv(spark, path, RAW_SCHEMA)


def load_preview(spark, sf):
    prepared = I.prepare_for_load(_raw(spark, sf), P.run_ts)
    return I.preview(prepared, 5)


def range_partition_bucket(spark, sf):
    path = fresh_work_dir(spark, "campaign_kpis")
    S.write_range_partitioned(_kpis(spark, sf), path)
    back = spark.read.parquet(path)
    return back.groupBy(S.PARTITION_COL).agg(F.count(F.lit(1)).alias("kpi_rows"))


def dq_failures_all(spark, sf):
    rels = _checks_relations(spark, sf)
    failures = Q.failures_long(rels, Q.published_checks(), Q.KEY_COLUMNS)
    return Q.store_failures(failures, fresh_work_dir(spark, "dq_failures")).select("check_name", "relation", "row_key")


# ---- 2.2 ingest preparation and profiling ----

def ingest_validation(spark, sf):
    return I.validation_report(_faulty_raw(spark, sf))


def stamp_load_ts(spark, sf):
    return I.stamp_load_ts(_raw(spark, sf), P.run_ts).select("_row_id", "_dbt_loaded_at")


def dense_row_id(spark, sf):
    return I.add_dense_row_id(_raw(spark, sf).select("_row_id"), "_row_id", "row_num")


def _as_text(raw: DataFrame) -> DataFrame:
    """The raw relation as a text export would hold it: integers as text, and the
    NULL-bearing duration as float text ('123.0'), as a float column prints."""
    cols = []
    for c in raw.columns:
        if c == "duration":
            cols.append(F.col(c).cast("double").cast("string").alias(c))
        elif c in ("_dbt_loaded_at", "_row_id"):
            cols.append(F.col(c))
        else:
            cols.append(F.col(f"`{c}`").cast("string").alias(c))
    return raw.select(*cols)


def coerce_numeric(spark, sf):
    text = with_faults(_as_text(_raw(spark, sf)), TEXT_FAULTS, "_row_id")
    return I.coerce_numeric(text).select("_row_id", *[F.col(c) for c in I.NUMERIC_COLUMNS])


def coerce_categorical(spark, sf):
    text = _as_text(_raw(spark, sf))
    return I.coerce_categorical(text).select("_row_id", *[F.col(f"`{c}`") for c in I.CATEGORICAL_COLUMNS])


def null_profile(spark, sf):
    return I.null_profile(_raw(spark, sf))


def dataset_shape(spark, sf):
    return I.dataset_shape(_raw(spark, sf))


def null_counts_all(spark, sf):
    return I.null_counts(_raw(spark, sf))


def target_value_counts(spark, sf):
    return I.target_value_counts(_raw(spark, sf))


# ---- 2.3 row-level operators ----

def rename_contacts(spark, sf):
    return C.rename_contacts(_raw(spark, sf))


def _rule(cols):
    def run(spark, sf):
        return _unfiltered(spark, sf).select("row_id", *cols)
    return run


clean_age = _rule(["age"])
clean_job_marital = _rule(["job", "marital_status"])
clean_whitelists = _rule(["education_level", "contact_type", "previous_campaign_outcome"])
clean_booleans = _rule(["has_credit_default", "has_housing_loan", "has_personal_loan", "subscribed"])
clamp_balance = _rule(["account_balance_eur"])
clean_day = _rule(["contact_day"])
clean_month = _rule(["contact_month"])
clean_lower_bounds = _rule(["contact_duration_sec", "num_contacts_campaign", "num_contacts_previous"])
clean_pdays = _rule(["days_since_last_contact"])
bucket_age = _rule(["age", "age_segment"])
bucket_balance = _rule(["account_balance_eur", "balance_segment"])
bucket_duration = _rule(["contact_duration_sec", "call_duration_segment"])
bucket_intensity = _rule(["num_contacts_campaign", "campaign_intensity"])
flag_debt_loan = _rule(["has_debt_indicators", "has_any_loan"])
flag_history = _rule(["was_contacted_before", "recently_contacted", "previous_campaign_success"])
duration_minutes = _rule(["contact_duration_sec", "contact_duration_min"])
month_number = _rule(["contact_month", "contact_month_num"])
month_quarter = _rule(["contact_month", "contact_quarter"])


def quality_filter(spark, sf):
    return _unfiltered(spark, sf).where(C.quality_condition()).select(
        "row_id", "subscribed", "age", "num_contacts_campaign", "contact_month")


def contacts_clean(spark, sf):
    return _clean(spark, sf)


def safe_divide_q(spark, sf):
    return _clean(spark, sf).select(
        "row_id", safe_divide("num_contacts_previous", "days_since_last_contact").alias("previous_per_day"))


def conversion_rates(spark, sf):
    return _coarse(spark, sf).select(*COARSE, "total_contacts", "successful_contacts", "conversion_rate_pct",
                                     "non_conversion_rate_pct")


def rate_helper(spark, sf):
    g = _base_metrics(_clean(spark, sf), ("contact_month",))
    return g.select("contact_month", rate_pct("successful_contacts", "total_contacts", 1).alias("rate_pct_1dp"),
                    rate_pct("unsuccessful_contacts", "total_contacts", 3).alias("non_rate_pct_3dp"))


def conversions_per_minute(spark, sf):
    return _coarse(spark, sf).select(*COARSE, "total_call_duration_sec", "conversions_per_call_minute")


def performance_vs_target(spark, sf):
    return _coarse(spark, sf).select(*COARSE, "conversion_rate_pct", "performance_vs_target")


def performance_segment(spark, sf):
    return _coarse(spark, sf).select(*COARSE, "conversion_rate_pct", "performance_segment")


def efficiency_index(spark, sf):
    return _coarse(spark, sf).select(*COARSE, "avg_contacts_per_client", "efficiency_index")


def contact_quality_index(spark, sf):
    return _coarse(spark, sf).select(*COARSE, "avg_call_duration_min", "contact_quality_index")


def _mart_cols(cols):
    def run(spark, sf):
        return _kpis(spark, sf).select("kpi_row_id", *cols)
    return run


share_in_segment = _mart_cols(["total_contacts", "total_contacts_in_segment", "share_of_contacts_in_segment_pct"])
rate_vs_segment = _mart_cols(["conversion_rate_pct", "avg_conversion_rate_in_segment", "conversion_rate_vs_segment_avg"])
top_performer_flag = _mart_cols(["conversion_rank_by_age", "is_top_performer_in_age_segment"])
kpi_with_segment = _mart_cols(["age_segment", "job", "education_level", "balance_segment", "total_contacts_in_segment",
                               "total_conversions_in_segment", "avg_conversion_rate_in_segment",
                               "best_month_for_segment"])


def cents_to_euros(spark, sf):
    li = read_table(spark, sf, "lineitem")
    cents = F.round(F.col("l_extendedprice") * F.lit(100.0)).cast("long")
    return li.select("l_orderkey", "l_linenumber", cents.alias("price_cents"),
                     _cents_to_euros(cents).alias("price_eur"))


def surrogate_key_q(spark, sf):
    return _clean(spark, sf).select(
        "row_id", surrogate_key(["job", "education_level", "has_credit_default", "contact_day"]).alias("sk"))


def filter_by_id(spark, sf):
    """Equality filter on an upstream model (the starter project's ``id = 1``)."""
    return _clean(spark, sf).where(F.col("row_id") == 1).select("row_id", "age", "job", "subscribed")


def campaign_kpis(spark, sf):
    return _kpis(spark, sf)


# ---- 2.4 aggregations ----

def base_metrics(spark, sf):
    return _base_metrics(_clean(spark, sf))


def pct_previously_contacted(spark, sf):
    return _base_metrics(_clean(spark, sf), ("contact_month",)).select("contact_month", "pct_previously_contacted")


def median_by_group(spark, sf):
    return _base_metrics(_clean(spark, sf), COARSE).select(*COARSE, "median_call_duration_sec", "median_account_balance")


def segment_summary(spark, sf):
    e = M.kpi_groups(_clean(spark, sf), P)
    return M.segment_summary(e)


def column_domain(spark, sf):
    return R.column_domain(_clean(spark, sf), "contact_month")


def row_count(spark, sf):
    return R.row_count(_clean(spark, sf))


def avg_conversion(spark, sf):
    return R.avg_conversion(_groups(spark, sf))


# ---- 2.5 windows ----

def _ranks(col):
    def run(spark, sf):
        e = M.kpi_groups(_clean(spark, sf), P)
        return M.add_ranks(e, P).select(M.SK, "conversion_rate_pct", col)
    return run


rank_by_age = _ranks("conversion_rank_by_age")
rank_by_month = _ranks("conversion_rank_by_month")
conversion_percentile = _ranks("conversion_percentile")
kpi_row_id = _ranks("kpi_row_id")


# ---- 2.7 / 2.8 sorts, top-k, reports ----

def contacts_chronological(spark, sf):
    return C.contacts_chronological(_clean(spark, sf)).select("row_id", "contact_month_num", "contact_day")


def top_segments(spark, sf):
    return R.top_segments(_kpis(spark, sf), LOW_FLOOR)


def top_segments_coarse(spark, sf):
    """S2 at the (age segment, job, education) grain, where groups reach the volume floor."""
    g = enriched_metrics(_base_metrics(_clean(spark, sf), ("age_segment", "job", "education_level")), P)
    return (
        g.where(F.col("total_contacts") >= P.top_segments_min_contacts)
        .orderBy(F.col("conversion_rate_pct").desc(), F.col("age_segment"), F.col("job").asc_nulls_first(),
                 F.col("education_level").asc_nulls_first())
        .limit(10)
        .select("age_segment", "job", "education_level", "conversion_rate_pct", "total_contacts",
                "successful_contacts")
    )


def top_age_segments(spark, sf):
    return R.top_age_segments(_groups(spark, sf))


def monthly_trend(spark, sf):
    return R.monthly_trend(_groups(spark, sf))


def weak_segments(spark, sf):
    return R.weak_segments(_kpis(spark, sf), LOW_FLOOR)


def roi_by_duration(spark, sf):
    return R.roi_by_duration(_groups(spark, sf))


def layer_counts(spark, sf):
    raw = _raw(spark, sf)
    clean = C.contacts_clean(raw, P)
    return R.layer_counts(raw, clean, M.kpi_groups(clean, P, checkpoint=False))


# ---- 2.9 data quality ----

dq_not_null = _dq("src_y_not_null")
dq_unique = _dq("stg_row_id_unique")
dq_unique_combo = _dq("stg_row_id_unique_combo")
dq_accepted_values = _dq("stg_contact_month_accepted_values")
dq_accepted_range = _dq("stg_age_accepted_range")
dq_between = _dq("src_age_between")
dq_rate_logic = _dq("assert_conversion_rate_logic")
dq_no_negative = _dq("assert_no_negative_metrics")
dq_staging_duplicates = _dq("assert_staging_no_duplicates")
dq_total_sum = _dq("assert_total_contacts_sum")


def source_freshness(spark, sf):
    return Q.source_freshness(_raw(spark, sf), P.run_ts, P)


def dq_summary(spark, sf):
    return Q.summarize(_checks_relations(spark, sf), Q.published_checks())


# ---- stored tables, sketches and builds ----

def _stored_mart(spark, sf) -> tuple[DataFrame, str]:
    """The mart written by month ranges, and where."""
    path = fresh_work_dir(spark, "campaign_kpis")
    S.write_range_partitioned(_kpis(spark, sf), path)
    return spark.read.parquet(path), path


def month_rebuild(spark, sf):
    """March made again in a stored mart; the other months' files stay."""
    mart, path = _stored_mart(spark, sf)
    again = stored(mart.where("contact_month_num = 3").drop(S.PARTITION_COL), "march")  # a folder cannot replace itself
    S.replace_ranges(again.withColumn("dbt_run_timestamp", F.lit("rebuilt")), path, [2])
    return spark.read.parquet(path).groupBy(S.PARTITION_COL).agg(
        F.count(F.lit(1)).alias("kpi_rows"), F.count_if(F.col("dbt_run_timestamp") == "rebuilt").alias("rebuilt_rows"))


def kpis_of_quarter(spark, sf):
    """A filter on a joined month table prunes the mart's folders while the query runs."""
    mart, _ = _stored_mart(spark, sf)
    months = stored(_clean(spark, sf).select("contact_month_num", "contact_quarter").distinct(), "months")
    wanted = months.where("contact_quarter = 'Q2'").select((F.col("contact_month_num") - 1).alias("bucket"))
    return mart.join(wanted, mart[S.PARTITION_COL] == wanted["bucket"]).select(
        "kpi_row_id", "contact_month", "total_contacts", "conversion_rate_pct")


def published_view(spark, sf):
    """A build that passes its gates, published under a name of the session catalog."""
    tolerant = Q.graded_checks(severities={c.name: "warn" for c in Q.published_checks() if c.relation == "contacts_raw"})
    B.run_and_publish(spark, _raw(spark, sf), p=replace(P, error_after_hours=10**7), run_ts=P.run_ts, checks=tolerant)
    return published.read(spark, S.schema_name("marts", "campaign", "dev"), "campaign_kpis")


def combine_by_position(spark, sf):
    """Features and target stored apart, the target with rows missing, put side by side by row position."""
    raw = _raw(spark, sf)
    features, target = (fresh_work_dir(spark, n) for n in ("features", "target"))
    S.overwrite_parquet(raw.select("_row_id", *[F.col(f"`{c}`") for c in I.FEATURE_COLUMNS]).orderBy("_row_id"), features)
    S.overwrite_parquet(raw.where("_row_id % 10 <> 0").select("_row_id", "y").orderBy("_row_id").select("y"), target)
    return positional.combine_by_position(spark, features, target)


def kpi_with_segment_bucketed(spark, sf):
    """J1 from two tables stored in buckets of the segment keys: no exchange on either side."""
    e = M.kpi_groups(_clean(spark, sf), P)
    n, own = int(spark.conf.get("spark.sql.shuffle.partitions")), uuid.uuid4().hex[:8]
    keys, database = list(M.SEGMENT_KEYS), S.schema_name("buckets", "campaign", "dev")
    groups, segments = f"{database}.groups_{own}", f"{database}.segments_{own}"
    bucketed.write_bucketed(M.add_ranks(e, P).select("kpi_row_id", *keys), groups, keys, n)
    bucketed.write_bucketed(M.segment_summary(e), segments, keys, n)
    return bucketed.join_buckets(spark, groups, segments, keys).select(
        "kpi_row_id", *keys, "total_contacts_in_segment", "total_conversions_in_segment", "avg_conversion_rate_in_segment",
        "best_month_for_segment")


def _stored_raw(spark, sf) -> str:
    path = fresh_work_dir(spark, "contacts_raw")
    S.overwrite_parquet(footers.with_loaded_us(_raw(spark, sf)), path)
    return path


def footer_row_count(spark, sf):
    return footers.row_count(spark, _stored_raw(spark, sf))


def footer_freshness(spark, sf):
    return footers.freshness(spark, _stored_raw(spark, sf), P.run_ts, P)


def median_sketch(spark, sf):
    """G6 by sketches in one exchange; exact where a group has at most ``sketches.K`` contacts."""
    return sketches.medians(sketches.duration_sketches(_clean(spark, sf), COARSE), COARSE)


def median_rollup(spark, sf):
    """Months rolled up from stored sketches of finer groups, without reading the contacts again."""
    fine = stored(sketches.duration_sketches(_clean(spark, sf), ("contact_month", *COARSE)), "sketches")
    return sketches.medians(sketches.roll_up(fine, ["contact_month"]), ["contact_month"])


def merged_profile(spark, sf):
    """Two loads profiled apart, their stored states merged; the exact part of the profile."""
    raw = stored(_raw(spark, sf), "contacts_raw")
    states = [stored(sketches.profile_state(raw.where(F.col("_row_id") % 2 == k), f"load {k}"), "profile") for k in (0, 1)]
    merged = sketches.merge_profiles(states[0].unionByName(states[1]))
    return sketches.profile(merged).join(merged.select("column_name", F.col("load").alias("loads")), "column_name").select(
        "column_name", "position", "loads", "n_rows", "n_nulls", "null_pct", "least", "greatest")


def dataset_head(spark, sf):
    return I.dataset_head(_raw(spark, sf))


def dq_summary_graded(spark, sf):
    """Q12: a check that only warns, and thresholds below which an error only warns."""
    checks = Q.graded_checks(severities={"src_y_not_null": "warn"},
                             error_above={"src_age_between": 10, "src_campaign_between": 1_000_000_000})
    return Q.summarize(_checks_relations(spark, sf), checks)


def model_build(spark, sf):
    """Q13/A2: layers by declared inputs; the audit's failed checks stop only what hangs on it."""
    by_layer = lambda layer: tuple(c for c in Q.published_checks() if c.relation == layer)
    audit = tuple(replace(_check(f"src_{n}"), name=f"audit_{n}", relation="audited_raw") for n in (
        "age_not_null", "age_between", "y_not_null", "previous_not_null"))
    models = [
        Model("monthly_trend", ("campaign_kpis",), R.monthly_trend),
        Model("campaign_kpis", ("contacts_clean",), lambda clean: M.campaign_kpis(clean, P), by_layer("campaign_kpis"), True),
        Model("audited_targets", ("audited_raw",), I.target_value_counts),
        Model("audited_raw", ("contacts_raw",), lambda raw: raw, audit),
        Model("contacts_clean", ("contacts_raw",), lambda raw: C.contacts_clean(raw, P), by_layer("contacts_clean")),
        Model("contacts_raw", ("source",), lambda source: source),
    ]
    built = model_builder.build(spark, models, fresh_work_dir(spark, "models"), {"source": _raw(spark, sf)})
    return model_builder.outcomes(spark, built)


QUERIES: dict[str, Query] = {
    # 2.1
    "scan_contacts": scan_contacts,
    "combine_features_target": combine_features_target,
    "required_field_nulls": required_field_nulls,
    "loaded_row_count": loaded_row_count,
    "csv_export": csv_export,
    "load_preview": load_preview,
    "range_partition_bucket": range_partition_bucket,
    "dq_failures_all": dq_failures_all,
    # 2.2
    "ingest_validation": ingest_validation,
    "stamp_load_ts": stamp_load_ts,
    "dense_row_id": dense_row_id,
    "coerce_numeric": coerce_numeric,
    "coerce_categorical": coerce_categorical,
    "null_profile": null_profile,
    "dataset_shape": dataset_shape,
    "null_counts_all": null_counts_all,
    "target_value_counts": target_value_counts,
    # 2.3
    "rename_contacts": rename_contacts,
    "clean_age": clean_age,
    "clean_job_marital": clean_job_marital,
    "clean_whitelists": clean_whitelists,
    "clean_booleans": clean_booleans,
    "clamp_balance": clamp_balance,
    "clean_day": clean_day,
    "clean_month": clean_month,
    "clean_lower_bounds": clean_lower_bounds,
    "clean_pdays": clean_pdays,
    "bucket_age": bucket_age,
    "bucket_balance": bucket_balance,
    "bucket_duration": bucket_duration,
    "bucket_intensity": bucket_intensity,
    "flag_debt_loan": flag_debt_loan,
    "flag_history": flag_history,
    "duration_minutes": duration_minutes,
    "month_number": month_number,
    "month_quarter": month_quarter,
    "quality_filter": quality_filter,
    "contacts_clean": contacts_clean,
    "safe_divide": safe_divide_q,
    "conversion_rates": conversion_rates,
    "rate_helper": rate_helper,
    "conversions_per_minute": conversions_per_minute,
    "performance_vs_target": performance_vs_target,
    "performance_segment": performance_segment,
    "efficiency_index": efficiency_index,
    "contact_quality_index": contact_quality_index,
    "share_in_segment": share_in_segment,
    "rate_vs_segment": rate_vs_segment,
    "top_performer_flag": top_performer_flag,
    "cents_to_euros": cents_to_euros,
    "surrogate_key": surrogate_key_q,
    "filter_by_id": filter_by_id,
    "campaign_kpis": campaign_kpis,
    # 2.4
    "base_metrics": base_metrics,
    "pct_previously_contacted": pct_previously_contacted,
    "median_by_group": median_by_group,
    "segment_summary": segment_summary,
    "column_domain": column_domain,
    "row_count": row_count,
    "avg_conversion": avg_conversion,
    # 2.5
    "rank_by_age": rank_by_age,
    "rank_by_month": rank_by_month,
    "conversion_percentile": conversion_percentile,
    "kpi_row_id": kpi_row_id,
    # 2.6
    "kpi_with_segment": kpi_with_segment,
    # 2.7 / 2.8
    "contacts_chronological": contacts_chronological,
    "top_segments": top_segments,
    "top_segments_coarse": top_segments_coarse,
    "top_age_segments": top_age_segments,
    "monthly_trend": monthly_trend,
    "weak_segments": weak_segments,
    "roi_by_duration": roi_by_duration,
    "layer_counts": layer_counts,
    # 2.9
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_unique_combo": dq_unique_combo,
    "dq_accepted_values": dq_accepted_values,
    "dq_accepted_range": dq_accepted_range,
    "dq_between": dq_between,
    "dq_rate_logic": dq_rate_logic,
    "dq_no_negative": dq_no_negative,
    "dq_staging_duplicates": dq_staging_duplicates,
    "dq_total_sum": dq_total_sum,
    "source_freshness": source_freshness,
    "dq_summary": dq_summary,
    # stored tables, sketches and builds
    "month_rebuild": month_rebuild,
    "kpis_of_quarter": kpis_of_quarter,
    "published_view": published_view,
    "combine_by_position": combine_by_position,
    "kpi_with_segment_bucketed": kpi_with_segment_bucketed,
    "footer_row_count": footer_row_count,
    "footer_freshness": footer_freshness,
    "median_sketch": median_sketch,
    "median_rollup": median_rollup,
    "merged_profile": merged_profile,
    "dataset_head": dataset_head,
    "dq_summary_graded": dq_summary_graded,
    "model_build": model_build,
}
