"""Data-quality checks: each check maps a relation to its failing rows (zero rows = pass).

Checks are data (:class:`Check`); :func:`failing_rows` gives the rows a check
returns, :func:`summarize` evaluates many checks with one aggregate pass per
relation for the row-level ones (``count_if`` per check) and one grouped
aggregate per uniqueness check, and :func:`store_failures` writes failing rows
of the checks that failed under the shared work folder.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialstat.functions.numeric import rate_pct
from dialstat.params import MONTHS, TARGET_VALUES, Params
from dialstat.sources.sinks import write_partitioned

ROW_LEVEL = ("not_null", "accepted_values", "accepted_range", "between", "rate_logic", "no_negative", "total_sum")
GROUPED = ("unique", "unique_combo", "duplicates")

# The columns that must not be negative.
NEGATIVE_GUARDED = ("total_contacts", "successful_contacts", "unsuccessful_contacts", "conversion_rate_pct",
                    "avg_call_duration_min", "avg_contacts_per_client")


@dataclass(frozen=True)
class Check:
    name: str
    relation: str
    kind: str
    columns: tuple[str, ...] = ()
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True
    severity: str = "error"
    # failures up to ``warn_above`` pass; an error check with failures up to ``error_above`` only warns
    warn_above: int = 0
    error_above: int = 0
    show: tuple[str, ...] = field(default=())


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def failing_condition(check: Check) -> Column:
    """Row-level failure predicate; a NULL predicate never counts as a failure."""
    k = check.kind
    if k == "not_null":
        return _c(check.columns[0]).isNull()
    if k == "accepted_values":
        return ~_c(check.columns[0]).isin(list(check.values))
    if k in ("accepted_range", "between"):
        x = _c(check.columns[0])
        ok = None
        if check.min_value is not None:
            ok = (x >= check.min_value) if check.inclusive else (x > check.min_value)
        if check.max_value is not None:
            hi = (x <= check.max_value) if check.inclusive else (x < check.max_value)
            ok = hi if ok is None else ok & hi
        return ~ok
    if k == "rate_logic":
        return F.abs(F.col("conversion_rate_pct") - rate_pct("successful_contacts", "total_contacts")) > 0.01
    if k == "no_negative":
        cond = None
        for c in NEGATIVE_GUARDED:
            e = F.col(c) < 0
            cond = e if cond is None else cond | e
        return cond
    if k == "total_sum":
        return F.col("total_contacts") != (F.col("successful_contacts") + F.col("unsuccessful_contacts"))
    raise ValueError(f"not a row-level check: {k}")


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows the check returns, in the shape of the published test query."""
    k = check.kind
    if k == "accepted_values":
        col = check.columns[0]
        return (
            df.where(failing_condition(check))
            .groupBy(_c(col).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
        )
    if k in ROW_LEVEL:
        out = df.where(failing_condition(check))
        if k == "rate_logic":
            expected = rate_pct("successful_contacts", "total_contacts")
            out = out.select(
                "kpi_row_id", "age_segment", "job", "total_contacts", "successful_contacts", "conversion_rate_pct",
                expected.alias("expected_conversion_rate"),
                F.abs(F.col("conversion_rate_pct") - expected).alias("difference"),
            )
        elif k == "no_negative":
            out = out.select("kpi_row_id", "age_segment", "job", "contact_month", *NEGATIVE_GUARDED)
        elif k == "total_sum":
            out = out.select(
                "kpi_row_id", "age_segment", "job", "contact_month", "total_contacts", "successful_contacts",
                "unsuccessful_contacts",
                (F.col("successful_contacts") + F.col("unsuccessful_contacts")).alias("calculated_total"),
                (F.col("total_contacts") - F.col("successful_contacts") - F.col("unsuccessful_contacts")).alias("difference"),
            )
        elif check.show:
            out = out.select(*[_c(c) for c in check.show])
        return out
    if k == "unique":
        col = check.columns[0]
        return (
            df.where(_c(col).isNotNull())
            .groupBy(_c(col).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1)
        )
    if k == "unique_combo":
        return df.groupBy(*[_c(c) for c in check.columns]).agg(F.count(F.lit(1)).alias("n_records")).where(
            F.col("n_records") > 1
        )
    if k == "duplicates":
        col = check.columns[0]
        return (
            df.groupBy(_c(col))
            .agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1)
            .orderBy(F.col("occurrences").desc(), _c(col))
        )
    raise ValueError(f"unknown check kind: {k}")


def _failure_count_exprs(check: Check) -> Column:
    return F.count_if(F.coalesce(failing_condition(check), F.lit(False))).alias(check.name)


def _by_key(checks: Sequence[Check]) -> dict[tuple[str, ...], list[Check]]:
    """The uniqueness checks by their key columns."""
    out: dict[tuple[str, ...], list[Check]] = {}
    for c in checks:
        if c.kind in GROUPED:
            out.setdefault(c.columns, []).append(c)
    return out


def _repeated(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys found more than once, with their number of rows."""
    return df.groupBy(*[_c(x) for x in cols]).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)


def _all_set(cols: Sequence[str]) -> Column:
    e = _c(cols[0]).isNotNull()
    for x in cols[1:]:
        e = e & _c(x).isNotNull()
    return e


def _row_key(check: Check) -> Column:
    """The text that names a repeated key in the stored failures."""
    if check.kind == "unique_combo":
        return F.concat_ws("|", *[F.coalesce(_c(x).cast("string"), F.lit("_null_")) for x in check.columns])
    return _c(check.columns[0]).cast("string")


def summarize(relations: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Q12: one row per check: (check_name, relation, severity, failures, status).

    Per relation: all row-level checks share ONE aggregate pass (``count_if`` each);
    uniqueness checks on the same key columns (unique / combination / duplicates)
    share ONE grouped aggregate; accepted_values counts failing distinct values
    (the rows that check returns).
    """
    parts: list[DataFrame] = []
    by_rel: dict[str, list[Check]] = {}
    for c in checks:
        by_rel.setdefault(c.relation, []).append(c)
    for rel, rel_checks in by_rel.items():
        df = relations[rel]
        row_checks = [c for c in rel_checks if c.kind in ROW_LEVEL and c.kind != "accepted_values"]
        if row_checks:
            agg = df.agg(*[_failure_count_exprs(c) for c in row_checks])
            stack = ", ".join(f"'{c.name}', `{c.name}`" for c in row_checks)
            parts.append(agg.selectExpr(f"stack({len(row_checks)}, {stack}) as (check_name, failures)"))
        for c in rel_checks:
            if c.kind == "accepted_values":
                parts.append(
                    failing_rows(df, c).agg(F.count(F.lit(1)).alias("failures")).select(
                        F.lit(c.name).alias("check_name"), "failures"
                    )
                )
        for cols, group_checks in _by_key(rel_checks).items():
            counted = _repeated(df, cols).agg(
                *[(F.count_if(_all_set(cols)) if c.kind == "unique" else F.count(F.lit(1))).alias(c.name)
                  for c in group_checks]
            )
            stack = ", ".join(f"'{c.name}', `{c.name}`" for c in group_checks)
            parts.append(counted.selectExpr(f"stack({len(group_checks)}, {stack}) as (check_name, failures)"))
    meta = {c.name: c for c in checks}
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    spark = out.sparkSession
    meta_df = spark.createDataFrame(
        [(c.name, c.relation, c.severity, c.warn_above, c.error_above) for c in meta.values()],
        "check_name string, relation string, severity string, warn_above long, error_above long",
    )
    return (
        out.join(F.broadcast(meta_df), "check_name")
        .select(
            "check_name", "relation", "severity", F.col("failures").cast("long").alias("failures"),
            F.when(F.col("failures") <= F.col("warn_above"), "pass")
            .when((F.col("severity") == "warn") | (F.col("failures") <= F.col("error_above")), "warn")
            .otherwise("fail").alias("status"),
        )
    )


def failures_long(relations: Mapping[str, DataFrame], checks: Sequence[Check], key_cols: Mapping[str, str]) -> DataFrame:
    """Failing rows of every check in one shape: (check_name, relation, row_key).

    Row-level checks of one relation are evaluated in ONE scan: each row carries the
    array of checks it fails, which is exploded; grouped checks on the same key
    columns share one aggregate, whose duplicate keys carry the checks they fail.
    """
    parts = []
    by_rel: dict[str, list[Check]] = {}
    for c in checks:
        by_rel.setdefault(c.relation, []).append(c)
    for rel, rel_checks in by_rel.items():
        df = relations[rel]
        row_checks = [c for c in rel_checks if c.kind in ROW_LEVEL and c.kind != "accepted_values"]
        if row_checks:
            key = F.coalesce(_c(key_cols[rel]).cast("string"), F.lit("_null_"))
            failed = F.filter(
                F.array(*[F.when(F.coalesce(failing_condition(c), F.lit(False)), F.lit(c.name)) for c in row_checks]),
                lambda x: x.isNotNull(),
            )
            parts.append(
                df.select(key.alias("row_key"), failed.alias("__failed"))
                .where(F.size("__failed") > 0)
                .select(F.explode("__failed").alias("check_name"), F.lit(rel).alias("relation"), "row_key")
            )
        for c in rel_checks:
            if c.kind == "accepted_values":
                key = F.coalesce(F.col("value_field").cast("string"), F.lit("_null_"))
                parts.append(failing_rows(df, c).select(
                    F.lit(c.name).alias("check_name"), F.lit(rel).alias("relation"), key.alias("row_key")))
        for cols, group_checks in _by_key(rel_checks).items():
            failed = F.explode(F.filter(
                F.array(*[F.when(_all_set(cols) if c.kind == "unique" else F.lit(True), F.struct(
                    F.lit(c.name).alias("check_name"), _row_key(c).alias("row_key"))) for c in group_checks]),
                lambda x: x.isNotNull()))
            parts.append(_repeated(df, cols).select(failed.alias("__failed")).select(
                "__failed.check_name", F.lit(rel).alias("relation"), "__failed.row_key"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def store_failures(failures: DataFrame, path: str) -> DataFrame:
    """Write failing rows partitioned by check (overwrite) and read them back.

    Rows are dealt by check and rebalanced by size: a check that fails on a large share of the rows is
    written by many tasks, and checks with few failing rows share one.
    """
    write_partitioned(failures, path, "check_name")
    return failures.sparkSession.read.parquet(path)


def source_freshness(raw: DataFrame, as_of: _dt.datetime, p: Params | None = None,
                     loaded_col: str = "_dbt_loaded_at") -> DataFrame:
    """Q11: age of the newest load against ``as_of``: pass / warn (> warn_after) / error (> error_after)."""
    return freshness_status(raw.agg(F.max(loaded_col).alias("max_loaded_at")), as_of, p)


def freshness_status(newest: DataFrame, as_of: _dt.datetime, p: Params | None = None) -> DataFrame:
    """The verdict on one row with ``max_loaded_at`` (no time at all is an error)."""
    p = p or Params()
    as_of_lit = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    age_h = (F.unix_timestamp(as_of_lit) - F.unix_timestamp("max_loaded_at")) / F.lit(3600.0)
    return newest.select("max_loaded_at", age_h.alias("age_hours")).select(
        "max_loaded_at",
        F.round("age_hours", 2).alias("age_hours"),
        F.when(F.col("age_hours").isNull(), "error")
        .when(F.col("age_hours") > p.error_after_hours, "error")
        .when(F.col("age_hours") > p.warn_after_hours, "warn")
        .otherwise("pass")
        .alias("status"),
    )


# ---------------------------------------------------------------------------
# The published test suite: 7 source, 8 staging, 8 mart and 4 singular checks.
# ---------------------------------------------------------------------------
def published_checks() -> list[Check]:
    raw, stg, kpi = "contacts_raw", "contacts_clean", "campaign_kpis"
    return [
        Check("src_age_not_null", raw, "not_null", ("age",)),
        Check("src_age_between", raw, "between", ("age",), min_value=18, max_value=100),
        Check("src_campaign_not_null", raw, "not_null", ("campaign",)),
        Check("src_campaign_between", raw, "between", ("campaign",), min_value=1, max_value=100),
        Check("src_previous_not_null", raw, "not_null", ("previous",)),
        Check("src_y_not_null", raw, "not_null", ("y",)),
        Check("src_y_accepted_values", raw, "accepted_values", ("y",), values=TARGET_VALUES),
        Check("stg_row_id_unique_combo", stg, "unique_combo", ("row_id",)),
        Check("stg_row_id_not_null", stg, "not_null", ("row_id",)),
        Check("stg_row_id_unique", stg, "unique", ("row_id",)),
        Check("stg_age_not_null", stg, "not_null", ("age",)),
        Check("stg_age_accepted_range", stg, "accepted_range", ("age",), min_value=18, max_value=100),
        Check("stg_contact_month_not_null", stg, "not_null", ("contact_month",)),
        Check("stg_contact_month_accepted_values", stg, "accepted_values", ("contact_month",), values=MONTHS),
        Check("stg_subscribed_not_null", stg, "not_null", ("subscribed",)),
        Check("kpi_row_id_unique", kpi, "unique", ("kpi_row_id",)),
        Check("kpi_row_id_not_null", kpi, "not_null", ("kpi_row_id",)),
        Check("kpi_rate_not_null", kpi, "not_null", ("conversion_rate_pct",)),
        Check("kpi_rate_accepted_range", kpi, "accepted_range", ("conversion_rate_pct",), min_value=0, max_value=100),
        Check("kpi_total_not_null", kpi, "not_null", ("total_contacts",)),
        Check("kpi_total_accepted_range", kpi, "accepted_range", ("total_contacts",), min_value=0),
        Check("kpi_successful_not_null", kpi, "not_null", ("successful_contacts",)),
        Check("kpi_successful_accepted_range", kpi, "accepted_range", ("successful_contacts",), min_value=0),
        Check("assert_conversion_rate_logic", kpi, "rate_logic"),
        Check("assert_no_negative_metrics", kpi, "no_negative"),
        Check("assert_staging_no_duplicates", stg, "duplicates", ("row_id",)),
        Check("assert_total_contacts_sum", kpi, "total_sum"),
    ]


def graded_checks(severities: Mapping[str, str] | None = None, warn_above: Mapping[str, int] | None = None,
                  error_above: Mapping[str, int] | None = None) -> list[Check]:
    """The published checks with some severities and thresholds set anew, by check name."""
    severities, warn_above, error_above = severities or {}, warn_above or {}, error_above or {}
    unknown = ({*severities} | {*warn_above} | {*error_above}) - {c.name for c in published_checks()}
    if unknown:
        raise ValueError(f"no such checks: {sorted(unknown)}")
    return [replace(c, severity=severities.get(c.name, c.severity), warn_above=warn_above.get(c.name, c.warn_above),
                    error_above=error_above.get(c.name, c.error_above)) for c in published_checks()]


KEY_COLUMNS = {"contacts_raw": "_row_id", "contacts_clean": "row_id", "campaign_kpis": "kpi_row_id"}
