"""Q13: the ordered build - load raw, check sources, clean, check, build the mart, check.

Each layer is written once under the shared work folder (a table the next layer
reads back), so a lost executor never forces recomputation of an earlier layer
and every layer's checks read stored data. An ``error`` check failure stops the
build before the next layer is written; failing rows can be stored (A14).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dialstat.operators import clean as C
from dialstat.operators import mart as M
from dialstat.operators import quality as Q
from dialstat.params import Params
from dialstat.schema import RAW_SCHEMA
from dialstat.session import scratch, work_dir
from dialstat.sources import ingest as I
from dialstat.sources import published
from dialstat.sources import sinks as S


LOADED = "_dbt_loaded_at"


class CheckFailed(RuntimeError):
    pass


@dataclass
class BuildResult:
    paths: dict[str, str]
    counts: dict[str, int] = field(default_factory=dict)
    checks: list[dict] = field(default_factory=list)
    freshness: dict = field(default_factory=dict)
    version: str = ""


def _gate(summary: DataFrame, layer: str, fail_on_error: bool, result: BuildResult) -> None:
    rows = [r.asDict() for r in summary.collect()]  # one row per check (bounded by the check list)
    result.checks.extend(rows)
    failed = [r for r in rows if r["status"] == "fail"]
    if failed and fail_on_error:
        names = ", ".join(f"{r['check_name']}={r['failures']}" for r in failed)
        raise CheckFailed(f"{layer}: error-severity checks failed: {names}")


def load_raw(spark: SparkSession, source: DataFrame, path: str, p: Params, run_ts: _dt.datetime,
             order_key: str | None = "_row_id", gate: Callable[[_dt.datetime | None], None] | None = None) -> int:
    """Entry 1: validate -> stamp, dense ids, coercion -> overwrite load -> row count.

    With ``order_key`` the loaded ``_row_id`` is 1..n in its order. Numbering writes the source's
    rows once, and the validation counts are observed during that write, so the source is not
    read again to validate; nothing is loaded if they fail. The stamp is a literal and generated
    ids are dense, so the REQUIRED fields cannot be NULL. Without ``order_key`` the source's own
    ids are kept and validated first. ``gate`` gets the source's own newest load time (None if it has
    none) before anything is loaded, and may raise.
    """
    newest = F.max(LOADED if LOADED in source.columns else F.lit(None).cast("timestamp")).alias("newest")
    if order_key is None:
        message = I.validate(source)[1]
        prepared = None if message else I.prepare_for_load(source, run_ts)
        counts = {"newest": source.agg(newest).first()["newest"]} if gate and not message else {}
    else:
        message, prepared, counts = I.schema_problem(source), None, {}
        if not message.startswith("missing columns"):
            seen = Observation()
            prepared = I.prepare_for_load(source, run_ts, order_key, observe=(seen, [*I.validation_metrics(), newest]))
            counts = seen.get
            message = I.verdict(counts, message)
    if message:
        raise CheckFailed(f"validation failed: {message}")
    if gate:
        gate(counts["newest"])
    S.overwrite_parquet(prepared, path)
    return S.loaded_row_count(spark, path).first()["row_count"]


def run(
    spark: SparkSession,
    source: DataFrame,
    p: Params | None = None,
    run_ts: _dt.datetime | None = None,
    target_name: str = "dev",
    default_schema: str = "campaign",
    fail_on_error: bool = False,
    store_failures: bool = True,
    stamp_load: bool = True,
    checks: list[Q.Check] | None = None,
) -> BuildResult:
    """Build all layers in dependency order and evaluate the published checks (or ``checks``).

    ``run_ts`` is the time of the load (now, in UTC, unless given); it stamps the rows and names the
    build's folder, which no other build shares. Freshness is judged by the source's own newest load time,
    before anything is loaded: a source older than the error limit stops a build that fails on errors.
    """
    p = p or Params()
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    version = f"{run_ts.strftime('%Y%m%dt%H%M%S')}_{uuid.uuid4().hex[:8]}"
    base = work_dir(spark, "build", version)
    paths = {
        "contacts_raw": f"{base}/{S.schema_name(None, default_schema, target_name)}/contacts_raw",
        "contacts_clean": f"{base}/{S.schema_name('staging', default_schema, target_name)}/contacts_clean",
        "campaign_kpis": f"{base}/{S.schema_name('marts', default_schema, target_name)}/campaign_kpis",
        "dq_failures": f"{base}/{S.schema_name('test_results', default_schema, target_name)}/dq_failures",
    }
    result = BuildResult(paths, version=version)
    checks = Q.published_checks() if checks is None else checks

    def judge_source(newest: _dt.datetime | None) -> None:
        row = spark.createDataFrame([(newest,)], "max_loaded_at timestamp")
        result.freshness = Q.freshness_status(row, run_ts, p).first().asDict()
        if result.freshness["status"] == "error" and fail_on_error:
            raise CheckFailed(f"sources: stale, {result.freshness['age_hours']} hours old")

    if stamp_load:
        with scratch(spark):
            result.counts["contacts_raw"] = load_raw(spark, source, paths["contacts_raw"], p, run_ts, gate=judge_source)
    else:
        judge_source(source.agg(F.max(LOADED)).first()[0])
        S.overwrite_parquet(source.select(*[f.name for f in RAW_SCHEMA.fields]), paths["contacts_raw"])
        result.counts["contacts_raw"] = S.loaded_row_count(spark, paths["contacts_raw"]).first()["row_count"]
    raw = I.read_raw(spark, paths["contacts_raw"])
    rels = {"contacts_raw": raw}
    _gate(Q.summarize(rels, [c for c in checks if c.relation == "contacts_raw"]), "sources", fail_on_error, result)

    # The staging view is lazy in the published model; here it is written once
    # because the mart and four checks read it.
    S.overwrite_parquet(C.contacts_clean(raw, p, run_ts), paths["contacts_clean"])
    clean = spark.read.parquet(paths["contacts_clean"])
    rels["contacts_clean"] = clean
    _gate(Q.summarize(rels, [c for c in checks if c.relation == "contacts_clean"]), "staging", fail_on_error, result)

    with scratch(spark):
        kpis = M.campaign_kpis(clean, Params(**{**p.__dict__, "run_ts": run_ts}))
        S.write_range_partitioned(kpis, paths["campaign_kpis"])
    mart = spark.read.parquet(paths["campaign_kpis"]).drop(S.PARTITION_COL)
    rels["campaign_kpis"] = mart
    _gate(Q.summarize(rels, [c for c in checks if c.relation == "campaign_kpis"]), "marts", fail_on_error, result)

    result.counts["contacts_clean"] = clean.count()
    result.counts["campaign_kpis"] = mart.count()
    if store_failures and any(r["failures"] for r in result.checks):
        failed_names = {r["check_name"] for r in result.checks if r["failures"]}
        failing = Q.failures_long(rels, [c for c in checks if c.name in failed_names], Q.KEY_COLUMNS)
        Q.store_failures(failing, paths["dq_failures"])
    return result


def run_and_publish(spark: SparkSession, source: DataFrame, target_name: str = "dev", default_schema: str = "campaign",
                    **options) -> BuildResult:
    """Build, and only if every gate passes point the public names at the new layers.

    The names live in the database that the schema rule gives the marts; a failed build leaves
    them as they were.
    """
    result = run(spark, source, target_name=target_name, default_schema=default_schema, fail_on_error=True, **options)
    layers = {n: result.paths[n] for n in ("contacts_raw", "contacts_clean", "campaign_kpis")}
    published.publish(spark, S.schema_name("marts", default_schema, target_name), layers, result.version)
    return result


def freshness(spark: SparkSession, raw_path: str, as_of: _dt.datetime, p: Params | None = None) -> dict:
    """Source freshness of a loaded raw table (pass / warn / error)."""
    return Q.source_freshness(I.read_raw(spark, raw_path), as_of, p).first().asDict()


def register_views(spark: SparkSession, result: BuildResult) -> list[str]:
    """A10: expose the built layers as temporary views, so SQL users query them by name
    (``spark.sql("SELECT ... FROM campaign_kpis ...")``)."""
    names = []
    for name in ("contacts_raw", "contacts_clean", "campaign_kpis"):
        read_layer(spark, result, name).createOrReplaceTempView(name)
        names.append(name)
    return names


def read_layer(spark: SparkSession, result: BuildResult, name: str) -> DataFrame:
    df = spark.read.parquet(result.paths[name])
    return df.drop(S.PARTITION_COL) if S.PARTITION_COL in df.columns else df


def month_slice(spark: SparkSession, result: BuildResult, month_num: int) -> DataFrame:
    """Read one month of the mart: the filter on the partition column prunes files."""
    b = month_num - 1
    return spark.read.parquet(result.paths["campaign_kpis"]).where(F.col(S.PARTITION_COL) == b)
