import datetime as dt

import pytest
from pyspark.sql import functions as F

from dialstat.operators import reports as R
from dialstat.plans import build as B
from dialstat.params import Params
from dialstat.plans.catalog import QUERIES
from dialstat.plans.oracle import ORACLE


def test_ordered_build_writes_layers_and_checks(spark, raw_small):
    ts = dt.datetime(2030, 1, 2, 3, 4, 5)
    res = B.run(spark, raw_small, run_ts=ts, fail_on_error=False)
    assert res.counts["contacts_raw"] == raw_small.count()
    assert res.counts["campaign_kpis"] == B.read_layer(spark, res, "campaign_kpis").count()
    status = {r["check_name"]: r["status"] for r in res.checks}
    assert len(status) == 27
    # the planted dirty source values fail the source checks; staging and mart checks pass
    assert status["src_age_between"] == "fail" and status["src_y_not_null"] == "fail"
    assert all(v == "pass" for k, v in status.items() if not k.startswith("src_"))
    stored = spark.read.parquet(res.paths["dq_failures"])
    assert stored.select("check_name").distinct().count() == sum(1 for v in status.values() if v != "pass")
    loaded = B.read_layer(spark, res, "contacts_raw").select("_dbt_loaded_at").distinct().collect()
    assert [r[0] for r in loaded] == [ts]
    assert B.month_slice(spark, res, 5).where(F.col("contact_month_num") != 5).count() == 0
    fresh = B.freshness(spark, res.paths["contacts_raw"], ts + dt.timedelta(hours=25))
    # the load stamps its rows; the build's own verdict is on the source's times, years before
    assert fresh["status"] == "warn" and res.freshness["status"] == "error"


def loaded_at(raw, ts):
    return raw.withColumn("_dbt_loaded_at", F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"))


def test_stale_source_stops_the_build_before_it_loads(spark, raw_small):
    import os

    from dialstat.session import work_dir

    ts = dt.datetime(2031, 5, 6, 7, 8, 9)
    builds = lambda: {d for d in os.listdir(work_dir(spark, "build")) if d.startswith("20310506")}
    os.makedirs(work_dir(spark, "build"), exist_ok=True)
    before = builds()  # the shared folder may hold builds of other runs
    with pytest.raises(B.CheckFailed, match="stale, 49"):
        B.run(spark, loaded_at(raw_small, ts - dt.timedelta(hours=49)), run_ts=ts, fail_on_error=True)
    assert builds() == before
    with pytest.raises(B.CheckFailed, match="error-severity checks failed"):  # fresh: the checks decide
        B.run(spark, loaded_at(raw_small, ts - dt.timedelta(hours=1)), run_ts=ts, fail_on_error=True)
    assert len(builds() - before) == 1
    with pytest.raises(B.CheckFailed, match="stale"):
        B.run(spark, raw_small, run_ts=ts, fail_on_error=True, stamp_load=False)


def test_names_switch_only_after_the_gates(spark, raw_small):
    from dialstat.operators import quality as Q
    from dialstat.sources import published

    ts = dt.datetime(2031, 1, 1)
    tolerant = Q.graded_checks(severities={c.name: "warn" for c in Q.published_checks() if c.relation == "contacts_raw"})
    source = loaded_at(raw_small, ts)
    go = lambda df, when, checks: B.run_and_publish(spark, df, default_schema="switch", run_ts=when, checks=checks)
    first = go(source.where("_row_id % 2 = 0"), ts, tolerant)
    half = published.read(spark, "switch_marts", "contacts_clean")
    n = half.count()
    assert n == first.counts["contacts_clean"] > 0
    started = published.read(spark, "switch_marts", "campaign_kpis")  # a reader that began before the next build
    kpis = started.count()
    with pytest.raises(B.CheckFailed):  # the published severities: the planted source faults are errors
        go(source, ts + dt.timedelta(hours=1), None)
    assert published.read(spark, "switch_marts", "contacts_clean").count() == n
    second = go(source, ts + dt.timedelta(hours=2), tolerant)
    assert published.read(spark, "switch_marts", "contacts_clean").count() == second.counts["contacts_clean"] > n
    assert started.count() == kpis and half.count() == n
    assert "partition_bucket" not in published.read(spark, "switch_marts", "campaign_kpis").columns
    assert len(published.versions(spark, "switch_marts", "campaign_kpis")) == 2
    assert published.drop_old(spark, "switch_marts", ["campaign_kpis"], keep=1) == [f"campaign_kpis__v_{first.version}"]
    assert published.read(spark, "switch_marts", "campaign_kpis").count() == second.counts["campaign_kpis"]


def test_load_numbers_densely_and_validates_in_the_same_pass(spark, raw_small):
    from dialstat.session import fresh_work_dir

    path, ts = fresh_work_dir(spark, "test_load"), dt.datetime(2030, 1, 1)
    n = B.load_raw(spark, raw_small.withColumn("_row_id", F.col("_row_id") * 10 + 7), path, Params(), ts)
    ids = [r[0] for r in spark.read.parquet(path).select("_row_id").collect()]
    assert n == raw_small.count() and sorted(ids) == list(range(1, n + 1))
    bad = raw_small.withColumn("y", F.when(F.col("_row_id") % 7 == 0, F.lit("maybe")).otherwise(F.col("y")))
    rows = bad.where("y = 'maybe'").count()
    for source, message in ((bad, f"invalid target values in {rows} rows"), (raw_small.limit(0), "dataframe is empty"),
                            (raw_small.drop("job"), "missing columns"),
                            (raw_small.withColumn("age", F.col("age").cast("string")), "wrong type")):
        with pytest.raises(B.CheckFailed, match=message):
            B.load_raw(spark, source, fresh_work_dir(spark, "test_bad"), Params(), ts)


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert len(df.columns) == 49 and df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(ORACLE) == set(QUERIES) and set(QUERIES) <= set(E.queries())


def test_views_hold_what_the_reports_say(spark, raw_small):
    res = B.run(spark, raw_small, run_ts=dt.datetime(2030, 2, 1), store_failures=False)
    B.register_views(spark, res)
    raw, clean, mart = (spark.table(n) for n in ("contacts_raw", "contacts_clean", "campaign_kpis"))
    assert raw.count() == res.counts["contacts_raw"] and clean.count() == res.counts["contacts_clean"]
    rows = mart.collect()
    trend = R.monthly_trend(mart).collect()
    assert {r.contact_month: r.total_contacts for r in trend} == {
        m: sum(x.total_contacts for x in rows if x.contact_month == m) for m in {x.contact_month for x in rows}}
    top = R.top_segments(mart, 2).collect()
    best = sorted((x for x in rows if x.total_contacts >= 2), key=lambda x: (-x.conversion_rate_pct, x.kpi_row_id))[:10]
    assert [r.conversion_rate_pct for r in top] == [x.conversion_rate_pct for x in best] and top
    weak = R.weak_segments(mart, 2).collect()
    assert len(weak) == sum(x.total_contacts >= 2 and x.performance_segment == "very_low_performance" for x in rows) > 0
    calls = {r.call_duration_segment: r.total_calls for r in R.roi_by_duration(mart).collect()}
    assert sum(calls.values()) == clean.count()
    mean = sum(x.conversion_rate_pct for x in rows) / len(rows)
    assert abs(R.avg_conversion(mart).first()[0] - mean) < 0.01
    ages = R.top_age_segments(mart).collect()
    assert [r.conversion for r in ages] == sorted((r.conversion for r in ages), reverse=True) and len(ages) == 5


def test_build_leaves_no_intermediate_tables(spark, raw_small):
    import os

    from dialstat.session import work_dir

    before = set(os.listdir(work_dir(spark)))
    B.run(spark, raw_small, run_ts=dt.datetime(2030, 3, 1), store_failures=False)
    assert set(os.listdir(work_dir(spark))) - before <= {"build"}
