"""Plan properties that matter at scale."""

import re

from dialstat.operators.clean import contacts_clean
from dialstat.session import fresh_work_dir
from dialstat.sources.ingest import read_raw
from tests.conftest import SF_SMALL, no_broadcasts, operators


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clean_stage_pushes_filters_and_prunes(spark, raw_small):
    path = fresh_work_dir(spark, "plan_raw")
    raw_small.write.parquet(path)
    clean = contacts_clean(read_raw(spark, path)).select("row_id", "age_segment")
    plan = _plan(clean)
    assert "PushedFilters: [IsNotNull(age), IsNotNull(campaign), GreaterThanOrEqual(age,18)" in plan
    assert "Exchange" not in plan  # row-level stage: no shuffle
    read = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {f.split(":")[0] for f in read.split(",")} == {"_row_id", "age", "campaign", "month", "y"}


def test_no_python_udfs_in_the_mart(kpis_small):
    plan = _plan(kpis_small)
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert op not in plan


def test_mart_has_no_single_partition_exchange_over_rows(spark, clean_small):
    from dialstat.operators import mart as M

    with no_broadcasts(spark):
        ops = operators(M.campaign_kpis(clean_small))
    alone = [o for o in ops if o.startswith("Exchange") and "SinglePartition" in o]
    assert alone and not any("group_sk" in o or "total_contacts" in o for o in alone)  # histograms of rates only


def test_bridge_history_window_reuses_the_customer_join_partitioning(spark):
    """With broadcasts off (the shape at scale), orders are hash-partitioned on the
    customer key once: the history window reuses the join's partitioning."""
    from dialstat.sources.bridge import contacts_raw

    with no_broadcasts(spark):
        plan = _plan(contacts_raw(spark, SF_SMALL))
    assert "SortMergeJoin" in plan
    assert plan.count("hashpartitioning(o_custkey") == 1, plan


def test_hot_customers_join_apart_and_meet_the_others_once(spark):
    """With hot customers, no exchange by the customer lies above the union of the two parts."""
    from dialstat.sources.bridge import contacts_raw

    with no_broadcasts(spark):
        split = contacts_raw(spark, SF_SMALL, hot_rows=12)
        plan = _plan(split)
        above, below = plan.split("Union", 1)
        assert above.count("Exchange") == 1 and "Exchange hashpartitioning(o_orderkey" in above
        # by the customer alone: the others' window and join, and what numbers the few tiles
        by_customer = re.findall(r"Exchange hashpartitioning\(o_custkey#\d+L, \d+\)", below)
        assert len(by_customer) <= 2, below
        assert "BroadcastHashJoin" in below  # the few hot customers
        whole = contacts_raw(spark, SF_SMALL)
        assert "Union" not in _plan(whole)
        assert split.count() == whole.count() and split.exceptAll(whole).count() == 0
