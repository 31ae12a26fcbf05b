"""Stored tables: file sizes, rebuilt ranges, positions, buckets, footers, sketches, profiles, declared models."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from dialstat.operators import quality as Q
from dialstat.operators import sketches as K
from dialstat.plans import models as M
from dialstat.session import fresh_work_dir
from dialstat.sources import bucketed, footers, positional
from dialstat.sources import sinks as S


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files(path, bucket):
    return {f: os.path.getsize(f) for f in glob.glob(f"{path}/{S.PARTITION_COL}={bucket}/*.parquet")}


@pytest.fixture
def months(spark):
    """200,000 rows, 90 % of them in May, the others over all months and none."""
    return spark.range(0, 200_000, 1, 16).selectExpr(
        "id", "CASE WHEN id % 10 > 0 THEN 5 WHEN id % 13 = 0 THEN NULL ELSE CAST(id / 10 % 12 + 1 AS INT) END AS contact_month_num",
        "md5(CAST(id AS STRING)) AS text")


def test_a_heavy_month_is_written_in_files_of_the_stated_size(spark, months):
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    path, target = fresh_work_dir(spark, "sized"), 1 << 20
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    S.write_range_partitioned(months, path, target_bytes=target)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) == before
    may = files(path, 4)
    assert len(may) > 4 and max(may.values()) < 2 * target
    assert all(len(files(path, b)) <= 2 for b in (0, 1, 2, 3, 5, 6, 7, 8, 9, 10, 11))
    back = spark.read.parquet(path)
    assert back.count() == 200_000 and back.where("contact_month_num IS NULL").select(S.PARTITION_COL).distinct().collect() == [(None,)]


def test_a_heavy_check_is_stored_by_several_tasks(spark):
    rows = spark.range(0, 100_000, 1, 16).selectExpr(
        "CASE WHEN id % 50 = 0 THEN concat('check', id % 7) ELSE 'often' END AS check_name", "'r' AS relation", "md5(CAST(id AS STRING)) AS row_key")
    path = fresh_work_dir(spark, "failures")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(Q, "write_partitioned", lambda df, to, by: S.write_partitioned(df, to, by, 1 << 20))
        back = Q.store_failures(rows, path)
    assert back.count() == 100_000
    assert len(glob.glob(f"{path}/check_name=often/*.parquet")) > 2 and len(glob.glob(f"{path}/check_name=check1/*.parquet")) <= 2


def test_a_rebuilt_month_leaves_the_other_files_alone(spark, months):
    path = fresh_work_dir(spark, "rebuilt")
    S.write_range_partitioned(months, path)
    all_files = lambda: {f: os.path.getmtime(f) for f in glob.glob(f"{path}/{S.PARTITION_COL}=*/*.parquet")}
    before = all_files()
    S.replace_ranges(months.withColumn("text", F.lit("new")), path, [2, 7])
    after = all_files()
    inside = lambda f: f"{S.PARTITION_COL}=2/" in f or f"{S.PARTITION_COL}=7/" in f
    assert {f: t for f, t in before.items() if not inside(f)} == {f: t for f, t in after.items() if not inside(f)}
    assert not {f for f in before if inside(f)} & set(after)
    back = spark.read.parquet(path)
    assert back.count() == 200_000
    assert {r[0] for r in back.where("text = 'new'").select(S.PARTITION_COL).distinct().collect()} == {2, 7}
    assert back.where(f"{S.PARTITION_COL} IN (2, 7) AND text <> 'new'").count() == 0


def test_a_rebuilt_month_without_rows_ends_empty(spark, months):
    path = fresh_work_dir(spark, "emptied")
    S.write_range_partitioned(months, path)
    n = months.where("contact_month_num = 9 OR contact_month_num = 10").count()
    S.replace_ranges(months.where("contact_month_num <> 9"), path, [8, 9])
    back = spark.read.parquet(path)
    assert back.where("contact_month_num = 9").count() == 0 < back.where("contact_month_num = 10").count() < n
    assert back.count() == 200_000 - months.where("contact_month_num = 9").count()


def test_a_joined_month_table_prunes_folders(spark, months):
    path, of = fresh_work_dir(spark, "pruned"), fresh_work_dir(spark, "quarters")
    S.write_range_partitioned(months, path)
    spark.range(12).selectExpr("CAST(id AS INT) AS bucket", "id div 3 AS quarter").write.parquet(of)
    wanted = spark.read.parquet(of).where("quarter = 3")
    mart = spark.read.parquet(path)
    joined = mart.join(wanted, mart[S.PARTITION_COL] == wanted["bucket"])
    assert "dynamicpruning" in plan(joined)
    assert joined.count() == months.where("contact_month_num >= 10").count()


def test_positions_are_dense_over_files_and_short_tables_end_in_nulls(spark):
    left, right = fresh_work_dir(spark, "left"), fresh_work_dir(spark, "right")
    spark.range(0, 5000, 1, 7).selectExpr("id * 3 AS a").write.option("parquet.block.size", 4096).parquet(left)
    spark.range(0, 4321, 1, 3).selectExpr("id * 5 AS b").write.parquet(right)
    rows = positional.combine_by_position(spark, left, right).collect()
    assert sorted((r._position, r.a, r.b) for r in rows) == [(i, i * 3, i * 5 if i < 4321 else None) for i in range(5000)]
    with pytest.raises(ValueError, match="both tables"):
        positional.combine_by_position(spark, left, left)


def test_bucketed_tables_join_without_an_exchange(spark):
    keys = ["k1", "k2"]
    df = spark.range(3000).selectExpr("id", "IF(id % 11 = 0, NULL, id % 7) AS k1", "concat('x', id % 5) AS k2")
    bucketed.write_bucketed(df, "bucket_test.many", keys, 4)
    small = df.groupBy(*keys).count()
    bucketed.write_bucketed(small, "bucket_test.few", keys, 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = bucketed.join_buckets(spark, "bucket_test.many", "bucket_test.few", keys)
        assert "Exchange" not in plan(joined)
        got = sorted((r.id, r["count"]) for r in joined.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    n = {(r.k1, r.k2): r["count"] for r in small.collect()}
    assert got == [(i, None if i % 11 == 0 else n[i % 7, f"x{i % 5}"]) for i in range(3000)]


def test_counts_and_freshness_come_from_footers(spark, raw_small):
    path, as_of = fresh_work_dir(spark, "footers"), dt.datetime(2002, 1, 1)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    footers.with_loaded_us(raw_small).write.parquet(path)
    count, fresh = footers.row_count(spark, path), footers.freshness(spark, path, as_of)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert "PushedAggregation: [COUNT(*)]" in plan(count) and "ReadSchema: struct<count(*):bigint>" in plan(count)
    assert "PushedAggregation: [MAX(_loaded_us)]" in plan(fresh)
    assert count.collect() == [(raw_small.count(),)]
    assert fresh.collect() == Q.source_freshness(raw_small, as_of).collect()
    empty = fresh_work_dir(spark, "footers")
    footers.with_loaded_us(raw_small.limit(0)).write.parquet(empty)
    assert footers.row_count(spark, empty).first()[0] == 0 and footers.freshness(spark, empty, as_of).first().status == "error"


def test_sketched_quantiles_are_exact_when_small_and_near_when_large(spark):
    clean = spark.range(0, 300_000, 1, 8).selectExpr(
        "CASE WHEN id % 100 = 0 THEN concat('small', id % 700) ELSE 'large' END AS g", "id % 3 AS h",
        "IF(id % 17 = 0, NULL, (id * 7919) % 100003) AS contact_duration_sec", "CAST(NULL AS BIGINT) AS account_balance_eur")
    direct = K.duration_sketches(clean, ["g"])
    rolled = K.roll_up(K.duration_sketches(clean, ["g", "h"]), ["g"])
    values = {}
    for r in clean.where("contact_duration_sec IS NOT NULL").select("g", "contact_duration_sec").collect():
        values.setdefault(r.g, []).append(r.contact_duration_sec)
    for state in (direct, rolled):
        for r in K.medians(state, ["g"]).collect():
            v = sorted(values[r.g])
            assert r.median_account_balance is None and r.total_contacts == clean.where(F.col("g") == r.g).count()
            for q, got in ((0.5, r.median_call_duration_sec), (0.25, r.p25_call_duration_sec), (0.9, r.p90_call_duration_sec)):
                at = sum(x <= got for x in v) / len(v)
                if len(v) <= K.K:
                    assert got == v[-int(-q * len(v) // 1) - 1]
                else:
                    assert abs(at - q) < 0.005 and got in v
    assert max(len(v) for v in values.values()) > 10 * K.K
    assert all(len(r[0]) < 100_000 for r in direct.select("sketch_contact_duration_sec").collect())  # bounded state


def test_merged_profiles_equal_the_profile_of_all_rows(spark, raw_small):
    parts = [raw_small.where(F.col("_row_id") % 3 == k) for k in range(3)] + [raw_small.limit(0)]
    states = [K.profile_state(p, f"load{i}") for i, p in enumerate(parts)]
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    got = {r.column_name: r for r in K.profile(K.merge_profiles(both)).collect()}
    want = {r.column_name: r for r in K.profile(K.profile_state(raw_small, "all")).collect()}
    assert list(got) and set(got) == set(raw_small.columns)
    for c in raw_small.columns:
        assert got[c][:7] == want[c][:7], c
        exact = raw_small.agg(F.count_distinct(F.col(f"`{c}`"))).first()[0]
        assert abs(got[c].n_distinct - exact) <= max(1, 0.05 * exact)
    ages = sorted(r[0] for r in raw_small.select("age").collect() if r[0] is not None)
    assert got["age"].median == ages[(len(ages) - 1) // 2] and got["job"].median is None


def chain(spark, log, bad=False):
    def make(name):
        def run(*inputs):
            log.append(name)
            return inputs[0]
        return run
    wrong = Q.Check("never_seven", "b", "accepted_range", ("id",), max_value=6)
    return [M.Model("d", ("b", "c"), make("d")), M.Model("b", ("a",), make("b"), (wrong,) if bad else ()),
            M.Model("c", ("a",), make("c")), M.Model("a", ("source",), make("a")), M.Model("e", ("d",), make("e"))]


def test_models_are_built_in_order_skip_what_fails_and_go_on(spark):
    folder, source, log = fresh_work_dir(spark, "models"), spark.range(10), []
    assert [m.name for m in M.ordered(chain(spark, log), ["source"])] == ["a", "b", "c", "d", "e"]
    out = M.build(spark, chain(spark, log, bad=True), folder, {"source": source})
    assert {n: o.status for n, o in out.items()} == {"a": "built", "b": "failed", "c": "built", "d": "skipped", "e": "skipped"}
    assert out["b"].failed_checks == ["never_seven"] and (out["d"].because, out["e"].because) == ("b", "d") and log == ["a", "b", "c"]
    log.clear()
    out = M.build(spark, chain(spark, log), folder, {"source": source})  # mended: goes on from what is stored
    assert log == ["b", "d", "e"] and out["a"] == M.Outcome("reused", 10) and out["e"].rows == 10
    log.clear()
    assert {o.status for o in M.build(spark, chain(spark, log), folder, {"source": source}).values()} == {"reused"} and not log
    with pytest.raises(ValueError, match="no model makes"):
        M.ordered(chain(spark, log))
    with pytest.raises(ValueError):  # a circle
        M.ordered([M.Model("x", ("y",), lambda y: y), M.Model("y", ("x",), lambda x: x)])


def test_thresholds_and_severities(spark):
    rows = {"r": spark.range(20).selectExpr("id", "IF(id < 5, NULL, id) AS v")}
    status = lambda **k: Q.summarize(rows, [Q.Check("c", "r", "not_null", ("v",), **k)]).first().status
    assert status() == "fail" and status(severity="warn") == "warn"
    assert status(warn_above=5) == "pass" and status(error_above=5) == "warn" and status(error_above=4) == "fail"
    assert status(severity="warn", warn_above=4) == "warn"
    with pytest.raises(ValueError, match="no such checks"):
        Q.graded_checks(severities={"nothing": "warn"})
