"""The distributed ordinals equal plain windows exactly, including with tiny cells
(forcing the key-prefix split) and on the tiled per-group sequence."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialstat.operators import mart as M
from dialstat.operators.ordinal import dense_row_number, rank_family, sequence_in_groups
from dialstat.sources.tables import read_table
from tests.conftest import SF_SMALL, no_broadcasts, operators


def _groups(clean_small):
    e = M.kpi_groups(clean_small)
    return e.withColumn("rk", F.round(F.col("conversion_rate_pct") * 100).cast("long"))


def test_rank_family_equals_plain_windows(clean_small):
    e = _groups(clean_small)
    plain = e.select(
        "group_sk",
        F.row_number().over(W.partitionBy("age_segment").orderBy(F.desc("rk"), "group_sk")).alias("a"),
        F.row_number().over(W.partitionBy("contact_month").orderBy(F.desc("rk"), "group_sk")).alias("m"),
        F.row_number().over(W.orderBy(F.desc("rk"), "group_sk")).alias("g"),
        F.percent_rank().over(W.orderBy("rk")).alias("pr"),
    )
    for cell_rows in (1_000_000, 40, 2):
        got = rank_family(e, [(["age_segment"], "a"), (["contact_month"], "m"), ([], "g")], "rk", "group_sk",
                          True, cell_rows, "pr").select("group_sk", "a", "m", "g", "pr")
        assert got.count() == e.count()
        assert got.exceptAll(plain).count() == 0


def test_rank_family_shuffles_and_sorts_wide_rows_once(spark, clean_small):
    e = _groups(clean_small)
    with no_broadcasts(spark):
        got = rank_family(e, [(["age_segment"], "a"), (["contact_month"], "m"), ([], "g")], "rk", "group_sk")
        wide = [o for o in operators(got) if "median_account_balance" in o]
    assert sum(o.startswith("Exchange") for o in wide) == 1 and sum(o.startswith("Sort\n") for o in wide) == 1
    assert not any(o.startswith("Window") for o in wide)


def test_dense_row_number(spark):
    o = read_table(spark, SF_SMALL, "orders").select("o_orderkey")
    got = dense_row_number(o, "o_orderkey", "rn", buckets=7)
    plain = o.select("o_orderkey", F.row_number().over(W.orderBy("o_orderkey")).alias("rn"))
    assert got.exceptAll(plain).count() == 0 and got.count() == o.count()


def test_sequence_in_groups_tiled_equals_plain(spark):
    o = read_table(spark, SF_SMALL, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    plain = o.select("*", (F.row_number().over(w) - 1).cast("long").alias("seq_pos"),
                     F.lag("o_orderdate").over(w).alias("prev_o_orderdate"),
                     F.lag("o_orderstatus").over(w).alias("prev_o_orderstatus"))
    # hot_rows=2 sends every customer with more than 2 orders down the tiled path;
    # many ranges cut those customers into several tiles
    got = sequence_in_groups(o, ["o_custkey"], "o_orderdate", "o_orderkey", ["o_orderstatus"], hot_rows=2, ranges=97)
    assert got.count() == o.count()
    assert got.select(*plain.columns).exceptAll(plain).count() == 0


def test_sequence_of_one_group_with_equal_dates_is_spread_over_many_tasks(spark):
    """One customer holds all rows, most on one date: tiles have about equal numbers of rows."""
    df = spark.range(20_000).selectExpr(
        "1 AS g", "if(id % 10 = 0, date'2024-01-02', date'2024-01-01') AS d", "id * 1000003 AS k", "id % 7 AS c")
    w = W.partitionBy("g").orderBy("d", "k")
    plain = df.select("*", (F.row_number().over(w) - 1).cast("long").alias("seq_pos"),
                      F.lag("d").over(w).alias("prev_d"), F.lag("c").over(w).alias("prev_c"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sequence_in_groups(df, ["g"], "d", "k", ["c"], hot_rows=100, ranges=40)
        assert got.select(*plain.columns).exceptAll(plain).count() == 0 and got.count() == 20_000
        per_task = got.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        assert per_task < 10_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sequence_in_groups(df, [], "d", "k", ["c"], ranges=5).select(*plain.columns).exceptAll(plain).count() == 0


def test_dense_row_number_of_ties_nulls_and_empty_tables(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, NULL, id % 5) AS k", "id")
    got = dense_row_number(df, "k", "rn", buckets=6).collect()
    assert sorted(r.rn for r in got) == list(range(1, 1001))
    keys = [-1 if r.k is None else r.k for r in sorted(got, key=lambda r: r.rn)]
    assert keys == sorted(keys)
    assert dense_row_number(df.limit(0), "k", "rn").count() == 0


def test_no_table_stays_cached(spark, clean_small):
    spark.catalog.clearCache()
    M.campaign_kpis(clean_small).count()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0


def test_rank_family_splits_a_hot_value_across_tasks(spark):
    """One value holding most rows (here: the rate coarsened so nearly all groups tie)
    is cut into key-prefix cells; the result still equals the plain windows and no
    task receives the whole hot value."""
    from dialstat.operators.clean import contacts_clean
    from dialstat.sources.bridge import contacts_raw

    e = M.kpi_groups(contacts_clean(contacts_raw(spark, "/root/testdata/sf0.01")))
    e = e.withColumn("hot", (F.col("conversion_rate_pct") >= 50).cast("long"))  # value 0 holds ~all rows
    n = e.count()
    top_share = e.groupBy("hot").count().agg(F.max("count")).first()[0] / n
    assert top_share > 0.8
    got = rank_family(e, [(["age_segment"], "a"), ([], "g")], "hot", "group_sk", True, 200, "pr")
    plain = e.select(
        "group_sk",
        F.row_number().over(W.partitionBy("age_segment").orderBy(F.desc("hot"), "group_sk")).alias("a"),
        F.row_number().over(W.orderBy(F.desc("hot"), "group_sk")).alias("g"),
        F.percent_rank().over(W.orderBy("hot")).alias("pr"),
    )
    assert got.select("group_sk", "a", "g", "pr").exceptAll(plain).count() == 0
    per_task = got.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert per_task < 0.5 * n


def test_rank_family_keeps_shuffle_joins_above_the_broadcast_limit(spark, monkeypatch):
    from dialstat.operators import joins

    monkeypatch.setattr(joins.checked_small, "__defaults__", (5, False))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(500).selectExpr("id % 3 AS p", "if(id % 9 = 0, NULL, id % 100) AS v", "md5(cast(id AS string)) AS k")
        out = rank_family(df, [(["p"], "rank"), ([], "place")], "v", "k", percent_rank_col="share")
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
        plain = df.selectExpr("k", "row_number() OVER (PARTITION BY p ORDER BY v DESC, k) AS want",
                              "row_number() OVER (ORDER BY v DESC, k) AS want2", "percent_rank() OVER (ORDER BY v) AS want3")
        both = out.join(plain, "k")
        assert both.count() == 500 and both.where("rank <> want OR place <> want2 OR share <> want3").count() == 0
        one = rank_family(df.limit(1), [([], "place")], "v", "k", percent_rank_col="share").collect()
        assert [(r.place, r.share) for r in one] == [(1, 0.0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_private_folder_off_local_masters(spark, monkeypatch):
    import pytest

    from dialstat import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            set = staticmethod(lambda *a: None)
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="checkpoint"):
        session.prepare(Session())


def test_a_wide_table_of_few_rows_is_not_broadcast(spark):
    from dialstat.operators.joins import checked_small, measured

    df = spark.range(100).selectExpr("id", "repeat('x', 100) AS t", "CAST(NULL AS string) AS u")
    assert measured(df) == (100, 100 * (8 + 108 + 8))
    assert measured(df.limit(0)) == (0, 0)
    assert checked_small(df, max_bytes=1000)[1] is False and checked_small(df)[1] is True
