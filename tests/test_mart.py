from pyspark.sql import functions as F

from dialstat.operators import mart as M
from dialstat.schema import KPI_COLUMNS


def test_mart_shape_and_invariants(clean_small, kpis_small):
    assert kpis_small.columns == list(KPI_COLUMNS) and len(KPI_COLUMNS) == 49
    n_clean = clean_small.count()
    agg = kpis_small.agg(F.sum("total_contacts").alias("t"), F.count(F.lit(1)).alias("n"),
                         F.countDistinct("kpi_row_id").alias("ids"), F.max("kpi_row_id").alias("mx")).first()
    assert agg.t == n_clean
    assert agg.n == agg.ids == agg.mx  # kpi_row_id is 1..n
    assert kpis_small.where("total_contacts != successful_contacts + unsuccessful_contacts").count() == 0
    # one rank-1 group per age segment and per month
    assert kpis_small.where("conversion_rank_by_age = 1").count() == kpis_small.select("age_segment").distinct().count()
    assert kpis_small.where("conversion_rank_by_month = 1").count() == kpis_small.select("contact_month").distinct().count()


def test_null_keys_never_join_the_segment(kpis_small):
    nulls = kpis_small.where(F.col("job").isNull() | F.col("education_level").isNull())
    assert nulls.count() > 0
    assert nulls.where(F.col("total_contacts_in_segment").isNotNull()).count() == 0


def test_best_month_matches_rank_one_definition(clean_small, kpis_small):
    # The summary derives the best month without the month ranking; it must equal
    # MAX(month of rank-1 groups) per segment computed from the ranked rows.
    e = M.kpi_groups(clean_small)
    ranked = M.add_ranks(e)
    keys = ["age_segment", "job", "education_level", "balance_segment"]
    want = ranked.groupBy(*keys).agg(F.max(F.when(F.col("conversion_rank_by_month") == 1, F.col("contact_month")))
                                     .alias("best_month_for_segment"))
    got = M.segment_summary(e).select(*keys, "best_month_for_segment")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_range_bucket(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (12,), (13,)], "contact_month_num int")
    assert [r[0] for r in df.select(M.range_bucket()).collect()] == [None, None, 0, 11, None]
