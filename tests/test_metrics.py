from pyspark.sql import functions as F

from dialstat.operators import metrics as MT


def test_target_band_uses_doubles(spark):
    df = spark.createDataFrame([(10, 100), (2, 25), (81, 1000), (79, 1000), (0, 0)], "s long, t long")
    band = MT.performance_vs_target(MT.safe_divide("s", "t"), 0.10)
    # 2/25 = 0.08 is below 0.1 * 0.8 = 0.08000000000000002 in double arithmetic
    assert [r[0] for r in df.select(band).collect()] == ["above_target", "below_target", "near_target",
                                                         "below_target", "below_target"]


def test_performance_band(spark):
    df = spark.createDataFrame([(0.20,), (0.10,), (0.05,), (0.049,), (None,)], "r double")
    got = [r[0] for r in df.select(MT.performance_segment(F.col("r"))).collect()]
    assert got == ["high_performance", "medium_performance", "low_performance", "very_low_performance",
                   "very_low_performance"]


def test_median_is_an_input_element(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (1, 4), (2, 1), (2, 2), (2, 3), (2, None), (3, None)],
                               "g int, x long")
    got = {r.g: r.m for r in df.groupBy("g").agg(MT.median("x").alias("m")).collect()}
    assert got == {1: 2, 2: 2, 3: None}


def test_exact_mean_of_fixed_point(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "x double")
    assert df.agg(MT.exact_mean_of_fixed_point("x", 2)).first()[0] == 0.2


def test_medians_from_value_counts_equal_the_aggregate_and_merge_no_value_maps(clean_small):
    for dims in (("age_segment", "job"), ("contact_month",)):
        got = MT.base_metrics(clean_small, dims)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
        want = clean_small.groupBy(*dims).agg(
            *[MT.median(c).alias(name) for c, name in MT.MEDIANS],
            *[F.avg(c).alias(name) for c, name in MT.AVERAGES.items()],
            F.avg("contact_duration_sec").alias("avg_call_duration_sec"), F.avg("account_balance_eur").alias("avg_account_balance"),
            F.sum("contact_duration_sec").alias("total_call_duration_sec"),
            F.count(F.lit(1)).alias("total_contacts"), F.max("num_contacts_campaign").alias("max_contacts_to_client"))
        got = got.select(*want.columns)
        assert got.count() > 10 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_first_aggregate_spreads_a_group_by_its_values(spark):
    df = spark.range(1000).select(F.lit("hot").alias("g"), (F.col("id") % 250).alias("x"), F.lit(None).cast("long").alias("y"))
    counted = MT.value_counts(df, ["g"], ["x", "y"], {"s": F.col("x")}, {})
    assert counted.count() == 251 and counted.agg(F.sum("s")).first()[0] == df.agg(F.sum("x")).first()[0]
    marked = MT.mark_medians(counted)
    assert counted.where("__kind = 1 AND (g IS NOT NULL OR s IS NOT NULL)").count() == 0  # narrow: key, value and count
    lows = {r["__kind"]: r["m"] for r in marked.groupBy("__kind").agg(F.min("__upper").alias("m")).collect()}
    assert lows == {0: 124, 1: None}
