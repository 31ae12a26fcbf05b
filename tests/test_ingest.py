import datetime as dt

from pyspark.sql import functions as F

from dialstat.operators import quality as Q
from dialstat.operators.starter import first_model, second_model
from dialstat.session import fresh_work_dir
from dialstat.sources import ingest as I
from dialstat.sources import sinks as S
from dialstat.sources.bridge import contacts_raw
from tests.conftest import SF_SMALL


def test_validation_first_failure_wins(spark, raw_small):
    assert I.validate(raw_small) == (True, "")
    assert I.validate(raw_small.drop("y"))[0] is False
    assert "missing columns" in I.validate(raw_small.drop("y"))[1]
    assert I.validate(raw_small.limit(0)) == (False, "dataframe is empty")
    assert "wrong type for 'age'" in I.validate(raw_small.withColumn("age", F.col("age").cast("string")))[1]
    bad = raw_small.withColumn("y", F.when(F.col("_row_id") % 7 == 0, F.lit("maybe")).otherwise(F.col("y")))
    ok, msg = I.validate(bad)
    assert not ok and msg.startswith("invalid target values: 1 distinct in ")


def test_prepare_stamps_one_timestamp_and_dense_ids(spark, raw_small):
    ts = dt.datetime(2024, 5, 6, 7, 8, 9)
    out = I.stamp_load_ts(raw_small, ts)
    assert out.select("_dbt_loaded_at").distinct().collect()[0][0] == ts
    ids = I.add_dense_row_id(raw_small.select(F.col("_row_id").alias("k")), "k", "_row_id")
    agg = ids.agg(F.min("_row_id"), F.max("_row_id"), F.countDistinct("_row_id"), F.count(F.lit(1))).first()
    assert agg[0] == 1 and agg[1] == agg[2] == agg[3]


def test_required_fields_and_profiles(spark, raw_small):
    assert I.required_field_nulls(raw_small).first().asDict() == {"null_row_id": 0, "null_dbt_loaded_at": 0}
    prof = {r.column_name: (r.null_count, r.null_pct) for r in I.null_profile(raw_small).collect()}
    n = raw_small.count()
    assert set(prof) <= set(raw_small.columns) and all(v[0] > 0 for v in prof.values())
    assert prof["y"][1] == round(prof["y"][0] * 100.0 / n, 2)
    assert I.dataset_shape(raw_small).first().asDict() == {"n_rows": n, "n_columns": 19}
    counts = [r["count"] for r in I.target_value_counts(raw_small).collect()]
    assert counts == sorted(counts, reverse=True)


def test_load_write_and_reread(spark, raw_small):
    path = fresh_work_dir(spark, "test_raw")
    S.overwrite_parquet(raw_small, path)
    S.overwrite_parquet(raw_small, path)  # overwrite, not append
    assert S.loaded_row_count(spark, path).first().row_count == raw_small.count()
    back = I.read_raw(spark, path)
    assert [f.name for f in back.schema.fields] == list(raw_small.columns)
    csv_path = fresh_work_dir(spark, "test_csv")
    S.write_csv(raw_small.select("_row_id", "job", "duration"), csv_path)
    text = S.read_csv(spark, csv_path)
    assert set(text.columns) == {"_row_id", "job", "duration"} and text.count() == raw_small.count()
    coerced = I.coerce_numeric(text, ["_row_id", "duration"])
    assert coerced.join(raw_small.select("_row_id", "duration"), ["_row_id", "duration"]).count() == \
        raw_small.where(F.col("duration").isNotNull()).count()


def test_range_partitioned_sink_prunes(spark, kpis_small):
    path = fresh_work_dir(spark, "test_kpis")
    S.write_range_partitioned(kpis_small, path)
    back = spark.read.parquet(path)
    may = back.where(F.col(S.PARTITION_COL) == 4)
    assert may.count() == kpis_small.where("contact_month_num = 5").count()
    plan = may._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "partition_bucket" in plan


def test_schema_name():
    assert S.schema_name(None, "analytics", "dev") == "analytics"
    assert S.schema_name(" marts ", "analytics", "prod") == "marts"
    assert S.schema_name("marts", "analytics", "dev") == "analytics_marts"


def test_combine_features_target_is_key_aligned(spark, raw_small):
    x, y = I.split_features_target(raw_small)
    combined = I.combine_features_target(x, y.where(F.col("_row_id") % 2 == 0))
    assert combined.count() == raw_small.count()
    assert combined.where(F.col("y").isNotNull()).count() == raw_small.where((F.col("_row_id") % 2 == 0) & F.col("y").isNotNull()).count()


def test_starter_models_and_negative_fixture(spark):
    first = first_model(spark)
    assert sorted([r.id for r in first.collect()], key=lambda v: (v is None, v)) == [1, None]
    assert Q.failing_rows(first, Q.Check("nn", "t", "not_null", ("id",))).count() == 1
    assert Q.failing_rows(first, Q.Check("u", "t", "unique", ("id",))).count() == 0
    assert [r.id for r in second_model(first).collect()] == [1]


def test_bridge_counts_match_probe(spark):
    raw = contacts_raw(spark, SF_SMALL)
    assert raw.count() == 1500


def test_validation_pass_also_gates_required_ids(spark, raw_small):
    broken = raw_small.withColumn("_row_id", F.when(F.col("_row_id") == 3, F.lit(None)).otherwise(F.col("_row_id")))
    ok, msg = I.validate(broken)
    assert not ok and msg == "REQUIRED fields hold NULLs: {'_row_id': 1}"


def test_csv_sink_keeps_spaces_and_schema(spark, raw_small):
    path = fresh_work_dir(spark, "test_csv_spaces")
    S.write_csv(raw_small, path)
    back = S.read_csv(spark, path, I.RAW_SCHEMA)
    padded = raw_small.where(F.col("job").startswith(" ")).count()
    assert padded > 0
    assert back.where(F.col("job").startswith(" ") & F.col("job").endswith(" ")).count() == padded
    assert back.count() == raw_small.count()
