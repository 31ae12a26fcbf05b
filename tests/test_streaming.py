from pyspark.sql import functions as F

from dialstat.operators.clean import contacts_clean
from dialstat.session import fresh_work_dir
from dialstat.streaming import start_clean_stream


def test_stream_cleans_batches_incrementally(spark, raw_small):
    land = fresh_work_dir(spark, "landing")
    out = fresh_work_dir(spark, "stream_out")
    ckpt = fresh_work_dir(spark, "stream_ckpt")
    first = raw_small.where(F.col("_row_id") % 2 == 0)
    second = raw_small.where(F.col("_row_id") % 2 == 1)
    first.write.mode("append").parquet(land)
    q = start_clean_stream(spark, land, out, checkpoint=ckpt)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == contacts_clean(first).count()
    second.write.mode("append").parquet(land)
    q = start_clean_stream(spark, land, out, checkpoint=ckpt)  # restart from the checkpoint
    q.awaitTermination()
    got = spark.read.parquet(out)
    want = contacts_clean(raw_small)
    assert got.count() == want.count()
    assert got.select("row_id", "age_segment", "subscribed").exceptAll(
        want.select("row_id", "age_segment", "subscribed")).count() == 0
