"""``contacts_raw`` derived from the driver's TPC-H-style tables.

One contact per order: orders joined to their customer, a per-order lineitem
aggregate (left join) and the customer's order history (position and
previous order). Values come from the data or integer arithmetic on keys;
dirty values are planted on purpose so that every cleaning rule has work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.operators.joins import checked_small
from dialstat.operators.ordinal import sequence_parts
from dialstat.params import MONTHS
from dialstat.schema import RAW_SCHEMA, enforce
from dialstat.sources.tables import read_table


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("li_n"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("li_r"),
        F.sum("l_quantity").alias("li_qty"),
    )


def contacts_raw(spark: SparkSession, sf_dir: str, hot_rows: int = 2_000_000) -> DataFrame:
    """The 19-column raw contact relation (explicit schema, no inference).

    A customer with more than ``hot_rows`` orders is numbered and joined apart from the others.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    # History on the orders alone: hot customers are tiled before any join. The others' rows join on the window's
    # own partitioning; hot customers are few (orders / hot_rows at most) and are broadcast after a check of
    # their size, so their rows stay in their tiles. Then the parts meet.
    history, hot, hot_keys = sequence_parts(
        orders, ["o_custkey"], "o_orderdate", "o_orderkey", carry_cols=["o_orderstatus"], pos_col="prev_count", hot_rows=hot_rows)
    history = history.join(cust, F.col("o_custkey") == F.col("c_custkey"), "inner")
    if hot is not None:
        few, _ = checked_small(cust.join(hot_keys, F.col("c_custkey") == F.col("o_custkey"), "left_semi"))
        history = history.unionByName(hot.join(few, F.col("o_custkey") == F.col("c_custkey"), "inner"))
    lines = _order_lines(spark, sf_dir)
    j = history.join(lines, history["o_orderkey"] == lines["l_orderkey"], "left")

    ck = F.col("o_custkey")
    odate = F.col("o_orderdate")
    prio = F.col("o_orderpriority")
    prev_st = F.col("prev_o_orderstatus")
    n, r = F.col("li_n"), F.col("li_r")
    marital_by_mod = F.element_at(F.array(*[F.lit(v) for v in ("Married", "single ", "divorced", "married", "unknown")]),
                                  (ck % 5 + 1).cast("int"))
    education_by_mod = F.element_at(
        F.array(*[F.lit(v) for v in ("Primary", " secondary", "tertiary", "unknown", "other")]),
        (F.col("c_nationkey") % 5 + 1).cast("int"),
    )
    out = j.select(
        F.col("o_orderkey").cast("long").alias("_row_id"),
        (F.lit(15) + (ck * 37) % 90).cast("long").alias("age"),
        F.when(ck % 13 == 0, F.lit("unknown"))
        .when(ck % 17 == 0, F.lit(""))
        .otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")))
        .alias("job"),
        marital_by_mod.alias("marital"),
        education_by_mod.alias("education"),
        F.when(ck % 51 == 0, F.lit(None).cast("string"))
        .when(ck % 50 == 0, F.lit("yes"))
        .otherwise(F.lit("no"))
        .alias("default"),
        F.floor(F.col("c_acctbal") * 12).cast("long").alias("balance"),
        F.when(ck % 3 == 0, F.lit("yes")).otherwise(F.lit("no")).alias("housing"),
        F.when(prio == "1-URGENT", F.lit("YES")).otherwise(F.lit("no")).alias("loan"),
        F.when(prio == "4-NOT SPECIFIED", F.lit("unknown"))
        .when(prio.startswith("1-") | prio.startswith("2-"), F.lit("cellular"))
        .otherwise(F.lit("Telephone"))
        .alias("contact"),
        F.dayofmonth(odate).cast("long").alias("day_of_week"),
        F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(odate)).alias("month"),
        F.floor(F.col("li_qty") * 3).cast("long").alias("duration"),
        F.coalesce(n, F.lit(0)).cast("long").alias("campaign"),
        F.when(F.col("prev_o_orderdate").isNull(), F.lit(-1))
        .otherwise(F.datediff(F.to_date(odate), F.to_date(F.col("prev_o_orderdate"))))
        .cast("long")
        .alias("pdays"),
        F.col("prev_count").cast("long").alias("previous"),
        F.when(prev_st == "F", F.lit("success"))
        .when(prev_st == "O", F.lit("failure"))
        .when(prev_st == "P", F.lit("other"))
        .otherwise(F.lit("unknown"))
        .alias("poutcome"),
        F.when(n.isNull(), F.lit(None).cast("string"))
        .when(r * 3 >= n * 2, F.lit("yes"))
        .otherwise(F.lit("no"))
        .alias("y"),
        F.col("o_orderdate").cast("timestamp").alias("_dbt_loaded_at"),
    )
    return enforce(out, RAW_SCHEMA)
