"""The ``campaign_kpis`` mart: metrics, ranks, segment summary, final projection.

Plan shape (see README and PLANS.md): scan + clean (narrow) -> two shuffles for
the 15-key aggregate (by key and value, then by key) -> the grouped table is written once under the shared work
folder, because several branches read it -> the three rankings and the
percentile in the distributed form of ``ordinal.rank_family`` (bounded
histograms broadcast after a size check, ONE shuffle of the rows) -> the segment
summary (bounded by segment cardinality) is joined back, broadcast after a size
check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialstat.functions.keys import surrogate_key
from dialstat.functions.numeric import flag, safe_divide
from dialstat.operators.clean import ts_literal
from dialstat.operators.metrics import base_metrics, enriched_metrics, exact_mean_of_fixed_point
from dialstat.operators.joins import checked_small, equi_join, null_safe_join
from dialstat.operators.ordinal import rank_family
from dialstat.params import KPI_DIMENSIONS, SEGMENT_KEYS, Params
from dialstat.schema import KPI_COLUMNS
from dialstat.session import stored

SK = "group_sk"
RATE = "conversion_rate_pct"
RATE_KEY = "rate_hundredths"


def with_group_key(df: DataFrame) -> DataFrame:
    """Surrogate key of the 15 dimensions: unique per group, the tie-break of every rank."""
    return df.withColumn(SK, surrogate_key(list(KPI_DIMENSIONS)))


def kpi_groups(clean: DataFrame, p: Params | None = None, checkpoint: bool = True) -> DataFrame:
    """base_metrics -> conversion_metrics -> indices, plus the group key."""
    e = with_group_key(enriched_metrics(base_metrics(clean), p))
    return stored(e, "kpi_groups") if checkpoint else e


def add_ranks(e: DataFrame, p: Params | None = None) -> DataFrame:
    """Ranks by age segment and by month, global row id and global percentile.

    All four order by the 2-dp rate (at most 10,001 values) with the group key as
    tie-break, so they share one shuffle (see ``ordinal.rank_family``).
    """
    p = p or Params()
    # Rank on the rate in hundredths as an exact integer: same order and ties as the
    # 2-dp double, and an integral key keeps one hash partitioning valid for all windows
    # (double keys are normalised by the planner, which would add exchanges).
    keyed = e.withColumn(RATE_KEY, F.round(F.col(RATE) * F.lit(100.0)).cast("long"))
    ranked = rank_family(
        keyed,
        [(["age_segment"], "conversion_rank_by_age"), (["contact_month"], "conversion_rank_by_month"),
         ([], "kpi_row_id")],
        RATE_KEY, SK, descending=True, cell_rows=p.rank_cell_rows, percent_rank_col="conversion_percentile",
        bounded_values=True,  # hundredths of a percent: 10,001 rates and NULL
    )
    return ranked.drop(RATE_KEY)


def best_month_by_segment(e: DataFrame) -> DataFrame:
    """G10 without a window: the rank-1 group of each month is the min of
    (-rate, group key); the month goes to that group's segment, max month text wins."""
    top = e.groupBy("contact_month").agg(
        F.min(F.struct(
            (-F.col(RATE)).alias("neg_rate"), F.col(SK).alias("sk"), *[F.col(k) for k in SEGMENT_KEYS]
        )).alias("top")
    )
    return top.select("contact_month", *[F.col(f"top.{k}").alias(k) for k in SEGMENT_KEYS]).groupBy(
        *SEGMENT_KEYS
    ).agg(F.max("contact_month").alias("best_month_for_segment"))


def segment_summary(e: DataFrame) -> DataFrame:
    """Totals, conversions and the unweighted mean rate per 4-key segment."""
    s = e.groupBy(*SEGMENT_KEYS).agg(
        F.sum("total_contacts").alias("total_contacts_in_segment"),
        F.sum("successful_contacts").alias("total_conversions_in_segment"),
        exact_mean_of_fixed_point(RATE, 2).alias("avg_conversion_rate_in_segment"),
    )
    best = best_month_by_segment(e)  # a row a month; months are free text, so the join chooses by measured size
    return null_safe_join(s, best, list(SEGMENT_KEYS), "left")


def join_segment(ranked: DataFrame, summary: DataFrame) -> DataFrame:
    """J1 + P31-P33: plain-equality LEFT join (NULL keys never match)."""
    # The summary is bounded by the number of segments; broadcast after a size check.
    summary, _ = checked_small(summary)
    j = equi_join(ranked, summary, list(SEGMENT_KEYS), "left")
    return j.withColumns({
        "share_of_contacts_in_segment_pct": F.round(
            safe_divide("total_contacts", "total_contacts_in_segment") * F.lit(100.0), 2
        ),
        "conversion_rate_vs_segment_avg": F.round(F.col(RATE) - F.col("avg_conversion_rate_in_segment"), 2),
        "is_top_performer_in_age_segment": flag(F.col("conversion_rank_by_age") == 1),
    })


def campaign_kpis(clean: DataFrame, p: Params | None = None, checkpoint: bool = True) -> DataFrame:
    """The 49-column KPI mart."""
    p = p or Params()
    e = kpi_groups(clean, p, checkpoint)
    ranked = add_ranks(e, p)
    final = join_segment(ranked, segment_summary(e)).withColumns({
        "dbt_updated_at": ts_literal(p.run_ts),
        "dbt_run_timestamp": F.lit(p.run_started_at_text),
    })
    return final.select(*KPI_COLUMNS)


def range_bucket(c: str = "contact_month_num", start: int = 1, end: int = 13, interval: int = 1):
    """Integer range partition id; NULL for NULL and out-of-range values (catch-all)."""
    x = F.col(c)
    return F.when((x >= start) & (x < end), F.floor((x - F.lit(start)) / F.lit(interval)).cast("int"))
