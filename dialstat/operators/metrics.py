"""Group metrics (G1-G8) and the row-level KPI formulas on them.

Rows are counted by (group, value) first, then by group: the exact discrete median
comes from running sums over the value counts, so all aggregates are plain hash
aggregates and no task merges the value maps of a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialstat.functions.numeric import safe_divide
from dialstat.params import (
    KPI_DIMENSIONS,
    NEAR_TARGET_FACTOR,
    PERFORMANCE_BANDS,
    PERFORMANCE_FLOOR,
    TARGET_BANDS,
    Params,
)

def exact_mean_of_fixed_point(c: Column | str, decimals: int) -> Column:
    """AVG of a column holding values rounded to ``decimals`` places, computed exactly.

    Values are summed as integers of 10^-decimals units and divided once, so the
    result is the correctly rounded mean, independent of partitioning and
    summation order (a plain double AVG is not).
    """
    x = F.col(c) if isinstance(c, str) else c
    scale = 10 ** decimals
    units = F.sum(F.round(x * F.lit(float(scale))).cast("long"))
    return F.try_divide(units.cast("double"), (F.count(x) * F.lit(scale)).cast("double"))


def median(c: str) -> Column:
    """Lower median as an aggregate: an input element, NULLs skipped, in the input's integer type.

    Its buffer is the group's value map, merged in one task: for groups of few distinct values. The
    mart takes the same median from value counts (:func:`mark_medians`).
    """
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{c}`)").cast("long")


#: Columns whose exact lower median is taken, and the result's name.
MEDIANS = (("contact_duration_sec", "median_call_duration_sec"), ("account_balance_eur", "median_account_balance"))
#: Plain averages of integers (the columns of the medians have theirs from the value counts).
AVERAGES = {
    "num_contacts_campaign": "avg_contacts_per_client",
    "age": "avg_age",
    "days_since_last_contact": "avg_days_since_last_contact",
}


#: Two hashes of the grouping columns, 128 bits together, that stand for them where they need not travel.
KEY = ("__group", "__check")


def value_counts(df: DataFrame, dims: Sequence[str], values: Sequence[str], sums: dict[str, Column],
                 largest: dict[str, Column]) -> DataFrame:
    """(KEY, dims, __kind, __value, __n, sums, largest): rows per group and value of each column of ``values``.

    ``__kind`` is the place of the column in ``values``. The grouping columns, the further sums and
    the maxima are on kind 0 alone: rows of the other kinds are a key, a kind, a value and a count.
    """
    pair = F.explode(F.array(*[
        F.struct(F.lit(i).alias("kind"), F.col(v).cast("long").alias("value")) for i, v in enumerate(values)]))
    used = {**sums, **largest}
    key = [(F.xxhash64(F.lit(seed), *dims) if dims else F.lit(0).cast("long")).alias(k) for seed, k in enumerate(KEY)]
    rows = df.select(*[F.col(d) for d in dims], *key, *[e.alias(k) for k, e in used.items()], pair.alias("__pair"))
    first = F.col("__pair.kind") == 0
    on_first = [F.when(first, F.col(d)).alias(d) for d in dims]
    return rows.groupBy(*KEY, F.col("__pair.kind").alias("__kind"), F.col("__pair.value").alias("__value"), *on_first).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(F.when(first, F.col(k))).alias(k) for k in sums],
        *[F.max(F.when(first, F.col(k))).alias(k) for k in largest],
    )


def mark_medians(counted: DataFrame) -> DataFrame:
    """Adds __upper: the value where at least half of its group's non-NULL rows are at or below it.

    The least of them is PERCENTILE_DISC(0.5), the lower median: always an input element and the same
    however rows are partitioned. One exchange by the key's first half, which the window and an aggregate by the whole
    key reuse; sorting compares numbers only.
    """
    n = F.when(F.col("__value").isNotNull(), F.col("__n")).otherwise(F.lit(0))
    group = Window.partitionBy(*KEY, "__kind")
    up_to = F.sum(n).over(group.orderBy("__value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counted.repartition(KEY[0]).withColumn("__upper", F.when(2 * up_to >= F.sum(n).over(group), F.col("__value")))


def base_metrics(clean: DataFrame, dims: Sequence[str] = KPI_DIMENSIONS) -> DataFrame:
    """One row per combination of ``dims`` (NULLs form groups).

    Two hash aggregates. The first is by (dims, value): it spreads a group that holds a third of all
    rows by its values, after map-side combining, and carries every sum. The second works on a group's
    distinct values, whose number the value domain bounds (call seconds, clamped balances).
    """
    minutes = F.round(F.col("contact_duration_min") * F.lit(100.0)).cast("long")
    one = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("long")
    sums = {
        "__won": one(F.col("subscribed") == F.lit(True)),
        "__lost": one(F.col("subscribed") == F.lit(False)),
        "__seen": one(F.col("was_contacted_before")),
        "__sum_minutes": minutes,
        "__has_minutes": one(minutes.isNotNull()),
        **{f"__sum_{c}": F.col(c).cast("long") for c in AVERAGES},
        **{f"__has_{c}": one(F.col(c).isNotNull()) for c in AVERAGES},
    }
    counted = value_counts(clean, dims, [v for v, _ in MEDIANS], sums, {"__most": F.col("num_contacts_campaign")})
    # what the other kinds know of their group is laid beside its rows of kind 0, which alone go on
    whole = Window.partitionBy(*KEY)
    valued = F.col("__value").isNotNull()
    marked = mark_medians(counted).withColumns({
        f"__{name}{i}": of.over(whole) for i in range(1, len(MEDIANS)) for name, of in {
            "median": F.min(F.when(F.col("__kind") == i, F.col("__upper"))),
            "added": F.sum(F.when(F.col("__kind") == i, F.col("__value") * F.col("__n"))),
            "valued": F.sum(F.when((F.col("__kind") == i) & valued, F.col("__n")))}.items()}).where(F.col("__kind") == 0)
    total, added = F.sum("__n"), F.sum(F.col("__value") * F.col("__n"))

    def quotient(units: Column, rows: Column) -> Column:
        # whole-number sums divided once: independent of partitioning and order
        return F.try_divide(units.cast("double"), rows.cast("double"))

    def mean(c: str) -> Column:
        return quotient(F.sum(f"__sum_{c}"), F.sum(f"__has_{c}"))

    return marked.groupBy(*KEY, *dims).agg(
        total.alias("total_contacts"),
        F.sum("__won").alias("successful_contacts"),
        F.sum("__lost").alias("unsuccessful_contacts"),
        quotient(added, F.sum(F.when(valued, F.col("__n")))).alias("avg_call_duration_sec"),
        quotient(F.sum("__sum_minutes"), F.sum("__has_minutes") * F.lit(100)).alias("avg_call_duration_min"),
        F.min("__upper").alias(MEDIANS[0][1]),
        added.alias("total_call_duration_sec"),
        mean("num_contacts_campaign").alias(AVERAGES["num_contacts_campaign"]),
        F.max("__most").alias("max_contacts_to_client"),
        mean("age").alias(AVERAGES["age"]),
        quotient(F.max("__added1"), F.max("__valued1")).alias("avg_account_balance"),
        F.max("__median1").alias(MEDIANS[1][1]),
        quotient(F.sum("__seen"), total).alias("pct_previously_contacted"),
        mean("days_since_last_contact").alias(AVERAGES["days_since_last_contact"]),
    ).drop(*KEY)


def success_ratio() -> Column:
    return safe_divide("successful_contacts", "total_contacts")


def performance_vs_target(ratio: Column, threshold: float) -> Column:
    """Doubles on purpose: 0.1 * 0.8 is 0.08000000000000002, not 0.08."""
    above, near, below = TARGET_BANDS
    return (
        F.when(ratio >= F.lit(float(threshold)), above)
        .when(ratio >= F.lit(float(threshold) * NEAR_TARGET_FACTOR), near)
        .otherwise(below)
    )


def performance_segment(ratio: Column) -> Column:
    """P28."""
    e = None
    for lowest, label in PERFORMANCE_BANDS:
        cond = ratio >= F.lit(lowest)
        e = F.when(cond, label) if e is None else e.when(cond, label)
    return e.otherwise(PERFORMANCE_FLOOR)


def conversion_exprs(p: Params) -> dict[str, Column]:
    """P24, P26-P28 over base metrics."""
    ratio = success_ratio()
    return {
        "conversion_rate_pct": F.round(ratio * F.lit(100.0), 2),
        "non_conversion_rate_pct": F.round(safe_divide("unsuccessful_contacts", "total_contacts") * F.lit(100.0), 2),
        "conversions_per_call_minute": F.round(
            safe_divide("successful_contacts", F.col("total_call_duration_sec") / F.lit(60.0)), 4
        ),
        "performance_vs_target": performance_vs_target(ratio, p.success_threshold),
        "performance_segment": performance_segment(ratio),
    }


def index_exprs() -> dict[str, Column]:
    """P29-P30 over conversion metrics."""
    return {
        "efficiency_index": F.round(safe_divide("conversion_rate_pct", "avg_contacts_per_client"), 2),
        "contact_quality_index": F.round(
            F.col("conversion_rate_pct") * F.col("avg_call_duration_min") / F.lit(10.0), 2
        ),
    }


def conversion_metrics(base: DataFrame, p: Params | None = None) -> DataFrame:
    return base.withColumns(conversion_exprs(p or Params()))


def enriched_metrics(base: DataFrame, p: Params | None = None) -> DataFrame:
    return conversion_metrics(base, p).withColumns(index_exprs())
