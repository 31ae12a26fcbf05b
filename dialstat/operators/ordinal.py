"""Row numbers, ranks and predecessors without a one-task window.

A window with no (or a low-cardinality) PARTITION BY sorts a whole segment,
or the whole table, in a single task. The forms below give identical
results while every sort is bounded:

* :func:`rank_rows` - ROW_NUMBER() OVER (PARTITION BY p ORDER BY v, tie).
  A histogram of (p, v) - bounded because v has few distinct values -
  gives each cell its running offset; a heavy (p, v) pair is split into
  sub-cells by a prefix of the hex tie-break key, so no cell exceeds
  ``cell_rows`` rows. Rows are numbered inside their cell only.
* :func:`percent_rank` - PERCENT_RANK() from the same histogram; no row sort.
* :func:`rank_family` - several such rankings over the same order (different
  partitions) with one shared shuffle of the rows, plus PERCENT_RANK; used
  by the KPI mart.

Histogram and cell tables are broadcast only after their row count is
checked (``joins.checked_small``); above the limit the join is a shuffle join.
* :func:`dense_row_number` - 1..n in the order of a key, by one range shuffle.
* :func:`sequence_in_groups` - position, previous value and previous
  carried columns within a group (lag / row_number by group), split into
  tiles so that one hot group is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialstat.operators.joins import checked_small, null_safe_join
from dialstat.session import stored

_MAX_PREFIX = 8


def _order(c: str, descending: bool) -> Column:
    # Spark's defaults: ascending puts NULLs first, descending puts them last.
    return F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first()


def _join_small(big: DataFrame, small: DataFrame, cols: Sequence[str], known_small: bool = False) -> DataFrame:
    """NULL-safe join of a bounded table onto ``big``: broadcast when its checked size allows."""
    small, _ = checked_small(small, known_small=known_small)
    return null_safe_join(big, small, cols)


def rank_family(
    df: DataFrame,
    rankings: Sequence[tuple[Sequence[str], str]],
    value_col: str,
    tie_col: str,
    descending: bool = True,
    cell_rows: int = 1_000_000,
    percent_rank_col: str | None = None,
    num_partitions: int | None = None,
    bounded_values: bool = False,
) -> DataFrame:
    """Several ROW_NUMBER() columns that all order by (value_col, tie_col) but partition
    differently - e.g. by age segment, by month, and globally - with one shuffle of narrow rows.

    ``rankings`` is a list of (partition columns, output column). Every ranking
    splits rows into cells (partition, value, prefix of the hex tie key), where
    the prefix length of a value comes from its global count, so no cell holds
    more than about ``cell_rows`` rows. Only the ranking's own columns go through
    the windows: they are hash-partitioned once on (value, prefix), which satisfies
    every ranking's window (each window's keys include both), so the windows only
    sort. The whole rows meet their ranks by the tie key, which must be unique and
    never NULL; it spreads them evenly, so no wide row enters a hot cell or is sorted
    more than once. Per-cell offsets come from one small histogram over (all partition columns, value,
    prefix) and are broadcast after a size check. ``percent_rank_col`` adds
    PERCENT_RANK() OVER (ORDER BY value_col ASC) from the value histogram.
    ``bounded_values`` says that the number of distinct values is bounded by their
    domain, so that their histogram needs no size check.
    ``value_col`` must be integral or text: the planner normalises floating keys,
    which would stop the single partitioning from serving the windows.
    """
    if df.schema[value_col].dataType.typeName() in ("double", "float"):
        raise TypeError(f"rank_family needs an integral or text value column, got {value_col!r} as double")
    all_p: list[str] = []
    for cols, _ in rankings:
        for c in cols:
            if c not in all_p:
                all_p.append(c)
    vh = df.groupBy(value_col).agg(F.count(F.lit(1)).alias("__vn"))
    vh, vh_small = checked_small(vh, known_small=bounded_values)
    plen = F.when(
        F.col("__vn") > cell_rows,
        F.least(F.ceil(F.log(16.0, F.col("__vn") / F.lit(float(cell_rows)))).cast("int"), F.lit(_MAX_PREFIX)),
    ).otherwise(F.lit(0))
    cols_vh = [value_col, plen.alias("__plen")]
    if percent_rank_col:
        w_all = Window.partitionBy(F.lit(0))
        lower = F.coalesce(
            F.sum("__vn").over(w_all.orderBy(_order(value_col, False)).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        )
        total = F.sum("__vn").over(w_all.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        cols_vh.append(
            F.when(total > 1, lower.cast("double") / (total - 1).cast("double")).otherwise(F.lit(0.0)).alias(percent_rank_col)
        )
    narrow = list(dict.fromkeys([tie_col, value_col, *all_p]))
    tagged = _join_small(df.select(*narrow), vh.select(*cols_vh), [value_col], known_small=vh_small)
    tagged = tagged.withColumn(
        "__pfx", F.when(F.col("__plen") > 0, F.expr(f"substring(`{tie_col}`, 1, __plen)")).otherwise(F.lit(""))
    ).drop("__plen")

    fine = tagged.groupBy(*all_p, value_col, "__pfx").agg(F.count(F.lit(1)).alias("__cn"))
    fine, fine_small = checked_small(fine)
    out = tagged
    for i, (cols, _) in enumerate(rankings):
        p = list(cols)
        roll = fine.groupBy(*p, value_col, "__pfx").agg(F.sum("__cn").alias("__cn"))
        w = (Window.partitionBy(*p) if p else Window.partitionBy(F.lit(0))).orderBy(
            _order(value_col, descending), F.col("__pfx").asc()
        ).rowsBetween(Window.unboundedPreceding, -1)
        offs = roll.select(*p, value_col, "__pfx", F.coalesce(F.sum("__cn").over(w), F.lit(0)).alias(f"__before{i}"))
        out = _join_small(out, offs, p + [value_col, "__pfx"], known_small=fine_small)

    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = out.repartition(n, F.col(value_col), F.col("__pfx"))
    for i, (cols, out_col) in enumerate(rankings):
        w = Window.partitionBy(*cols, value_col, "__pfx").orderBy(F.col(tie_col).asc())
        out = out.withColumn(out_col, (F.col(f"__before{i}") + F.row_number().over(w)).cast("long"))
    ranks = out.select(F.col(tie_col).alias("__tie"), *[c for _, c in rankings], *([percent_rank_col] if percent_rank_col else []))
    return df.join(ranks, F.col(tie_col) == F.col("__tie")).drop("__tie")


def _ranged(df: DataFrame, order: Sequence[Column], name: str, ranges: int | None = None, observe=None) -> DataFrame:
    """``df`` in a total order, written once and read back with ``__range`` and ``__at``.

    One range shuffle deals the rows to ``ranges`` tasks of about equal size (the planner samples
    the bounds); every task sorts its range. ``__range`` is the number of the range and ``__at`` the
    place in it, so a row's rank is the rows of all ranges before its own plus its place. The stored
    table fixes both. ``observe`` is an (Observation, metrics) pair measured during the write.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = placed.withColumn("__place", F.monotonically_increasing_id())
    if observe is not None:
        placed = placed.observe(observe[0], *observe[1])
    # monotonically_increasing_id: the task's number above 33 bits that count the task's rows
    return stored(placed, name).withColumns({
        "__range": F.shiftright("__place", 33), "__at": F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))}).drop("__place")


def dense_row_number(df: DataFrame, key_col: str, out_col: str, buckets: int | None = None, observe=None) -> DataFrame:
    """1..n in ascending order of a key (ROW_NUMBER() OVER (ORDER BY key)); ties in any order.

    Rows are range-partitioned and written once (see :func:`_ranged`); a range's offset is the row
    count of the ranges before it, one row per range, which is broadcast: its bound is the number of
    partitions. No value of the key reaches the driver.
    """
    placed = _ranged(df, [F.col(key_col).asc_nulls_first()], "numbered", buckets, observe)
    before = Window.partitionBy(F.lit(0)).orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(F.col("__range").alias("__of")).agg(F.count(F.lit(1)).alias("__n")).select(
        "__of", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    joined = placed.join(F.broadcast(offsets), F.col("__range") == F.col("__of"))
    return joined.withColumn(out_col, F.col("__before") + F.col("__at") + 1).drop("__range", "__at", "__of", "__before")


def _sequence_plain(df, g, order_col, key_col, carry, pos_col, prev_prefix):
    w = (Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))).orderBy(
        F.col(order_col).asc_nulls_first(), F.col(key_col).asc()
    )
    return df.select(
        *df.columns,
        (F.row_number().over(w) - 1).cast("long").alias(pos_col),
        F.lag(F.col(order_col)).over(w).alias(prev_prefix + order_col),
        *[F.lag(F.col(c)).over(w).alias(prev_prefix + c) for c in carry],
    )


def _sequence_tiled(df, g, order_col, key_col, carry, pos_col, prev_prefix, ranges=None):
    order = [*[F.col(c).asc_nulls_first() for c in g], F.col(order_col).asc_nulls_first(), F.col(key_col).asc()]
    t = _ranged(df, order, "tiles", ranges)
    tile_keys = [*g, "__range"]
    last = [order_col, *carry]
    tiles = t.groupBy(*tile_keys).agg(
        F.count(F.lit(1)).alias("__tn"), *[F.max_by(F.col(c), F.col("__at")).alias(f"__last_{c}") for c in last])
    # A group has at most one tile per range, whatever its number of rows.
    w_t = (Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))).orderBy("__range")
    tiles = tiles.select(
        *tile_keys,
        F.coalesce(F.sum("__tn").over(w_t.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__tbefore"),
        *[F.lag(F.col(f"__last_{c}")).over(w_t).alias(f"__tprev_{c}") for c in last],
    )
    j = null_safe_join(t, tiles, tile_keys)
    w_r = Window.partitionBy(*tile_keys).orderBy("__at")
    rn = F.row_number().over(w_r)
    return j.select(
        *df.columns,
        (F.col("__tbefore") + rn - 1).cast("long").alias(pos_col),
        *[F.when(rn == 1, F.col(f"__tprev_{c}")).otherwise(F.lag(F.col(c)).over(w_r)).alias(prev_prefix + c) for c in last],
    )


def sequence_parts(
    df: DataFrame,
    group_cols: Sequence[str],
    order_col: str,
    key_col: str,
    carry_cols: Sequence[str] = (),
    pos_col: str = "seq_pos",
    prev_prefix: str = "prev_",
    hot_rows: int = 2_000_000,
    ranges: int | None = None,
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """The two parts of :func:`sequence_in_groups`: (rows of other groups, rows of hot groups, the hot groups).

    The first part is hash-partitioned by the group, the second dealt by ranges; callers that join by the group do so
    on each part in its own way. The last two are None if no group is hot.
    """
    g, carry = list(group_cols), list(carry_cols)
    hot = df.groupBy(*g).agg(F.count(F.lit(1)).alias("__gn")).where(F.col("__gn") > hot_rows).select(*g)
    hot = stored(hot, "hot_groups")
    if not hot.take(1):
        return _sequence_plain(df, g, order_col, key_col, carry, pos_col, prev_prefix), None, None
    hot, _ = checked_small(hot.withColumn("__hot", F.lit(True)))
    marked = null_safe_join(df, hot, g, "left")
    cold_part = marked.where(F.col("__hot").isNull()).drop("__hot")
    hot_part = marked.where(F.col("__hot")).drop("__hot")
    return (_sequence_plain(cold_part, g, order_col, key_col, carry, pos_col, prev_prefix),
            _sequence_tiled(hot_part, g, order_col, key_col, carry, pos_col, prev_prefix, ranges), hot.drop("__hot"))


def sequence_in_groups(
    df: DataFrame,
    group_cols: Sequence[str],
    order_col: str,
    key_col: str,
    carry_cols: Sequence[str] = (),
    pos_col: str = "seq_pos",
    prev_prefix: str = "prev_",
    hot_rows: int = 2_000_000,
    ranges: int | None = None,
) -> DataFrame:
    """Per row: 0-based position within its group ordered by (order_col, key_col),
    plus the previous row's ``order_col`` and ``carry_cols`` (NULL for the first row).

    Same as ROW_NUMBER()-1 and LAG(...) OVER (PARTITION BY group ORDER BY order_col,
    key_col), with ``key_col`` unique. One aggregate finds groups with more than
    ``hot_rows`` rows (at most rows/hot_rows of them). Other groups use the plain
    window; rows of hot groups are dealt to ``ranges`` ranges of about equal size
    of (group, order_col, key_col). A tile is a group's part of one range; the tile
    table (at most ranges + hot groups rows) carries counts and last values between
    tiles, so a group holding a third of all rows is numbered by a third of the tasks.
    """
    if not group_cols:
        return _sequence_tiled(df, [], order_col, key_col, list(carry_cols), pos_col, prev_prefix, ranges)
    cold, hot, _ = sequence_parts(df, group_cols, order_col, key_col, carry_cols, pos_col, prev_prefix, hot_rows, ranges)
    return cold if hot is None else cold.unionByName(hot)
