"""Mixing sources to target weights.

Words are added up per source; a source's target is its weight's share of all words, at most
``ceiling`` times its own words, what exceeds that being shared again by weight until no target is
above. Rate = target / words of the source. Each document is taken floor(rate) times, and once
more with probability rate - floor(rate), decided by a seeded hash of its id and text: a rerun
takes the same documents.

Shape: one pass over the texts writes (id, source, size, coin) in the shared folder; sources are
aggregated map-side first; only single-row totals reach the driver, one per round of resharing.
Source order (for the weights) is a range-partitioned sort with per-partition offsets.

Defined cases: a null text has size 0; the null source is a source, last in order; sources without
words have target 0; an empty table gives an empty result; rows repeated exactly are decided alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialstat.llm.common import count_words, fresh, read_table, stage

CEILING = 3
WEIGHTS = (1, 2, 3)
SEED = 20240
_COIN = 1 << 53


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, coin) of every row; coin is uniform in [0, 1)."""
    key, body = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    coin = F.pmod(F.xxhash64(F.lit(seed), key.cast("string"), body), F.lit(_COIN)) / F.lit(float(_COIN))
    return docs.select(key.alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
                       count_words(body).alias("size"), coin.alias("coin"))


def source_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds weight: sources in code-point order, null last, weigh ``weights`` in turn."""
    ordered = sources.repartitionByRange(F.col("source").asc_nulls_last())
    placed = stage(ordered.withColumn("part", F.spark_partition_id()), "mix-order")
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    ranked = placed.withColumn("place", place).join(before, "part")
    turn = F.pmod(F.col("place") + F.col("before") - 1, F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn + 1)
    return ranked.select("source", "source_size", weight.alias("weight"))


def targets(sources: DataFrame, ceiling: int = CEILING) -> DataFrame:
    """Adds target to (source, source_size, weight); the totals of each round are one row."""
    level, capped = None, -1
    cap = F.col("source_size") * ceiling
    free = F.lit(True)
    while True:
        row = sources.agg(F.sum("source_size").alias("all"), F.sum(F.when(free, 0).otherwise(cap)).alias("given"),
                          F.sum(F.when(free, F.col("weight")).otherwise(0)).alias("weights"),
                          F.count(F.when(~free, 1)).alias("capped")).first()
        if row["capped"] == capped or not row["weights"]:
            break
        capped, level = row["capped"], ((row["all"] or 0) - (row["given"] or 0), row["weights"])
        # a source is at its ceiling where weight * left / weights >= cap, in whole numbers
        exact = "decimal(38,0)"
        free = F.col("weight").cast(exact) * F.lit(level[0]).cast("decimal(20,0)") < (
            cap.cast(exact) * F.lit(level[1]).cast("decimal(20,0)"))
    if level is None:
        return sources.withColumn("target", F.lit(0.0))
    share = F.col("weight").cast("double") * F.lit(float(level[0])) / F.lit(float(level[1]))
    return sources.withColumn("target", F.when(free, share).otherwise(cap.cast("double")))


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken."""
    rows = stage(sizes(docs, doc_id, text, source, seed), "mix-sizes")
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    mix = stage(targets(stage(source_weights(by_source, weights), "mix-weights"), ceiling), "mix-targets")
    mix = mix.select(F.col("source").alias("of"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = (F.floor("rate") + (F.col("coin") < F.col("rate") - F.floor("rate")).cast("long")).cast("long")
    joined = rows.join(mix, rows["source"].eqNullSafe(mix["of"])).withColumn("rate", rate)
    return joined.select("doc_id", "size", "source_size", "target", copies.alias("copies"),
                         (F.col("size") * copies).alias("taken"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING, seed: int = SEED) -> DataFrame:
    """The mixed corpus: the columns of ``docs`` and copy (1, 2, ...), each document as often as taken.

    If ``docs`` has a column copy, the new one is called copy_ with as many _ as make it new.

    The rate is joined by source, and the coin is drawn again from the row, so the texts are never
    shuffled by id; a source table within Spark's own broadcast size is broadcast by the planner.
    """
    rows = stage(sizes(docs, doc_id, text, source, seed), "mix-sizes")
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    table = stage(targets(stage(source_weights(by_source, weights), "mix-weights"), ceiling), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    of, rated = fresh(docs, "mix_of"), fresh(docs, "mix_rate")
    copy = "copy" if "copy" not in (c.lower() for c in docs.columns) else fresh(docs, "copy_")
    table = table.select(F.col("source").alias(of), rate.alias(rated))
    joined = docs.join(table, F.col(f"`{source}`").cast("string").eqNullSafe(F.col(of)))
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`").cast("string"), F.col(f"`{text}`")),
                   F.lit(_COIN)) / F.lit(float(_COIN))
    n = (F.floor(rated) + (drawn < F.col(rated) - F.floor(rated)).cast("long")).cast("int")
    taken = joined.where(n > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), n)))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns], copy)


def query(spark, sf_dir: str) -> DataFrame:
    return plan(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
