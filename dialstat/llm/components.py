"""Connected components of an undirected graph by least-label spreading with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialstat.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); component is the least node reachable.

    Each round takes the least label among a node and its neighbours, then follows the label's own
    label; the table is written to the shared folder every round, and only a changed flag reaches
    the driver. Labels shrink along paths of doubling length, so long chains need few rounds.
    """
    both = stage(edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
        edges.select("b", "a")).distinct(), "components-edges")
    labels = stage(both.groupBy("node").agg(F.min("other").alias("near")).select(
        "node", F.least("node", "near").alias("component")), "components")
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), "component"), "other")
        near = seen.groupBy("node").agg(F.min("component").alias("near"))
        best = labels.join(near, "node").select("node", F.col("component").alias("was"),
                                                F.least("component", "near").alias("to"))
        up = labels.select(F.col("node").alias("to"), F.col("component").alias("top"))
        moved = stage(best.join(up, "to").select("node", F.col("top").alias("component"),
                                                 (F.col("top") != F.col("was")).alias("changed")), "components")
        labels = moved.select("node", "component")
        if not moved.where("changed").take(1):
            return labels
