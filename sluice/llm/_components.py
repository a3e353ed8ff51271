"""Connected components of a link table, by minimum labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._stage import staged


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 64) -> DataFrame:
    """(node, component) for every node of ``links``: the smallest node reachable.

    Each round takes, per node, the least label among its neighbours (a
    partial and a final aggregate, so a hub costs one row per map task), then
    jumps to the label's own label, which halves the depth of every chain.
    Every round's labels are written to the shared folder; both join sides
    are therefore plain exchanges whose skewed parts Spark can split. Nothing
    but one changed-rows count per round reaches the driver. Null ends are
    dropped; an empty table gives an empty result.
    """
    links = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v")
    edges = staged(links.union(links.select("v", "u")).distinct(), "edges")
    labels = staged(edges.groupBy(F.col("u").alias("node")).agg(F.least("node", F.min("v")).alias("component")),
                    "labels")
    for _ in range(max_rounds):
        near = (edges.join(labels.select(F.col("node").alias("v"), "component"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("component").alias("near")))
        nearest = (labels.join(near, "node")
                   .select("node", F.col("component").alias("old"), F.least("component", "near").alias("label")))
        up = labels.select(F.col("node").alias("label"), F.col("component").alias("next"))
        labels = staged(nearest.join(up, "label", "left")
                        .select("node", "old", F.least("label", "next").alias("component")), "labels")
        if not labels.filter("old != component").limit(1).count():
            return labels.select("node", "component")
        labels = labels.select("node", "component")
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
