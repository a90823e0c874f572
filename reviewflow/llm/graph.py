"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.tables import saved


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, component) for each end of the links (a, b); a component's name is its smallest node.

    Labels travel along the links and then jump to the label of their label,
    so the number of rounds grows with the logarithm of the longest path. Each
    round is written to the shared folder, so no lineage builds up.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = saved(both.where("a <> b").distinct(), f"{label}-edges")
    labels = saved(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select(
        "node", F.least("node", "near").alias("component")), f"{label}-round")
    while True:
        offered = edges.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("offer"))
        nearer = labels.join(offered, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "offer").alias("component"))
        far = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        after = saved(nearer.join(far, "component").select("node", "before", F.least("component", "further").alias("component")),
                      f"{label}-round")
        labels = after.select("node", "component")
        if after.where("before <> component").isEmpty():
            return labels
