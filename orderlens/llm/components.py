"""Connected components of a table of links, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.session import reliable


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest reachable node) of every end of a link (``a``, ``b``).

    Each round gives a node the smallest label among its neighbours, then the label of its label,
    which halves the remaining distances; rounds end when no label changes. Labels are combined in
    the map tasks, so a node with very many links is no hot spot. No links give no rows.
    """
    ends = reliable(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b").distinct()
    )
    labels = reliable(
        ends.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component"))
    )
    while True:
        near = (
            ends.join(labels, ends["b"] == labels["node"])
            .groupBy(F.col("a").alias("near_node"))
            .agg(F.min("component").alias("nearest"))
        )
        passed = labels.join(near, F.col("node") == F.col("near_node")).select(
            "node", F.col("component").alias("old"), F.least("component", "nearest").alias("component")
        )
        roots = labels.select(F.col("node").alias("root"), F.col("component").alias("of_root"))
        jumped = reliable(
            passed.join(roots, F.col("component") == F.col("root"), "left").select(
                "node", "old", F.least("component", "of_root").alias("component")
            )
        )
        labels = jumped.select("node", "component")
        if jumped.where("component <> old").isEmpty():
            return labels
