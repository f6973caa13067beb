"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.llm.common import staged


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node.

    Each round every node takes the smallest label around it, labels follow
    their labels once, and links are rewritten between labels; links inside a
    component vanish. Self-links and nulls are ignored; no links give no rows.
    """
    edges = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = staged(edges, "links")
    labels = staged(
        edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().select("node", F.col("node").alias("component")),
        "labels",
    )
    for _ in range(max_rounds):
        if edges.isEmpty():
            return labels
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("m"))
        # follow the chosen label once: its own choice is not larger
        jump = least.select(F.col("a").alias("m"), F.col("m").alias("mm"))
        step = staged(
            least.join(jump, "m", "left").select("a", F.coalesce("mm", "m").alias("to")), "steps"
        )
        labels = staged(
            labels.join(step.select(F.col("a").alias("component"), "to"), "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")
            ),
            "labels",
        )
        one = edges.join(step, "a", "left").select("b", F.coalesce("to", "a").alias("x"))
        two = one.join(step.withColumnRenamed("a", "b"), "b", "left").select("x", F.coalesce("to", "b").alias("y"))
        edges = staged(
            two.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links"
        )
    raise RuntimeError("components did not settle")
