"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topictide.session import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); a component is its smallest node.

    Every round takes the smallest label among the neighbours and then the label of that
    label, which halves the way to the root. Labels are written to the shared folder after each
    round; rounds grow with the logarithm of the diameter.
    """
    forward = edges.select("u", "v").where(F.col("u") != F.col("v"))
    both = materialise(
        forward.unionByName(forward.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges"
    )
    labels = materialise(
        both.groupBy("u").agg(F.min("v").alias("_low")).select(
            F.col("u").alias("node"), F.least("u", "_low").alias("component")
        ),
        "labels",
    )
    while True:
        seen = labels.select(F.col("node").alias("v"), F.col("component").alias("_label"))
        low = both.join(seen, "v").groupBy(F.col("u").alias("node")).agg(F.min("_label").alias("_low"))
        hooked = labels.join(low, "node").select(
            "node", "component", F.least("component", "_low").alias("_next")
        )
        roots = labels.select(F.col("node").alias("_next"), F.col("component").alias("_root"))
        step = materialise(
            hooked.join(roots, "_next").select(
                "node",
                F.least("_next", "_root").alias("component"),
                (F.least("_next", "_root") < F.col("component")).alias("_moved"),
            ),
            "labels",
        )
        labels = step.select("node", "component")
        if step.where("_moved").isEmpty():
            return labels
