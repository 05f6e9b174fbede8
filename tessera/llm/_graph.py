"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._store import written


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of all nodes of ``edges`` (a, b); comp is the smallest
    node of the component. Every round takes the smallest label around each
    node (map-side combined, so a node with many links is no hot key) and
    then the label of that label; written each round, so nothing is lost
    with an executor. Only the number of changes reaches the driver."""
    edges = edges.select("a", "b").filter("a <> b")
    both = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "graph-edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m"))
                     .select("node", F.least("node", "_m").alias("comp")), "graph-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("comp").alias("_l")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("_l").alias("_l")))
        step = labels.join(near, "node").select("node", F.col("comp").alias("_old"), F.least("comp", "_l").alias("_new"))
        jump = labels.select(F.col("node").alias("_new"), F.col("comp").alias("_root"))
        after = written(step.join(jump, "_new", "left").select(
            "node", "_old", F.least("_new", F.coalesce("_root", "_new")).alias("comp")), "graph-labels")
        changed = after.filter("comp <> _old").limit(1).count()
        labels = after.select("node", "comp")
        if not changed:
            return labels
