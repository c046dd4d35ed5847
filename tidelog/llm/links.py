"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.base import discard, stage


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every end of a link; ``links`` has ``a`` and ``b``.

    The component is the smallest node reachable.  Every node holds a label, at
    first its own number.  In each round it takes the smallest label among its
    neighbours and then the label of that label's node, so a label's reach
    doubles.  Rounds go on until no label changes.  Neighbours are reduced to a
    minimum before they are joined, so a node with many links is no burden.
    """
    both = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .filter("a <> b").distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                   .select("node", F.least("node", "b").alias("component")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        taken = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("new"))
        roots = labels.select(F.col("node").alias("new"), F.col("component").alias("beyond"))
        moved = stage(taken.join(roots, "new", "left")
                      .select("node", F.col("component").alias("old"),
                              F.least("new", F.coalesce("beyond", "new")).alias("component")), "labels")
        changed = moved.filter("component <> old").limit(1).count()
        discard(labels)
        labels = moved.select("node", "component")
        if not changed:
            discard(both)
            return labels
