"""Connected components by minimum labels with pointer jumping, as DataFrame joins.

Every round each node takes the label of its label, then the least among its own and its
neighbours'.  Rounds are written tables in the shared folder.  Labels are
aggregated map-side, and the joins are plain equi-joins of exchanged sides, so Spark can
split the rows of a hot node.  Rounds grow with the logarithm of the diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, written


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected ``links`` (a, b); root is the least node of its component."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.filter("a <> b").distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("root")), "labels")
    last = labels
    while True:
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("up"))
        jumped = labels.join(up, "root").select("node", F.least("root", "up").alias("root"))
        near = edges.join(jumped, edges["b"] == jumped["node"]).select(F.col("a").alias("node"), "root", F.lit(None).cast(jumped.schema["root"].dataType).alias("own"))
        every = near.unionByName(jumped.withColumn("own", F.col("root")))
        found = written(every.groupBy("node").agg(F.min("root").alias("root"), F.max("own").alias("own")), "labels")
        drop(last)
        labels, last = found.select("node", "root"), found
        if not found.filter("root <> own").limit(1).count():
            drop(edges)
            return labels
