"""Connected components of a table of links, by minimum labels and pointer jumping, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node, component (the smallest node reachable) for each node of links(u, v).

    A round gives every node the smallest label among its neighbours, then the label of that label. It ends when a round
    changes nothing. Each round's labels are a written table.
    """
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = scratch.table(both.distinct(), f"{name}-edges")
    labels = scratch.table(edges.groupBy("u").agg(F.min("v").alias("near")).select(F.col("u").alias("node"), F.least("u", "near").alias("component")), f"{name}-0")
    k = 0
    while True:
        k += 1
        near = edges.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("component").alias("near"))
        lower = labels.join(near.withColumnRenamed("u", "node"), "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("now"))
        lower = scratch.table(lower, f"{name}-low{k}")
        up = lower.select(F.col("node").alias("now"), F.col("now").alias("above"))
        jumped = lower.join(up, "now", "left").select("node", "was", F.coalesce("above", "now").alias("component"))
        jumped = scratch.table(jumped, f"{name}-{k}")
        changed = jumped.filter("was <> component").limit(1).count()
        scratch.drop(f"{name}-low{k}")
        scratch.drop(f"{name}-{k - 1}")
        labels = jumped.select("node", "component")
        if not changed:
            scratch.drop(f"{name}-edges")
            return labels
