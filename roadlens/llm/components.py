"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``; the component is its smallest node.

    Each round every node takes the smallest label among itself and its
    neighbours, then the label of that label (pointer jumping), so labels cross
    a long chain in a logarithmic number of rounds. Minima are pre-aggregated
    and labels joined, so a node with any number of links is spread over tasks.
    """
    both = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a != b").distinct(), "cc-links")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "cc-labels0")
    number = 0
    while True:
        number += 1
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
                .withColumnRenamed("a", "node"))
        taken = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        after = staged(taken.join(jump, "next", "left").select(
            "node", F.least("next", F.coalesce("far", "next")).alias("component"),
            (F.least("next", F.coalesce("far", "next")) != F.col("component")).alias("moved")), f"cc-labels{number}")
        labels = after.select("node", "component")
        if after.filter("moved").isEmpty():
            return labels


def extended(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels (node, component)`` after further ``links (a, b)``; only components that these join are walked again, by their names."""
    ends = links.select("a", "b").join(labels.select(F.col("node").alias("a"), F.col("component").alias("x")), "a", "left")
    ends = ends.join(labels.select(F.col("node").alias("b"), F.col("component").alias("y")), "b", "left")
    ends = staged(ends.select("a", "b", F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y")), "cc-ends")
    names = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b"))).toDF("component", "after")
    nodes = labels.unionByName(ends.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("x").alias("component")),
                                                             F.struct(F.col("b").alias("node"), F.col("y").alias("component")))).alias("s"))
                               .select("s.node", "s.component")).distinct()
    return staged(nodes.join(names, "component", "left").select("node", F.coalesce("after", "component").alias("component")), "cc-extended")
