"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import discard, stored


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) of every linked node; links: a, b (long).

    Every step joins each node's smallest neighbour to its links and is written to the shared folder, so
    the work survives lost executors; the number of steps grows with the logarithm of the component's size.
    """
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    before, spark = None, links.sparkSession
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(edges.select("lo", "lo").distinct().toDF("node", "root"))
        before = now
        both = edges.union(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stored(both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")), "large-star")
        small = large.join(large.groupBy("hi").agg(F.min("lo").alias("m")), "hi")
        moved = small.filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(small.select("hi", F.col("m").alias("lo")))
        old, edges = edges, stored(moved.distinct(), "edges")
        discard(spark, old, large)


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (node, root) after more links (a, b) between nodes; links within a component change nothing."""
    root = lambda side: labels.select(F.col("node").alias(side), F.col("root").alias(f"r{side}"))
    more = links.join(root("a"), "a", "left").join(root("b"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).filter("a <> b")
    more = stored(more.distinct(), "links")
    if more.isEmpty():
        return labels
    moved = components(more).toDF("root", "to")
    old = labels.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return stored(old.union(moved.join(labels.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("to").alias("root"))), "labels")
