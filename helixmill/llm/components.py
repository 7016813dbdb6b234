"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


#: Edges a task of the rounds takes; a table of few edges is one file, whatever the shuffle's partitions.
EDGES_A_TASK = 1_000_000


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in edges (a, b). No edges, no rows.

    Each step keeps the components and shortens the ways; a node's neighbours are never
    gathered, only their minimum is taken and joined back.
    """
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    turned = lambda e: e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    after = scratch.table(turned(edges.select("a", "b")), f"{name}-0")
    few, last, k = 1 + after.count() // EDGES_A_TASK, None, 0
    while (seen := after.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()) != last and seen[0]:
        now, last, k = after, seen, k + 1
        linked = both(now)
        least = linked.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = linked.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.where("m < a").select("a", F.col("m").alias("b")))
        large = scratch.table(large.where("a <> b").distinct().coalesce(few), f"{name}-{k}l")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        after = scratch.table(turned(small).coalesce(few), f"{name}-{k}")
        scratch.drop(f"{name}-{k}l", f"{name}-{k - 1}")
    roots = after.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return after.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def joined_labels(labels: DataFrame, edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """labels (id, component) after edges (a, b) are added: only components that an edge joins are looked at again."""
    of = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias(f"{c}_component"))
    ends = edges.join(of("a"), "a", "left").join(of("b"), "b", "left")
    joined = scratch.table(components(ends.select(F.coalesce("a_component", "a").alias("a"), F.coalesce("b_component", "b").alias("b")), scratch, name), f"{name}-joined")
    moved = labels.join(joined.toDF("component", "to"), "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return moved.unionByName(joined.join(labels, "id", "left_anti"))
