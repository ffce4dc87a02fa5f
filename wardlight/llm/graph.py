"""Connected components of a table of links, and links found inside buckets without all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlight.llm.common import stage

#: Most hubs that a node is tried against, and how many nodes a node's bucket holds on average before a further one is.
HUBS, MANY = 5, 20


def _mark(edges: DataFrame) -> tuple:
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b); the root is the smallest node reachable.

    Large and small stars in turn, each round a few aggregations and joins over the links and stored, until the links
    no longer change; the rounds grow with the logarithm of the longest chain. Links may repeat, run either way or
    lead to themselves; NULL ends are left out.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _mark(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("low", "a").alias("root"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
                 .where("a <> b").distinct())
        large = stage(large, "stars")
        low = large.groupBy("a").agg(F.min("b").alias("root"))
        small = (large.join(low, "a").where("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
                 .union(low.select("a", F.col("root").alias("b"))).distinct())
        edges = stage(small, "stars")
        after = _mark(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))


def linked(buckets: DataFrame, verified: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, root) of the nodes that verified links join, of all pairs that share a bucket (`key`, `node`).

    `verified` keeps the true links of a table of pairs (a, b). First every node is tried against one hub of each of its
    buckets. What that joins needs no more trying: then only pairs of one bucket that still lie in different components
    are tried. While those are many more than the nodes in question, other hubs are tried before. So every pair is
    either tried or already joined, and a bucket of many alike nodes costs a few tries for each node instead of one for
    each pair.
    """
    # one shuffle by key; most buckets hold one node and go where they arrive
    bucket = Window.partitionBy("key")
    members = stage(buckets.withColumns({"low": F.min("node").over(bucket), "high": F.max("node").over(bucket)})
                    .where("low <> high").select("key", "node").distinct(), "bucket-members")
    links = members.sparkSession.createDataFrame([], members.select(F.col("node").alias("a"), F.col("node").alias("b")).schema)
    placed = members.withColumn("root", F.col("node"))
    for number in range(HUBS):
        chosen = F.min_by(F.struct("node", "root"), F.struct(F.xxhash64("node", F.lit(number)), "node"))
        hubs = placed.groupBy("key").agg(chosen.alias("hub")).select("key", F.col("hub.node").alias("hub"), F.col("hub.root").alias("hub_root"))
        tried = placed.join(hubs, "key").where("root <> hub_root").select(
            F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
        links = stage(links.union(verified(tried).select("a", "b")).distinct(), "hub-links")
        roots = stage(components(links), "roots")
        placed = members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        sizes = placed.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        open_ = stage(placed.join(sizes.select("key", "n"), "key"), "open-buckets")
        nodes, pairs = open_.agg(F.count("*"), F.sum("n")).first()
        if (pairs or 0) <= MANY * nodes:
            break
        placed = open_.select("key", "node", "root")
    a, b = (open_.select("key", F.col("node").alias(n), F.col("root").alias(f"root_{n}")) for n in "ab")
    rest = stage(verified(a.join(b, "key").where("root_a < root_b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()), "other-links")
    if rest.isEmpty():
        return roots
    return components(links.union(rest.select("a", "b")))
