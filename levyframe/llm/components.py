"""Connected components of a graph that no machine can hold: union-find by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyframe.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (a long, b long) -> (node, component), one row a node; the component is its smallest node.

    Each round hooks every node's larger neighbours, then its smaller ones, to
    the smallest node it knows, so trees flatten and a path of n links needs
    about log n rounds.  Minima are summed up before they are shuffled, so a
    node with very many links is no hot key there; in the joins a node has one
    row on one side, which is written first, so Spark can split the other.  Nulls, self links and
    repeated links are ignored; without links the result is empty.
    """
    links = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m")))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large)
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = materialize(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    # every link now leads from a node to its component's smallest node
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
