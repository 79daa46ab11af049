"""Connected components of a graph given as links, in a few shuffles of the links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from registrylake.tables.work import staged


def _state(edges: DataFrame):
    """Number and checksum of the edges."""
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node with a link; the component is its smallest node.

    Alternates two steps until nothing changes. The first links each larger neighbour of a
    node to the smallest one, the second links a node and its smaller neighbours to the
    smallest. Each step keeps the components and shortens the paths; a chain of n nodes
    takes about log n rounds. Every round is written to the shared folder, so a lost
    executor costs one round at most. NULL ends and loops are no links.
    """
    edges = staged(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )
    before = None
    while (now := _state(edges)) != before and now[0]:
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(smallest, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(smallest, "u")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(smallest.select("u", F.col("m").alias("v")))
        edges = staged(small.distinct())
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
