"""Connected components of an edge table by alternating large-star and small-star steps.

Every step groups the edges by one end, takes the smallest neighbour (a
map-side combined aggregate) and joins it back, so a vertex with very many
edges is never gathered in one task: the aggregate is partial, and adaptive
execution splits the join.  Both join sides are written tables in the shared
checkpoint folder; the loop on the driver only compares two checksums.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.materialize import materialize


def _checksum(edges: DataFrame):
    h = F.xxhash64("a", "b").cast("decimal(20,0)")
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("h")).first()
    return r["n"], r["h"]


def _star(edges: DataFrame, hub: Column, leaf: Column, keep: Column, label: str) -> DataFrame:
    """Edges (hub, leaf) -> (leaf, smallest of the hub's closed neighbourhood)."""
    pairs = edges.select(hub.alias("u"), leaf.alias("v"))
    low = materialize(pairs.groupBy("u").agg(F.min("v").alias("m"))
                      .select("u", F.least("u", "m").alias("m")), label)
    return pairs.join(low, "u").where(keep).select(F.col("v").alias("a"), F.col("m").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of its component for every node that has an edge.

    ``edges`` has two columns ``a`` and ``b`` of one ordered, non-NULL type.  No edges give no
    rows; repeated edges and self-loops (which leave a node its own root) change nothing.
    """
    a, b = F.col("a"), F.col("b")
    nodes = edges.select(a.alias("node")).union(edges.select(b.alias("node"))).distinct()
    edges = materialize(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
                        "edges")
    before = _checksum(edges)
    while before[0]:
        both = edges.union(edges.select(b, a))
        large = materialize(_star(both, a, b, F.col("v") > F.col("u"), "large").where(a != b).distinct(), "large-star")
        down = large.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        small = _star(down, a, b, F.col("v") != F.col("m"), "small")
        hubs = down.groupBy("a").agg(F.min("b").alias("b"))
        edges = materialize(small.union(hubs.select("a", "b")).distinct(), "small-star")
        after = _checksum(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
