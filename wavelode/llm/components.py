"""Connected components of a table of links."""

from pyspark.sql import functions as F

from wavelode.llm.common import discard, stored


def _signature(edges):
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("hash"),
    ).first()
    return row["n"], row["hash"]


def _to_minimum(edges, label):
    """Point each u's neighbours v, and u, at the smallest of them all."""
    least = stored(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), label)
    return edges.join(least, "u"), least


def connected_components(edges):
    """Rows (node, component) for the ends of links (u, v); a component is named by its
    smallest node.

    Large-star and small-star steps in turn: each step keeps the components, and ends
    with a star around every smallest node, after a number of rounds that grows with
    the logarithm of the nodes. Each step writes its links under the shared folder. Only
    sums over links reach the driver. Links of a node are never gathered in one place:
    minima are combined before the shuffle and joined back to the links.
    """
    edges = stored(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u <> v").distinct(),
        "links",
    )
    seen = None
    while True:
        now = _signature(edges)
        if now == seen:
            break
        seen = now
        # Large star: every larger neighbour of a node goes to the node's minimum.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        moved, least = _to_minimum(both, "large-minima")
        large = stored(
            moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "large-star",
        )
        discard(edges, least)
        # Small star: a node and its smaller neighbours go to the smallest of them.
        small, least = _to_minimum(large, "small-minima")
        edges = stored(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct(),
            "small-star",
        )
        discard(large, least)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
