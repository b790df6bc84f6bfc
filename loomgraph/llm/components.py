"""Connected components of pairwise matches by alternating large-star and small-star.

Edges are pairs of numbers. Each round rewrites every edge towards the smallest neighbour, with
one aggregation (which combines before it shuffles) and one join a step; a hub's rows are split
by the skew join of adaptive execution. Each round is written to the shared folder and the one
before it is deleted, so lineage stays short and lost executors do no harm. The end is the first
round that leaves count and checksum of the edge set as they were; every node then has one edge,
to its component's minimum.

Defined results: null ends are dropped, loops and repeated edges change nothing, a node without
a partner is its own group; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.session import materialize, release


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.bit_xor(F.xxhash64("b", F.lit(7), "a")).alias("y")).first()
    return tuple(r)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Of edges with a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    side = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return side.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, group) for every node that has an edge; group is the smallest node connected."""
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x is not null and y is not null and x <> y")
    e = materialize(e.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
    before = _signature(e)
    for _ in range(max_rounds):
        new = materialize(_small_star(_large_star(e)), "edges")
        after = _signature(new)
        release(e)
        e = new
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no end after {max_rounds} rounds")
    roots = e.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("group"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("group")).unionByName(roots)


def star_edges(rows: DataFrame, node: str, key: list[str]) -> DataFrame:
    """Rows that share a key as a star around the least node: as many edges as rows, not pairs."""
    keyed = rows.filter(" and ".join(f"{k} is not null" for k in key)).select(node, *key).distinct()
    least = keyed.groupBy(*key).agg(F.min(node).alias("b"))
    return keyed.join(least, key).select(F.col(node).alias("a"), "b").filter("a <> b")


def group_rows(rows: DataFrame, node: str, keys: list[list[str]]) -> DataFrame:
    """(node, group) for every distinct non-null node of ``rows``; rows match if they agree in any of the keys."""
    edges = None
    for key in keys:
        s = star_edges(rows, node, key)
        edges = s if edges is None else edges.unionByName(s)
    found = components(edges)
    nodes = rows.filter(F.col(node).isNotNull()).select(F.col(node).alias("node")).distinct()
    return nodes.join(found, "node", "left").select("node", F.coalesce("group", "node").alias("group"))
