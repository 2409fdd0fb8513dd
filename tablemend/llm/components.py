"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.session import materialize

_SALTS = 64


def _least(edges: DataFrame, node: str, value: str) -> DataFrame:
    """Least value per node; a node with very many edges is reduced in parts first."""
    parts = edges.groupBy(node, F.pmod(F.xxhash64(value), F.lit(_SALTS)).alias("salt")).agg(F.min(value).alias("least"))
    return parts.groupBy(F.col(node).alias("of")).agg(F.min("least").alias("least"))


def components(edges: DataFrame) -> DataFrame:
    """The smallest node reachable from each node, as (node, component).

    `edges` has the columns a and b of one orderable type; loops are allowed and null ends are left out. Nodes are
    joined to the least neighbour in alternating turns (large star, small star) until nothing changes, which takes a
    number of rounds that grows with the logarithm of the graph. Every round is written to the shared folder; only
    two numbers of a round reach the driver.
    """
    clean = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    all_nodes = materialize(clean.select("a", "b"), "edges")
    current = all_nodes.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    while True:
        current = materialize(current, "star")
        state = current.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("sum")
        ).first()
        if state == before or not state["n"]:
            break
        before = state
        current = _small_star(materialize(_large_star(current), "star"))
    nodes = all_nodes.select(F.col("a").alias("node")).union(all_nodes.select("b")).distinct()
    # Now every edge leads to the least node of its component, and that node has none.
    return nodes.join(current.select(F.col("a").alias("node"), "b"), "node", "left").select(
        "node", F.coalesce("b", "node").alias("component")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are tied to its least neighbour, itself included."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both, "a", "b").select("of", F.least("of", "least").alias("least"))
    larger = edges.select(F.col("b").alias("of"), F.col("a").alias("other"))
    return larger.join(least, "of").select(F.col("other").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the least of them."""
    least = _least(edges, "a", "b")
    tied = edges.join(least, F.col("a") == F.col("of"))
    return (
        tied.select(F.col("b").alias("a"), F.col("least").alias("b"))
        .where("a <> b")
        .union(least.select(F.col("of").alias("a"), F.col("least").alias("b")))
        .distinct()
    )
