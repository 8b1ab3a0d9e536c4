"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servelens.session import ensure_checkpoint_dir


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours are linked to the smallest of them (or the node itself): for
    ``large`` the greater neighbours, else the smaller ones and the node."""
    if large:
        near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    if large:
        linked = near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = near.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return linked.filter("a != b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)`` that is not the smallest of its
    component, which is the component's name.  The rounds grow with the logarithm of the longest
    path; each is checkpointed to the shared folder."""
    ensure_checkpoint_dir(edges.sparkSession)
    state = lambda df: tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
    edges = edges.filter("a != b").distinct().checkpoint()
    before = state(edges)
    while True:
        edges = _star(_star(edges, True), False).checkpoint()
        now = state(edges)
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
