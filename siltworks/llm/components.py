"""Connected components of an edge table, by joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.staging import settle


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Point the neighbours of each node at the least of them.

    A node's neighbours are reduced to their minimum before the join, never gathered.
    """
    if not small:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    joined = edges.join(least, "a")
    if small:
        linked = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    else:
        linked = joined.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return linked.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Nodes with the least node of their component, for edges (a, b).

    Alternating star operations; each round is a written table, and the rounds end when one
    changes nothing. Nodes without an edge do not appear.
    """
    ordered = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = settle(ordered.distinct(), "edges")
    before = None
    while True:
        edges = settle(_stars(_stars(edges, small=False), small=True), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
