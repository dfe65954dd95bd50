"""Connected components of a graph given as edges, by Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.session import write_out


def components(edges: DataFrame, label: str) -> DataFrame:
    """node, component: the smallest node that edges (a, b) reach, for every node that has an edge.

    Rounds of two steps hang every node below smaller ones until all hang on the least node of their component: first
    each node links its larger neighbours to its smallest neighbour, then its smaller ones. A round is a written table,
    and the number of rounds follows the logarithm of the number of nodes. Rows of a node with very many neighbours
    are joined to its minimum with adaptive skew handling; no neighbourhood is collected.
    """
    now = write_out(_tidy(edges.select("a", "b")), f"{label}-edges")
    while True:
        large = _linked(_both(now), larger=True)
        small = _linked(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), larger=False)
        after = write_out(_tidy(small), f"{label}-edges")
        if _print(after) == _print(now):
            break
        now = after
    least = after.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return least.unionByName(after.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _tidy(edges: DataFrame) -> DataFrame:
    """Larger end first, no loops, no repeats."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _linked(edges: DataFrame, larger: bool) -> DataFrame:
    """Neighbours b of each a (all larger ones, or all smaller ones and a itself) linked to a's smallest neighbour."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = edges.join(least, "a")
    if larger:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own).where("a <> b")


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum("b")).first())
