"""Connected components of an edge table, by distributed label passing.

Every round links each node's larger neighbours, and then the node itself, to the smallest
node in its neighbourhood (large-star and small-star). The number of rounds grows with the
logarithm of a component's size, not with its diameter. Minima are combined on the map side;
what is left of a node with very many neighbours is an equi-join that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom import runtime


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie the larger neighbours of each node to its smallest neighbour (or itself)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return (
        both.join(low, "a")
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie each node and its smaller neighbours to the smallest of them; edges point down (a > b)."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(low, "a").filter(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (the smallest node) for every node of an edge.

    Loops and missing ends are left out; direction and repeats do not matter. Every round is
    stored in the shared folder, so a lost executor costs one round at most.
    """
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    known = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    current = runtime.store(known.select(high.alias("a"), low.alias("b")).distinct(), "edges")
    seen = _checksum(current)
    while seen[0]:
        current = runtime.store(_small_star(_large_star(current)), "edges")
        now = _checksum(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )


def _checksum(edges: DataFrame) -> tuple:
    """Row count and sums of two hashes: equal edge sets have equal sums."""
    parts = [F.xxhash64(F.lit(seed), "a", "b").cast("decimal(20,0)") for seed in (1, 2)]
    return tuple(edges.agg(F.count("*"), *[F.sum(p) for p in parts]).first())
