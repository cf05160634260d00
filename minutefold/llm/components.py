"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minutefold.llm.work import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it sees."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return (
        both.join(least, "a")
        .filter("b > a")
        .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        .filter("a != b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    return (
        down.join(least, "a")
        .select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        .filter("a != b")
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum over them: equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def stars(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges ``a``, ``b`` (long) as ``a``, ``b`` where ``b`` is the smallest node of a's component.

    Smallest nodes have no row. Minima are aggregated before they are shuffled and joined back,
    so that a hub is no group in one task. The number of rounds grows with the logarithm of the
    longest path; each round is landed.
    """
    known = None
    while True:
        edges = scratch.land(_small_star(_large_star(edges)), "stars")
        found = _state(edges)
        scratch.release("stars", keep=1)
        if found == known:
            return edges
        known = found
