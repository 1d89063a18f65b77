"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkgrid.llm.common import table



def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, component`` (smallest node reachable) of every node in ``edges`` (columns ``a``, ``b``; any order, repeats allowed).

    Alternating large-star and small-star rounds: each links the neighbours of a node to the smallest of them, by grouped
    minimum and join, so a hub is no single task's work, and the number of rounds grows with the logarithm of the longest
    chain. Every round is a table in the shared folder, of few files if it has few rows (a round never adds edges); the driver
    only sees whether a round changed anything.
    """
    now = table(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    state = _state(now)
    while state[0]:
        large = _star(now.union(now.select("b", "a")), larger_only=True)
        now = table(_star(large, larger_only=False), label, state[0])
        state, before = _state(now), state
        if state == before:
            break
    top = now.groupBy("a").agg(F.min("b").alias("b"))
    return top.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def _state(edges: DataFrame) -> tuple:
    """Number of edges and two order-free sums that change if any edge does."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(h.bitwiseAND(F.lit((1 << 31) - 1))), F.lit(0)), F.coalesce(F.sum(F.shiftright(h, 33)), F.lit(0))).first())


def _star(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Links to the smallest neighbour m of each node u (or u itself): of u's larger neighbours (large star, ``pairs`` in both
    directions), or of u and its smaller neighbours (small star, ``pairs`` from the larger to the smaller node)."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = pairs.join(least, "a")
    if larger_only:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.filter("a != b").distinct()
