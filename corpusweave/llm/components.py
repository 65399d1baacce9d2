"""Connected components of a link table, without driver state.

Rounds of large-star and small-star steps: every node links its neighbours to
the smallest node near it, until each component is a star around its smallest
member. Links are halved or contracted in each round, minima are combined before
the shuffle, and a node with very many links costs its minimum and one join that
may be split. Rounds are written to the shared folder, so a lost executor
repeats at most one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusweave.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest node near it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    found = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return found.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each smaller neighbour of a node, and the node, to its smallest neighbour."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame):
    """Equal for equal link sets."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every node of ``edges(a, b)`` of long ids.

    ``component`` is the smallest id that links reach. Loops, repeated links and
    either direction are fine; nulls link nothing. Nodes without another are left out.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = written(ordered, "links")
    mark = _mark(now)
    while mark[0]:
        now = written(_small_star(_large_star(now)), "links")
        new = _mark(now)
        if new == mark:
            break
        mark = new
    found = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return found.unionByName(roots)
