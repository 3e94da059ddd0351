"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1000003).alias("s"), F.sum(F.xxhash64("b", "a") % 999983).alias("t")).first()
    return row["n"], row["s"], row["t"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; the root is the least node of its component.

    `edges` has two columns of one comparable type, in any direction and with repeats; links of a node with itself and
    null ends are ignored. Each round is written to the shared folder, so a lost executor costs at most one round. A
    node with very many links is only ever a join key of tables that Spark can split, or an aggregate.
    """
    a, b = edges.columns
    now = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct(), "links")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)), "links")
        state, before = _state(now), state
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
