"""Connected components of a distributed edge list, by alternating star steps.

A large-star step links every neighbour above a vertex to the smallest of its
neighbourhood; a small-star step does so for those below. Both only move edges,
so no task ever holds a neighbourhood. Each round is written as a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.tables import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), "m")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), "m")
    return moved.union(least.select("u", "m"))


def _star(edges: DataFrame, step) -> DataFrame:
    return step(edges).toDF("u", "v").where("u != v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum("v")).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of the edges (u, v), both BIGINT.

    A component is named by its smallest vertex. Loops and repeated edges change
    nothing; no edges give no rows.
    """
    edges = stored(
        edges.select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        ).distinct(),
        "edges",
    )
    state = _state(edges)
    while True:
        edges = stored(_star(_star(edges, _large_star), _small_star), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )
