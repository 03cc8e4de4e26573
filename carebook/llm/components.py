"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebook.llm.common import stored

MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour of u above u is linked to u's least neighbour (or u)."""
    pairs = _both_ways(edges)
    least = pairs.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
    return (pairs.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its neighbours below u are linked to the least of them. ``edges`` has u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("_m"))
    below = edges.join(least, "u").where(F.col("v") != F.col("_m")).select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return below.unionByName(least.select("u", F.col("_m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long, any order).

    ``component`` is the least node reachable. Large-star and small-star steps
    alternate until the edge table no longer changes, at which point each node
    is linked to its component alone. Each round is written to the shared
    folder; the driver sees three numbers a round. A node with very many
    neighbours is one key of a join against one row, which Spark's skew split
    cuts up; its least neighbour is aggregated before the shuffle.

    Self-links and rows with a null end are ignored; repeated edges count once;
    no edges give no rows.
    """
    now = stored(edges.where(F.col("u") != F.col("v"))
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        now = stored(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
