"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.session import settle


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("u"), F.col("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    rest = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v, longs): root is the smallest node of its component.

    Each round stores its links, so a lost executor costs one round, and its end is seen when a
    round leaves all links as they are. The minimum around a node is found by partial
    aggregation and joined back, so a node with most of the links is a skewed join that Spark
    splits, never one task's list. Loops and repeated links do no harm; no links give no rows.
    """
    now = settle(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    for _ in range(most_rounds):
        if not state[0]:
            break
        now = settle(_small_star(_large_star(now)))
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"links still change after {most_rounds} rounds")
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return settle(now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots))


def _state(edges: DataFrame) -> tuple[int, int]:
    """Changes with the set of links: how many, and the sum of their hashes."""
    n, total = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
    return n, int(total)
