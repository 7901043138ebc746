"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round is two grouped minima and two joins on the edges, so a hub with very many links is pre-aggregated
and its join partition can be split. Edges are written to the shared checkpoint folder after each round.

Edges with a null end must be left out before; repeated edges count once; an empty table has no components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemill.llm.session import tidy


def splittable(grouped: DataFrame, *keys: str) -> DataFrame:
    """A grouped table, dealt out once more by a hash of its keys. A join on the keys then shuffles it itself, and only such
    joins are split by Spark where the other side has very many rows of a key."""
    return grouped.repartition(F.xxhash64(*keys))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _round(e: DataFrame) -> DataFrame:
    """Edges after a large-star and a small-star step."""
    both = e.union(e.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.join(splittable(least, "u"), "u").filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    joined = large.join(splittable(least, "u"), "u")
    small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
    return small.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()


def components(edges: DataFrame, a: str, b: str, rounds: int | None = None) -> DataFrame:
    """(node, component): for each node with an edge to another, the smallest node that it reaches.

    rounds: stop after so many; a component may then still be in parts, each named by one of its nodes.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct().checkpoint()
    before, turn = None, 0
    while turn < rounds if rounds else (now := _state(e)) != before:
        before, turn = None if rounds else now, turn + 1
        e = _round(e)
        tidy(edges.sparkSession)
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    if rounds:
        stars = stars.groupBy("node").agg(F.min("component").alias("component"))
        return stars.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()).groupBy("node").agg(F.min("component").alias("component"))
    return stars.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
