"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from telhado.session import materialise

MAX_ROUNDS = 100


def _toward_least(pairs: DataFrame, keep_larger_only: bool) -> DataFrame:
    """One star step over ordered pairs (u, v): the chosen neighbours of each u are linked to the least of them and u.

    The least neighbour is an aggregate and comes back by a join, so a node with very many
    neighbours is never gathered in one place.
    """
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = pairs.join(least, "u")
    if keep_larger_only:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the least node of its component.

    `links` has columns a and b of one orderable type. Alternates the large-star and the
    small-star step until the links no longer change; each round is written to the shared
    folder, so its lineage is one table and an executor's loss costs one round at most. Only
    a count and a checksum reach the driver. No links: no rows.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialise(edges, "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = tuple(state)
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = _toward_least(both, keep_larger_only=True)
        small = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        edges = materialise(_toward_least(small, keep_larger_only=False), "links")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
