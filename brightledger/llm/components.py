"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brightledger.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id that is linked to a smaller one, for links (a, b).

    Large-star and small-star steps alternate until nothing moves; then every id is linked to
    the smallest of its component alone. Steps are joins and minima by id, so a hub with a
    third of all links is reduced before it is shuffled and split when it is joined. Every
    round starts at a table in the shared folder. Null ids and links to oneself are ignored,
    repeated links count once, no links give no rows.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(edges.where("u <> v").distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(nearest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(nearest).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first())
