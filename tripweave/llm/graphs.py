"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripweave.llm.common import discard, stored


def _stars(pairs: DataFrame, larger: bool) -> tuple[DataFrame, DataFrame]:
    """pairs (u, v): each u's chosen neighbours, hung on the least of u and all of them; and
    the table of the least, stored: the join then has a shuffle on each side, and one of a
    node with very many neighbours can be split."""
    least = stored(pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "components-least")
    linked = pairs.join(least, "u")
    if larger:
        return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), least
    own = least.select("u", F.col("m").alias("v"))
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own), least


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """edges (a, b: long) -> node, component (the least node reachable), for the nodes that
    have an edge. Only the check for change, two numbers, comes to the driver."""

    def tidy(pairs: DataFrame) -> DataFrame:
        return pairs.where("u <> v").distinct()

    pairs = stored(tidy(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))), "components")
    state = None
    for _ in range(rounds):
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rows, least = _stars(both, True)
        large = stored(tidy(rows), "components-large")
        discard(pairs, least)
        rows, least = _stars(large, False)
        pairs = stored(tidy(rows), "components")
        discard(large, least)
        row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (new := tuple(row)) == state:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
