"""Connected components of links, round by round, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stocktrail.session import written


def _stars(links: DataFrame, larger_only: bool) -> DataFrame:
    """Tie each node's larger (or smaller) neighbours to the least node of its neighbourhood."""
    if larger_only:
        near = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        return (
            near.join(least.select("u", F.least("u", "m").alias("m")), "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    hung = links.join(least, "a").where(F.col("b") != F.col("m"))
    return (
        hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionAll(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(id, component): the least node that each linked node reaches.

    ``links`` has columns a > b, both long and never NULL, in any number of copies. Nodes without
    a link are left out. The alternation of large and small stars ends after about log(n) rounds;
    each round is a table in the shared folder. A node with very many links is only ever an
    aggregate's key or one side of a join that adaptive execution may split.
    """
    now = written(links.select("a", "b").distinct(), "links")
    state = None
    while True:
        now = written(_stars(_stars(now, True), False), "links")
        after = now.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")),
        ).first()
        if tuple(after) == state:
            break
        state = tuple(after)
    nodes = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return nodes.unionAll(now.select("b", "b").distinct())
