"""What lies upstream and downstream: of datasets, of columns, of tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stocktrail.session import cut

# Rounds after which the reached rows are written as one piece again.
_MERGE_EVERY = 8


def reversed_edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def closure(
    edges: DataFrame,
    start: DataFrame,
    direction: str = "downstream",
    max_depth: int | None = None,
) -> DataFrame:
    """All (label, node) reachable from the start rows, with the least number of steps.

    ``edges`` is (src, dst), ``start`` (label, node); a label is whatever is carried along: the
    node the walk began at, or a tag. Depth 0 is the start itself.

    A round joins only the nodes found in the last one, and drops what was found before, so cycles
    end. Every round is written out: its plan does not grow with the rounds before it, and a lost
    executor does not set it back to the first.

    Neither the edges nor what was reached are ever sent whole to the driver: Spark takes their size
    from the compressed files below them, a few bytes a row, and would broadcast millions of rows
    once a round. Both sides of a join are shuffled and merged.
    """
    if direction not in ("downstream", "upstream"):
        raise ValueError(f"unknown direction: {direction}")
    steps = edges.select("src", "dst") if direction == "downstream" else reversed_edges(edges)
    steps = cut(steps.where(F.col("src") != F.col("dst")).distinct())
    frontier = cut(
        start.select("label", "node").distinct().withColumn("depth", F.lit(0).cast("bigint"))
    )
    reached = frontier
    depth = 0
    while max_depth is None or depth < max_depth:
        depth += 1
        found = (
            frontier.join(steps.hint("merge"), frontier["node"] == steps["src"])
            .select("label", F.col("dst").alias("node"))
            .distinct()
            .join(reached.hint("merge"), ["label", "node"], "left_anti")
        )
        frontier = cut(found.withColumn("depth", F.lit(depth).cast("bigint")))
        if frontier.isEmpty():
            break
        reached = reached.union(frontier)
        if depth % _MERGE_EVERY == 0:
            reached = cut(reached)
    return reached


def propagate_tags(edges: DataFrame, tags: DataFrame) -> DataFrame:
    """(node, tag) for each tagged node and all that is made from it. ``tags`` is (node, tag)."""
    reached = closure(edges, tags.select(F.col("tag").alias("label"), "node"))
    return reached.select("node", F.col("label").alias("tag"))


def column_edges(records: DataFrame) -> DataFrame:
    """One row per output column and input column it is made from.

    ``records`` has out_table, out_column and lineage, an array of (table, column).
    """
    return (
        records.select("out_table", "out_column", F.explode("lineage").alias("origin"))
        .select(
            "out_table",
            "out_column",
            F.col("origin.table").alias("in_table"),
            F.col("origin.column").alias("in_column"),
        )
        .distinct()
    )


def column_records(events: DataFrame) -> DataFrame:
    """(out_table, out_column, lineage) as the events' outputs report them; see ``column_edges``."""
    reported = events.select(F.explode("outputs").alias("d")).select(
        F.col("d.name").alias("out_table"),
        F.explode("d.facets.columnLineage.fields").alias("out_column", "of"),
    )
    origin = F.transform(
        "of.inputFields", lambda x: F.struct(x["name"].alias("table"), x["field"].alias("column"))
    )
    return reported.select("out_table", "out_column", origin.alias("lineage"))


def column_graph(edges: DataFrame) -> DataFrame:
    """Column lineage as a graph over ``table.column`` nodes."""
    return edges.select(
        F.concat_ws(".", "in_table", "in_column").alias("src"),
        F.concat_ws(".", "out_table", "out_column").alias("dst"),
    )


def column_impact(edges: DataFrame, columns: DataFrame) -> DataFrame:
    """Final columns reachable from each source column; final means nothing is made from them.

    ``columns`` has one column ``node`` of ``table.column`` names.
    """
    graph = column_graph(edges)
    reached = closure(graph, columns.select(F.col("node").alias("label"), "node"))
    inner = graph.where(F.col("src") != F.col("dst")).select(F.col("src").alias("node")).distinct()
    final = reached.where(F.col("depth") > 0).join(inner.hint("merge"), "node", "left_anti")
    return final.select(F.col("label").alias("source"), F.col("node").alias("final"), "depth")
