"""A report on an event log: copies, runs, trees, graph, findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stocktrail.lineage.graph import closure
from stocktrail.lineage.runs import dedupe, edges, findings, flow_edges, run_tree, runs
from stocktrail.session import cut, written


def lineage_report(events: DataFrame) -> DataFrame:
    """One row per figure: (section, name, value).

    The de-duplicated log is read by several sections, each of a few of its columns, so it is
    written once as a table; the run table and the graph are small next to it.
    """
    clean = written(dedupe(events), "distinct-events")
    table = cut(runs(clean))
    links = cut(edges(clean))
    graph = flow_edges(links)
    sources = graph.select(F.col("src").alias("node")).where(F.col("node").startswith("dataset:"))
    reach = closure(graph, sources.select(F.col("node").alias("label"), "node"))

    def figure(section: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(section).alias("section"), "name", F.col("value").cast("bigint"))

    def total(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("value")).withColumn("name", F.lit(name))

    trees = run_tree(table).where(F.col("root_id").isNotNull()).agg(
        F.count("*").alias("trees"),
        F.max("depth").alias("depth"),
        F.max("n_runs").alias("largest"),
        F.sum("n_open").alias("open"),
    )
    per_tree = trees.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("bigint").alias("value"))
        for c in ("trees", "depth", "largest", "open")
    ])))
    by_state = table.groupBy(F.col("state").alias("name")).agg(F.count("*").alias("value"))
    by_mode = links.groupBy(F.col("mode").alias("name")).agg(F.count("*").alias("value"))
    problems = findings(table).groupBy(F.col("problem").alias("name")).agg(
        F.count("*").alias("value")
    )
    parts = [
        figure("log", total("events", events)),
        figure("log", total("distinct events", clean)),
        figure("runs", by_state),
        figure("trees", per_tree),
        figure("graph", by_mode),
        figure("graph", total("reachable", reach.where(F.col("depth") > 0))),
        figure("findings", problems),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.union(part)
    return report
