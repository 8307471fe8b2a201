"""Tables about runs, jobs and datasets, from a log of run events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from stocktrail.functions.scalars import day
from stocktrail.session import cut

_EVENT_ID = {"_run": "run.runId", "_type": "eventType", "_time": "eventTime"}


def dedupe(events: DataFrame) -> DataFrame:
    """One copy of an event that was sent more than once.

    Whole events are sorted for this. They are shuffled first, so that a task sorts what it was sent,
    and not all the events that it makes of much smaller rows.
    """
    ids = {name: F.col(path) for name, path in _EVENT_ID.items()}
    return events.withColumns(ids).repartition(*ids).dropDuplicates(list(ids)).drop(*ids)


def runs(events: DataFrame) -> DataFrame:
    """One row per run, sent-twice events making no difference.

    The earliest START and the latest COMPLETE count. A COMPLETE without START is a finished run
    whose start is not known.

    Over the log, texts are keys and only times are added up, which Spark hashes; with texts among
    the results it would sort the log. What is left is a row or two per run.
    """
    started = F.min(F.when(F.col("eventType") == "START", F.col("eventTime")))
    ended = F.max(F.when(F.col("eventType") == "COMPLETE", F.col("eventTime")))
    said = events.groupBy(
        F.col("run.runId").alias("run_id"),
        F.col("job.namespace").alias("ns"),
        F.col("job.name").alias("n"),
        F.col("run.facets.parent.run.runId").alias("parent"),
    ).agg(started.alias("started_at"), ended.alias("ended_at"))
    table = said.groupBy("run_id").agg(
        F.max(F.struct("ns", "n")).alias("j"),
        F.max("parent").alias("parent_run_id"),
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
    )
    return table.select(
        "run_id",
        F.col("j.ns").alias("namespace"),
        F.col("j.n").alias("job"),
        "parent_run_id",
        "started_at",
        "ended_at",
        seconds_between("started_at", "ended_at").alias("duration_sec"),
        F.when(F.col("ended_at").isNotNull(), "COMPLETE").otherwise("START").alias("state"),
    )


def seconds_between(start, end) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def run_history(runs: DataFrame, k: int = 2) -> DataFrame:
    """The current and the k - 1 previous runs of every job.

    Spark keeps k runs per job in each task before the shuffle, so a job with most of the runs
    does not reach one task with all of them.
    """
    latest = W.partitionBy("namespace", "job").orderBy(
        F.col("started_at").desc_nulls_last(), F.col("run_id").desc()
    )
    return runs.withColumn("recency", F.row_number().over(latest)).where(F.col("recency") <= k)


def job_runtime(runs: DataFrame) -> DataFrame:
    """Finished runs per job: how many, mean, longest and most recent duration."""
    done = runs.where(F.col("duration_sec").isNotNull())
    return done.groupBy("namespace", "job").agg(
        F.count("*").alias("n_runs"),
        (F.sum("duration_sec").cast("double") / F.count("*")).alias("mean_sec"),
        F.max("duration_sec").alias("max_sec"),
        F.max_by("duration_sec", F.struct("started_at", "run_id")).alias("last_sec"),
    )


def _touches(events: DataFrame) -> DataFrame:
    """One row per event and dataset it reads or writes, in one pass over the log."""

    def side(column: str, mode: str) -> Column:
        return F.transform(
            column,
            lambda d: F.struct(
                F.lit(mode).alias("mode"),
                d["namespace"].alias("namespace"),
                d["name"].alias("name"),
                d["facets"]["schema"]["fields"].alias("fields"),
            ),
        )

    both = F.concat(side("inputs", "read"), side("outputs", "write"))
    return events.select(
        F.col("run.runId").alias("run_id"),
        F.col("job.namespace").alias("job_namespace"),
        F.col("job.name").alias("job"),
        "eventTime",
        F.explode(both).alias("d"),
    )


def access_frequency(events: DataFrame) -> DataFrame:
    """Runs that read and that wrote each dataset, per day.

    START and COMPLETE repeat the datasets, so runs are counted, not events. Making (dataset, day,
    run) distinct first spreads a much-used dataset over its runs.
    """
    per_run = (
        _touches(events)
        .select("d.namespace", "d.name", "d.mode", day("eventTime").alias("date"), "run_id")
        .distinct()
    )
    return per_run.groupBy("namespace", "name", "date").agg(
        F.count(F.when(F.col("mode") == "read", 1)).alias("n_reads"),
        F.count(F.when(F.col("mode") == "write", 1)).alias("n_writes"),
    )


def edges(events: DataFrame) -> DataFrame:
    """Which job reads and writes which dataset."""
    return (
        _touches(events)
        .select(
            "job_namespace",
            "job",
            "d.mode",
            F.col("d.namespace").alias("dataset_namespace"),
            F.col("d.name").alias("dataset"),
        )
        .distinct()
    )


def flow_edges(edges: DataFrame) -> DataFrame:
    """The same as a directed graph: dataset -> job for a read, job -> dataset for a write."""
    ds = F.concat_ws(":", F.lit("dataset"), "dataset_namespace", "dataset")
    job = F.concat_ws(":", F.lit("job"), "job_namespace", "job")
    read = F.col("mode") == "read"
    return edges.select(
        F.when(read, ds).otherwise(job).alias("src"), F.when(read, job).otherwise(ds).alias("dst")
    )


def schema_history(events: DataFrame) -> DataFrame:
    """Every column a written dataset was reported with, and when it was first and last seen."""
    fields = events.select("eventTime", F.explode("outputs").alias("d")).select(
        "eventTime",
        "d.namespace",
        "d.name",
        F.posexplode("d.facets.schema.fields").alias("position", "f"),
    )
    return fields.groupBy(
        "namespace",
        "name",
        "position",
        F.col("f.name").alias("column"),
        F.col("f.type").alias("type"),
        F.col("f.description").alias("description"),
    ).agg(F.min("eventTime").alias("first_seen"), F.max("eventTime").alias("last_seen"))


def dataset_lifecycle(events: DataFrame) -> DataFrame:
    """Per dataset: first and last written, last read, schema versions and the current schema.

    Over the log a schema is part of the key and only times are added up, as in ``runs``; the JSON
    text is made once per dataset and schema.
    """
    seen = (
        _touches(events)
        .groupBy(
            F.col("d.namespace").alias("namespace"),
            F.col("d.name").alias("name"),
            F.col("d.mode").alias("mode"),
            F.when(F.col("d.mode") == "write", F.col("d.fields")).alias("fields"),
        )
        .agg(F.min("eventTime").alias("first"), F.max("eventTime").alias("last"))
    )
    read, write = F.col("mode") == "read", F.col("mode") == "write"
    versions = seen.withColumn("schema", F.to_json("fields"))
    latest = F.when(F.col("schema").isNotNull(), F.struct("last", "schema"))
    return versions.groupBy("namespace", "name").agg(
        F.min(F.when(write, F.col("first"))).alias("first_written"),
        F.max(F.when(write, F.col("last"))).alias("last_written"),
        F.max(F.when(read, F.col("last"))).alias("last_read"),
        F.countDistinct("schema").alias("n_versions"),
        F.max(latest)["schema"].alias("current_schema"),
    )


def job_sources(events: DataFrame) -> DataFrame:
    """Where the code of each job is kept, as last reported. Places are keys over the log, so that
    it is hashed, not sorted."""
    source = F.col("job.facets.sourceCodeLocation")
    places = (
        events.where(source.isNotNull())
        .groupBy(
            F.col("job.namespace").alias("namespace"),
            F.col("job.name").alias("job"),
            source.alias("s"),
        )
        .agg(F.max("eventTime").alias("last"))
    )
    return (
        places.groupBy("namespace", "job")
        .agg(F.max(F.struct("last", "s")).alias("latest"))
        .select("namespace", "job", "latest.s.url", "latest.s.branch", "latest.s.version")
    )


def integrity(events: DataFrame) -> DataFrame:
    """``findings`` of a log, which is read once."""
    return findings(cut(runs(events)))


def findings(table: DataFrame) -> DataFrame:
    """Runs that never completed, that completed without a START, parents nobody ran, and runs whose
    parents are a cycle.

    ``table`` (of ``runs``) is read several times. One row per finding; ``n_runs`` is the number of
    runs it concerns.
    """
    one = F.lit(1).cast("bigint").alias("n_runs")
    never = table.where(F.col("ended_at").isNull())
    unstarted = table.where(F.col("started_at").isNull())
    parents = (
        table.where(F.col("parent_run_id").isNotNull())
        .groupBy(F.col("parent_run_id").alias("run_id"))
        .agg(F.count("*").alias("n_runs"))
    )
    unknown = parents.join(table.select("run_id"), "run_id", "left_anti")
    circling = run_roots(table).where(F.col("root_id").isNull())
    return (
        never.select(F.lit("never completed").alias("problem"), "run_id", one)
        .union(unstarted.select(F.lit("completed without start").alias("problem"), "run_id", one))
        .union(unknown.select(F.lit("parent unknown").alias("problem"), "run_id", "n_runs"))
        .union(circling.select(F.lit("parents in a cycle").alias("problem"), "run_id", one))
    )


def run_roots(runs: DataFrame) -> DataFrame:
    """(run_id, root_id, depth): the topmost known run above each run.

    A parent id that matches no run makes its child a root. Each round doubles the distance every
    run has looked up, so a tree of depth d takes log2(d) rounds. Runs on a cycle of parents, and
    those below one, have NULL for root and depth: they are those left when a round finds no root,
    as the depths of a tree have no gaps.

    ``runs`` may be a long way from a log and is read three times, so its two columns are cut first.
    """
    table = cut(runs.select("run_id", F.col("parent_run_id").alias("up")))
    parents = table.where(F.col("up").isNotNull()).select(F.col("up").alias("run_id")).distinct()
    known = parents.join(table.select("run_id"), "run_id").select(F.col("run_id").alias("up"))
    linked = table.join(known.withColumn("_known", F.lit(True)), "up", "left").select(
        "run_id", F.when(F.col("_known"), F.col("up")).alias("up")
    )
    linked = cut(linked)
    done = linked.where(F.col("up").isNull()).select(
        "run_id", F.col("run_id").alias("root_id"), F.lit(0).cast("bigint").alias("depth")
    )
    waiting = linked.where(F.col("up").isNotNull()).withColumn("depth", F.lit(1).cast("bigint"))
    left = waiting.count()
    while left:
        at_root = done.select(
            F.col("run_id").alias("up"), "root_id", F.col("depth").alias("above")
        )
        above = waiting.select(
            F.col("run_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("skip")
        )
        stepped = cut(
            waiting.join(at_root, "up", "left").join(above, "up", "left").select(
                "run_id",
                F.coalesce("next", "up").alias("up"),
                "root_id",
                (F.col("depth") + F.coalesce("above", "skip", F.lit(0))).alias("depth"),
            )
        )
        found = stepped.where(F.col("root_id").isNotNull()).select("run_id", "root_id", "depth")
        waiting = stepped.where(F.col("root_id").isNull()).select("run_id", "up", "depth")
        done = done.union(found)
        still = waiting.count()
        if still == left:
            none = F.lit(None)
            circling = waiting.select(
                "run_id", none.cast("string").alias("root_id"), none.cast("bigint").alias("depth")
            )
            return done.union(circling)
        left = still
    return done


def run_tree(runs: DataFrame) -> DataFrame:
    """Steps and statements under each flow, rolled up: size, depth, span and open runs. Runs whose
    parents are a cycle are one row without root and depth."""
    rooted = runs.join(run_roots(runs), "run_id")
    return rooted.groupBy("root_id").agg(
        F.count("*").alias("n_runs"),
        F.max("depth").alias("depth"),
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
        seconds_between(F.min("started_at"), F.max("ended_at")).alias("duration_sec"),
        F.count(F.when(F.col("ended_at").isNull(), 1)).alias("n_open"),
    )
