"""Run events from tables of runs, steps and statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stocktrail.functions.scalars import dotted, two_digits
from stocktrail.sources.eventlog import EVENT_SCHEMA

DATASET = EVENT_SCHEMA["inputs"].dataType.elementType

PRODUCER = "stocktrail"

# Optional columns of a run table, with their types.
_OPTIONAL = {
    "ended_at": "timestamp",
    "inputs": EVENT_SCHEMA["inputs"].dataType,
    "outputs": EVENT_SCHEMA["outputs"].dataType,
    "nominal_start": "timestamp",
    "parent_run_id": "string",
    "parent_namespace": "string",
    "parent_job": "string",
    "sql": "string",
    "source_url": "string",
    "source_branch": "string",
    "source_version": "string",
    "run_facets": "map<string,string>",
}


def dataset(
    namespace,
    name,
    fields: Column | None = None,
    told: dict[str, Column] | None = None,
    made_of: Column | None = None,
) -> Column:
    """An input or output of a run; ``fields`` is its schema, an array of name/type/description.

    ``told`` are structs said of it in this run, kept as JSON under their names. ``made_of``: by
    column of an output, an array of namespace/name/field of the columns it is made from.
    """
    schema = F.lit(None)
    if fields is not None or made_of is not None:
        lineage = None if made_of is None else F.transform_values(made_of, lambda _, of: F.struct(of))
        schema = F.struct(
            F.lit(None) if fields is None else F.struct(fields),
            F.lit(None) if lineage is None else F.struct(lineage),
            F.lit(None),
        )
    entries = [c for key, value in (told or {}).items() for c in (F.lit(key), F.to_json(value))]
    return F.struct(
        _column(namespace).alias("namespace"),
        _column(name).alias("name"),
        schema.cast(DATASET["facets"].dataType).alias("facets"),
        (F.create_map(*entries) if entries else F.lit(None).cast("map<string,string>")).alias("told"),
    )


def input_dataset(namespace, name, quality: Column, fields: Column | None = None) -> Column:
    """An input with what is known of its data, a struct such as one of ``upkeep.profile``."""
    return dataset(namespace, name, fields, {"dataQuality": quality})


def output_dataset(namespace, name, stats: Column, fields: Column | None = None) -> Column:
    """An output with its size, under both names in use; see ``upkeep.output_stats``."""
    return dataset(namespace, name, fields, {"stats": stats, "outputStatistics": stats})


def schema_fields(df: DataFrame) -> Column:
    """The schema facet of a table, as a literal array."""
    return F.array(
        *[
            F.struct(
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString().upper()).alias("type"),
                F.lit(f.metadata.get("comment")).cast("string").alias("description"),
            )
            for f in df.schema.fields
        ]
    )


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _or_none(datasets: str) -> Column:
    kind = _OPTIONAL[datasets]
    return F.coalesce(F.col(datasets).cast(kind), F.array().cast(kind))


def _when_set(key: str, struct: Column) -> Column:
    return F.when(F.col(key).isNotNull(), struct)


def to_events(runs: DataFrame, producer: str = PRODUCER) -> DataFrame:
    """START at the start and COMPLETE at the end of each run, under one run id.

    ``runs`` has run_id, namespace, job and started_at. A run without an end gives its START only,
    one without a start its COMPLETE only.
    """
    missing = {c: F.lit(None).cast(t) for c, t in _OPTIONAL.items() if c not in runs.columns}
    runs = runs.withColumns(missing) if missing else runs
    moments = F.filter(
        F.array(
            F.struct(F.lit("START").alias("t"), F.col("started_at").cast("timestamp").alias("at")),
            F.struct(F.lit("COMPLETE").alias("t"), F.col("ended_at").cast("timestamp").alias("at")),
        ),
        lambda m: m["at"].isNotNull(),
    )
    parent = _when_set(
        "parent_run_id",
        F.struct(F.struct("parent_run_id"), F.struct("parent_namespace", "parent_job")),
    )
    nominal = _when_set("nominal_start", F.struct("nominal_start", F.lit(None).cast("timestamp")))
    source = _when_set(
        "source_url", F.struct(F.lit("git"), "source_url", "source_branch", "source_version")
    )
    fields = {
        "eventType": F.col("_m.t"),
        "eventTime": F.col("_m.at"),
        "producer": F.lit(producer),
        "run": F.struct(F.col("run_id").cast("string"), F.struct(nominal, parent, "run_facets")),
        "job": F.struct(
            "namespace", "job", F.struct(_when_set("sql", F.struct("sql")), source, F.lit(None))
        ),
        "inputs": _or_none("inputs"),
        "outputs": _or_none("outputs"),
    }
    return runs.withColumn("_m", F.explode(moments)).select(
        *[fields[f.name].cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields]
    )


def step_events(steps: DataFrame) -> DataFrame:
    """Events of the steps below a flow.

    ``steps`` has run_id, namespace, flow, flow_run_id, step, started_at and ended_at.
    """
    runs = steps.withColumns(
        {
            "job": dotted("flow", "step"),
            "parent_run_id": F.col("flow_run_id").cast("string"),
            "parent_namespace": F.col("namespace"),
            "parent_job": F.col("flow"),
        }
    )
    return to_events(runs)


def sql_job_events(statements: DataFrame) -> DataFrame:
    """Events of the statements below a step.

    ``statements`` has run_id, namespace, step_run_id, step_job, table, sql and its times.
    """
    runs = statements.withColumns(
        {
            "job": dotted(F.lit("execute_sql"), "table"),
            "parent_run_id": F.col("step_run_id").cast("string"),
            "parent_namespace": F.col("namespace"),
            "parent_job": F.col("step_job"),
        }
    )
    return to_events(runs)


def nominal_time(hour, on: str, minute: int = 12) -> Column:
    """The nominal start of an hourly run on a fixed day."""
    text = F.concat(
        F.lit(f"{on} "), two_digits(hour), F.lit(":"), two_digits(F.lit(minute)), F.lit(":00")
    )
    return F.to_timestamp(text, "yyyy-MM-dd HH:mm:ss")
