"""The run-event record, and logs of it as JSON lines or Parquet.

Facets are open: anybody may add one to a run, a job or a dataset. Those declared here are columns;
all others are kept beside them, under ``other``, as JSON texts by name, and go back to their place
when the event is written as JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _TIME = T.StringType(), T.TimestampType()
_FACETS = T.MapType(_TEXT, _TEXT)
_DATASET = {
    "namespace": _TEXT,
    "name": _TEXT,
    "facets": _struct(
        schema=_struct(fields=T.ArrayType(_struct(name=_TEXT, type=_TEXT, description=_TEXT))),
        columnLineage=_struct(
            fields=T.MapType(
                _TEXT, _struct(inputFields=T.ArrayType(_struct(namespace=_TEXT, name=_TEXT, field=_TEXT)))
            )
        ),
        other=_FACETS,
    ),
}

EVENT_SCHEMA = _struct(
    eventType=_TEXT,
    eventTime=_TIME,
    producer=_TEXT,
    run=_struct(
        runId=_TEXT,
        facets=_struct(
            nominalTime=_struct(nominalStartTime=_TIME, nominalEndTime=_TIME),
            parent=_struct(run=_struct(runId=_TEXT), job=_struct(namespace=_TEXT, name=_TEXT)),
            other=_FACETS,
        ),
    ),
    job=_struct(
        namespace=_TEXT,
        name=_TEXT,
        facets=_struct(
            sql=_struct(query=_TEXT),
            sourceCodeLocation=_struct(type=_TEXT, url=_TEXT, branch=_TEXT, version=_TEXT),
            other=_FACETS,
        ),
    ),
    inputs=T.ArrayType(_struct(**_DATASET, inputFacets=_FACETS)),
    outputs=T.ArrayType(_struct(**_DATASET, outputFacets=_FACETS)),
)


def _as_read(kind: T.DataType) -> T.DataType:
    """A type of the record as it is in JSON: facets are a map, whatever is among them."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_read(kind.elementType))
    if isinstance(kind, T.StructType) and "other" not in kind.names:
        return T.StructType([T.StructField(f.name, _as_read(f.dataType)) for f in kind.fields])
    return _FACETS if isinstance(kind, T.StructType) else kind


def _declared(facets: Column, kind: T.StructType) -> Column:
    """Facets by name to the declared ones and the others."""
    names = [n for n in kind.names if n != "other"]
    rest = F.map_filter(facets, lambda name, _: ~name.isin(names))
    typed = [F.from_json(facets[n], kind[n].dataType).alias(n) for n in names]
    return F.when(
        facets.isNotNull(), F.struct(*typed, F.when(F.size(rest) > 0, rest).alias("other"))
    )


def _by_name(facets: Column, kind: T.StructType) -> Column:
    """The declared facets and the others to facets by name, as JSON values."""
    names = [n for n in kind.names if n != "other"]
    entries = [c for n in names for c in (F.lit(n), F.parse_json(F.to_json(facets[n])))]
    told = F.map_filter(F.create_map(*entries), lambda _, value: value.isNotNull())
    rest = F.transform_values(facets["other"], lambda _, text: F.parse_json(text))
    return F.when(
        facets.isNotNull(), F.when(facets["other"].isNull(), told).otherwise(F.map_concat(told, rest))
    )


def _with_facets(value: Column, kind: T.DataType, change) -> Column:
    """``value`` with ``change`` made to the facets anywhere in it."""
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _with_facets(x, kind.elementType, change))
    if not isinstance(kind, T.StructType):
        return value
    if "other" in kind.names:
        return change(value, kind)
    fields = [_with_facets(value[f.name], f.dataType, change).alias(f.name) for f in kind.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def with_parsed(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the event that the JSON in column ``text`` tells, as a struct ``name``; the schema
    is declared, so no pass is spent on inferring it. What is no event gives NULLs.

    The text is parsed in a column of its own, once; every field of an event has it parsed anew
    where it is taken from the expression itself.
    """
    event = F.col("_parsed")
    fields = [
        _with_facets(event[f.name], f.dataType, _declared).cast(f.dataType).alias(f.name)
        for f in EVENT_SCHEMA.fields
    ]
    parsed = df.withColumn("_parsed", F.from_json(text, _as_read(EVENT_SCHEMA)))
    return parsed.withColumn(name, F.struct(*fields)).drop("_parsed")


def read_events(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """A JSON-lines event log. A stream's batch is bounded by files or by bytes, not both."""
    reader = spark.readStream if streaming else spark.read
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    lines = reader.text(path)
    return with_parsed(lines.where(F.trim("value") != ""), "value", "event").select("event.*")


#: Events to a file of a gzipped log.
PER_FILE = 25_000


def write_events(
    events: DataFrame, path: str, compression: str | None = None, per_file: int | None = None
) -> None:
    """Append events to a JSON-lines log, gzipped on request, at most ``per_file`` of them to a file: a
    gzipped file is read by one task, whatever its size."""
    writer = events.select(*_fields_by_name(events)).write.mode("append")
    if compression:
        writer = writer.option("compression", compression)
    if per_file:
        writer = writer.option("maxRecordsPerFile", per_file)
    writer.json(path)


def _fields_by_name(events: DataFrame) -> list[Column]:
    return [
        _with_facets(events[f.name], f.dataType, _by_name).alias(f.name) for f in events.schema.fields
    ]


def event_json(events: DataFrame) -> Column:
    """Each event as JSON text, all facets in their places."""
    return F.to_json(F.struct(*_fields_by_name(events)))


def qualify(name, default_namespace: str) -> Column:
    """A dataset name with the default namespace put before it when it has none."""
    name = F.col(name) if isinstance(name, str) else name
    return F.when(name.contains("."), name).otherwise(
        F.concat_ws(".", F.lit(default_namespace), name)
    )
