"""Streams of run events and state changes, from and to files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stocktrail.lineage.upkeep import by_date
from stocktrail.streaming.versions import Versions

# Values of the approval rule, fixed by the service that sends the events.
APPROVAL_SOURCE = "aws.sagemaker"
APPROVAL_DETAIL_TYPE = "SageMaker Model Package State Change"
APPROVED = "Approved"


#: Later than any event.
END = dt.datetime(9999, 12, 1)


def with_end(stream: DataFrame, path: str, marks: list[dict]) -> tuple[DataFrame, Callable[[], None]]:
    """A stream of finite input that can be told that it is over, and what tells it.

    Watermarks follow the events, so what the last events keep open never closes by itself. The
    stream returned also watches the folder ``path``, empty until the function is called, which
    puts ``marks`` there: rows (by column; the others NULL) dated ``END``, in a batch after all
    that was read before. The watermark then passes every other event. Each input
    with a watermark of its own needs a mark that reaches it, with values in all that is filtered
    or joined on, and none that match. Marks stay open themselves and so come out of no join or
    window. A stream that has been ended can not be gone on with.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).write.parquet(path)
    watched = spark.readStream.schema(stream.schema).parquet(path)

    def end() -> None:
        rows = [tuple(mark.get(c) for c in stream.columns) for mark in marks]
        spark.createDataFrame(rows, stream.schema).coalesce(1).write.mode("append").parquet(path)

    return stream.unionByName(watched), end


def drain(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    end: Callable[[], None] | None = None,
) -> DataFrame:
    """Run a stream over all there is to read, and return what it wrote.

    The default trigger is used because it goes on, after the last rows, to a batch without rows;
    only that batch lets out what the final watermark has closed. With ``end`` (of ``with_end``)
    all is closed.
    """
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .start()
    )
    try:
        query.processAllAvailable()
        if end is not None:
            end()
            query.processAllAvailable()
    finally:
        query.stop()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ingest(
    events: DataFrame, path: str, checkpoint: str, period: str = "day", **trigger
) -> StreamingQuery:
    """Append run events to a Parquet log, by event date.

    How much a batch takes is set where ``events`` are read (``read_events``: files or bytes per
    batch); a backlog is then several batches, each read once.
    """
    return (
        by_date(events, period=period)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("event_date")
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def dedupe_stream(
    events: DataFrame, ids: list[str], time: str, delay: str = "10 minutes"
) -> DataFrame:
    """One copy of an event that was sent again within ``delay``; older ids are forgotten."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(ids)


def pair_stream(
    starts: DataFrame,
    ends: DataFrame,
    key: str,
    bound: str,
    delay: str = "10 minutes",
) -> DataFrame:
    """Each START with the ends that follow it within ``bound``.

    ``starts`` has ``key`` and start_time, ``ends`` ``key`` and end_time. A START without an end
    comes out, with NULLs, once the watermark shows that none can come: late or failed. Keeping
    the bound keeps the state small.
    """
    right = ends.withColumnRenamed(key, "_key").withWatermark("end_time", delay)
    left = starts.withWatermark("start_time", delay)
    within = F.expr(
        f"{key} = _key AND end_time >= start_time AND end_time <= start_time + INTERVAL {bound}"
    )
    return left.join(right, within, "left").drop("_key")


def windowed_counts(
    events: DataFrame, time: str, keys: list[str], width: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """Events per key and tumbling window; a window is final once the watermark passes its end."""
    return (
        events.withWatermark(time, delay)
        .groupBy(F.window(time, width).alias("w"), *keys)
        .agg(F.count("*").alias("n_events"))
        .select(F.col("w.start").alias("window_start"), *keys, "n_events")
    )


def _field(path: list[str]) -> Column:
    return F.col(".".join(f"`{part}`" for part in path))


def _conditions(pattern: dict, path: tuple[str, ...] = ()) -> list[Column]:
    found = []
    for name, allowed in pattern.items():
        if isinstance(allowed, dict):
            found += _conditions(allowed, (*path, name))
        else:
            found.append(_field([*path, name]).isin(list(allowed)))
    return found


def match_pattern(df: DataFrame, pattern: dict) -> DataFrame:
    """Events whose every listed field has one of its listed values; batch or stream.

    Nested fields are nested in the pattern as they are in the event.
    """
    for condition in _conditions(pattern):
        df = df.where(condition)
    return df


def approval_pattern(group: str) -> dict:
    """The state change that starts a deployment: a model version of ``group`` was approved."""
    return {
        "source": [APPROVAL_SOURCE],
        "detail-type": [APPROVAL_DETAIL_TYPE],
        "detail": {"ModelPackageGroupName": [group], "ModelApprovalStatus": [APPROVED]},
    }


def run_state_partials(events: DataFrame) -> DataFrame:
    """What one batch of events says about each run; the parts merge by min and max."""
    return events.groupBy(F.col("run.runId").alias("run_id")).agg(
        F.max("job.name").alias("job"),
        F.min(F.when(F.col("eventType") == "START", F.col("eventTime"))).alias("started_at"),
        F.max(F.when(F.col("eventType") == "COMPLETE", F.col("eventTime"))).alias("ended_at"),
    )


def _merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy("run_id").agg(
        F.max("job").alias("job"),
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
    )


def run_state_stream(
    events: DataFrame, path: str, checkpoint: str, merge_every: int = 10, **trigger
) -> StreamingQuery:
    """Keep the state of all runs as a versioned table.

    A batch writes its own part, so its cost is that of the batch and not of all runs ever seen;
    each ``merge_every``-th also merges the parts since the last merge into a new base. A version is
    published once all it consists of is written, and what no version needs any more is removed. A
    batch that is run again is not written twice.
    """
    store = Versions(events.sparkSession, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        store.add(batch_id, run_state_partials(batch), _merged, merge_every)

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def run_state(spark: SparkSession, path: str) -> DataFrame:
    """The state of each run as of the version published last."""
    merged = _merged(Versions(spark, path).read())
    return merged.withColumn(
        "state", F.when(F.col("ended_at").isNotNull(), "COMPLETE").otherwise("START")
    )
