"""Retention, search, and statistics about datasets."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession, functions as F


def retain(
    events: DataFrame, now, days: int = 7, time: str = "eventTime", period: str = "day"
) -> DataFrame:
    """Events of the last ``days`` days before ``now``.

    Of a log stored by date (``write_by_date``, of the same period) only the kept dates are read.
    """
    since = F.lit(now) - F.make_dt_interval(F.lit(days))
    if "event_date" in events.columns:
        events = events.where(F.col("event_date") >= F.to_date(F.date_trunc(period, since)))
    return events.where(F.col(time) >= since)


def by_date(events: DataFrame, time: str = "eventTime", period: str = "day") -> DataFrame:
    """Events with their ``event_date``, placed for writing by it.

    They are placed by date, and by their measured sizes small days then share a task and so make
    one file each, while a day with most of the events is split over many tasks, with it the days
    that fell into the same partition of the shuffle. No sample is taken, so the events are worked
    out once. ``period`` widens the dates to the first of the week or month, for logs of few events
    a day.
    """
    dated = events.withColumn("event_date", F.to_date(F.date_trunc(period, time)))
    return dated.hint("rebalance", "event_date")


def write_by_date(
    events: DataFrame, path: str, time: str = "eventTime", period: str = "day"
) -> None:
    """Store a log by date, replacing only the dates it holds."""
    (
        by_date(events, time, period=period)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )


def purge(
    spark: SparkSession, path: str, now: dt.datetime, days: int = 7, time: str = "eventTime"
) -> None:
    """Remove from a log stored by day (``write_by_date``) what is older than ``days`` days.

    Expired days are dropped as folders, unread. Only the day in which the limit falls is read and
    written anew, beside the log, and then takes its place: who reads that day meanwhile reads again.
    """
    since = now - dt.timedelta(days=days)
    where = spark._jvm.org.apache.hadoop.fs.Path
    files = where(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in files.listStatus(where(path)):
        found = re.fullmatch(r"event_date=(\d{4}-\d\d-\d\d)", folder.getPath().getName())
        if found and dt.date.fromisoformat(found[1]) < since.date():
            files.delete(folder.getPath(), True)
    _finish_purge(files, where, path)
    boundary = f"{path}/event_date={since.date()}"
    if not files.exists(where(boundary)):
        return
    day = spark.read.parquet(boundary)
    kept = day.where(F.col(time) >= F.lit(since).cast(day.schema[time].dataType))
    if kept.isEmpty():
        files.delete(where(boundary), True)
        return
    fresh = f"{path}/_purged-{since.date()}"
    kept.write.mode("overwrite").parquet(fresh)
    files.delete(where(boundary), True)
    _finish_purge(files, where, path)


def _finish_purge(files, where, path: str) -> None:
    """Put a day that is written anew in its place, also one that a purge was stopped over; one that
    was not written whole goes."""
    for folder in files.listStatus(where(path)):
        found = re.fullmatch(r"_purged-(.*)", folder.getPath().getName())
        if found:
            place = where(f"{path}/event_date={found[1]}")
            if files.exists(where(folder.getPath(), "_SUCCESS")) and not files.exists(place):
                files.rename(folder.getPath(), place)
            else:
                files.delete(folder.getPath(), True)


def search(df: DataFrame, name: str, text: str) -> DataFrame:
    """Rows whose name holds some word of ``text``, most words first, then by name."""
    words = sorted({w for w in text.lower().split() if w})
    if not words:
        raise ValueError("nothing to search for")
    tokens = F.split(F.lower(name), "[^a-z0-9]+")
    hits = sum(
        (F.array_contains(tokens, w).cast("int") for w in words[1:]),
        F.array_contains(tokens, words[0]).cast("int"),
    )
    return df.withColumn("hits", hits).where(F.col("hits") > 0).orderBy(F.col("hits").desc(), name)


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: rows, NULLs, distinct values, least and greatest value (as text).

    Each column is read by itself and counted by value, partly before the shuffle: a value that
    most rows have is one row of each task, and no row is copied per column. ``df`` is worked out
    once per column, of which a stored table reads that column alone.
    """

    def of(name: str) -> DataFrame:
        column = F.col(f"`{name}`")
        values = df.groupBy(column.alias("value")).agg(F.count("*").alias("n"))
        return values.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
            F.count("value").alias("distinct_count"),
            F.min("value").cast("string").alias("min"),
            F.max("value").cast("string").alias("max"),
        ).select(F.lit(name).alias("column"), "*")

    first, *rest = [of(name) for name in columns or df.columns]
    for other in rest:
        first = first.union(other)
    return first


def output_stats(df: DataFrame) -> DataFrame:
    """Rows, and bytes of the rows as JSON (NULL fields left out)."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))).alias("size"),
    )
