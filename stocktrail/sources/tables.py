"""Scans, permanent and temporary tables, scalar session values."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """A named table: Parquet below ``folder``, or of the session catalog."""
    if folder is None:
        return spark.table(name)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_jdbc(
    spark: SparkSession, url: str, query: str, column: str, low, high, parts: int
) -> DataFrame:
    """A query result of an external database, read by ``parts`` tasks side by side."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", f"({query}) q")
        .option("partitionColumn", column)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", parts)
        .load()
    )


def load_features(spark: SparkSession, name: str, columns: list[str]) -> DataFrame:
    """The training frame of a feature table, read by its columns."""
    return spark.table(name).select(*columns)


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create or replace a permanent table from a query, and read it back."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def stage(df: DataFrame, name: str, cache: bool = False) -> DataFrame:
    """A session-temporary table. ``cache`` only pays when several later steps read it."""
    if cache:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def window_bounds(as_of: str | dt.date, days: int = 730) -> tuple[dt.date, dt.date]:
    """First and last day of the analysed period.

    ``as_of`` is an argument, not the clock: a job that is run again gives the same rows.
    """
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return as_of - dt.timedelta(days=days), as_of


def declare_window(spark: SparkSession, as_of: str, days: int = 730) -> None:
    """The same bounds as SQL session variables ``start_date`` and ``end_date``."""
    spark.sql("DECLARE OR REPLACE VARIABLE start_date DATE")
    spark.sql("DECLARE OR REPLACE VARIABLE end_date DATE")
    spark.sql("SET VAR end_date = CAST(:as_of AS DATE)", args={"as_of": as_of})
    spark.sql("SET VAR start_date = date_sub(end_date, :days)", args={"days": days})
