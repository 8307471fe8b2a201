"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from stocktrail.plans.standins import Tables
from stocktrail.session import configure, fit_to_input


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        configure(spark)
        fit_to_input(spark, folder)
        return present(self.build(Tables(spark, folder)))


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function of the tables under its own name."""

    def register(build: Callable[[Tables], DataFrame]):
        if build.__name__ in QUERIES:
            raise ValueError(f"registered twice: {build.__name__}")
        QUERIES[build.__name__] = Query(build.__name__, covers, build, sql)
        return build

    return register


def present(df: DataFrame) -> DataFrame:
    """Dates and instants as text, which any two engines print alike."""
    text = {}
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind == "date":
            text[f.name] = F.col(f.name).cast("string")
        elif kind in ("timestamp", "timestamp_ntz"):
            text[f.name] = F.date_format(f.name, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(text) if text else df


def at(column: str) -> str:
    """SQL for the text of an instant."""
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def on(column: str) -> str:
    """SQL for the text of a day."""
    return f"strftime({column}, '%Y-%m-%d')"
