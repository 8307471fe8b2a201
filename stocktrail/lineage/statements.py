"""Tables read and written by the statements of a log, by pattern matching.

Names are found by the keyword before them, not by parsing: a semicolon or a FROM inside a quoted
text is taken for the real thing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_NAME = r'([A-Za-z_][\w$.]*)'
TARGET = (
    r"(?is)\b(?:CREATE\s+(?:OR\s+REPLACE\s+)?(?:TEMPORARY\s+|TEMP\s+)?TABLE|INSERT\s+INTO)\s+" + _NAME
)
SOURCE = r"(?is)\b(?:FROM|JOIN)\s+" + _NAME
CTE = r"(?is)(?:\bWITH|,)\s+" + _NAME + r"\s+AS\s*\("
COMMENT = r"(?s)/\*.*?\*/|--[^\n]*"


def split_statements(scripts: DataFrame, text: str = "text") -> DataFrame:
    """One row per statement of each script, counted from 0; empty ones are not counted."""
    parts = F.transform(F.split(F.regexp_replace(text, COMMENT, " "), ";"), lambda s: F.btrim(
        F.regexp_replace(s, r"\s+", " ")
    ))
    keep = [c for c in scripts.columns if c != text]
    return scripts.select(
        *keep, F.posexplode(F.filter(parts, lambda s: s != "")).alias("index", "statement")
    )


def first_statements(statements: DataFrame, n: int = 8) -> DataFrame:
    """The first n statements of each script."""
    return statements.where(F.col("index") < n)


def _names(statement: str, pattern: str) -> Column:
    return F.array_distinct(
        F.transform(F.regexp_extract_all(statement, F.lit(pattern), F.lit(1)), F.lower)
    )


def statement_tables(statements: DataFrame, statement: str = "statement") -> DataFrame:
    """The table a statement fills and the tables it reads, CTE names left out."""
    target = F.lower(F.regexp_extract(statement, TARGET, 1))
    return statements.withColumns(
        {
            "out_table": F.nullif(target, F.lit("")),
            "in_tables": F.array_except(_names(statement, SOURCE), _names(statement, CTE)),
        }
    )


def table_edges(tables: DataFrame) -> DataFrame:
    """Table lineage of a statement log as a graph."""
    return (
        tables.where(F.col("out_table").isNotNull())
        .select(F.explode("in_tables").alias("src"), F.col("out_table").alias("dst"))
        .distinct()
    )
