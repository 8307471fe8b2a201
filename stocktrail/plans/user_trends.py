"""Users created per day."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stocktrail.operators.relational import daily_counts
from stocktrail.sources.tables import materialize


def user_counts(history: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Count users per day of creation and keep the result as a permanent table."""
    return materialize(daily_counts(history, "created_at", "id"), table, path)
