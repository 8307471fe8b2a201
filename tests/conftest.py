import datetime as dt

import pytest
from pyspark.sql import SparkSession

from stocktrail.session import configure


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *columns):
    """Rows as a sorted list of tuples, NULLs first."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda r: [(v is not None, str(type(v)), v if v is not None else 0) for v in r],
    )
