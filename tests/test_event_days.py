"""The grids of users and days reach from the first event to the last, whichever days these are."""

import datetime as dt

import pytest

from stocktrail.catalogue import QUERIES

SHAPE = "event_id long, user_id long, ts timestamp, event_type string, value double"


@pytest.fixture
def folder(spark, tmp_path):
    def make(*events):
        spark.createDataFrame(list(events), SHAPE).write.parquet(str(tmp_path / "events.parquet"))
        return str(tmp_path)

    return make


def got(spark, name, folder):
    return sorted((r.user_id, str(r.date)) for r in QUERIES[name].run(spark, folder).collect())


def test_days_outside_the_test_month_are_in_the_grid(spark, folder):
    where = folder(
        (1, 1, dt.datetime(2023, 12, 30, 23), "purchase", 50.0),
        (2, 2, dt.datetime(2024, 1, 2), "error", 1.0),
        (3, 1, None, "view", 1.0),
    )
    days = ["2023-12-30", "2023-12-31", "2024-01-01", "2024-01-02"]
    want = [(u, d) for u in (1, 2) for d in days]
    assert got(spark, "every_user_on_every_day", where) == want
    assert got(spark, "daily_events_without_gaps", where) == want
    assert got(spark, "every_user_on_days_of_a_table", where) == [(1, days[0]), (2, days[0])]


def test_no_events_no_days(spark, folder):
    assert got(spark, "daily_events_without_gaps", folder((1, 1, None, "view", 1.0))) == []
