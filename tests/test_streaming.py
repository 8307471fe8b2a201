"""Streams give what the batch gives, for files that arrive one after the other."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stocktrail.session import scratch_path
from stocktrail.sources import eventlog
from stocktrail.streaming import jobs as J
from stocktrail.streaming.versions import Versions
from tests.conftest import rows
from tests.test_lineage import _events, at

_SCHEMA = "id string, kind string, at timestamp"


def _folder(spark, tmp_path, files, name="in"):
    """One JSON file per list, read in order of writing."""
    import os

    folder = tmp_path / name
    folder.mkdir()
    for i, data in enumerate(files):
        text = "\n".join(
            f'{{"id":"{k}","kind":"{kind}","at":"{when.isoformat()}Z"}}' for k, kind, when in data
        )
        path = folder / f"{i}.json"
        path.write_text(text + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(_SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))


def _drain(spark, df):
    return J.drain(df, scratch_path(spark, "out"), scratch_path(spark, "checkpoint"))


FAR = dt.datetime(2030, 1, 1)


def _pairs(spark, stream):
    starts = stream.where("kind = 'START'").select("id", F.col("at").alias("start_time"))
    ends = stream.where("kind = 'END'").select("id", F.col("at").alias("end_time"))
    return J.pair_stream(starts, ends, "id", "1 HOUR", "10 minutes")


def test_pairs_and_late_starts_over_several_files(spark, tmp_path):
    stream = _folder(
        spark,
        tmp_path,
        [
            [("a", "START", at(0)), ("b", "START", at(60))],
            [("a", "END", at(600)), ("c", "START", at(700))],
            [("b", "END", at(7000)), ("c", "END", at(4300))],
            [("end", "START", FAR), ("end", "END", FAR + dt.timedelta(days=1))],
            [("end2", "START", FAR + dt.timedelta(days=9)), ("end2", "END", FAR + dt.timedelta(days=9))],
        ],
    )
    got = _drain(spark, _pairs(spark, stream)).where(~F.col("id").startswith("end"))
    # c ended exactly an hour after it started; b after more than that.
    assert rows(got, "id", F.col("end_time").isNull().alias("late")) == [
        ("a", False), ("b", True), ("c", False)
    ]


def test_windows_close_with_the_watermark(spark, tmp_path):
    day = dt.timedelta(days=1)
    stream = _folder(
        spark,
        tmp_path,
        [
            [("a", "x", at(0)), ("b", "x", at(10))],
            [("c", "x", at(0) + day)],
            [("e", "x", at(1) + day)],
            [("late", "x", at(5)), ("d", "x", at(0) + 3 * day)],
        ],
    )
    got = _drain(spark, J.windowed_counts(stream, "at", ["kind"]))
    # The first day was closed when "late" came; the last one still is open.
    assert rows(got, F.to_date("window_start").alias("d"), "n_events") == [
        (dt.date(2024, 1, 1), 2), (dt.date(2024, 1, 2), 2)
    ]


def test_copies_across_files(spark, tmp_path):
    stream = _folder(
        spark, tmp_path, [[("a", "x", at(0)), ("a", "x", at(0))], [("a", "x", at(0)), ("b", "x", at(1))]]
    )
    assert rows(_drain(spark, J.dedupe_stream(stream, ["id"], "at")), "id") == [("a",), ("b",)]


def test_run_state_over_batches_and_a_second_start(spark, tmp_path):
    log, state, checkpoint = (str(tmp_path / n) for n in ("log", "state", "checkpoint"))

    def send(*data):
        eventlog.write_events(_events(spark, list(data)), log)
        J.run_state_stream(
            eventlog.read_events(spark, log, streaming=True), state, checkpoint
        ).awaitTermination()
        return rows(J.run_state(spark, state), "run_id", "state")

    none = (None,) * 5
    assert send(("a", "ns", "j", at(0), None, *none)) == [("a", "START")]
    assert send(("a", "ns", "j", None, at(5), *none), ("b", "ns", "j", at(1), None, *none)) == [
        ("a", "COMPLETE"), ("b", "START")
    ]


def test_the_end_closes_all_windows_and_starts(spark, tmp_path):
    stream = _folder(
        spark,
        tmp_path,
        [[("a", "START", at(0)), ("b", "START", at(60))], [("a", "END", at(600))], [("c", "START", at(90_000))]],
    )
    ended, end = J.with_end(stream, scratch_path(spark, "end"), [{"id": k, "kind": k, "at": J.END} for k in ("START", "END")])
    pairs = J.drain(_pairs(spark, ended), scratch_path(spark, "out"), scratch_path(spark, "checkpoint"), end=end)
    assert rows(pairs, "id", F.col("end_time").isNull().alias("late")) == [("a", False), ("b", True), ("c", True)]
    ended, end = J.with_end(stream, scratch_path(spark, "end"), [{"kind": "", "at": J.END}])
    days = J.drain(J.windowed_counts(ended, "at", ["kind"]), scratch_path(spark, "out"), scratch_path(spark, "checkpoint"), end=end)
    assert rows(days, F.to_date("window_start").alias("d"), "kind", "n_events") == [
        (dt.date(2024, 1, 1), "END", 1), (dt.date(2024, 1, 1), "START", 2), (dt.date(2024, 1, 2), "START", 1)
    ]


def test_many_batches_leave_few_folders_and_one_version_to_each_reader(spark, tmp_path):
    state = str(tmp_path / "state")
    store = Versions(spark, state)
    merge = lambda parts: parts.groupBy("k").agg(F.sum("n").alias("n"))
    reader = None
    for number in range(20):
        store.add(number, spark.createDataFrame([(number % 3, 1), (7, 1)], "k int, n long"), merge, 6)
        store.add(number, spark.createDataFrame([(99, 1)], "k int, n long"), merge, 6)  # run again
        if reader is not None:  # opened a version ago, read only now
            assert reader[0].agg(F.sum("n")).first()[0] == 2 * reader[1]
        reader = store.read(), number + 1
    assert store.marks()[-1] == (19, 17)
    assert len([p for p in (tmp_path / "state").iterdir() if p.is_dir()]) <= 1 + 2 + 2 * 6
    assert rows(merge(store.read()), "k", "n") == [(0, 7), (1, 7), (2, 6), (7, 20)]


def test_a_version_without_its_mark_is_not_read(spark, tmp_path):
    store = Versions(spark, str(tmp_path / "state"))
    with pytest.raises(FileNotFoundError):
        store.read()
    row = spark.createDataFrame([(1, 1)], "k int, n long")
    store.add(0, row, lambda p: p, 10)
    row.write.parquet(str(tmp_path / "state" / "part=1"))  # a batch that was lost before it published
    assert store.read().count() == 1
    store.add(1, row, lambda p: p, 10)
    assert store.read().count() == 2


def test_ingest_by_day(spark, tmp_path):
    log = str(tmp_path / "log")
    eventlog.write_events(_events(spark, [("a", "ns", "j", at(0), at(90_000), *(None,) * 5)]), log)
    stream = eventlog.read_events(spark, log, streaming=True)
    J.ingest(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "event_date", "eventType") == [
        (dt.date(2024, 1, 1), "START"), (dt.date(2024, 1, 2), "COMPLETE")
    ]


@pytest.mark.parametrize("bound", [{"files_per_batch": 1}, {"bytes_per_batch": 1}, {}])
def test_a_backlog_is_taken_in_bounded_batches(spark, tmp_path, bound):
    log = str(tmp_path / "log")
    for i in range(3):
        run = (f"r{i}", "ns", "j", at(i), at(90_000), *(None,) * 5)
        eventlog.write_events(_events(spark, [run]).coalesce(1), log)
    stream = eventlog.read_events(spark, log, streaming=True, **bound)
    query = J.ingest(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    read = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert read == ([2, 2, 2] if bound else [6])
    assert spark.read.parquet(str(tmp_path / "out")).select("run.runId", "eventType").distinct().count() == 6


@pytest.mark.parametrize(
    "change, count",
    [({}, 1), ({"status": "Rejected"}, 0), ({"group": "other"}, 0), ({"source": "elsewhere"}, 0)],
)
def test_approval_pattern(spark, change, count):
    event = {"source": J.APPROVAL_SOURCE, "group": "g", "status": J.APPROVED, **change}
    df = spark.range(1).select(
        F.lit(event["source"]).alias("source"),
        F.lit(J.APPROVAL_DETAIL_TYPE).alias("detail-type"),
        F.struct(
            F.lit(event["group"]).alias("ModelPackageGroupName"),
            F.lit(event["status"]).alias("ModelApprovalStatus"),
        ).alias("detail"),
    )
    assert J.match_pattern(df, J.approval_pattern("g")).count() == count
