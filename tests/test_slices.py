"""Jobs in slices: the same rows, and no shuffle of one slice left when the next begins."""

import os
import time

import pytest
from pyspark.sql import functions as F

from stocktrail import session
from stocktrail.catalogue import QUERIES
from tests.conftest import rows
from tests.oracle import compare, connect, types_differ

FOLDER = "/root/testdata/sf0.001"


def shuffle_files(spark) -> int:
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum("shuffle" in name for name in disk.getAllBlocks().mkString(" ").split())


def left_at_most(spark, files: int) -> bool:
    """Files are removed in the background: soon, if not at once."""
    end = time.time() + 20
    while shuffle_files(spark) > files and time.time() < end:
        time.sleep(0.1)
    return shuffle_files(spark) <= files


@pytest.fixture
def two_slices(spark):
    spark.conf.set(session.SLICES, "2")
    yield
    spark.conf.unset(session.SLICES)


def test_rows_of_all_slices_and_of_none(spark, two_slices):
    df = spark.range(100).select(F.when(F.col("id") > 3, F.col("id") % 10).alias("k"))
    parts = [session.slice_of(df, "k", n, 2) for n in range(2)]
    assert all(part.count() for part in parts)
    counted = session.in_slices(
        spark, "counted",
        lambda part: part(df, "k").groupBy("k").agg(F.count("*").alias("n")),
        spark.createDataFrame([(77, 1)], "k bigint, n bigint"),
    )
    assert rows(counted) == [(None, 4), *((k, 9 + (k > 3)) for k in range(10)), (77, 1)]


def test_shuffles_of_a_slice_go_with_it(spark, two_slices):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"))
    before = shuffle_files(spark)
    df.groupBy("k").count().collect()
    assert shuffle_files(spark) > before
    before = shuffle_files(spark)
    for _ in range(3):
        session.in_slices(spark, "gone", lambda part: part(df, "k").groupBy("k").count())
        session.kept(df.repartition(5, "k"), "gone")
    assert left_at_most(spark, before)
    assert spark.conf.get(session.CLEAN_UP) == "false"


def test_slices_grow_in_number_with_the_input(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(f"{tmp_path}/t.parquet")
    try:
        session.fit_to_input(spark, str(tmp_path))
        assert session.slices(spark) == 1
        monkeypatch.setattr(session, "SLICE_BYTES", 100)
        session.fit_to_input(spark, str(tmp_path))
        assert session.slices(spark) == session.MOST_SLICES
    finally:
        spark.conf.unset(session.SLICES)
        spark.conf.unset(session.INITIAL_PARTITIONS)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize(
    "name",
    [
        "inventory_per_day",
        "stock_outs_ahead",
        "forecast_carried_forward",
        "supplier_fill_history",
        "failed_fills_of_orders_placed",
        "age_of_oldest_open_order",
        "training_set",
    ],
)
def test_a_query_in_slices_agrees_with_its_sql(spark, monkeypatch, name):
    """Written by its slices, no shuffle left but of what is read last."""
    monkeypatch.setattr(session, "SLICE_BYTES", 300_000)
    con, before = connect(FOLDER), shuffle_files(spark)
    try:
        df = QUERIES[name].run(spark, FOLDER)
        assert session.slices(spark) > 1
        assert left_at_most(spark, before)
        assert types_differ(df, con, QUERIES[name].sql) == []
        assert compare(df, con, QUERIES[name].sql) is None
    finally:
        spark.conf.unset(session.SLICES)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize(
    "name",
    [
        "event_log_round_trip",
        "ingested_log",
        "run_state_of_a_stream",
    ],
)
def test_a_log_takes_no_more_disk_than_the_tables(spark, monkeypatch, tmp_path, name):
    """As text it is some twenty times as large; what its events are shuffled for goes with the job."""
    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path))
    monkeypatch.setattr(session, "SLICE_BYTES", 300_000)
    before = shuffle_files(spark)
    try:
        df = QUERIES[name].run(spark, FOLDER)
        logged = [f for kind in ("events", "log") for f in tmp_path.rglob(f"stocktrail/{kind}-*/part-*")]
        tables = sum(os.path.getsize(f"{FOLDER}/{t}.parquet") for t in ("lineitem", "orders", "customer"))
        assert 0 < sum(f.stat().st_size for f in logged) < tables
        assert left_at_most(spark, before)
        assert compare(df, connect(FOLDER), QUERIES[name].sql) is None
    finally:
        spark.conf.unset(session.SLICES)
