"""Session settings and the shared folder."""

from stocktrail import session
from tests.conftest import rows


def test_task_numbers_are_the_sessions(spark):
    before = {k: spark.conf.get(k, None) for k in (session.INITIAL_PARTITIONS, "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    session.configure(spark)
    assert {k: spark.conf.get(k, None) for k in before} == before
    assert session.shuffle_partitions(spark) == int(before["spark.sql.shuffle.partitions"])


def test_scratch_is_below_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = (session.scratch_path(spark, "t") for _ in range(2))
    assert first.startswith(root) and first != second


def test_written_and_cut_keep_the_rows(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "x int, y string")
    assert rows(session.written(df, "t")) == rows(session.cut(df)) == rows(df)


def test_tasks_grow_in_number_with_the_input(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(f"{tmp_path}/small.parquet")
    changed = [session.INITIAL_PARTITIONS, "spark.sql.files.maxPartitionBytes"]
    before = {key: spark.conf.get(key, None) for key in changed}
    try:
        for key in changed:
            spark.conf.unset(key)
        session.fit_to_input(spark, str(tmp_path))
        assert session.shuffle_partitions(spark) == 4
        monkeypatch.setattr(session, "PARTITION_BYTES", 100)
        session.fit_to_input(spark, str(tmp_path))
        assert session.shuffle_partitions(spark) > 20
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(session.SPLIT_BYTES)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
