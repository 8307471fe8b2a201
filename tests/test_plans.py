"""Physical plans: what is pushed down, what is shuffled, what must not appear."""

import os
import re

import pytest
from pyspark.sql import functions as F

from stocktrail.catalogue import QUERIES
from stocktrail.lineage import runs as R
from stocktrail.operators import series
from stocktrail.plans import inventory as I, standins as S
from stocktrail.plans.training_set import training_set
from tests.conftest import d

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Streams and loops have run by the time they return; what they return is a plain scan.
EAGER = {q.name for q in QUERIES.values() if {"ST1", "ST2", "ST3", "ST4", "ST6"} & set(q.covers.split())}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name].run(spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython",
                "ArrowEvalPython", "MapInPandas"):
        assert bad not in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_only_totals_go_to_one_partition(spark, name):
    """What meets in one task is one row per task: the partial results of a total."""
    lines = plan(QUERIES[name].run(spark, FOLDER)).split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next(x for x in lines[i + 1 :] if "Aggregate" in x or "Window" in x)
            assert "keys=[]" in below or "key=[]" in below, below


def test_filters_and_columns_reach_the_scan(spark):
    t = S.Tables(spark, FOLDER)
    text = plan(t.orders.where(F.col("o_totalprice").between(1, 2)).select("o_orderkey"))
    assert "GreaterThanOrEqual(o_totalprice,1.0)" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>", text)


def test_latest_runs_are_cut_before_the_shuffle(spark):
    text = plan(R.run_history(R.runs(S.run_events(S.Tables(spark, FOLDER))), 2))
    assert "WindowGroupLimit" in text and "Partial" in text


def _facts(spark, keys):
    return spark.createDataFrame(
        [("a", "x", d("2024-01-02"), 1), ("b", "x", d("2024-01-03"), 0)],
        "product_id string, ordering_region string, date date, flag int",
    ).repartition(3)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_grid_is_never_shuffled(spark, no_broadcast):
    """Keys and facts are; the days made from them are not, whatever windows follow."""
    facts = _facts(spark, I.SERIES)
    grid = series.densify(facts, I.SERIES, d("2024-01-01"), d("2024-03-01"), facts)
    ahead = series.future_flag(grid, I.SERIES, "date", "flag", [7, 14, 21, 28])
    text = plan(series.forward_fill(ahead, I.SERIES, "date", "flag"))
    assert "Exchange" not in text.split("Generate explode")[0]
    assert "Join" not in text


def test_the_training_set_moves_no_row_of_its_grid(spark, no_broadcast):
    lo, hi = d("2024-01-01"), d("2024-03-01")
    series_columns = "product_id string, ordering_region string"
    facts = spark.createDataFrame(
        [],
        f"{series_columns}, date date, available_fba bigint, available_fbm bigint",
    )
    forecast = spark.createDataFrame(
        [], f"{series_columns}, start_forecast_dt date, ds_forecast bigint"
    )
    lines = spark.createDataFrame(
        [],
        f"{series_columns}, brand string, date_placed date, date_shipped_from_vendor date,"
        " last_rec_date date, ordered_quantity bigint, received_quantity bigint,"
        " failed_fills int, lead_time int",
    )
    text = plan(training_set(facts, forecast, facts, lines, lo, hi))
    # The first Generate from the top is the one that makes the days.
    assert "Exchange" not in text.split("Generate explode(sequence")[0]


def test_text_does_not_make_inventory_sort_before_adding_up(spark):
    text = plan(QUERIES["inventory_per_day"].run(spark, FOLDER))
    union = text.index("Union")
    assert "HashAggregate" in text[:union].split("\n")[-2]


def test_a_hot_key_is_split_even_below_an_aggregate_on_it(spark, no_broadcast):
    """A third of the rows have one key; the join is followed by grouping on that key."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        fact = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
        )
        dim = spark.range(0, 60_000).select(F.col("id").alias("k"), F.lit(1).alias("w"))
        joined = fact.join(dim, "k", "left").groupBy("k").agg(F.max("v").alias("v"), F.sum("w").alias("n"))
        totals = joined.agg(F.sum("n").alias("n"), F.count("*").alias("keys"))
        assert tuple(joined.where("k = 0").select("n").first()) == (20_000,)
        assert tuple(totals.first()) == (60_000, 40_001)
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for key in small:
            spark.conf.unset(key)


def test_the_log_is_not_sorted_for_the_run_table(spark, no_broadcast, tmp_path):
    from pyspark.sql import functions as F

    from stocktrail.lineage import events as E, runs as R

    made = spark.range(9).select(
        F.col("id").cast("string").alias("run_id"), F.lit("n").alias("namespace"), F.lit("j").alias("job"),
        F.current_timestamp().alias("started_at"),
    )
    E.to_events(made).write.parquet(str(tmp_path / "log"))
    text = plan(R.runs(spark.read.parquet(str(tmp_path / "log"))))
    # Plans read from the top: below the first text in a result, over the runs, all is hashed.
    assert "HashAggregate" in text.rsplit("SortAggregate", 1)[1] and text.count("Scan parquet") == 1


@pytest.mark.parametrize(
    "name",
    [
        "stock_outs_ahead",
        "forecast_carried_forward",
        "failed_fills_of_orders_placed",
        "age_of_oldest_open_order",
    ],
)
def test_daily_queries_return_their_days(spark, name):
    """Not totals of them."""
    got = QUERIES[name].run(spark, FOLDER)
    days = got.groupBy("product_id").agg(F.countDistinct("date").alias("n")).agg(F.max("n")).first()[0]
    assert "date" in got.columns and days > 100
