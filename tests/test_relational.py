"""Filters, joins, aggregates and scalar functions on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stocktrail.functions import scalars as X
from stocktrail.operators import learn, relational as R
from stocktrail.plans import housing, inventory as I
from stocktrail.sources import eventlog, tables
from tests.conftest import d, rows


def _sales(spark, data):
    return spark.createDataFrame(
        data, "house_id int, price double, sqft double, bedrooms int, bathrooms double"
    )


def _places(spark, data):
    return spark.createDataFrame(data, "house_id int, zipcode string, school_rating int")


def test_clean_keeps_both_ends(spark):
    sales = _sales(
        spark,
        [(1, 10_000.0, 1.0, 1, 1.0), (2, 1_000_000.0, 1.0, 1, 1.0), (3, 9_999.99, 1.0, 1, 1.0),
         (4, None, 1.0, 1, 1.0)],
    )
    assert rows(housing.clean(sales), "house_id") == [(1,), (2,)]


def test_features_drop_and_repeat(spark):
    """No location, two locations, no size, no rating."""
    sales = _sales(
        spark,
        [(1, 20_000.0, 5.0, 1, 1.0), (2, 20_000.0, 6.0, 1, 1.0), (3, 20_000.0, None, 1, 1.0),
         (4, 20_000.0, 7.0, 1, 1.0)],
    )
    places = _places(spark, [(2, "a", 3), (2, "b", 4), (3, "a", 3), (4, "a", None)])
    got = housing.features(sales, places)
    assert got.columns == ["sqft", "bedrooms", "bathrooms", "school_rating", "price"]
    assert rows(got, "sqft", "school_rating") == [(6.0, 3), (6.0, 4)]


def test_exact_line_has_no_error(spark):
    data = [(float(x), 3.0 * x + 7) for x in range(20)]
    df = spark.createDataFrame(data, "x double, y double")
    model = learn.fit_ols(df, ["x"], "y")
    record = learn.evaluate(model, df, ["x"], "y").first()
    assert record.n_rows == 20 and record.mse < 1e-12 and record.mse_text == "0.00"
    terms = {r.term: r.value for r in learn.coefficients(model, spark, ["x"]).collect()}
    assert terms["x"] == pytest.approx(3) and terms["intercept"] == pytest.approx(7)


def test_error_is_divided_by_n(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 3.0)], "prediction double, y double")
    assert learn.mse(df, "y").first().mse == 5.0


def test_daily_counts_edges(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP_NTZ '2024-01-01 23:59:59.999'),"
        " (2, TIMESTAMP_NTZ '2024-01-02 00:00:00'), (NULL, TIMESTAMP_NTZ '2024-01-02 05:00:00'),"
        " (3, NULL) AS t(id, created_at)"
    )
    got = R.daily_counts(df, "created_at", "id")
    assert rows(got) == [(None, 1), (d("2024-01-01"), 1), (d("2024-01-02"), 1)]


def test_full_outer_with_nulls_and_a_hot_key(spark):
    left = spark.createDataFrame(
        [(1, "a")] * 50 + [(2, "b"), (None, "c"), (9, "d")], "k int, l string"
    )
    right = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "k int, r string")
    got = R.full_outer(left, right, "k").select("k", "l", "r")
    # The key stays as the left side has it: NULL for rows of the right side alone.
    want = left.alias("a").join(right.alias("b"), F.expr("a.k = b.k"), "full").select("a.k", "l", "r")
    assert rows(got) == rows(want)


def test_full_outer_filter_does_not_unmatch(spark):
    left = spark.createDataFrame([(1, 5), (2, 50)], "k int, v int")
    right = spark.createDataFrame([(1, "x"), (3, "y")], "k int, r string")
    got = R.full_outer(left, right, "k", F.col("v") > 10)
    assert rows(got, "k", "v", "r") == [(None, None, "y"), (2, 50, None)]


def test_union_keeps_one_copy(spark):
    a = spark.createDataFrame([(1, 2), (1, 2)], "x int, y int")
    b = spark.createDataFrame([(1, 2), (3, None)], "p int, q int")
    assert rows(R.union_distinct(a, b)) == [(1, 2), (3, None)]


def test_failed_fill_and_lead_time(spark):
    df = spark.createDataFrame(
        [(5, 5, d("2024-01-01"), d("2024-01-09")), (5, 4, d("2024-01-01"), d("2024-01-09")),
         (5, None, d("2024-01-01"), None), (0, 0, d("2024-01-01"), d("2024-01-02"))],
        "o int, r int, placed date, last date",
    )
    got = df.select(
        X.failed_fill("o", "r").alias("failed"), X.lead_time("placed", "last", "o", "r").alias("lead")
    )
    assert [tuple(r) for r in got.collect()] == [(0, 8), (1, None), (1, None), (0, 1)]


def test_two_digits(spark):
    df = spark.createDataFrame([(0,), (7,), (42,)], "n int")
    assert [r[0] for r in df.select(X.two_digits("n")).collect()] == ["00", "07", "42"]
    with pytest.raises(Exception, match="two digits"):
        spark.createDataFrame([(100,)], "n int").select(X.two_digits("n")).collect()


def test_text_and_time(spark):
    row = spark.sql("SELECT TIMESTAMP '2024-01-01 10:00:00.5' AS ts, 1234567.891D AS v").select(
        X.iso_instant("ts").alias("iso"),
        X.thousands("v").alias("v"),
        X.shift("ts", hours=1, minutes=2, seconds=3).alias("later"),
        eventlog.qualify(F.lit("t"), "ns").alias("a"),
        eventlog.qualify(F.lit("other.t"), "ns").alias("b"),
    ).first()
    assert row.iso == "2024-01-01T10:00:00.500Z" and row.v == "1,234,567.89"
    assert row.later == dt.datetime(2024, 1, 1, 11, 2, 3, 500000)
    assert (row.a, row.b) == ("ns.t", "other.t")


def test_window_bounds():
    assert tables.window_bounds("2024-03-01", 1) == (d("2024-02-29"), d("2024-03-01"))
    assert tables.window_bounds("2024-03-01")[0] == d("2022-03-02")


def test_stage_and_materialize(spark, tmp_path):
    df = spark.range(3)
    assert tables.stage(df, "staged_once", cache=True).count() == 3
    for n in (3, 2):
        kept = tables.materialize(spark.range(n), "kept_table", str(tmp_path / "kept"))
        assert kept.count() == n
    assert rows(tables.load(spark, "kept_table")) == [(0,), (1,)]


# Inventory: one product, the rows a fixture should hold.

_QUANTITY = ["warehouse_stow_quantity", "available_fba_quantity", "inbound_fba_quantity",
             "warehouse_total_quantity", "reserved_fc_transfer_quantity",
             "reserved_fc_processing_quantity", "on_order_quantity", "warehouse_processing_quantity"]


def _stock_row(day, program, master=1, market="Amazon US", gone=False, stow=5, fba=2, page="B01"):
    return (page, master, "US", d(day), market, program, stow, fba, 1, 1, None, 1, 1, 1, 9.5, "v", gone)


def _inventory(spark, stock, listings=(("B01", "FBM"),), reserve=((1, 3.0),)):
    schema = (
        "listing_page_id string, master_id bigint, country_code string, date date,"
        " marketplace_name string, fulfillment_program string, "
        + ", ".join(f"{q} bigint" for q in _QUANTITY)
        + ", wholesale_price double, vendor_name string, is_discontinued_historic boolean"
    )
    return I.inventory(
        spark.createDataFrame(stock, schema),
        spark.createDataFrame([("US", "NA")], "country_code string, ordering_region string"),
        spark.createDataFrame([("NA", "B01")], "ordering_region string, product_id string"),
        spark.createDataFrame(list(listings), "listing_page_id string, fulfillment_type string"),
        spark.createDataFrame(list(reserve), "master_id bigint, reserve double"),
        d("2024-01-01"),
        d("2024-01-31"),
    )


def test_pooled_programs_count_once_remote_ones_add_up(spark):
    stock = [
        _stock_row("2024-01-05", "PANEU a"),
        _stock_row("2024-01-05", "PANEU b", stow=7),
        _stock_row("2024-01-05", "NARF a"),
        _stock_row("2024-01-05", None, stow=1),
        _stock_row("2024-01-05", "neither", stow=100),
    ]
    got = _inventory(spark, stock).where(F.col("product_id").isNotNull())
    assert rows(got, "available_fbm", "available_fba", "total_available") == [(6, 4, 10), (7, 2, 9)]


def test_unknown_flag_keeps_a_row_outside_the_period(spark):
    stock = [
        _stock_row("2023-01-05", None, gone=None, market="Elsewhere"),
        _stock_row("2023-01-06", None, gone=False),
        _stock_row("2024-01-06", None, gone=True),
        _stock_row("2024-01-07", None, market="Walmart"),
    ]
    got = _inventory(spark, stock)
    assert rows(got, "product_id", "date", "first_date") == [
        ("B01", d("2023-01-05"), d("2023-01-05"))
    ]


def test_reserve_without_inventory_has_no_keys(spark):
    got = _inventory(spark, [_stock_row("2024-01-05", None)], reserve=[(1, 3.0), (2, 4.0), (5, 0.5)])
    assert rows(got, "product_id", "date", "reserve", "available_fba") == [
        (None, None, 4.5, 0),
        ("B01", d("2024-01-05"), 3.0, 2),
    ]


def test_two_listings_double_the_sums(spark):
    got = _inventory(
        spark, [_stock_row("2024-01-05", None)], listings=[("B01", "FBM"), ("B01", "FBA")]
    )
    assert rows(got, "available_fbm", "available_fba", "reserve") == [(5, 4, 6.0)]


def test_equal_rows_of_both_arms_appear_once(spark):
    got = _inventory(spark, [_stock_row("2024-01-05", "PANEU NARF")])
    assert rows(got, "available_fbm", "available_fba") == [(5, 2)]
