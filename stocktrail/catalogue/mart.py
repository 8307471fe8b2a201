"""The feature mart and the price model."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from stocktrail.catalogue.basics import HOUSE_FEATURES_SQL
from stocktrail.catalogue.registry import on, query
from stocktrail.operators import learn
from stocktrail.plans import housing, inventory as I, purchase_orders as P, standins as S
from stocktrail.plans.standins import PERIOD, WEEK_OF, Tables
from stocktrail.plans.training_set import training_set as assemble_training_set
from stocktrail.session import Part, in_slices, kept, slices, written

LO, HI = PERIOD

# The price model


def _house_features(t: Tables) -> DataFrame:
    return housing.features(S.house_sales(t), S.location_info(t))


@query(
    "PIPE1 F1 J1 P2 F3 P3",
    f"""SELECT bedrooms, school_rating, count(*) AS n, CAST(sum(round(price * 100)) AS bigint) AS cents
    FROM ({HOUSE_FEATURES_SQL}) GROUP BY 1, 2""",
)
def house_feature_counts(t: Tables) -> DataFrame:
    return _house_features(t).groupBy("bedrooms", "school_rating").agg(
        F.count("*").alias("n"), F.sum(F.round(F.col("price") * 100).cast("bigint")).alias("cents")
    )


@query(
    "M1",
    f"""WITH f AS ({HOUSE_FEATURES_SQL})
    SELECT 'intercept' AS term, round(regr_intercept(price, sqft), 2) AS value FROM f
    UNION ALL SELECT 'sqft', round(regr_slope(price, sqft), 2) FROM f""",
)
def fit_one_feature(t: Tables) -> DataFrame:
    model = learn.fit_ols(_house_features(t), ["sqft"], housing.TARGET)
    return learn.coefficients(model, t.spark, ["sqft"]).withColumn("value", F.round("value", 2))


@query(
    "M2",
    f"""WITH f AS ({HOUSE_FEATURES_SQL}), m AS (SELECT regr_slope(price, sqft) AS a, regr_intercept(price, sqft) AS b FROM f)
    SELECT sqft, round(min(a * sqft + b), 2) AS prediction, count(*) AS n FROM f, m GROUP BY 1""",
)
def predict_by_one_feature(t: Tables) -> DataFrame:
    frame = _house_features(t)
    model = learn.fit_ols(frame, ["sqft"], housing.TARGET)
    predicted = learn.predict(model, frame, ["sqft"])
    return predicted.groupBy("sqft").agg(
        F.round(F.min("prediction"), 2).alias("prediction"), F.count("*").alias("n")
    )


@query(
    "M3",
    f"""WITH f AS ({HOUSE_FEATURES_SQL}), m AS (SELECT regr_slope(price, sqft) AS a, regr_intercept(price, sqft) AS b FROM f)
    SELECT round(avg((price - a * sqft - b) * (price - a * sqft - b)), 0) AS mse FROM f, m""",
)
def error_of_one_feature(t: Tables) -> DataFrame:
    frame = _house_features(t)
    model = learn.fit_ols(frame, ["sqft"], housing.TARGET)
    predicted = learn.predict(model, frame, ["sqft"])
    return learn.mse(predicted, housing.TARGET).select(F.round("mse", 0).alias("mse"))


# Least squares one feature after the other: each is freed of those before it, then so is the price.
_RESIDUALS = f"""
WITH f AS ({HOUSE_FEATURES_SQL}),
a AS (SELECT *, sqft - avg(sqft) OVER () AS q1 FROM f),
b AS (SELECT a.*, bedrooms - s * q1 - i AS q2 FROM a, (SELECT regr_slope(bedrooms, q1) AS s, regr_intercept(bedrooms, q1) AS i FROM a)),
c1 AS (SELECT b.*, bathrooms - s * q1 - i AS t3 FROM b, (SELECT regr_slope(bathrooms, q1) AS s, regr_intercept(bathrooms, q1) AS i FROM b)),
c AS (SELECT c1.*, t3 - s * q2 AS q3 FROM c1, (SELECT regr_slope(t3, q2) AS s FROM c1)),
d1 AS (SELECT c.*, school_rating - s * q1 - i AS t4 FROM c, (SELECT regr_slope(school_rating, q1) AS s, regr_intercept(school_rating, q1) AS i FROM c)),
d2 AS (SELECT d1.*, t4 - s * q2 AS u4 FROM d1, (SELECT regr_slope(t4, q2) AS s FROM d1)),
d AS (SELECT d2.*, u4 - s * q3 AS q4 FROM d2, (SELECT regr_slope(u4, q3) AS s FROM d2)),
r AS (SELECT price - avg(price) OVER () - regr_slope(price, q1) OVER () * q1 - regr_slope(price, q2) OVER () * q2
  - regr_slope(price, q3) OVER () * q3 - regr_slope(price, q4) OVER () * q4 AS e FROM d)"""


@query(
    "PIPE1 M1 M2 M3 M4 D5",
    f"""{_RESIDUALS} SELECT 'LinearRegressionModel' AS model_type, 'pyspark.ml' AS framework,
      count(*) AS n_rows, round(avg(e * e), 0) AS mse FROM r""",
)
def house_price_model(t: Tables) -> DataFrame:
    record = housing.train(S.house_sales(t), S.location_info(t))
    return record.withColumn("mse", F.round("mse", 0)).drop("version", "mse_text")


# Products, reserve, inventory

REGIONS = """
country AS (SELECT n_name AS country_code, r_name AS ordering_region FROM nation JOIN region ON n_regionkey = r_regionkey),
seller AS (SELECT s_suppkey, s_nationkey, country_code, ordering_region FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN country ON country_code = n_name)"""


PRODUCTS = f"""{REGIONS},
catalogue AS (SELECT *, 'B0' || p_partkey AS product_id, split_part(p_name, ' ', 2) AS vendor_name,
  CAST(length(split_part(p_name, ' ', 2)) AS bigint) AS vendor_id FROM part),
sold AS (SELECT DISTINCT ordering_region, vendor_id, vendor_name AS brand, product_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN catalogue ON l_partkey = p_partkey JOIN seller ON l_suppkey = s_suppkey
  WHERE o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) > DATE '{LO}' - 365 AND l_extendedprice > 0),
parent AS (SELECT DISTINCT ordering_region, product_id, 'B0' || (p_partkey - p_partkey % 10) AS parent_id FROM catalogue
  JOIN country ON country_code = 'NATION_' || (p_partkey % 25) WHERE p_size > 20),
product AS (SELECT s.ordering_region, s.brand, coalesce(p.parent_id, s.product_id) AS parent_id, s.product_id
  FROM sold s LEFT JOIN parent p ON p.product_id = s.product_id AND p.ordering_region = s.ordering_region)"""

# An item's reserve: its weeks of supply times the mean forecast of its shop's lines near the day.
RESERVE = f"""
planned AS (SELECT p_partkey AS master_id, p_type IN ('SMALL', 'PROMO', 'ECONOMY') AS in_shop,
  if(p_size > 10, p_size, 2 * p_size) AS weeks FROM part WHERE p_size <= 40 AND p_type <> 'MEDIUM'),
demand AS (SELECT l_partkey, l_returnflag = 'N' AS in_shop,
    avg(l_quantity + if(l_linestatus = 'O', 1, round(l_discount * 100)) + round(l_tax * 100)) AS units
  FROM lineitem SEMI JOIN (SELECT s_suppkey FROM seller WHERE ordering_region = 'AMERICA') ON l_suppkey = s_suppkey
  WHERE l_returnflag <> 'A' AND date_diff('day', DATE '{WEEK_OF}', CAST(l_shipdate AS DATE)) BETWEEN -7 AND 21 GROUP BY ALL),
reserve AS (SELECT master_id, weeks * units AS reserve FROM planned n LEFT JOIN demand d ON l_partkey = master_id AND d.in_shop = n.in_shop)"""

# What each stored line adds to a quantity, before it counts once per product row and listing.
_ADDS = {
    "available_fba": "if(l_linestatus = 'O', 2 * l_linenumber, 0)",
    "total_coming_inventory": "l_linenumber + 2 * units + cents + l_linenumber % 3",
    "reserved_transfer": "cents",
    "reserved_processing": "l_linenumber % 3",
    "warehouse_total": "2 * units",
    "inbound": "l_linenumber",
    "on_order": "round(l_tax * 100)",
    "warehouse_processing": "round(l_discount * 100)",
    "reserve": "coalesce(reserve, 0)",
}


def _inventory_sql() -> str:
    """Lines weighed by product rows and listings, instead of joined to them; reserves no line asks
    for added by an anti join; one pass for both programs."""
    added = ", ".join(f"sum(({_ADDS[c]}) * copies) AS {c}" for c in I.QUANTITIES if c != "available_fbm")
    lonely = ", ".join("sum(coalesce(reserve, 0))" if c == "reserve" else "0" for c in I.QUANTITIES if c != "available_fbm")
    either = lambda c: f"if(narrow, sum({c}), max({c}))"
    columns = ", ".join(f"{either(c)} AS {c}" for c in I.QUANTITIES)
    return f"""{PRODUCTS}, {RESERVE},
kind AS (SELECT ordering_region, product_id, count(*) * any_value(if(p_size > 40, 2, 1)) AS copies,
    count(*) * any_value(if(p_size > 20, 1, 0)) AS own_copies FROM product JOIN catalogue USING (product_id) GROUP BY ALL),
stored AS (SELECT l.*, c.*, k.*, CAST(l_quantity AS bigint) AS units, CAST(round(l_discount * 100) AS bigint) AS cents,
    CAST(l_shipdate AS DATE) AS date, if(p_type = 'LARGE', NULL, p_partkey) AS master_id,
    if(p_type = 'PROMO', NULL, p_brand = 'Brand#3') AS gone, l_linenumber <> 1 AS retail,
    CASE WHEN l_returnflag = 'A' THEN 'wide' WHEN l_returnflag <> 'R' THEN 'none' WHEN l_linenumber < 7 THEN 'remote' ELSE 'local' END AS program
  FROM lineitem l JOIN catalogue c ON l_partkey = p_partkey JOIN seller ON l_suppkey = s_suppkey JOIN kind k USING (product_id, ordering_region)),
placed AS (
  SELECT product_id, ordering_region, date, retail, program, sum(units * own_copies) AS available_fbm, {added},
    max(p_retailprice) AS wholesale_price, max(vendor_name) AS brand
  FROM stored LEFT JOIN reserve USING (master_id)
  WHERE gone IS NULL OR (NOT gone AND retail AND date BETWEEN DATE '{LO}' AND DATE '{HI}') GROUP BY ALL
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, 'none', 0, {lonely}, 0, NULL FROM reserve
  WHERE NOT EXISTS (SELECT 1 FROM stored WHERE stored.master_id = reserve.master_id) HAVING count(*) > 0),
dated AS (SELECT *, program <> 'wide' AS narrow, min(date) OVER (PARTITION BY product_id, ordering_region) AS first_date
  FROM placed QUALIFY program <> 'local'),
inventory AS (SELECT DISTINCT * EXCLUDE narrow FROM (
  SELECT product_id, ordering_region, date, narrow, {columns}, {either('available_fbm')} + {either('available_fba')} AS total_available,
    min(first_date) AS first_date, max(wholesale_price) AS wholesale_price, max(brand) AS brand FROM dated GROUP BY 1, 2, 3, 4))"""


INVENTORY = _inventory_sql()


def _whole(names: list[str]) -> str:
    return ", ".join(
        "round(reserve, 2) AS reserve" if c == "reserve" else f"CAST({c} AS bigint) AS {c}"
        for c in names
    )


@query("PIPE3 J3 A12", f"WITH {PRODUCTS} SELECT * FROM product")
def products(t: Tables) -> DataFrame:
    return I.products(S.daily_sales(t), S.product_parent_map(t), S.ordering_regions(t), LO)


@query(
    "PIPE4 A10 A11 F7 P6",
    f"WITH {REGIONS}, {RESERVE} SELECT master_id, round(reserve, 4) AS reserve FROM reserve",
)
def reserve_per_item(t: Tables) -> DataFrame:
    reserve = I.reserve(S.forecast_weeks(t), S.ordering_files(t), WEEK_OF)
    return reserve.withColumn("reserve", F.round("reserve", 4))


def _products(t: Tables) -> DataFrame:
    return I.products(S.daily_sales(t), S.product_parent_map(t), S.ordering_regions(t), LO)


def _inventory(t: Tables, products: DataFrame, then=lambda days: days) -> DataFrame:
    return I.inventory_table(
        S.inventory_daily(t),
        S.ordering_regions(t),
        products,
        S.listings(t),
        I.reserve(S.forecast_weeks(t), S.ordering_files(t), WEEK_OF),
        LO,
        HI,
        then,
    )


@query(
    "PIPE5 J2 J4 J5 F8 F9 A4 A5 A6 A7 W1 S1 S3",
    f"""WITH {INVENTORY} SELECT product_id, ordering_region, {on('date')} AS date, {_whole(I.QUANTITIES)},
      CAST(total_available AS bigint) AS total_available, {on('first_date')} AS first_date, wholesale_price, brand FROM inventory""",
)
def inventory_per_day(t: Tables) -> DataFrame:
    inventory = _inventory(t, kept(_products(t), "products"))
    return inventory.withColumn("reserve", F.round("reserve", 2))


POSITION = f"""
position AS (SELECT product_id, ordering_region, date, {', '.join(f'sum({c}) AS {c}' for c in [*I.QUANTITIES, 'total_available'])},
  min(first_date) AS first_date, max(wholesale_price) AS wholesale_price, max(brand) AS brand FROM inventory GROUP BY 1, 2, 3),
grid AS (SELECT product_id, ordering_region, CAST(x AS DATE) AS date FROM (SELECT DISTINCT product_id, ordering_region FROM product)
  CROSS JOIN generate_series(DATE '{LO}', DATE '{HI}', INTERVAL 1 DAY) g(x)),
flagged AS (SELECT *, CASE WHEN coalesce(available_fba, 0) + coalesce(available_fbm, 0) <= 0 THEN 1 ELSE 0 END AS out_of_stock
  FROM grid LEFT JOIN position USING (product_id, ordering_region, date)),
spine AS (SELECT *, {', '.join(
    f'''max(out_of_stock) OVER (PARTITION BY product_id, ordering_region ORDER BY date
  RANGE BETWEEN INTERVAL 1 DAY FOLLOWING AND INTERVAL {n} DAY FOLLOWING) AS out_of_stock_{n}''' for n in I.HORIZONS)} FROM flagged)"""

FORECAST = f"""
forecast AS (SELECT product_id, ordering_region, CAST(o_orderdate AS DATE) AS date, CAST(sum(CAST(l_quantity AS bigint)) AS bigint) AS f
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN catalogue ON l_partkey = p_partkey JOIN seller ON l_suppkey = s_suppkey GROUP BY 1, 2, 3),
filled AS (SELECT s.*, last_value(f IGNORE NULLS) OVER (PARTITION BY product_id, ordering_region ORDER BY date
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS forecast FROM spine s LEFT JOIN forecast USING (product_id, ordering_region, date))"""

# A row per product, region and day is 731 rows per product sold in a region. The stock-outs, the
# forecast, the failed fills and the age of orders return them all. The fill history and the
# training set make them all and return each series' totals: its days, and of each column the
# days it is known on, its sum, and its sum weighed by the day, which shows where in the period its
# values lie. Means go in as whole millionths, amounts as cents.
_FLAGS = ["out_of_stock", *[f"out_of_stock_{n}" for n in I.HORIZONS]]
_STOCK = ["available_fbm", "available_fba", "total_available"]


def _totals(days: DataFrame, keys: list[str], columns: list[str], scaled: dict[str, int] | None = None) -> DataFrame:
    scaled = scaled or {}
    day = F.datediff("date", F.lit(LO))
    out = [F.count("*").alias("n_days")]
    for c in [*columns, *scaled]:
        value = F.round(F.col(c) * scaled[c]).cast("bigint") if c in scaled else F.col(c).cast("bigint")
        out += [F.count(c).alias(f"{c}_days"), F.sum(value).alias(f"{c}_sum"), F.sum(value * day).alias(f"{c}_by_day")]
    return days.groupBy(*keys).agg(*out)


def _totals_sql(source: str, keys: list[str], columns: list[str], scaled: dict[str, int] | None = None) -> str:
    scaled = scaled or {}
    out = [*keys, "count(*) AS n_days"]
    for c in [*columns, *scaled]:
        value = f"CAST(round({c} * {scaled[c]}) AS bigint)" if c in scaled else f"CAST({c} AS bigint)"
        day = f"date_diff('day', DATE '{LO}', date)"
        out += [f"count({c}) AS {c}_days", f"CAST(sum({value}) AS bigint) AS {c}_sum", f"CAST(sum({value} * {day}) AS bigint) AS {c}_by_day"]
    return f"SELECT {', '.join(out)} FROM {source} GROUP BY {', '.join(keys)}"


_SPINE = f"""product_id, ordering_region, {on('date')} AS date, {', '.join(f'CAST({c} AS bigint) AS {c}' for c in _STOCK)},
  brand, round(reserve, 2) AS reserve, {', '.join(_FLAGS)}"""


def _position(t: Tables) -> tuple[DataFrame, DataFrame]:
    products = _table(_products(t), "products")
    return _inventory(t, products, I.position), products


def _table(df: DataFrame, name: str) -> DataFrame:
    return written(df, name) if slices(df.sparkSession) == 1 else kept(df, name)


@query(
    "PIPE6 A13 J7 J8 X11 W2",
    f"WITH {INVENTORY}, {POSITION} SELECT {_SPINE} FROM spine",
)
def stock_outs_ahead(t: Tables) -> DataFrame:
    stock = I.stock_outs(*_position(t), LO, HI)
    return stock.select(
        *I.SERIES, "date", *_STOCK, "brand", F.round("reserve", 2).alias("reserve"), *_FLAGS
    )


@query(
    "PIPE7 J10 W3 P4",
    f"""WITH {INVENTORY}, {POSITION}, {FORECAST}
    SELECT product_id, ordering_region, {on('date')} AS date, out_of_stock, forecast FROM filled""",
)
def forecast_carried_forward(t: Tables) -> DataFrame:
    position, products = _position(t)
    stock = I.forecast_stock(position, _demand(t), products, LO, HI)
    return stock.select(*I.SERIES, "date", "out_of_stock", "forecast")


def _demand(t: Tables) -> DataFrame:
    """The forecasts of the period."""
    demand = S.demand_forecast(t)
    return kept(demand.where(F.col("start_forecast_dt").between(F.lit(LO), F.lit(HI))), "demand-forecast")


# Purchase orders


def po_lines_sql() -> str:
    return """
item AS (SELECT l_orderkey, l_partkey, l_suppkey, sum(CAST(l_quantity AS bigint)) AS ordered,
    sum(CASE WHEN l_linestatus = 'F' THEN CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS bigint) * 4 // 5
      ELSE CAST(l_quantity AS bigint) END END) AS received,
    min(CASE WHEN l_linestatus = 'F' THEN CAST(l_partkey % 50 + l_linenumber AS int) END) AS first_late,
    max(CASE WHEN l_linestatus = 'F' THEN CAST(l_partkey % 50 + l_linenumber AS int) END) AS last_late,
    min(CASE WHEN l_returnflag <> 'N' THEN l_linenumber END) AS ship_late
  FROM lineitem GROUP BY 1, 2, 3),
vendor AS (SELECT vendor_id AS vid, max(vendor_name) AS vendor FROM catalogue GROUP BY 1),
po AS (SELECT 'PO-' || o_orderkey AS po_number, product_id, ordering_region, p_partkey AS master_id, vendor_id, vendor AS brand,
    country_code, 'state ' || o_orderstatus AS state, placed AS date_placed,
    coalesce(placed + ship_late, CASE WHEN o_orderpriority <> '5-LOW' THEN placed + 5 END) AS date_shipped_from_vendor,
    placed + first_late AS first_rec_date, placed + last_late AS last_rec_date,
    CAST(ordered AS bigint) AS ordered_quantity, CAST(received AS bigint) AS received_quantity,
    CASE WHEN coalesce(received, 0) < ordered THEN 1 ELSE 0 END AS failed_fills,
    CASE WHEN received >= ordered THEN last_late END AS lead_time
  FROM item JOIN (SELECT *, CAST(o_orderdate AS DATE) AS placed FROM orders) ON l_orderkey = o_orderkey
    JOIN catalogue ON l_partkey = p_partkey JOIN vendor ON vid = vendor_id JOIN seller ON l_suppkey = s_suppkey
  WHERE (product_id, ordering_region) IN (SELECT (product_id, ordering_region) FROM sold))"""


def _lines(t: Tables) -> DataFrame:
    sold = I.sold_products(S.daily_sales(t), LO)
    return P.po_lines(**S.po_inputs(t), sold=sold)


def _line_table(t: Tables) -> DataFrame:
    return P.line_table(S.po_inputs(t), I.sold_products(S.daily_sales(t), LO))


_DATES = ["date_placed", "date_shipped_from_vendor", "first_rec_date", "last_rec_date"]


@query(
    "PIPE8 J11 A14 A15 X9 X10",
    f"""WITH {PRODUCTS}, {po_lines_sql()}
    SELECT * REPLACE ({', '.join(f'{on(c)} AS {c}' for c in _DATES)}) FROM po""",
)
def purchase_order_lines(t: Tables) -> DataFrame:
    return _lines(t)


_BACK = LO - dt.timedelta(days=P.LOOK_BACK)


def _days_sql(start: dt.date) -> str:
    return f"generate_series(DATE '{start}', DATE '{HI}', INTERVAL 1 DAY) g(x)"


_W = """OVER (PARTITION BY product_id, ordering_region, brand ORDER BY date
  RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW)"""

PO_FEATURES = f"""
series AS (SELECT DISTINCT product_id, ordering_region, brand FROM po),
po_grid AS (SELECT product_id, ordering_region, brand, CAST(x AS DATE) AS date FROM series CROSS JOIN {_days_sql(_BACK)}),
by_receipt AS (SELECT product_id, ordering_region, brand, last_rec_date AS date,
    sum(CASE WHEN ordered_quantity <> 0 THEN received_quantity * 1000000 // ordered_quantity END) AS rates,
    count(CASE WHEN ordered_quantity <> 0 THEN received_quantity END) AS n_rates,
    sum(lead_time) AS leads, count(lead_time) AS n_leads FROM po WHERE last_rec_date IS NOT NULL GROUP BY 1, 2, 3, 4),
by_placing AS (SELECT product_id, ordering_region, brand, date_placed AS date, sum(failed_fills) AS failed FROM po GROUP BY 1, 2, 3, 4),
rolled AS (SELECT *, CAST(sum(rates) {_W} AS double) / sum(n_rates) {_W} / 1000000 AS rate,
    CAST(sum(leads) {_W} AS double) / sum(n_leads) {_W} AS lead,
    CAST(coalesce(sum(failed) {_W}, 0) AS bigint) AS failed_90
  FROM po_grid LEFT JOIN by_receipt USING (product_id, ordering_region, brand, date)
    LEFT JOIN by_placing USING (product_id, ordering_region, brand, date)),
day AS (SELECT CAST(x AS DATE) AS date FROM {_days_sql(LO)}),
oldest AS (SELECT product_id, ordering_region, date, CAST(date_diff('day', min(date_placed), date) AS int) AS age,
    CAST(date_diff('day', min(CASE WHEN date_shipped_from_vendor IS NOT NULL THEN date_placed END), date) AS int) AS shipped_age
  FROM day JOIN po ON date_placed <= date AND (last_rec_date > date OR last_rec_date IS NULL) GROUP BY 1, 2, 3)"""


_MEANS = {"avg_partial_fill_rate_90": 1_000_000, "rolling_avg_lead_time_90": 1_000_000}
_ROLLED = f"""period AS (SELECT *, rate AS avg_partial_fill_rate_90, lead AS rolling_avg_lead_time_90,
  failed_90 AS number_failed_fills_90 FROM rolled WHERE date >= DATE '{LO}')"""


@query(
    "PIPE8 W4 W5 J7 J8",
    f"WITH {PRODUCTS}, {po_lines_sql()}, {PO_FEATURES}, {_ROLLED} {_totals_sql('period', P.BRANDED, [], _MEANS)}",
)
def supplier_fill_history(t: Tables) -> DataFrame:
    return _totals(P.fill_history(_line_table(t), LO, HI), P.BRANDED, [], _MEANS)


@query(
    "PIPE8 W6 J7 J8",
    f"""WITH {PRODUCTS}, {po_lines_sql()}, {PO_FEATURES}
    SELECT product_id, ordering_region, brand, {on('date')} AS date, failed_90 AS number_failed_fills_90
    FROM rolled WHERE date >= DATE '{LO}'""",
)
def failed_fills_of_orders_placed(t: Tables) -> DataFrame:
    return P.placed_history(_line_table(t), LO, HI)


@query(
    "PIPE8 J9",
    f"""WITH {PRODUCTS}, {po_lines_sql()}, {PO_FEATURES}
    SELECT product_id, ordering_region, {on('date')} AS date, age AS oldest_order_not_received FROM oldest""",
)
def age_of_oldest_open_order(t: Tables) -> DataFrame:
    return P.oldest_order_age(_line_table(t), LO, HI, "oldest_order_not_received")


_AGES = ["oldest_order_not_received", "oldest_order_not_received_but_shipped"]
_TRAINING = [*_STOCK, *_FLAGS, "forecast", "number_failed_fills_90", *_AGES]


@query(
    "PIPE9 J10",
    f"""WITH {INVENTORY}, {POSITION}, {FORECAST}, {po_lines_sql()}, {PO_FEATURES}, {_ROLLED},
    whole AS (SELECT f.*, avg_partial_fill_rate_90, rolling_avg_lead_time_90, number_failed_fills_90,
        age AS oldest_order_not_received, shipped_age AS oldest_order_not_received_but_shipped
      FROM filled f LEFT JOIN period r ON r.product_id = f.product_id AND r.ordering_region = f.ordering_region AND r.date = f.date
        LEFT JOIN oldest o ON o.product_id = f.product_id AND o.ordering_region = f.ordering_region AND o.date = f.date)
    {_totals_sql('whole', I.SERIES, _TRAINING, {'reserve': 100} | _MEANS)}""",
)
def training_set(t: Tables) -> DataFrame:
    position, products = _position(t)
    demand, lines = _demand(t), _line_table(t)

    def totals(part: Part) -> DataFrame:
        tables = [part(df, "product_id") for df in (position, demand, products, lines)]
        full = assemble_training_set(*tables, LO, HI)
        return _totals(full, I.SERIES, _TRAINING, {"reserve": 100} | _MEANS)

    return in_slices(t.spark, "training-set", totals)
