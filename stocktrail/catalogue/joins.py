"""Joins, aggregates and series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window as W, functions as F

from stocktrail.catalogue.registry import at, on, query
from stocktrail.functions.scalars import cents, day, failed_fill, filled, sum_if
from stocktrail.operators.relational import (
    assemble,
    full_outer,
    receipt_span,
    resolve_parent,
    rollup_position,
)
from stocktrail.operators.rolling import trailing_mean, trailing_sum
from stocktrail.operators.series import (
    densify,
    forward_fill,
    future_flag,
    oldest_open,
    open_counts,
)
from stocktrail.plans.standins import PERIOD, Tables

LO, HI = PERIOD

# Joins


@query(
    "J1",
    """SELECT c_mktsegment, count(*) AS n_orders, CAST(sum(round(o_totalprice * 100)) AS bigint) AS price_cents
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def order_value_by_segment(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(
        F.count("*").alias("n_orders"), F.sum(cents("o_totalprice")).alias("price_cents")
    )


@query(
    "J2",
    """SELECT n_name, count(*) AS n_lines, CAST(sum(round(l_extendedprice * 100)) AS bigint) AS cents
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey = c_nationkey
    JOIN nation ON n_nationkey = s_nationkey GROUP BY 1""",
)
def local_suppliers(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")
    )
    same = (F.col("s_suppkey") == F.col("l_suppkey")) & (
        F.col("s_nationkey") == F.col("c_nationkey")
    )
    return (
        lines.join(t.supplier, same)
        .join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
        .groupBy("n_name")
        .agg(F.count("*").alias("n_lines"), F.sum(cents("l_extendedprice")).alias("cents"))
    )


@query(
    "J3 X1",
    """SELECT a.l_partkey AS part, a.l_returnflag AS flag, coalesce(parent, a.l_partkey) AS parent
    FROM (SELECT DISTINCT l_partkey, l_returnflag FROM lineitem) a
    LEFT JOIN (SELECT p_partkey, CASE WHEN p_size > 30 THEN 'R' ELSE 'A' END AS flag,
               p_partkey - p_partkey % 10 AS parent FROM part) b
    ON a.l_partkey = p_partkey AND a.l_returnflag = b.flag""",
)
def parent_or_self(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    parents = t.part.select(
        key.alias("part"),
        F.when(F.col("p_size") > 30, "R").otherwise("A").alias("flag"),
        (key - key % 10).alias("parent"),
    )
    sold = t.lineitem.select(
        F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag")
    ).distinct()
    return resolve_parent(sold, parents, ["part", "flag"], "part", "parent")


@query(
    "J4 F9",
    f"""SELECT o_orderkey, o_custkey, c_name, {at('o_orderdate')} AS o_orderdate FROM
      (SELECT * EXCLUDE (o_orderstatus), CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END AS closed FROM orders)
    FULL JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
    WHERE o_orderdate >= DATE '1997-01-01' AND o_orderpriority ILIKE '%high%' AND closed = false OR closed IS NULL""",
)
def full_join_with_loose_or(t: Tables) -> DataFrame:
    closed = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F")
    orders = t.orders.withColumns({"closed": closed, "key": F.col("o_custkey")})
    customers = t.customer.where(F.col("c_acctbal") > 0).withColumnRenamed("c_custkey", "key")
    keep = (
        (F.col("o_orderdate") >= F.lit("1997-01-01").cast("date"))
        & F.col("o_orderpriority").ilike("%high%")
        & (F.col("closed") == F.lit(False))
    ) | F.col("closed").isNull()
    return full_outer(orders, customers, "key", keep).select(
        "o_orderkey", "o_custkey", "c_name", "o_orderdate"
    )


@query(
    "J4",
    """SELECT o_orderkey, c_name FROM (SELECT * FROM orders WHERE o_orderstatus = 'F')
    FULL JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""",
)
def full_join(t: Tables) -> DataFrame:
    orders = t.orders.where(F.col("o_orderstatus") == "F").withColumnRenamed("o_custkey", "key")
    customers = t.customer.where(F.col("c_acctbal") > 0).withColumnRenamed("c_custkey", "key")
    return full_outer(orders, customers, "key").select("o_orderkey", "c_name")


@query(
    "J5 A2",
    """SELECT o_orderpriority, count(*) AS n_rows, CAST(sum(round(o_totalprice * 100)) AS bigint) AS cents
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
)
def fan_out_before_sum(t: Tables) -> DataFrame:
    joined = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.groupBy("o_orderpriority").agg(
        F.count("*").alias("n_rows"), F.sum(cents("o_totalprice")).alias("cents")
    )


@query(
    "J6 A3",
    """SELECT c_custkey, c_mktsegment, mean_cents FROM customer LEFT JOIN
    (SELECT o_custkey, CAST(sum(round(o_totalprice * 100)) AS double) / count(*) AS mean_cents
     FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def customers_with_mean_order(t: Tables) -> DataFrame:
    mean = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        (F.sum(cents("o_totalprice")).cast("double") / F.count("*")).alias("mean_cents")
    )
    return t.customer.join(mean, "c_custkey", "left").select(
        "c_custkey", "c_mktsegment", "mean_cents"
    )


_GRID = """
WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n,
    count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1, 2),
grid AS (SELECT user_id, CAST(x AS DATE) AS d FROM (SELECT DISTINCT user_id FROM events), (SELECT
    unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS x FROM events)),
dense AS (SELECT user_id, d, n, errors FROM grid LEFT JOIN daily USING (user_id, d))"""


def _daily(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", day("ts").alias("date")).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("event_type") == "error", 1)).alias("errors")
    )


def _grid(t: Tables, **more) -> DataFrame:
    """Every user on every day from the first event's to the last one's; no rows without any."""
    lo, hi = t.events.agg(F.min(day("ts")), F.max(day("ts"))).first()
    users = t.events
    if lo is None:
        lo = hi = dt.date(1970, 1, 1)
        users = users.limit(0)
    return densify(users, ["user_id"], lo, hi, **more)


def _dense(t: Tables) -> DataFrame:
    return _grid(t, facts=_daily(t))


@query("J7", f"{_GRID} SELECT user_id, {on('d')} AS date FROM grid")
def every_user_on_every_day(t: Tables) -> DataFrame:
    return _grid(t)


@query(
    "J7",
    """SELECT DISTINCT u.user_id, strftime(d, '%Y-%m-%d') AS date FROM events u,
    (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase' AND value > 40)""",
)
def every_user_on_days_of_a_table(t: Tables) -> DataFrame:
    big = t.events.where((F.col("event_type") == "purchase") & (F.col("value") > 40))
    return _grid(t, days=big.select(day("ts").alias("date")))


@query("J8 J7", f"{_GRID} SELECT user_id, {on('d')} AS date, n, errors FROM dense")
def daily_events_without_gaps(t: Tables) -> DataFrame:
    return _dense(t)


_OPEN = f"""
WITH placed AS (SELECT c_nationkey, CAST(o_orderdate AS DATE) AS placed,
    CASE WHEN o_orderstatus = 'O' AND o_orderdate >= DATE '2001-05-01' THEN NULL
      ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS int) END AS received
  FROM orders JOIN customer ON o_custkey = c_custkey),
days AS (SELECT CAST(x AS DATE) AS d FROM generate_series(DATE '{LO}', DATE '{HI}', INTERVAL 1 DAY) g(x))"""


def _placed(t: Tables) -> DataFrame:
    placed = F.to_date("o_orderdate")
    still_open = (F.col("o_orderstatus") == "O") & (placed >= F.lit(dt.date(2001, 5, 1)))
    late = (F.col("o_orderkey") % 60).cast("int")
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_nationkey",
        placed.alias("placed"),
        F.when(~still_open, F.date_add(placed, late)).alias("received"),
    )


@query(
    "J9",
    f"""{_OPEN} SELECT c_nationkey, {on('d')} AS date, {on('min(placed)')} AS oldest_placed,
      date_diff('day', min(placed), d) AS age
    FROM days JOIN placed ON placed <= d AND (received > d OR received IS NULL) GROUP BY c_nationkey, d""",
)
def oldest_open_order_per_day(t: Tables) -> DataFrame:
    oldest = oldest_open(_placed(t), ["c_nationkey"], "placed", "received", LO, HI)
    return oldest.withColumn("age", F.datediff("date", "oldest_placed").cast("bigint"))


@query(
    "J9",
    f"""{_OPEN} SELECT n.c_nationkey, {on('days.d')} AS date, count(placed) AS open_orders
    FROM (SELECT DISTINCT c_nationkey FROM placed) n CROSS JOIN days LEFT JOIN placed p
      ON p.c_nationkey = n.c_nationkey AND placed <= days.d AND (received > days.d OR received IS NULL)
    GROUP BY n.c_nationkey, days.d""",
)
def open_orders_per_day(t: Tables) -> DataFrame:
    return open_counts(_placed(t), ["c_nationkey"], "placed", "received", LO, HI)


@query(
    "J10",
    """SELECT p_partkey, p_brand, n_lines, n_orders, first_ship FROM part
    LEFT JOIN (SELECT l_partkey, count(*) AS n_lines FROM lineitem GROUP BY 1) a ON a.l_partkey = p_partkey
    LEFT JOIN (SELECT l_partkey, count(DISTINCT l_orderkey) AS n_orders FROM lineitem
               WHERE l_returnflag = 'R' GROUP BY 1) b ON b.l_partkey = p_partkey
    LEFT JOIN (SELECT l_partkey, strftime(min(l_shipdate), '%Y-%m-%d') AS first_ship FROM lineitem
               WHERE l_linestatus = 'F' GROUP BY 1) c ON c.l_partkey = p_partkey""",
)
def features_onto_a_spine(t: Tables) -> DataFrame:
    def per_part(condition, *aggs) -> DataFrame:
        rows = t.lineitem.where(condition)
        return rows.groupBy(F.col("l_partkey").alias("p_partkey")).agg(*aggs)

    features = [
        per_part(F.lit(True), F.count("*").alias("n_lines")),
        per_part(F.col("l_returnflag") == "R", F.countDistinct("l_orderkey").alias("n_orders")),
        per_part(
            F.col("l_linestatus") == "F", F.to_date(F.min("l_shipdate")).alias("first_ship")
        ),
    ]
    return assemble(t.part.select("p_partkey", "p_brand"), features, ["p_partkey"])


# Aggregates


@query(
    "A2",
    """SELECT l_returnflag, CAST(sum(CAST(l_quantity AS bigint)) AS bigint) AS quantity,
    CAST(sum(CAST(round(l_extendedprice * 100) AS bigint)) AS bigint) AS cents FROM lineitem GROUP BY 1""",
)
def sums_by_flag(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.sum(cents("l_extendedprice")).alias("cents"),
    )


@query(
    "A3",
    """SELECT l_suppkey, l_returnflag, avg(l_quantity) AS mean_quantity FROM lineitem GROUP BY 1, 2""",
)
def mean_by_two_keys(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(
        F.avg("l_quantity").alias("mean_quantity")
    )


@query(
    "A4",
    f"""SELECT p_brand, min(p_retailprice) AS low, max(p_retailprice) AS high, max(p_name) AS label,
    min(p_type) AS kind FROM part GROUP BY 1""",
)
def extremes(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand").agg(
        F.min("p_retailprice").alias("low"),
        F.max("p_retailprice").alias("high"),
        F.max("p_name").alias("label"),
        F.min("p_type").alias("kind"),
    )


_STOCK = """SELECT *, CAST(l_quantity AS bigint) AS q,
    CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS bigint) END AS open_q,
    CASE WHEN l_returnflag <> 'N' THEN CAST(l_linenumber AS bigint) END AS flagged FROM lineitem"""


def _stock(t: Tables) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    return t.lineitem.withColumns(
        {
            "q": quantity,
            "open_q": F.when(F.col("l_linestatus") == "O", quantity),
            "flagged": F.when(
                F.col("l_returnflag") != "N", F.col("l_linenumber").cast("bigint")
            ),
        }
    )


@query(
    "A5 X2",
    f"""SELECT l_partkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN coalesce(open_q, 0) ELSE 0 END) AS bigint) AS v
    FROM ({_STOCK}) GROUP BY 1""",
)
def conditional_sum(t: Tables) -> DataFrame:
    return _stock(t).groupBy("l_partkey").agg(
        sum_if(F.col("l_returnflag") == "R", F.col("open_q")).alias("v")
    )


@query(
    "A6",
    f"""SELECT l_suppkey, CAST(sum(coalesce(q, 0) + coalesce(open_q, 0) + coalesce(flagged, 0)
    + coalesce(l_linenumber, 0)) AS bigint) AS v FROM ({_STOCK}) GROUP BY 1""",
)
def sum_of_row_expression(t: Tables) -> DataFrame:
    total = sum(filled(F.col(c)) for c in ("q", "open_q", "flagged", "l_linenumber"))
    return _stock(t).groupBy("l_suppkey").agg(F.sum(total).alias("v"))


@query(
    "A7",
    f"""SELECT l_suppkey, max(q) + max(flagged) AS most, CAST(sum(q) + sum(open_q) AS bigint) AS total
    FROM ({_STOCK}) GROUP BY 1""",
)
def arithmetic_between_aggregates(t: Tables) -> DataFrame:
    return _stock(t).groupBy("l_suppkey").agg(
        (F.max("q") + F.max("flagged")).alias("most"),
        (F.sum("q") + F.sum("open_q")).alias("total"),
    )


_ORDINALS = """SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n
FROM {lineitem} GROUP BY 1, 2, 3"""


@query("A8", _ORDINALS.format(lineitem="lineitem"))
def group_by_position(t: Tables) -> DataFrame:
    return t.spark.sql(_ORDINALS, lineitem=t.lineitem)


@query("A9 A1", "SELECT CAST(year(o_orderdate) AS int) AS y, count(o_custkey) AS n FROM orders GROUP BY y")
def group_by_alias(t: Tables) -> DataFrame:
    return t.spark.sql(
        "SELECT year(o_orderdate) AS y, count(o_custkey) AS n FROM {orders} GROUP BY y",
        orders=t.orders,
    )


@query(
    "A10",
    """SELECT l_partkey, coalesce(x, y) AS weeks, CAST(sum(q) AS bigint) AS q FROM (
      SELECT l_partkey, CASE WHEN l_linenumber > 3 THEN l_linenumber END AS x, l_linenumber % 2 AS y,
        CAST(l_quantity AS bigint) AS q FROM lineitem) GROUP BY l_partkey, x, y""",
)
def groups_finer_than_the_output(t: Tables) -> DataFrame:
    number = F.col("l_linenumber")
    rows = t.lineitem.select(
        "l_partkey",
        F.when(number > 3, number).alias("x"),
        (number % 2).alias("y"),
        F.col("l_quantity").cast("bigint").alias("q"),
    )
    grouped = rows.groupBy("l_partkey", "x", "y").agg(F.sum("q").alias("q"))
    return grouped.select("l_partkey", F.coalesce("x", "y").alias("weeks"), "q")


@query(
    "A11",
    """SELECT o_custkey, CAST(sum(q * 10) AS bigint) AS v FROM (
      SELECT o_custkey, l_orderkey, sum(m) AS q FROM (
        SELECT o_custkey, l_orderkey, l_returnflag, max(CAST(l_quantity AS bigint)) AS m
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3) GROUP BY 1, 2) GROUP BY 1""",
)
def three_level_aggregate(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    per_flag = lines.groupBy("o_custkey", "l_orderkey", "l_returnflag").agg(
        F.max(F.col("l_quantity").cast("bigint")).alias("m")
    )
    per_order = per_flag.groupBy("o_custkey", "l_orderkey").agg(F.sum("m").alias("q"))
    return per_order.groupBy("o_custkey").agg(F.sum(F.col("q") * 10).alias("v"))


@query("A12", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query(
    "A13",
    f"""SELECT l_partkey, CAST(sum(q) AS bigint) AS q, CAST(sum(open_q) AS bigint) AS open_q,
    {on('min(first)')} AS first, max(price) AS price FROM (
      SELECT l_partkey, l_suppkey, sum(CAST(l_quantity AS bigint)) AS q,
        sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS bigint) ELSE 0 END) AS open_q,
        CAST(min(l_shipdate) AS DATE) AS first, max(l_extendedprice) AS price
      FROM lineitem GROUP BY 1, 2) GROUP BY 1""",
)
def aggregate_of_an_aggregate(t: Tables) -> DataFrame:
    fine = _stock(t).groupBy("l_partkey", "l_suppkey").agg(
        F.sum("q").alias("q"),
        F.sum("open_q").alias("open_q"),
        F.to_date(F.min("l_shipdate")).alias("first"),
        F.max("l_extendedprice").alias("price"),
    )
    return rollup_position(fine, ["l_partkey"], ["q", "open_q"], ["first"], ["price"])


@query(
    "A14",
    f"""SELECT l_orderkey, {on('min(l_shipdate)')} AS first_rec_date, {on('max(l_shipdate)')} AS last_rec_date
    FROM lineitem GROUP BY 1""",
)
def first_and_last_receipt(t: Tables) -> DataFrame:
    return receipt_span(t.lineitem, ["l_orderkey"], "l_shipdate")


@query(
    "A15",
    f"""SELECT l_orderkey, l_partkey, q, open_q, CASE WHEN coalesce(open_q, 0) < q THEN 1 ELSE 0 END AS failed
    FROM ({_STOCK})""",
)
def failed_fills(t: Tables) -> DataFrame:
    return _stock(t).select(
        "l_orderkey", "l_partkey", "q", "open_q", failed_fill("q", "open_q").alias("failed")
    )


# Series


@query(
    "W1",
    f"""SELECT o_custkey, o_orderpriority, n, {on('min(first) OVER (PARTITION BY o_custkey)')} AS first_date
    FROM (SELECT o_custkey, o_orderpriority, count(*) AS n, CAST(min(o_orderdate) AS DATE) AS first
          FROM orders GROUP BY 1, 2)""",
)
def minimum_over_grouped_rows(t: Tables) -> DataFrame:
    grouped = t.orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.count("*").alias("n"), F.to_date(F.min("o_orderdate")).alias("first")
    )
    first = F.min("first").over(W.partitionBy("o_custkey"))
    return grouped.select("o_custkey", "o_orderpriority", "n", first.alias("first_date"))


def _ahead(n: int) -> str:
    return f"""max(f) OVER (PARTITION BY user_id ORDER BY d
      RANGE BETWEEN INTERVAL 1 DAY FOLLOWING AND INTERVAL {n} DAY FOLLOWING) AS f_{n}"""


@query(
    "W2",
    f"""{_GRID}, flagged AS (SELECT user_id, d, CASE WHEN n IS NULL THEN 1 ELSE 0 END AS f FROM dense)
    SELECT user_id, {on('d')} AS date, f, {', '.join(_ahead(n) for n in (7, 14, 21, 28))} FROM flagged""",
)
def silent_days_ahead(t: Tables) -> DataFrame:
    flagged = _dense(t).select(
        "user_id", "date", F.when(F.col("n").isNull(), 1).otherwise(0).alias("f")
    )
    return future_flag(flagged, ["user_id"], "date", "f", [7, 14, 21, 28])


@query(
    "W2",
    f"""{_GRID}, flagged AS (SELECT user_id, d, CASE WHEN errors > 0 THEN 1 WHEN n > 0 THEN 0 END AS f FROM dense)
    SELECT user_id, {on('d')} AS date, f, {', '.join(_ahead(n) for n in (1, 3))} FROM flagged""",
)
def error_days_ahead_where_known(t: Tables) -> DataFrame:
    flag = F.when(F.col("errors") > 0, 1).when(F.col("n") > 0, 0)
    flagged = _dense(t).select("user_id", "date", flag.alias("f"))
    return future_flag(flagged, ["user_id"], "date", "f", [1, 3])


@query(
    "W2",
    f"""{_GRID}, flagged AS (SELECT user_id, d, CASE WHEN n IS NULL THEN 1 ELSE 0 END AS f FROM dense)
    SELECT user_id, {on('d')} AS date, f, lead(f, 7) OVER w AS f_7, lead(f, 14) OVER w AS f_14
    FROM flagged WINDOW w AS (PARTITION BY user_id ORDER BY d)""",
)
def silent_day_at_distance(t: Tables) -> DataFrame:
    flagged = _dense(t).select(
        "user_id", "date", F.when(F.col("n").isNull(), 1).otherwise(0).alias("f")
    )
    return future_flag(flagged, ["user_id"], "date", "f", [7, 14], mode="at")


@query(
    "W3",
    f"""{_GRID} SELECT user_id, {on('d')} AS date, n, last_value(n IGNORE NULLS) OVER
      (PARTITION BY user_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried
    FROM dense""",
)
def last_known_count(t: Tables) -> DataFrame:
    dense = _dense(t).select("user_id", "date", "n")
    return forward_fill(dense, ["user_id"], "date", "n", out="carried")


_FILLS = """
WITH line AS (SELECT l_suppkey, l_returnflag, CAST(o_orderdate AS DATE) AS d,
    CAST(l_quantity AS bigint) AS ordered,
    CASE WHEN l_linestatus = 'F' THEN CASE WHEN l_returnflag = 'R'
      THEN CAST(l_quantity AS bigint) * 4 // 5 ELSE CAST(l_quantity AS bigint) END END AS received,
    CASE WHEN l_linestatus = 'F' THEN l_partkey % 50 + l_linenumber END AS lead
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_TRAILING = "OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY d RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW)"


def _fills(t: Tables) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    arrived = F.col("l_linestatus") == "F"
    received = F.when(F.col("l_returnflag") == "R", F.floor(quantity * 4 / 5)).otherwise(quantity)
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_suppkey",
        "l_returnflag",
        F.to_date("o_orderdate").alias("placed"),
        quantity.alias("ordered"),
        F.when(arrived, received).alias("received"),
        F.when(arrived, F.col("l_partkey") % 50 + F.col("l_linenumber")).alias("lead"),
    ).withColumn("failed", failed_fill("ordered", "received"))


@query(
    "W4",
    f"""{_FILLS}, rated AS (SELECT *, received * 1000000 // ordered AS r FROM line)
    SELECT DISTINCT l_suppkey, l_returnflag, {on('d')} AS date, CASE WHEN count(r) {_TRAILING} > 0 THEN
      CAST(CAST(sum(r) {_TRAILING} AS bigint) AS double) / count(r) {_TRAILING} / 1000000 END AS mean_90 FROM rated""",
)
def trailing_fill_rate(t: Tables) -> DataFrame:
    return trailing_mean(
        _fills(t), ["l_suppkey", "l_returnflag"], "placed", "received", "ordered"
    )


@query(
    "W5",
    f"""{_FILLS} SELECT DISTINCT l_suppkey, l_returnflag, {on('d')} AS date,
      CAST(sum(lead) {_TRAILING} AS bigint) AS sum_90, count(lead) {_TRAILING} AS n_90 FROM line""",
)
def trailing_lead_time(t: Tables) -> DataFrame:
    return trailing_sum(_fills(t), ["l_suppkey", "l_returnflag"], "placed", "lead")


@query(
    "W6",
    f"""{_FILLS}, f AS (SELECT *, CASE WHEN coalesce(received, 0) < ordered THEN 1 ELSE 0 END AS failed FROM line)
    SELECT DISTINCT l_suppkey, l_returnflag, {on('d')} AS date,
      CAST(sum(failed) {_TRAILING} AS bigint) AS sum_90, count(failed) {_TRAILING} AS n_90 FROM f""",
)
def trailing_failed_fills(t: Tables) -> DataFrame:
    return trailing_sum(_fills(t), ["l_suppkey", "l_returnflag"], "placed", "failed")
