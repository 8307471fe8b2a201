"""Sources, projection, filters, set operations, scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from stocktrail.catalogue.lineage_sql import EVENTS, STEPS
from stocktrail.catalogue.registry import at, on, query
from stocktrail.functions import scalars as X
from stocktrail.lineage.events import step_events
from stocktrail.operators.relational import (
    daily_counts,
    enrich,
    ilike_any,
    require,
    union_distinct,
)
from stocktrail.plans import housing, standins as S, user_trends
from stocktrail.plans.standins import Tables
from stocktrail.session import freed, scratch_path
from stocktrail.sources import eventlog
from stocktrail.sources.tables import (
    declare_window,
    load_features,
    materialize,
    stage,
    window_bounds,
)

HOUSE_FEATURES_SQL = """
SELECT l_quantity AS sqft, l_linenumber AS bedrooms,
       CASE WHEN l_discount > 0 THEN round(l_tax * 100) END AS bathrooms,
       CASE WHEN p_size < 50 THEN p_size END AS school_rating, l_extendedprice AS price
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_type <> 'PROMO' AND p_size < 50 AND l_discount > 0
  AND l_extendedprice BETWEEN 10000 AND 1000000"""


# Sources and sinks


@query("IO1", "SELECT * FROM customer")
def scan_table(t: Tables) -> DataFrame:
    return t.customer


@query("IO2 IO3 P3 F3", HOUSE_FEATURES_SQL)
def features_read_for_training(t: Tables) -> DataFrame:
    frame = housing.features(S.house_sales(t), S.location_info(t))
    materialize(frame, "stocktrail_features", scratch_path(t.spark, "features"))
    return load_features(t.spark, "stocktrail_features", [*housing.FEATURES, housing.TARGET])


@query(
    "IO3 PIPE2 X7 A1",
    f"""SELECT {on('ts')} AS date, count(CASE WHEN event_type <> 'error' THEN event_id END) AS user_count
    FROM events GROUP BY 1""",
)
def user_counts_table(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "user_counts")
    return user_trends.user_counts(S.user_history(t), "stocktrail_user_counts", path)


@query(
    "IO4",
    """SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS dearest
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""",
)
def staged_table_read_by_sql(t: Tables) -> DataFrame:
    stage(t.orders.where(F.col("o_orderstatus") == "F"), "stocktrail_finished")
    return t.spark.sql(
        "SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS dearest "
        "FROM stocktrail_finished GROUP BY o_custkey"
    )


def _event_columns(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("run.runId").alias("run_id"),
        "eventType",
        F.col("job.name").alias("job"),
        F.col("run.facets.parent.run.runId").alias("parent"),
        "eventTime",
        F.size("inputs").cast("bigint").alias("n_inputs"),
        F.size("outputs").cast("bigint").alias("n_outputs"),
    )


_EVENT_COLUMNS = f"""{EVENTS}
SELECT run_id, eventType, job, parent, {at('eventTime')} AS "eventTime", n_inputs, n_outputs FROM event"""


@query("IO5 IO8 D6", _EVENT_COLUMNS)
def event_log_round_trip(t: Tables) -> DataFrame:
    # As text alone the log is some twenty times the tables it tells of.
    path = scratch_path(t.spark, "events")
    with freed(t.spark):
        eventlog.write_events(S.run_events(t), path, "gzip", eventlog.PER_FILE)
    return _event_columns(eventlog.read_events(t.spark, path))


@query("IO6 IO8", _EVENT_COLUMNS)
def gzip_event_log_round_trip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "events-gzip")
    eventlog.write_events(S.run_events(t), path, compression="gzip")
    return _event_columns(eventlog.read_events(t.spark, path))


@query(
    "IO7",
    f"""{STEPS}, event AS (
      SELECT run_id, 'START' AS "eventType", started_at AS m FROM step WHERE started_at IS NOT NULL
      UNION ALL SELECT run_id, 'COMPLETE', ended_at FROM step WHERE ended_at IS NOT NULL)
    SELECT run_id, "eventType", {at('m')} AS "eventTime", true AS same FROM event""",
)
def event_json_round_trip(t: Tables) -> DataFrame:
    events = step_events(S.step_runs(t))
    whole = F.struct(*[F.col(c) for c in events.columns])
    # Maps can not be compared; their JSON can.
    sent = events.withColumns({"before": F.to_json(whole), "text": eventlog.event_json(events)})
    return (
        eventlog.with_parsed(sent, "text", "back")
        .select(
            F.col("back.run.runId").alias("run_id"),
            F.col("back.eventType").alias("eventType"),
            F.col("back.eventTime").alias("eventTime"),
            (F.to_json("back") == F.col("before")).alias("same"),
        )
    )


@query(
    "IO9",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN 'raw.' ELSE 'mart.' END || 'part_' || p_partkey AS name
    FROM part""",
)
def qualified_names(t: Tables) -> DataFrame:
    name = F.concat(F.lit("part_"), F.col("p_partkey").cast("string"))
    given = F.when(F.col("p_size") > 25, F.concat(F.lit("raw."), name)).otherwise(name)
    return t.part.select("p_partkey", eventlog.qualify(given, "mart").alias("name"))


@query(
    "IO10 D3 X5",
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2001-08-01' - 730 AND DATE '2001-08-01'""",
)
def orders_of_the_period(t: Tables) -> DataFrame:
    lo, hi = window_bounds("2001-08-01")
    day = F.to_date("o_orderdate")
    return t.orders.where(day.between(F.lit(lo), F.lit(hi))).select("o_orderkey", "o_custkey")


@query(
    "IO10 D3",
    """SELECT o_orderpriority, count(*) AS n FROM orders
    WHERE o_orderdate >= DATE '2001-08-01' - 730 AND o_orderdate <= DATE '2001-08-01' GROUP BY 1""",
)
def period_as_session_variables(t: Tables) -> DataFrame:
    declare_window(t.spark, "2001-08-01")
    return t.spark.sql(
        "SELECT o_orderpriority, count(*) AS n FROM {orders} "
        "WHERE o_orderdate >= start_date AND o_orderdate <= end_date GROUP BY o_orderpriority",
        orders=t.orders,
    )


# Projection


@query(
    "P1 F1",
    f"""SELECT * REPLACE ({at('o_orderdate')} AS o_orderdate) FROM orders
    WHERE o_totalprice BETWEEN 10000 AND 300000""",
)
def orders_in_price_range(t: Tables) -> DataFrame:
    return t.orders.select("*").where(F.col("o_totalprice").between(10_000, 300_000))


@query(
    "P2 J1",
    f"""SELECT o.* REPLACE ({at('o_orderdate')} AS o_orderdate), c_mktsegment
    FROM orders o JOIN customer ON o_custkey = c_custkey""",
)
def orders_with_segment(t: Tables) -> DataFrame:
    customers = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    return enrich(t.orders, customers, "o_custkey", ["c_mktsegment"])


@query("P3", "SELECT l_returnflag, l_partkey, l_quantity FROM lineitem")
def chosen_columns(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_partkey", "l_quantity")


@query("P4", "SELECT s_suppkey AS vendor_id, s_name AS brand, s_nationkey FROM supplier")
def renamed_columns(t: Tables) -> DataFrame:
    names = {"s_suppkey": "vendor_id", "s_name": "brand"}
    return t.supplier.withColumnsRenamed(names).drop("s_acctbal")


@query("P5", f"SELECT * EXCLUDE (price) FROM ({HOUSE_FEATURES_SQL})")
def features_without_target(t: Tables) -> DataFrame:
    return housing.features(S.house_sales(t), S.location_info(t)).drop(housing.TARGET)


@query(
    "P6 X8",
    """SELECT l_orderkey, l_quantity AS f1, round(l_discount * 100) AS f2, round(l_tax * 100) AS f3,
    l_quantity + round(l_discount * 100) + round(l_tax * 100) AS forecast FROM lineitem""",
)
def alias_used_beside_its_definition(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "l_orderkey",
        "l_quantity AS f1",
        "abs(round(l_discount * 100)) AS f2",
        "abs(round(l_tax * 100)) AS f3",
        "f1 + f2 + f3 AS forecast",
    )


@query(
    "P7 X3",
    """SELECT c_custkey, upper(c_mktsegment) AS marketplace FROM customer
    WHERE upper(c_mktsegment) LIKE '%MACH%'""",
)
def filter_on_a_computed_column(t: Tables) -> DataFrame:
    named = t.customer.select("c_custkey", F.upper("c_mktsegment").alias("marketplace"))
    return named.where(F.col("marketplace").like("%MACH%"))


# Filters


@query(
    "F2 X4 X6",
    f"""SELECT o_orderkey, {on('o_orderdate')} AS day FROM orders WHERE CAST(o_orderdate AS DATE)
    BETWEEN DATE '1998-06-15' - 7 AND DATE '1998-06-15' + 21""",
)
def orders_around_a_day(t: Tables) -> DataFrame:
    today = F.lit(dt.date(1998, 6, 15))
    day = F.col("o_orderdate").cast("date")
    return t.orders.where(day.between(F.date_sub(today, 7), F.date_add(today, 21))).select(
        "o_orderkey", day.alias("day")
    )


def _customers_with_orders(t: Tables) -> DataFrame:
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left")


_CUSTOMERS_WITH_ORDERS = "customer LEFT JOIN orders ON c_custkey = o_custkey"


@query(
    "F3",
    f"""SELECT c_custkey, o_orderkey, o_orderpriority FROM {_CUSTOMERS_WITH_ORDERS}
    WHERE o_orderkey IS NOT NULL AND o_orderpriority IS NOT NULL""",
)
def rows_without_nulls(t: Tables) -> DataFrame:
    return require(_customers_with_orders(t), ["o_orderkey", "o_orderpriority"]).select(
        "c_custkey", "o_orderkey", "o_orderpriority"
    )


@query(
    "F4",
    """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
    WHERE l_quantity > 10 AND l_quantity <= 40 AND l_tax >= 0.02 AND l_returnflag = 'R'""",
)
def plain_comparisons(t: Tables) -> DataFrame:
    return t.lineitem.where(
        (F.col("l_quantity") > 10)
        & (F.col("l_quantity") <= 40)
        & (F.col("l_tax") >= 0.02)
        & (F.col("l_returnflag") == "R")
    ).select("l_orderkey", "l_partkey", "l_quantity")


@query(
    "F5 F6",
    """SELECT c_custkey, c_mktsegment FROM customer
    WHERE upper(c_mktsegment) ILIKE '%build%' OR upper(c_mktsegment) ILIKE 'mach%'""",
)
def pattern_in_any_case(t: Tables) -> DataFrame:
    return t.customer.where(ilike_any("c_mktsegment", "%build%", "mach%")).select(
        "c_custkey", "c_mktsegment"
    )


@query(
    "F7",
    f"""SELECT c_custkey, o_orderkey, o_orderpriority FROM {_CUSTOMERS_WITH_ORDERS}
    WHERE NOT o_orderpriority IN ('1-URGENT', '5-LOW')""",
)
def not_in_list(t: Tables) -> DataFrame:
    return (
        _customers_with_orders(t)
        .where(~F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
        .select("c_custkey", "o_orderkey", "o_orderpriority")
    )


@query(
    "F8",
    """SELECT o_orderkey, l_returnflag FROM orders
    LEFT JOIN (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem) ON o_orderkey = l_orderkey
    WHERE l_returnflag ILIKE '%r%' OR l_returnflag IS NULL""",
)
def pattern_or_null(t: Tables) -> DataFrame:
    flags = t.lineitem.select("l_orderkey", "l_returnflag").distinct()
    return (
        t.orders.join(flags, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .where(F.col("l_returnflag").ilike("%r%") | F.col("l_returnflag").isNull())
        .select("o_orderkey", "l_returnflag")
    )


@query(
    "F10",
    """SELECT o_orderkey, o_totalprice > 250000 AS dear FROM orders
    WHERE true AND (o_totalprice > 250000) = false""",
)
def boolean_literals(t: Tables) -> DataFrame:
    return (
        t.orders.where(F.lit(True))
        .withColumn("dear", F.col("o_totalprice") > 250_000)
        .where(F.col("dear") == F.lit(False))
        .select("o_orderkey", "dear")
    )


# Set operations, CTEs


@query(
    "S1",
    """SELECT l_partkey AS k, max(l_quantity) AS v FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1
    UNION SELECT l_partkey, sum(l_quantity) FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""",
)
def union_of_two_aggregates(t: Tables) -> DataFrame:
    def arm(flag: str, value) -> DataFrame:
        rows = t.lineitem.where(F.col("l_returnflag") == flag)
        return rows.groupBy(F.col("l_partkey").alias("k")).agg(value("l_quantity").alias("v"))

    return union_distinct(arm("A", F.max), arm("R", F.sum))


_CHAIN = """
WITH priced AS (SELECT l_orderkey, CAST(round(l_extendedprice * 100) AS bigint) AS c FROM {lineitem}),
per_order AS (SELECT l_orderkey, sum(c) AS c, count(*) AS n FROM priced GROUP BY l_orderkey),
per_size AS (SELECT n, max(c) AS dearest, count(*) AS n_orders FROM per_order GROUP BY n)
SELECT n AS n_lines, CAST(dearest AS bigint) AS dearest, n_orders FROM per_size"""


@query("S2 A11", _CHAIN.format(lineitem="lineitem"))
def chain_of_ctes(t: Tables) -> DataFrame:
    return t.spark.sql(_CHAIN, lineitem=t.lineitem)


@query(
    "S3 S1",
    """WITH c AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT o_custkey, max(n) AS n FROM c WHERE o_orderstatus IN ('F', 'O') GROUP BY 1
    UNION SELECT o_custkey, CAST(sum(n) AS bigint) FROM c WHERE o_orderstatus IN ('F', 'P') GROUP BY 1""",
)
def one_aggregate_read_twice(t: Tables) -> DataFrame:
    counts = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    first = counts.where(F.col("o_orderstatus").isin("F", "O")).groupBy("o_custkey")
    second = counts.where(F.col("o_orderstatus").isin("F", "P")).groupBy("o_custkey")
    return union_distinct(first.agg(F.max("n").alias("n")), second.agg(F.sum("n").alias("n")))


# Scalar functions


@query(
    "X1 X2 X8 X11",
    """SELECT l_orderkey, l_linenumber,
    CASE WHEN coalesce(fba, 0) + coalesce(fbm, 0) <= 0 THEN 1 ELSE 0 END AS out_of_stock,
    coalesce(fba, fbm, -1) AS first_known, fba + fbm AS both_known FROM (
      SELECT l_orderkey, l_linenumber,
        CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS bigint) END AS fba,
        CASE WHEN l_returnflag <> 'N' THEN CAST(l_linenumber AS bigint) END AS fbm FROM lineitem)""",
)
def null_handling(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("bigint")).alias("fba"),
        F.when(F.col("l_returnflag") != "N", F.col("l_linenumber").cast("bigint")).alias("fbm"),
    )
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        X.out_of_stock("fba", "fbm").alias("out_of_stock"),
        F.coalesce("fba", "fbm", F.lit(-1)).alias("first_known"),
        (F.col("fba") + F.col("fbm")).alias("both_known"),
    )


@query(
    "X7 X14 X15",
    f"""SELECT event_id, {on('ts')} AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S.') ||
      lpad(CAST(extract('millisecond' FROM ts) % 1000 AS varchar), 3, '0') || 'Z' AS iso,
      {at('ts + to_minutes(2) + to_seconds(20) + to_hours(CAST(user_id % 5 AS int))')} AS ends
    FROM events""",
)
def instants(t: Tables) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return t.events.select(
        "event_id",
        X.day("ts").alias("day"),
        X.iso_instant(ts).alias("iso"),
        X.shift("ts", hours=(F.col("user_id") % 5).cast("int"), minutes=2, seconds=20).alias("ends"),
    )


@query(
    "X9 X10",
    f"""SELECT o_orderkey, {on('shipped')} AS shipped,
      CASE WHEN o_orderstatus = 'F' THEN date_diff('day', CAST(o_orderdate AS DATE), last_rec) END AS lead_time
    FROM (SELECT *, coalesce(CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 2 END,
        CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) + 5 END) AS shipped,
        CAST(o_orderdate AS DATE) + CAST(o_custkey % 60 AS int) AS last_rec FROM orders)""",
)
def day_differences(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    orders = t.orders.withColumns(
        {
            "actual": F.when(F.col("o_orderstatus") != "O", F.date_add(day, 2)),
            "requested": F.when(F.col("o_orderpriority") != "5-LOW", F.date_add(day, 5)),
            "last_rec": F.date_add(day, (F.col("o_custkey") % 60).cast("int")),
            "ordered": F.lit(1),
            "received": F.when(F.col("o_orderstatus") == "F", 1).otherwise(0),
        }
    )
    lead = X.lead_time("o_orderdate", "last_rec", "ordered", "received")
    return orders.select(
        "o_orderkey",
        X.ship_date("actual", "requested").alias("shipped"),
        lead.cast("bigint").alias("lead_time"),
    )


@query(
    "X12 X13 X16",
    """SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS price,
      lpad(CAST(o_orderkey % 100 AS varchar), 2, '0') AS two,
      'orders.' || lower(o_orderstatus) AS step, 'script.sql.' || o_orderkey AS job FROM orders""",
)
def text_building(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        X.thousands("o_totalprice").alias("price"),
        X.two_digits(F.col("o_orderkey") % 100).alias("two"),
        X.dotted(F.lit("orders"), F.lower("o_orderstatus")).alias("step"),
        F.format_string("script.sql.%d", "o_orderkey").alias("job"),
    )


@query(
    "A1 A9 X7",
    f"SELECT {on('ts')} AS date, count(event_id) AS user_count FROM events GROUP BY 1",
)
def daily_event_counts(t: Tables) -> DataFrame:
    return daily_counts(t.events, "ts", "event_id")
