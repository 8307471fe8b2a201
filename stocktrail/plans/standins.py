"""The source tables of the plans, cut from the order and event tables at hand.

Where a column the plans need is not there it is computed from one that is. Rows are never taken
out to make a table smaller; NULLs, unmatched keys and open orders come from the order and line
status, the return flag and the part type.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stocktrail.functions.scalars import cents, dotted, shift
from stocktrail.lineage.events import dataset, input_dataset, output_dataset, step_events, to_events
from stocktrail.sources.tables import load, window_bounds

AS_OF = dt.date(2001, 8, 1)
PERIOD = window_bounds(AS_OF)
WEEK_OF = dt.date(2001, 1, 15)
NAMESPACE = "sales"


class Tables:
    """The Parquet tables of one folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        # Kept on the instance: a table's schema is read from its files once.
        table = load(self.spark, name, self.folder)
        setattr(self, name, table)
        return table


# Houses: a line is a sale, its part the place.


def house_sales(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_partkey").alias("house_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("sqft"),
        F.col("l_linenumber").alias("bedrooms"),
        F.when(F.col("l_discount") > 0, F.round(F.col("l_tax") * 100)).alias("bathrooms"),
    )


def location_info(t: Tables) -> DataFrame:
    """Promotional parts have no location; the largest have no rating."""
    return t.part.where(F.col("p_type") != "PROMO").select(
        F.col("p_partkey").alias("house_id"),
        F.col("p_brand").alias("zipcode"),
        F.when(F.col("p_size") < 50, F.col("p_size")).alias("school_rating"),
    )


def user_history(t: Tables) -> DataFrame:
    return t.events.select(
        F.when(F.col("event_type") != "error", F.col("event_id")).alias("id"),
        F.col("ts").alias("created_at"),
    )


# Products: one per part.


def product_code() -> Column:
    return F.concat(F.lit("B0"), F.col("p_partkey").cast("string"))


def vendor_name() -> Column:
    return F.split_part("p_name", F.lit(" "), F.lit(2))


def _vendor_id() -> Column:
    return F.length(vendor_name()).cast("bigint")


def parts(t: Tables) -> DataFrame:
    return t.part.withColumns(
        {
            "product_id": product_code(),
            "vendor_name": vendor_name(),
            "vendor_id": _vendor_id(),
        }
    )


def ordering_regions(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("country_code"), F.col("r_name").alias("ordering_region")
    )


def _countries_of_suppliers(t: Tables) -> DataFrame:
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("country_code")
    )


def daily_sales(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    shop = F.when(F.col("o_orderstatus") == "P", "Walmart").otherwise("Amazon")
    return (
        lines.join(parts(t), F.col("l_partkey") == F.col("p_partkey"))
        .join(_countries_of_suppliers(t), "l_suppkey")
        .join(ordering_regions(t), "country_code")
        .select(
            "ordering_region",
            "vendor_id",
            "vendor_name",
            "product_id",
            F.concat_ws(" ", shop, "o_orderpriority").alias("marketplace"),
            F.to_date("o_orderdate").alias("date"),
            cents("l_extendedprice").alias("revenue_total"),
        )
    )


def product_parent_map(t: Tables) -> DataFrame:
    """A parent for the parts above size 20, each in one country."""
    rows = parts(t).where(F.col("p_size") > 20)
    country = F.concat(F.lit("NATION_"), (F.col("p_partkey") % 25).cast("string"))
    parent = F.concat(F.lit("B0"), (F.col("p_partkey") - F.col("p_partkey") % 10).cast("string"))
    return rows.select(
        country.alias("country_code"), parent.alias("parent_id"), "product_id"
    ).distinct()


def forecast_weeks(t: Tables) -> DataFrame:
    shop = (
        F.when(F.col("l_returnflag") == "A", "Amazon")
        .when(F.col("l_returnflag") == "N", "Shop")
        .otherwise("Outlet")
    )
    lines = t.lineitem.join(_countries_of_suppliers(t), "l_suppkey").join(
        ordering_regions(t), "country_code"
    )
    filled = F.col("l_linestatus") == "O"
    return lines.select(
        F.col("l_partkey").alias("master_id"),
        shop.alias("marketplace"),
        F.when(F.col("ordering_region") == "AMERICA", "US").otherwise(F.col("country_code")).alias(
            "country_code"
        ),
        F.to_date("l_shipdate").alias("week_start"),
        F.col("l_quantity").alias("base_rate"),
        F.when(filled, F.col("l_quantity") + 1).alias("base_rate_overwrite"),
        F.round(F.col("l_discount") * 100).alias("promo_increase"),
        F.when(filled, F.lit(0.0)).alias("promo_increase_overwrite"),
        F.round(F.col("l_tax") * 100).alias("seasonal_increase"),
        F.lit(None).cast("double").alias("seasonal_increase_overwrite"),
    )


def ordering_files(t: Tables) -> DataFrame:
    shop = (
        F.when(F.col("p_type") == "MEDIUM", "Walmart")
        .when(F.col("p_type").isin("SMALL", "PROMO", "ECONOMY"), "Shop")
        .otherwise("Outlet")
    )
    size = F.col("p_size").cast("double")
    return t.part.select(
        F.col("p_partkey").alias("master_id"),
        shop.alias("marketplace"),
        F.when(F.col("p_size") <= 40, "US").otherwise("EU").alias("ordering_region_alt"),
        F.when(F.col("p_size") > 10, size).alias("extra_weeks_of_supply_overwrite"),
        (size * 2).alias("safety_stock"),
    )


def inventory_daily(t: Tables) -> DataFrame:
    """A line is what was in stock of its part on its ship date."""
    lines = t.lineitem.join(parts(t), F.col("l_partkey") == F.col("p_partkey")).join(
        _countries_of_suppliers(t), "l_suppkey"
    )
    quantity = F.col("l_quantity").cast("bigint")
    discount, tax = F.round(F.col("l_discount") * 100), F.round(F.col("l_tax") * 100)
    program = (
        F.when(F.col("l_returnflag") == "A", "PanEU store")
        .when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") < 7), "Narf remote")
        .when(F.col("l_returnflag") == "R", "Local")
    )
    return lines.select(
        F.col("product_id").alias("listing_page_id"),
        F.when(F.col("p_type") != "LARGE", F.col("p_partkey")).alias("master_id"),
        "country_code",
        F.to_date("l_shipdate").alias("date"),
        F.when(F.col("l_linenumber") == 1, "Walmart").otherwise("Amazon").alias("marketplace_name"),
        program.alias("fulfillment_program"),
        quantity.alias("warehouse_stow_quantity"),
        F.when(F.col("l_linestatus") == "O", F.col("l_linenumber").cast("bigint") * 2).alias(
            "available_fba_quantity"
        ),
        F.col("l_linenumber").cast("bigint").alias("inbound_fba_quantity"),
        (quantity * 2).alias("warehouse_total_quantity"),
        F.when(F.col("l_discount") > 0, discount.cast("bigint")).alias(
            "reserved_fc_transfer_quantity"
        ),
        (F.col("l_linenumber") % 3).cast("bigint").alias("reserved_fc_processing_quantity"),
        tax.cast("bigint").alias("on_order_quantity"),
        discount.cast("bigint").alias("warehouse_processing_quantity"),
        F.col("p_retailprice").alias("wholesale_price"),
        "vendor_name",
        F.when(F.col("p_type") == "PROMO", F.lit(None).cast("boolean"))
        .otherwise(F.col("p_brand") == "Brand#3")
        .alias("is_discontinued_historic"),
    )


def listings(t: Tables) -> DataFrame:
    """Large parts are listed with both kinds of fulfilment."""
    kinds = (
        F.when(F.col("p_size") > 40, F.array(F.lit("FBM"), F.lit("FBA")))
        .when(F.col("p_size") > 20, F.array(F.lit("FBM")))
        .otherwise(F.array(F.lit("FBA")))
    )
    return (
        parts(t)
        .select(F.col("product_id").alias("listing_page_id"), F.explode(kinds).alias("fulfillment_type"))
        .distinct()
    )


def demand_forecast(t: Tables) -> DataFrame:
    """Ordered quantity per product, region and order date."""
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return (
        lines.join(parts(t), F.col("l_partkey") == F.col("p_partkey"))
        .join(_countries_of_suppliers(t), "l_suppkey")
        .join(ordering_regions(t), "country_code")
        .groupBy("product_id", "ordering_region", F.to_date("o_orderdate").alias("start_forecast_dt"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("ds_forecast"))
    )


# Purchase orders: an order is a purchase, its lines per part and supplier the items.


def purchases(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("purchase_id"),
        F.concat(F.lit("PO-"), F.col("o_orderkey").cast("string")).alias("po_number"),
        F.col("o_orderdate").alias("placed_at"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.date_add(F.to_date("o_orderdate"), 5)).alias(
            "requested_ship_date"
        ),
        F.col("o_orderstatus").alias("state_id"),
    )


def _item_key() -> list[Column]:
    return [
        F.col("l_orderkey").alias("purchase_id"),
        F.col("l_partkey").alias("product_ref"),
        F.col("l_suppkey").alias("warehouse_id"),
    ]


def purchase_items(t: Tables) -> DataFrame:
    """Returned lines came in at four fifths, rounded down."""
    quantity = F.col("l_quantity").cast("bigint")
    received = F.when(F.col("l_returnflag") == "R", F.floor(quantity * 4 / 5)).otherwise(quantity)
    return t.lineitem.groupBy(*_item_key()).agg(
        F.sum(quantity).alias("current_quantity"),
        F.sum(F.when(F.col("l_linestatus") == "F", received)).alias("received_quantity"),
    )


def receipts(t: Tables) -> DataFrame:
    """Finished lines came in up to 59 days after the order; open ones not yet."""
    lines = t.lineitem.where(F.col("l_linestatus") == "F").join(
        t.orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    late = (F.col("l_partkey") % 50 + F.col("l_linenumber")).cast("int")
    return lines.select(
        *_item_key(), F.date_add(F.to_date("o_orderdate"), late).alias("received_at")
    )


def shipments(t: Tables) -> DataFrame:
    lines = t.lineitem.where(F.col("l_returnflag") != "N").join(
        t.orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return lines.select(
        *_item_key(),
        F.date_add(F.to_date("o_orderdate"), F.col("l_linenumber")).alias("ship_date"),
    )


def po_inputs(t: Tables) -> dict[str, DataFrame]:
    """All inputs of the purchase-order plan but the sold products."""
    catalogue = parts(t)
    return {
        "purchases": purchases(t),
        "items": purchase_items(t),
        "receipts": receipts(t),
        "shipments": shipments(t),
        "products": catalogue.select(
            F.col("p_partkey").alias("product_ref"),
            "product_id",
            F.col("p_partkey").alias("master_id"),
            "vendor_id",
        ),
        "vendors": _one_per_id(catalogue),
        "states": t.orders.select(
            F.col("o_orderstatus").alias("state_id"),
            F.concat(F.lit("state "), "o_orderstatus").alias("state"),
        ).distinct(),
        "warehouses": t.supplier.select(
            F.col("s_suppkey").alias("warehouse_id"), F.col("s_nationkey").alias("country_id")
        ),
        "countries": t.nation.select(
            F.col("n_nationkey").alias("country_id"), F.col("n_name").alias("country_code")
        ),
        "regions": ordering_regions(t),
    }


def _one_per_id(catalogue: DataFrame) -> DataFrame:
    return catalogue.groupBy("vendor_id").agg(F.max("vendor_name").alias("vendor_name"))


# Run events: a customer is a flow, its orders the steps, the return flags of an order the
# statements. Datasets are the brands read and the nations written to.


def flow_runs(t: Tables) -> DataFrame:
    """Customers in debt were never started as a flow, so the parents of their orders are unknown."""
    at = F.to_timestamp(F.lit("1995-01-01"))
    return t.customer.where(F.col("c_acctbal") >= 0).select(
        F.concat(F.lit("flow-"), F.col("c_custkey").cast("string")).alias("run_id"),
        F.lit(NAMESPACE).alias("namespace"),
        dotted(F.lit("flow"), F.lower("c_mktsegment")).alias("job"),
        shift(at, hours=(F.col("c_custkey") % 24).cast("int")).alias("started_at"),
        F.to_timestamp(F.lit("2001-12-31")).alias("ended_at"),
    )


def _read_schema(late: Column) -> Column:
    def field(name: str, kind: str) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            F.lit(kind).alias("type"),
            F.lit(None).cast("string").alias("description"),
        )

    two = [field("nation", "STRING"), field("quantity", "BIGINT")]
    return F.when(late, F.array(*two, field("returned", "BOOLEAN"))).otherwise(F.array(*two))


def _datasets_read(t: Tables) -> tuple[DataFrame, DataFrame]:
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    nations = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return brands, nations


def _line_sets(t: Tables, keys: list[str]) -> DataFrame:
    """Brands and nations per key. Both sets have at most 25 members, however many lines a key
    has, and are made distinct before the shuffle."""
    brands, nations = _datasets_read(t)
    return (
        t.lineitem.join(brands, "l_partkey")
        .join(nations, "l_suppkey")
        .groupBy(*keys)
        .agg(
            F.sort_array(F.collect_set("p_brand")).alias("brands"),
            F.sort_array(F.collect_set("s_nationkey")).alias("nations"),
            F.count("*").alias("n_lines"),
        )
    )


def _with_datasets(runs: DataFrame) -> DataFrame:
    late = F.col("o_orderdate") >= F.lit(dt.date(1998, 1, 1)).cast("timestamp_ntz")
    none = F.array().cast("array<string>")
    lines = F.struct(F.col("n_lines").alias("rowCount"))
    return runs.withColumns(
        {
            "inputs": F.transform(
                F.coalesce("brands", none),
                lambda b: input_dataset(
                    F.lit(NAMESPACE), F.concat(F.lit("raw."), F.lower(b)), lines
                ),
            ),
            "outputs": F.transform(
                F.coalesce("nations", F.array().cast("array<int>")),
                lambda n: output_dataset(
                    F.lit(NAMESPACE),
                    F.concat(F.lit("mart.nation_"), n.cast("string")),
                    lines,
                    _read_schema(late),
                ),
            ),
        }
    )


def _order_times() -> dict[str, Column]:
    """Open orders have no end; those marked P have an end only."""
    start = F.col("o_orderdate").cast("timestamp")
    hours = (F.col("o_custkey") % 72 + 1).cast("int")
    status = F.col("o_orderstatus")
    return {
        "started_at": F.when(status != "P", start),
        "ended_at": F.when(status != "O", shift(start, hours=hours)),
    }


def step_runs(t: Tables) -> DataFrame:
    runs = t.orders.join(
        _line_sets(t, ["l_orderkey"]), F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    return _with_datasets(runs).select(
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.lit(NAMESPACE).alias("namespace"),
        F.lit("orders").alias("flow"),
        F.concat(F.lit("flow-"), F.col("o_custkey").cast("string")).alias("flow_run_id"),
        F.lower("o_orderpriority").alias("step"),
        *[c.alias(name) for name, c in _order_times().items()],
        "inputs",
        "outputs",
    )


def statement_runs(t: Tables) -> DataFrame:
    """The statements of each order, one per return flag, run at the time of the order."""
    start = F.col("o_orderdate").cast("timestamp")
    runs = _line_sets(t, ["l_orderkey", "l_returnflag"]).join(
        t.orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    table = dotted(F.lit("mart"), F.lower("l_returnflag"))
    return _with_datasets(runs).select(
        F.concat_ws("-", F.lit("sql"), "l_orderkey", "l_returnflag").alias("run_id"),
        F.lit(NAMESPACE).alias("namespace"),
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("step_run_id"),
        dotted(F.lit("orders"), F.lower("o_orderpriority")).alias("step_job"),
        table.alias("table"),
        F.concat(F.lit("INSERT INTO "), table, F.lit(" SELECT * FROM raw.lines")).alias("sql"),
        F.lit(None).cast("timestamp").alias("started_at"),
        shift(start, seconds=2).alias("ended_at"),
        "inputs",
        "outputs",
    )


def run_events(t: Tables) -> DataFrame:
    """Flow and step events; those of urgent orders were sent twice."""
    steps = step_events(step_runs(t))
    copies = F.when(F.col("job.name").endswith("1-urgent"), 2).otherwise(1)
    sent = steps.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")
    return to_events(flow_runs(t)).union(sent)


# Statements and column lineage: part n is made from part n / 2 and its brand.


def part_node(key: Column, prefix: str = "mart.part_") -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def part_tree(t: Tables) -> DataFrame:
    """src -> dst: the part a part is made from."""
    key = F.col("p_partkey")
    return t.part.where(key > 0).select(F.floor(key / 2).alias("src"), key.alias("dst"))


def scripts(t: Tables) -> DataFrame:
    key, brand = F.col("p_partkey"), F.lower(F.regexp_replace("p_brand", "#", "_"))
    name, base = part_node(key), part_node(F.floor(key / 2))
    text = F.concat(
        F.lit("-- part "), key.cast("string"),
        F.lit("; made from its half\nCREATE OR REPLACE TABLE "), name,
        F.lit(" AS WITH recent AS (\n  SELECT * FROM "), base,
        F.lit("\n) SELECT r.* FROM recent r JOIN raw."), brand,
        F.lit(" b ON r.id = b.id;\n;\ninsert into audit."), F.lower("p_type"),
        F.lit(" SELECT count(*) FROM "), name, F.lit(";\n"),
    )
    return t.part.select(key.alias("script_id"), text.alias("text"))


def column_records(t: Tables) -> DataFrame:
    """Each part has a rate, made from the rates of its half and of its brand."""
    key = F.col("p_partkey")

    def origin(table: Column) -> Column:
        return F.struct(table.alias("table"), F.lit("rate").alias("column"))

    brand = F.concat(F.lit("raw."), F.lower(F.regexp_replace("p_brand", "#", "_")))
    return t.part.select(
        part_node(key).alias("out_table"),
        F.lit("rate").alias("out_column"),
        F.array(origin(part_node(F.floor(key / 2))), origin(brand)).alias("lineage"),
    )


def lineage_runs(t: Tables) -> DataFrame:
    """A run per part that writes its table and tells where its columns are from; the part's size
    is a facet of the run that no schema knows."""
    records = column_records(t)
    of = F.transform(
        "lineage",
        lambda o: F.struct(
            F.lit(NAMESPACE).alias("namespace"), o["table"].alias("name"), o["column"].alias("field")
        ),
    )
    output = dataset(F.lit(NAMESPACE), "out_table", made_of=F.create_map("out_column", of))
    size = F.to_json(F.struct(F.array(F.struct(F.col("p_size").alias("size"))).alias("sizes")))
    return (
        records.join(t.part, part_node(F.col("p_partkey")) == F.col("out_table"))
        .select(
            F.concat(F.lit("made-"), F.col("p_partkey").cast("string")).alias("run_id"),
            F.lit(NAMESPACE).alias("namespace"),
            F.lit("make_part").alias("job"),
            F.to_timestamp(F.lit("1995-01-01")).alias("started_at"),
            F.array(output).alias("outputs"),
            F.create_map(F.lit("partSize"), size).alias("run_facets"),
        )
    )
