"""The retail tables (orders in several versions, products, customers) over the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockpond.operators.clean import clean_orders, keep_latest
from stockpond.operators.marts import enrich_orders
from stockpond.sources.tables import read_table

# Order statuses as the shop types them; cleaning trims and upper-cases.
RAW_STATUS = {"F": " completed ", "O": "Pending", "P": "CANCELLED "}

VERSION_ORDER = ["order_ts", "line_no", "product_id", "supplier_id", "line_price", "quantity"]


def raw_status(code: Column) -> Column:
    value = F.lit(None).cast("string")
    for short, text in RAW_STATUS.items():
        value = F.when(code == short, text).otherwise(value)
    return value


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per recorded version of an order, without the header columns."""
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_shipdate").alias("order_ts"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_extendedprice").alias("line_price"),
    )


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        raw_status(F.col("o_orderstatus")).alias("order_status"),
    )


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions with their header: the untouched landing table."""
    return order_versions(spark, sf_dir).join(order_headers(spark, sf_dir), "order_id")


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest version per order, cleaned.

    Versions are reduced before the header join: the header does not take part in the
    choice, so the join moves one row per order instead of all versions.
    """
    latest = keep_latest(order_versions(spark, sf_dir), ["order_id"], VERSION_ORDER)
    return clean_orders(latest.join(order_headers(spark, sf_dir), "order_id"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_orders(silver_orders(spark, sf_dir), products(spark, sf_dir))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the region of their nation."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    # 25 nations and 5 regions at any scale, hence safe to broadcast.
    regions = F.broadcast(nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey))
    customer = read_table(spark, sf_dir, "customer")
    return customer.join(regions, customer.c_nationkey == regions.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_mktsegment"), F.lit("."), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.col("r_name").alias("region"),
    )


def customer_order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table features are computed from."""
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("order_priority"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("order_value"),
        F.lit(0).alias("ship_priority"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_fulfilled"),
    )


def metering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits used per interval: the event type plays the warehouse."""
    return read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("warehouse_name"),
        F.col("ts").alias("start_time"),
        F.timestamp_add("HOUR", F.lit(1), F.col("ts")).cast("timestamp_ntz").alias("end_time"),
        F.col("value").cast("decimal(18,2)").alias("credits_used"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query history: one row per run; a failed run has no elapsed time."""
    e = read_table(spark, sf_dir, "events")
    elapsed = F.col("value").cast("decimal(18,2)")
    return e.select(
        F.col("event_id").alias("query_id"),
        F.concat(F.lit("CALL "), F.upper("event_type"), F.lit(" WITH "), F.col("props")).alias("query_text"),
        F.upper("event_type").alias("query_type"),
        F.concat(F.lit("day0"), (F.col("user_id") % 10).cast("string")).alias("query_tag"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_name"),
        F.concat(F.lit("WH_"), (F.col("user_id") % 3).cast("string")).alias("warehouse_name"),
        F.when(F.col("event_type") != "error", elapsed).alias("total_elapsed_time"),
        (elapsed * 1000).cast("bigint").alias("bytes_scanned"),
        F.col("ts").alias("start_time"),
    )
