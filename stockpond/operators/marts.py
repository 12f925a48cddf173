"""Enrichment joins and Gold aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stockpond.functions.scalars import approx_distinct

CANCELLED = "CANCELLED"


def enrich_orders(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order facts: one row per order whose product is known.

    No hint on the product side: Spark broadcasts it while its size is under the threshold
    and otherwise merges on ``product_id``, splitting hot products at run time.
    """
    joined = orders.join(products, "product_id", "inner")
    return joined.select(
        "order_id",
        "customer_id",
        "product_id",
        "product_name",
        "category",
        "quantity",
        "price",
        (F.col("quantity") * F.col("price")).alias("order_value"),
        "order_status",
        "order_ts",
    )


def not_cancelled() -> Column:
    return F.col("order_status") != CANCELLED


def category_summary(facts: DataFrame, exact: bool = False) -> DataFrame:
    """Revenue, order count and distinct customers per category, cancelled orders excluded.

    The distinct customers are approximate, as in the Gold table, unless ``exact`` is asked.
    """
    sold = facts.where(not_cancelled())
    if exact:
        return by_customer(sold).groupBy("category").agg(
            F.sum("total_revenue").alias("total_revenue"),
            F.sum("order_count").alias("order_count"),
            F.count("customer_id").alias("unique_customers"),
        )
    return sold.groupBy("category").agg(
        F.sum("order_value").alias("total_revenue"),
        F.count("*").alias("order_count"),
        approx_distinct("customer_id").alias("unique_customers"),
    )


def by_customer(sold: DataFrame) -> DataFrame:
    """One row per category and customer: counting these rows counts customers exactly."""
    return sold.groupBy("category", "customer_id").agg(
        F.sum("order_value").alias("total_revenue"), F.count("*").alias("order_count")
    )


def orders_over_time(facts: DataFrame) -> DataFrame:
    """All orders per day; revenue without the cancelled ones."""
    return facts.groupBy(F.to_date("order_ts").alias("order_date")).agg(
        F.count("*").alias("order_count"),
        F.sum(F.when(not_cancelled(), F.col("order_value")).otherwise(0)).alias("total_revenue"),
    )


def product_summary(products: DataFrame) -> DataFrame:
    """Row count and total price per category."""
    return products.groupBy("category").agg(
        F.count("*").alias("product_count"), F.sum("price").alias("total_value")
    )


def revenue_by_product(facts: DataFrame) -> DataFrame:
    return (
        facts.where(not_cancelled())
        .groupBy("product_name")
        .agg(F.sum("order_value").alias("order_value"))
        .orderBy(F.desc("order_value"), "product_name")
    )


def average_order_value(facts: DataFrame) -> DataFrame:
    return (
        facts.where(not_cancelled())
        .groupBy("category")
        .agg((F.sum("order_value") / F.count("order_value")).alias("avg_order_value"))
    )


def category_lookup(keys: DataFrame, summary: DataFrame) -> DataFrame:
    """Revenue for each asked category, compared without case; NULL when there is none."""
    totals = summary.groupBy(F.upper("category").alias("_key")).agg(F.sum("total_revenue").alias("total_revenue"))
    return (
        keys.join(totals, F.upper(keys.category) == totals._key, "left")
        .select(keys.category, "total_revenue")
    )


def category_explorer(facts: DataFrame, category: str | None = None) -> DataFrame:
    """Orders (all), revenue and customers (not cancelled), optionally of one category."""
    chosen = facts if category is None else facts.where(F.col("category") == category)
    return chosen.agg(
        F.count("*").alias("orders"),
        F.coalesce(F.sum(F.when(not_cancelled(), F.col("order_value"))), F.lit(0)).alias("revenue"),
        F.count_distinct(F.when(not_cancelled(), F.col("customer_id"))).alias("customers"),
    )


def category_kpis(facts: DataFrame) -> DataFrame:
    """Category with the most customers, and the day with the highest revenue."""
    top_category = category_summary(facts, exact=True).agg(
        F.max_by("category", F.struct("unique_customers", "category")).alias("top_category"),
        F.max("unique_customers").alias("top_category_customers"),
    )
    best_day = orders_over_time(facts).agg(
        F.max_by("order_date", F.struct("total_revenue", "order_date")).alias("best_day"),
        F.max("total_revenue").alias("best_day_revenue"),
    )
    return top_category.select("*", *[best_day.select(c).scalar().alias(c) for c in best_day.columns])


SKETCH_LOG_SIZE = 14
# Three standard errors of a sketch with 2^14 registers, which also covers a union of sketches.
SKETCH_ERROR = 0.025


def customer_sketches(facts: DataFrame) -> DataFrame:
    """Who bought, per category and month, as sketches that can be united over any grouping; cancelled orders don't count."""
    month = F.trunc(F.to_date("order_ts"), "MONTH").alias("order_month")
    return facts.where(not_cancelled()).groupBy("category", month).agg(F.hll_sketch_agg("customer_id", SKETCH_LOG_SIZE).alias("customers"))


def extend_sketches(stored: DataFrame, arrived: DataFrame) -> DataFrame:
    """Stored sketches with those of arrived orders. Orders can be added twice without harm, but none can be taken out."""
    both = stored.unionByName(customer_sketches(arrived))
    return both.groupBy("category", "order_month").agg(F.hll_union_agg("customers").alias("customers"))
