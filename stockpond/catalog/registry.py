"""Named queries over the driver tables, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, the last step before results are compared."""
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else f.name for f in df.schema.fields]
    )


# Shared parts of the SQL side: the same tables as in stockpond.sources.retail.
BRONZE_SQL = """
bronze AS (
  SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CASE o_orderstatus WHEN 'F' THEN ' completed ' WHEN 'O' THEN 'Pending' WHEN 'P' THEN 'CANCELLED ' END AS order_status,
         l_shipdate AS order_ts, l_linenumber AS line_no, l_suppkey AS supplier_id, l_extendedprice AS line_price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

LATEST_SQL = (
    "ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY order_ts DESC NULLS LAST, line_no DESC, "
    "product_id DESC, supplier_id DESC, line_price DESC, quantity DESC)"
)

SILVER_SQL = f"""{BRONZE_SQL},
silver AS (
  SELECT order_id, customer_id, product_id, COALESCE(quantity, 0) AS quantity,
         UPPER(TRIM(order_status)) AS order_status, order_ts
  FROM bronze QUALIFY {LATEST_SQL} = 1)"""

PRODUCTS_SQL = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price
  FROM part)"""

FACTS_SQL = f"""{SILVER_SQL},{PRODUCTS_SQL},
facts AS (
  SELECT order_id, customer_id, product_id, product_name, category, quantity, price,
         CAST(quantity * price AS DECIMAL(21,2)) AS order_value, order_status, order_ts
  FROM silver JOIN products USING (product_id))"""

SUMMARY_SQL = f"""{FACTS_SQL},
summary AS (
  SELECT category, SUM(order_value) AS total_revenue, COUNT(*) AS order_count,
         COUNT(DISTINCT customer_id) AS unique_customers
  FROM facts WHERE order_status <> 'CANCELLED' GROUP BY category)"""
