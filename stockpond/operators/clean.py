"""Silver cleaning and keep-latest deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def keep_latest(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The row with the greatest ``order_by`` per key, NULLs counting as oldest.

    Give a total order, otherwise ties are settled arbitrarily. Spark limits each key to
    one row per task before the shuffle, so a key with very many versions stays harmless.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order_by])
    return (
        df.withColumn("_version_rank", F.row_number().over(newest_first))
        .where("_version_rank = 1")
        .drop("_version_rank")
    )


def clean_orders(orders: DataFrame) -> DataFrame:
    """Missing quantities become 0, statuses are trimmed and upper-cased, types are fixed."""
    return orders.select(
        "order_id",
        "customer_id",
        "product_id",
        F.coalesce(F.col("quantity"), F.lit(0)).cast("int").alias("quantity"),
        F.upper(F.trim("order_status")).alias("order_status"),
        F.col("order_ts").cast("timestamp_ntz").alias("order_ts"),
    )


def build_silver_orders(bronze: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """Bronze order versions to one clean row per order."""
    return clean_orders(keep_latest(bronze, ["order_id"], ["order_ts", *(tie_break or [])]))
