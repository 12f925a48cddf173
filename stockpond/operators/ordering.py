"""Global order: row numbers, running sums, top-k, samples and splits without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockpond.session import materialize

# monotonically_increasing_id() = partition number * 2^33 + position in the partition.
POSITION_BITS = 33


def range_sorted(df: DataFrame, order_by: list[str | Column], name: str) -> DataFrame:
    """Range-sorted rows with their range (``_part``) and ``_position`` in it, written so that both stay fixed."""
    placed = df.sort(*order_by).withColumn("_at", F.monotonically_increasing_id())
    return materialize(
        placed.select(
            *df.columns,
            F.shiftright("_at", POSITION_BITS).alias("_part"),
            F.col("_at").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).alias("_position"),
        ),
        name,
    )


def global_row_number(df: DataFrame, order_by: list[str | Column], alias: str = "row_number") -> DataFrame:
    """Number all rows along a total order.

    The rows are sorted by range, so each task knows the position in its own range; adding
    the size of the ranges before it, one small row per range, gives the global number.
    """
    placed = range_sorted(df, order_by, "row-number")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per range of the sort: bounded by the number of shuffle partitions.
    offsets = F.broadcast(
        sizes.select(
            "_part",
            F.coalesce(
                F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_offset"),
        )
    )
    return placed.join(offsets, "_part").select(
        *df.columns, (F.col("_offset") + F.col("_position") + 1).alias(alias)
    )


def global_running_sums(df: DataFrame, order_by: list[str | Column], sums: dict[str, str]) -> DataFrame:
    """Running sums ``alias -> column`` over all rows along a total order."""
    placed = range_sorted(df, order_by, "running-sum")
    totals = placed.groupBy("_part").agg(*[F.sum(c).alias(f"_t_{a}") for a, c in sums.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(
        totals.select("_part", *[F.coalesce(F.sum(f"_t_{a}").over(before), F.lit(0)).alias(f"_o_{a}") for a in sums])
    )
    inside = Window.partitionBy("_part").orderBy("_position").rowsBetween(Window.unboundedPreceding, 0)
    running = placed.withColumns({f"_r_{a}": F.sum(c).over(inside) for a, c in sums.items()})
    return running.join(offsets, "_part").select(
        *df.columns, *[(F.col(f"_r_{a}") + F.col(f"_o_{a}")).alias(a) for a in sums]
    )


def top_k(df: DataFrame, order_by: list[str | Column], k: int) -> DataFrame:
    return df.orderBy(*order_by).limit(k)


def write_sorted(df: DataFrame, order_by: list[str | Column], path: str) -> DataFrame:
    """Write all rows in global order, file by file, and read them back."""
    df.sort(*order_by).write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_rank(*keys: str) -> Column:
    """A repeatable pseudo-random text per key, independent of partitioning."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def fixed_sample(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """``n`` rows, the same ones on every run."""
    return df.orderBy(hash_rank(*keys), *keys).limit(n)


def hash_bucket(*keys: str, buckets: int = 100) -> Column:
    return F.conv(F.substring(hash_rank(*keys), 1, 8), 16, 10).cast("bigint") % buckets


def hash_split(df: DataFrame, keys: list[str], train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; a key always falls on the same side."""
    train = hash_bucket(*keys) < train_percent
    return df.where(train), df.where(~train)
