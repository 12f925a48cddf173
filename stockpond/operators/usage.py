"""Usage, budget and run reports."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockpond.functions.scalars import preview
from stockpond.session import materialize


def usage_rollup(metering: DataFrame, keys: list[str | Column], since: Column | None = None) -> DataFrame:
    """Credits per key with the first and last interval."""
    recent = metering if since is None else metering.where(F.col("start_time") >= since)
    return recent.groupBy(*keys).agg(
        F.sum("credits_used").alias("credits_used"),
        F.min("start_time").alias("first_interval"),
        F.max("end_time").alias("last_interval"),
    )


def usage_by_day(metering: DataFrame, since: Column | None = None) -> DataFrame:
    day = F.to_date("start_time").alias("usage_day")
    return usage_rollup(metering, [day, "warehouse_name"], since).select("usage_day", "warehouse_name", "credits_used")


def usage_share(metering: DataFrame) -> DataFrame:
    """Credits per warehouse with their share of the total."""
    per_warehouse = usage_rollup(metering, ["warehouse_name"]).select("warehouse_name", "credits_used")
    total = metering.agg(F.sum("credits_used").alias("total")).scalar()
    return per_warehouse.withColumn("share", F.col("credits_used").cast("double") / total.cast("double"))


def budget_crossings(metering: DataFrame, quota: float, thresholds: dict[str, float]) -> DataFrame:
    """First time in each month at which the running credits reach a share of the quota.

    A credit below zero fails the query: the search relies on running sums that never fall. One scan sums the
    credits by minute, into a table whose size the calendar bounds. Running sums over its days, and over the minutes of
    one day, find the minute a threshold is crossed in; only the rows of these minutes are read again, by time ranges
    that reach the scan.
    """
    month = F.trunc(F.to_date("start_time"), "MONTH")
    rows = metering.select(
        month.alias("month"),
        F.to_date("start_time").alias("day"),
        F.date_trunc("MINUTE", F.col("start_time")).cast("timestamp_ntz").alias("minute"),
        F.col("start_time").alias("at"),
        "credits_used",
    )
    limits = F.explode(
        F.array(*[F.struct(F.lit(a).alias("action"), F.lit(quota * t).cast("decimal(18,2)").alias("needed")) for a, t in thresholds.items()])
    )

    def crossing(df: DataFrame, keys: list[str], step: str) -> DataFrame:
        """Per key the first step whose running credits reach what is still needed."""
        sums = df.groupBy(*keys, "needed", step).agg(F.sum("credits_used").alias("_credits"))
        upto = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
        running = sums.withColumn("_running", F.sum("_credits").over(upto))
        return (
            running.where(F.col("_running") >= F.col("needed"))
            .groupBy(*keys)
            .agg(
                F.min(step).alias(step),
                F.min_by(F.col("needed") - F.col("_running") + F.col("_credits"), step).alias("needed"),
                F.min_by("_running", step).alias("_running"),
            )
        )

    keys = ["month", "action"]
    sums = [F.sum("credits_used").alias("credits_used"), F.min("credits_used").alias("_least")]
    minutes = materialize(rows.groupBy("month", "day", "minute").agg(*sums), "credits-by-minute")
    # Thresholds times days: a handful of rows per month, exploded after the daily sums.
    daily = minutes.groupBy("month", "day").agg(sums[0], F.min("_least").alias("_least"))
    kind = daily.schema["credits_used"].dataType
    refused = F.raise_error(F.lit("a credit is below zero")).cast(kind)
    daily = daily.select("month", "day", F.when(F.col("_least") < 0, refused).otherwise(F.col("credits_used")).alias("credits_used"))
    by_day = crossing(daily.select("*", limits.alias("l")).select("month", "day", "credits_used", "l.*"), keys, "day")
    # One row per month and threshold, bounded by the calendar, so both joins may broadcast.
    in_day = minutes.join(F.broadcast(by_day.select(*keys, "day", "needed")), ["month", "day"])
    by_minute = materialize(crossing(in_day, keys, "minute"), "crossed-minutes")
    span = F.lit(False)
    for (minute,) in by_minute.select("minute").distinct().collect():
        span = span | ((F.col("at") >= F.lit(minute)) & (F.col("at") < F.lit(minute + timedelta(minutes=1))))
    in_minute = rows.where(span).join(F.broadcast(by_minute.select(*keys, "minute", "needed")), ["month", "minute"])
    exact = crossing(in_minute, keys, "at")
    return exact.select("month", "action", F.col("at").alias("crossed_at"))


def slow_runs(runs: DataFrame, patterns: list[str], tag_pattern: str, excluded_types: list[str], k: int = 20) -> DataFrame:
    """The slowest runs whose text or tag matches, unknown durations last."""
    wanted = F.col("query_tag").ilike(tag_pattern)
    for p in patterns:
        wanted = wanted | F.col("query_text").ilike(p)
    return (
        runs.where(~F.col("query_type").isin(excluded_types) & wanted)
        .orderBy(F.desc_nulls_last("total_elapsed_time"), "query_id")
        .limit(k)
        .select(
            "query_id",
            preview(F.col("query_text")).alias("query_text_preview"),
            "user_name",
            "warehouse_name",
            "total_elapsed_time",
            "bytes_scanned",
            "start_time",
        )
    )


def compare_tags(runs: DataFrame, tags: list[str], by: str = "query_type") -> DataFrame:
    """Runs and average duration of tagged runs, one column pair per tag."""
    return (
        runs.where(F.col("query_tag").isin(tags))
        .groupBy(by)
        .pivot("query_tag", tags)
        .agg(F.count("query_id").alias("runs"), F.sum("total_elapsed_time").alias("elapsed"))
    )


def run_history(log: DataFrame, names: list[str], since: Column | None = None, k: int | None = None) -> DataFrame:
    """Runs of the named jobs, newest first."""
    chosen = log.where(F.col("name").isin(names))
    if since is not None:
        chosen = chosen.where(F.col("scheduled_at") >= since)
    newest = chosen.orderBy(F.desc_nulls_last("scheduled_at"), F.desc("run_id"))
    return newest if k is None else newest.limit(k)


def load_history(ledger: DataFrame, table: str, since: Column) -> DataFrame:
    """Loads of one table since a time, newest first."""
    return ledger.where((F.col("table_name") == table) & (F.col("loaded_at") >= since)).orderBy(
        F.desc("loaded_at"), "file_path"
    )


def freshness(refreshes: DataFrame, now: Column, target_seconds: int, k: int = 10) -> DataFrame:
    """Lag of each refresh behind ``now`` and whether it keeps the target, newest first."""
    lag = F.timestamp_diff("SECOND", F.col("data_at"), now)
    return (
        refreshes.withColumn("lag_seconds", lag)
        .withColumn("within_target", F.col("lag_seconds") <= target_seconds)
        .orderBy(F.desc("refreshed_at"), "name")
        .limit(k)
    )
