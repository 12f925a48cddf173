"""Past states of a table from its append-only change log, restore and independent clones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stockpond.operators.changes import ACTION, IS_UPDATE, effective_changes
from stockpond.operators.clean import keep_latest
from stockpond.operators.ordering import global_running_sums

VERSION = "_version"
COMMITTED = "_committed_at"


def snapshot_as_changes(df: DataFrame) -> DataFrame:
    """A first version as inserts."""
    return df.withColumns({ACTION: F.lit("INSERT"), IS_UPDATE: F.lit(False)})


def log_entry(feed: DataFrame, version: int, committed_at: Column) -> DataFrame:
    """The rows one commit appends to the log: one per changed key."""
    return effective_changes(feed).withColumns(
        {VERSION: F.lit(version).cast("bigint"), COMMITTED: committed_at.cast("timestamp_ntz")}
    )


def _state(log: DataFrame, key: list[str]) -> DataFrame:
    last = keep_latest(log, key, [VERSION])
    return last.where(F.col(ACTION) != "DELETE").drop(ACTION, IS_UPDATE, VERSION, COMMITTED)


def state_as_of(log: DataFrame, key: list[str], at: Column) -> DataFrame:
    """The table as it was at a point in time."""
    return _state(log.where(F.col(COMMITTED) <= at), key)


def state_before(log: DataFrame, key: list[str], version: int) -> DataFrame:
    """The table just before a commit."""
    return _state(log.where(F.col(VERSION) < version), key)


def drop_entry(log: DataFrame, key: list[str], version: int, committed_at: Column) -> DataFrame:
    """Log rows for a dropped table: every live row is deleted."""
    live = state_before(log, key, version)
    deletes = live.withColumns({ACTION: F.lit("DELETE"), IS_UPDATE: F.lit(False)})
    return log_entry(deletes, version, committed_at)


def restore_entry(log: DataFrame, key: list[str], dropped: int, version: int, committed_at: Column) -> DataFrame:
    """Log rows that bring back the state before commit ``dropped``."""
    return log_entry(snapshot_as_changes(state_before(log, key, dropped)), version, committed_at)


def overlay(base: DataFrame, own_changes: DataFrame, key: list[str]) -> DataFrame:
    """A clone: the base version with the clone's own later changes on top.

    ``own_changes`` has at most one row per key; a DELETE hides the base row.
    """
    untouched = base.join(own_changes.select(*key), key, "left_anti").select(*base.columns)
    written = own_changes.where(F.col(ACTION) != "DELETE").select(*base.columns)
    return untouched.unionByName(written)


def file_ranges(df: DataFrame, key: str) -> DataFrame:
    """Smallest and greatest key of every file behind a file-based DataFrame."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.min(key).alias("low"), F.max(key).alias("high")
    )


def layout_report(ranges: DataFrame) -> DataFrame:
    """File count, average overlaps and average depth of key ranges.

    Overlaps of a file are the other files whose range meets its own; the depth is the
    number of files covering its low end. Both follow from counting, along the sorted
    range ends, how many ranges have started and ended, so no pair of files is formed.
    """
    known = ranges.where(F.col("low").isNotNull())
    ends = known.select(F.col("low").alias("point"), F.lit(1).alias("starts"), F.lit(0).alias("stops")).unionByName(
        known.select(F.col("high").alias("point"), F.lit(0).alias("starts"), F.lit(1).alias("stops"))
    )
    points = ends.groupBy("point").agg(F.sum("starts").alias("starts"), F.sum("stops").alias("stops"))
    counted = global_running_sums(points, ["point"], {"started": "starts", "stopped": "stops"}).select(
        "point", "starts", "stops", "started", (F.col("stopped") - F.col("stops")).alias("stopped_before")
    )
    # Sum over files of (ranges started by `high`) - (ranges stopped before `low`) - itself.
    per_point = counted.agg(
        F.sum("starts").alias("files"),
        F.sum(F.col("stops") * F.col("started")).alias("met"),
        F.sum(F.col("starts") * F.col("stopped_before")).alias("missed"),
        F.sum(F.col("starts") * (F.col("started") - F.col("stopped_before"))).alias("covering"),
    )
    files = F.col("files")
    return per_point.select(
        F.coalesce(files, F.lit(0)).alias("file_count"),
        ((F.col("met") - F.col("missed") - files) / files).alias("average_overlaps"),
        (F.col("covering") / files).alias("average_depth"),
    )
