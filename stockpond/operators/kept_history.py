"""A change log with a snapshot every few commits, so that a past state reads one snapshot and a short tail."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockpond.operators.changes import ACTION, IS_UPDATE, apply_changes
from stockpond.operators.clean import keep_latest
from stockpond.operators.history import COMMITTED, VERSION, log_entry
from stockpond.session import materialize

# Written last, so a commit that died half way is not there; one row for each commit.
COMMITS = f"{VERSION} bigint, {COMMITTED} timestamp_ntz, schema string, has_snapshot boolean"


def _commits(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(COMMITS).parquet(f"{root}/commits")
    except AnalysisException:
        return spark.createDataFrame([], COMMITS)


def commit(feed: DataFrame, root: str, key: list[str], committed_at: Column, every: int = 10) -> int:
    """Append a feed as the next version; returns its number.

    The first feed holds the whole table as inserts. Every ``every``-th version is also stored as a whole. A
    feed is written once, into the folder of its version, which a repeated run overwrites.
    """
    spark = feed.sparkSession
    last = _commits(spark, root).agg(F.max(VERSION)).first()[0]
    version = 0 if last is None else last + 1
    entry = log_entry(feed, version, committed_at)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in entry.drop(VERSION).schema)
    folder = f"{root}/log/{VERSION}={version}"
    entry.drop(VERSION).write.mode("overwrite").parquet(folder)
    due = (version + 1) % every == 0
    if due:
        _state(spark, root, key, schema, version).write.mode("overwrite").parquet(f"{root}/snapshots/{VERSION}={version}")
    done = spark.range(0, 1, 1, 1).select(
        F.lit(version).cast("bigint").alias(VERSION),
        committed_at.cast("timestamp_ntz").alias(COMMITTED),
        F.lit(schema).alias("schema"),
        F.lit(due).alias("has_snapshot"),
    )
    done.write.mode("overwrite").parquet(f"{root}/commits/commit={version}")
    return version


def _state(spark: SparkSession, root: str, key: list[str], schema: str, version: int) -> DataFrame:
    """The newest snapshot up to ``version`` with the last change of each key after it."""
    snapshots = _commits(spark, root).where((F.col(VERSION) <= version) & F.col("has_snapshot"))
    base = snapshots.agg(F.max(VERSION)).first()[0]
    # Exactly the folders of the tail; what lies before the snapshot is not even listed.
    tail = [f"{root}/log/{VERSION}={v}" for v in range(0 if base is None else base + 1, version + 1)]
    log = spark.read.schema(f"{schema}, {VERSION} bigint").option("basePath", f"{root}/log").parquet(*tail) if tail else None
    if base is None:
        return keep_latest(log, key, [VERSION]).where(F.col(ACTION) != "DELETE").drop(ACTION, IS_UPDATE, COMMITTED, VERSION)
    rows = spark.createDataFrame([], schema).drop(ACTION, IS_UPDATE, COMMITTED)
    whole = spark.read.schema(rows.schema).parquet(f"{root}/snapshots/{VERSION}={base}")
    if log is None:
        return whole
    return apply_changes(whole, materialize(keep_latest(log, key, [VERSION]), "log-tail"), key)


def state_of(spark: SparkSession, root: str, key: list[str], version: int) -> DataFrame:
    """The table after commit ``version``."""
    entry = _commits(spark, root).where(F.col(VERSION) == version).first()
    if entry is None:
        raise ValueError(f"no commit {version}")
    return _state(spark, root, key, entry.schema, version)


def state_at(spark: SparkSession, root: str, key: list[str], at: Column) -> DataFrame:
    """The table as it was at a point in time; refused before the first commit."""
    known = _commits(spark, root).where(F.col(COMMITTED) <= at.cast("timestamp_ntz"))
    version = known.agg(F.max(VERSION)).first()[0]
    if version is None:
        raise ValueError("no commit that early")
    return state_of(spark, root, key, version)
