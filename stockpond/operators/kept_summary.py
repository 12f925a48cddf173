"""A stored summary in hash buckets of its groups.

A refresh adds what changed to the buckets it touches; a bucket with too many additions is written anew, and no other.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from stockpond.operators.changes import settle, summarize, summary_deltas
from stockpond.session import delete_folder

BUCKET = "_bucket"
# One row for each refresh: how far it got in the change log, and the runs that make up each bucket.
POINTER = "seq bigint, upto bigint, schema string, group array<string>, measure string, buckets int, runs array<struct<bucket:int,parts:array<string>>>"


def _bucketed(df: DataFrame, group: list[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*group), F.lit(buckets)).cast("int"))


def _last_pointer(spark: SparkSession, root: str) -> tuple[Row, dict[int, list[str]]]:
    last = spark.read.schema(POINTER).parquet(f"{root}/pointer").orderBy(F.desc("seq")).limit(1).first()
    return last, {r.bucket: r.parts for r in last.runs}


def _point(spark: SparkSession, root: str, pointer: dict, runs: dict[int, list[str]]) -> None:
    pointer = pointer | {"runs": [{"bucket": b, "parts": r} for b, r in sorted(runs.items())]}
    row = spark.range(0, 1, 1, 1).select(F.from_json(F.lit(json.dumps(pointer)), POINTER).alias("p")).select("p.*")
    row.write.mode("errorifexists").parquet(f"{root}/pointer/commit={pointer['seq']}")


def _write_buckets(rows: DataFrame, folder: str) -> set[int]:
    """One file for each bucket; which buckets there are is known from the file names."""
    rows.write.mode("errorifexists").partitionBy(BUCKET).parquet(folder)
    try:
        files = rows.sparkSession.read.parquet(folder).inputFiles()
    except AnalysisException:  # nothing written, so no schema to read
        return set()
    return {int(n) for f in files for n in re.findall(rf"/{BUCKET}=(\d+)/", f)}


def _read_buckets(spark: SparkSession, root: str, schema: str, runs: dict[int, list[str]]) -> DataFrame:
    """The rows of all runs of some buckets, not added up."""
    if not runs:
        return spark.createDataFrame([], f"{schema}, {BUCKET} int")
    paths = [f"{root}/rows/run={run}/{BUCKET}={bucket}" for bucket, parts in sorted(runs.items()) for run in parts]
    stored = spark.read.schema(f"{schema}, run string, {BUCKET} int").option("basePath", f"{root}/rows")
    return stored.parquet(*paths).drop("run")


def create(df: DataFrame, root: str, group: list[str], measure: str, upto: int, buckets: int = 64) -> None:
    """Store the summary of ``df``, which is the table at version ``upto`` of its change log.

    ``buckets`` stays as it is; a good number makes a bucket one file of ordinary size.
    """
    spark = df.sparkSession
    summary = summarize(df, group, measure)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in summary.schema)
    run = f"r-{uuid.uuid4().hex}"
    written = _write_buckets(_bucketed(summary, group, buckets).repartition(BUCKET), f"{root}/rows/run={run}")
    _point(
        spark,
        root,
        {
            "seq": 0,
            "upto": upto,
            "schema": schema,
            "group": group,
            "measure": measure,
            "buckets": buckets,
        },
        {b: [run] for b in written},
    )


def read(spark: SparkSession, root: str) -> DataFrame:
    """The summary as the last finished refresh left it."""
    last, runs = _last_pointer(spark, root)
    rows = _read_buckets(spark, root, last.schema, runs).drop(BUCKET)
    return settle(rows, last.group, dict(rows.dtypes))


def refresh(log: DataFrame, root: str, version: str, upto: int, additions: int = 8) -> int:
    """Take the log up to version ``upto`` into the summary; returns the number of touched buckets.

    Versions that were taken before don't count again, so a refresh may be repeated. What the feed adds to
    each group is written by bucket; only buckets with more than ``additions`` such parts are read, added up and
    written next to the old files. The cost follows the feed, not the table or the summary. The summary changes
    when the pointer gets its next row; a run that died before leaves files that no pointer names. One
    writer at a time: a pointer row that exists is refused.
    """
    spark = log.sparkSession
    last, runs = _last_pointer(spark, root)
    if upto <= last.upto:
        return 0
    feed = log.where((F.col(version) > last.upto) & (F.col(version) <= upto))
    deltas = _bucketed(summary_deltas(feed, last.group, last.measure), last.group, last.buckets)
    types = dict(_read_buckets(spark, root, last.schema, {}).dtypes)
    run = f"r-{uuid.uuid4().hex}"
    touched = _write_buckets(
        deltas.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()]).repartition(BUCKET), f"{root}/rows/run={run}"
    )
    runs |= {b: [*runs.get(b, []), run] for b in touched}
    long = {b: runs[b] for b in touched if len(runs[b]) > additions + 1}
    if long:
        # Rows of a bucket meet here, so adding up by bucket and group needs no further exchange.
        parts = _read_buckets(spark, root, last.schema, long).repartition(BUCKET)
        run = f"r-{uuid.uuid4().hex}"
        written = _write_buckets(settle(parts, [BUCKET, *last.group], types), f"{root}/rows/run={run}")
        runs = {b: r for b, r in runs.items() if b not in long} | {b: [run] for b in written}
    _point(spark, root, last.asDict() | {"seq": last.seq + 1, "upto": upto}, runs)
    return len(touched)


def forget_superseded(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Remove buckets that none of the last ``keep`` pointers names; returns how many."""
    pointers = spark.read.schema(POINTER).parquet(f"{root}/pointer")
    last = pointers.agg(F.max("seq")).first()[0]
    parts = pointers.select("seq", F.explode("runs").alias("r"))
    named = parts.select("seq", "r.bucket", F.explode("r.parts").alias("run"))
    old = named.groupBy("bucket", "run").agg(F.max("seq").alias("seq")).where(F.col("seq") <= last - keep).collect()
    for entry in old:
        delete_folder(spark, f"{root}/rows/run={entry.run}/{BUCKET}={entry.bucket}")
    for entry in pointers.where(F.col("seq") <= last - keep).select("seq").collect():
        delete_folder(spark, f"{root}/pointer/commit={entry.seq}")
    return len(old)
