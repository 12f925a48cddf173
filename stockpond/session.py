"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
# Paths given out so far, oldest first.
_MADE: list[str] = []


def build_session(app: str = "stockpond", master: str | None = None, **conf: str) -> SparkSession:
    """A session with AQE, skew-join splitting and UTC timestamps."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets one temporary folder
    per application, which is also set as the checkpoint folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="stockpond-")
        context.setCheckpointDir(_LOCAL_ROOTS[context.applicationId])
    return _LOCAL_ROOTS[context.applicationId]


def _session_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/stockpond/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote below the shared folder, once its results are read."""
    delete_folder(spark, _session_folder(spark))
    _MADE.clear()


@contextmanager
def released(spark: SparkSession):
    """Remove the intermediate tables made inside, once the results made from them are stored or read."""
    before = len(_MADE)
    try:
        yield
    finally:
        for path in _MADE[before:]:
            delete_folder(spark, path)
        del _MADE[before:]


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    Later branches then scan a table instead of repeating the work, and the planner knows
    its size, so a join on it is broadcast only when it really is small. Where it is not,
    the join sees two plain shuffles, which is what lets Spark split hot keys at run time;
    above an aggregate it would not.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_by_key(df: DataFrame, name: str, key: str) -> DataFrame:
    """``materialize``, in as many buckets of ``key`` as a shuffle has partitions.

    Joins on ``key`` then shuffle the other side only, however often they come. A bucket is read by one task, so
    this is for keys without hot values. The catalog is needed for the write and does not keep the table.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    # Rows that a join has left in these partitions are not moved again.
    dealt = df.repartition(buckets, key)
    dealt.write.mode("errorifexists").format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(table)
    stored = spark.table(table)
    # An external table: its files stay.
    spark.sql(f"DROP TABLE {table}")
    return stored
