"""Batch file loads that never load a file twice.

A load writes its rows to ``data/load_id=n`` and then one ledger row per file. Only loads
present in the ledger are read, so a load that died in between is invisible and its folder
is written anew by the next one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stockpond.session import materialize
from stockpond.sources.tables import list_files, read_csv

LEDGER_SCHEMA = (
    "load_id bigint, table_name string, file_path string, file_size bigint, "
    "row_count bigint, loaded_at timestamp_ntz"
)


def read_ledger(spark: SparkSession, table_dir: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(f"{table_dir}/ledger")
    except AnalysisException:
        return spark.createDataFrame([], LEDGER_SCHEMA)


def load_new_files(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    table_dir: str,
    table_name: str,
    loaded_at: Column,
    glob: str = "*.csv",
    files_per_load: int = 10_000,
) -> int:
    """Load the CSV files of a folder that are not in the ledger, so many at a time; returns how many."""
    loaded = 0
    while n := _load_some(spark, folder, schema, table_dir, table_name, loaded_at, glob, files_per_load):
        loaded += n
    return loaded


def _load_some(
    spark: SparkSession, folder: str, schema: StructType, table_dir: str, table_name: str, loaded_at: Column, glob: str, most: int
) -> int:
    ledger = read_ledger(spark, table_dir)
    new_files = list_files(spark, folder, glob).join(ledger.select("file_path"), "file_path", "left_anti")
    # A bounded number of names for the reader; the next round takes the rest.
    chosen = materialize(new_files.orderBy("file_path").limit(most), "new-files")
    paths = [r.file_path for r in chosen.select("file_path").collect()]
    if not paths:
        return 0
    load_id = (ledger.agg(F.max("load_id")).first()[0] or 0) + 1
    data = f"{table_dir}/data/load_id={load_id}"
    rows = read_csv(spark, paths, schema)
    rows.select("*", F.col("_metadata.file_path").alias("_file")).write.mode("overwrite").parquet(data)
    counts = spark.read.parquet(data).groupBy(F.col("_file").alias("file_path")).agg(F.count("*").alias("row_count"))
    entries = chosen.join(counts, "file_path", "left").select(
        F.lit(load_id).cast("bigint").alias("load_id"),
        F.lit(table_name).alias("table_name"),
        "file_path",
        "file_size",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        loaded_at.cast("timestamp_ntz").alias("loaded_at"),
    )
    # One small file, so that the entries of a load become visible together.
    entries.repartition(1).write.mode("append").parquet(f"{table_dir}/ledger")
    return len(paths)


def read_loaded(spark: SparkSession, table_dir: str, schema: StructType) -> DataFrame:
    """All rows of the loads the ledger knows."""
    committed = read_ledger(spark, table_dir).select("load_id").distinct()
    if committed.isEmpty():
        return spark.createDataFrame([], schema)
    rows = spark.read.parquet(f"{table_dir}/data")
    return rows.join(committed, "load_id", "left_semi").select(*schema.names)
