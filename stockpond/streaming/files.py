"""Continuous file ingest: every file reaches the table exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, format: str = "csv", files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(format)
    if format == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def ingest(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    table_dir: str,
    checkpoint: str,
    every: str | None = None,
    format: str = "csv",
) -> StreamingQuery:
    """Append new files of ``folder`` to a parquet table.

    Without ``every`` it takes what is there and stops (one refresh); with an interval such
    as ``"1 minute"`` it keeps running and picks files up as they arrive.
    """
    writer = (
        file_stream(spark, folder, schema, format)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", table_dir)
        .outputMode("append")
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
