"""Table and file readers. A schema is always given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_csv(spark: SparkSession, paths: str | list[str], schema: StructType) -> DataFrame:
    """CSV with a header line, typed by ``schema``; a bad value fails the load."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .csv(paths)
    )


def list_files(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """Path, length and modification time of the files in a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("length").alias("file_size"),
            F.col("modificationTime").cast("timestamp_ntz").alias("modified_at"),
        )
    )


def literal_rows(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def layer_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per layer with its row count."""
    reports = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in tables.items()
    ]
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report
