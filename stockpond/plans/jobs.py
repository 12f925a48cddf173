"""Bronze → Silver → Gold as one dependent run, each step safe to repeat.

Tables are folders with one subfolder per run. A step writes only its run's subfolder and
overwrites it when repeated, so a run that died halfway is simply started again. Finished runs of Silver
may be compacted, so that a read does not grow with the number of runs ever made.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stockpond.operators.changes import has_data, merge_summary, new_rows, summary_deltas
from stockpond.operators.clean import build_silver_orders, keep_latest
from stockpond.operators.marts import category_summary, enrich_orders
from stockpond.session import delete_folder, materialize

RUN = "_run"
RUN_SCHEMA = (
    "run_id bigint, name string, schema_name string, state string, scheduled_at timestamp_ntz, "
    "started_at timestamp_ntz, completed_at timestamp_ntz, error_message string"
)


def _read(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """All runs of a table, empty when nothing has been written."""
    schema = like.select("*", F.lit(0).cast("bigint").alias(RUN)).schema
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def ingest_bronze(landing: DataFrame, bronze_dir: str, run_id: int) -> DataFrame:
    """Append landing rows of unknown orders; returns the rows of this run."""
    spark = landing.sparkSession
    known = _read(spark, bronze_dir, landing).where(F.col(RUN) != run_id)
    path = f"{bronze_dir}/{RUN}={run_id}"
    new_rows(landing, known, ["order_id"]).write.mode("overwrite").parquet(path)
    return spark.read.schema(landing.schema).parquet(path)


def merge_silver(arrived: DataFrame, silver_dir: str, run_id: int, tie_break: list[str] | None = None) -> None:
    """Write the cleaned latest version of every order that arrived in this run."""
    upto = _compacted_upto(arrived.sparkSession, silver_dir)
    if upto is not None and run_id <= upto:
        raise ValueError(f"runs up to {upto} are compacted; {run_id} cannot be repeated")
    build_silver_orders(arrived, tie_break).write.mode("overwrite").parquet(f"{silver_dir}/{RUN}={run_id}")


def _compacted_upto(spark: SparkSession, silver_dir: str) -> int | None:
    """The last run that the compacted rows hold. Folder names that begin with an underscore are skipped by a plain read."""
    try:
        return spark.read.schema("upto bigint").parquet(f"{silver_dir}/_compactions").agg(F.max("upto")).first()[0]
    except AnalysisException:
        return None


def _compacted(spark: SparkSession, silver_dir: str, upto: int) -> DataFrame:
    return spark.read.parquet(f"{silver_dir}/_compacted/upto={upto}")


def _later_runs(spark: SparkSession, silver_dir: str, schema: StructType | None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(silver_dir).withColumn(RUN, F.col(RUN).cast("bigint"))


def read_silver(spark: SparkSession, silver_dir: str) -> DataFrame:
    """Current Silver orders: the row of the latest run per order, from the compacted rows and the runs after them."""
    upto = _compacted_upto(spark, silver_dir)
    if upto is None:
        return keep_latest(_later_runs(spark, silver_dir, None), ["order_id"], [RUN]).drop(RUN)
    base = _compacted(spark, silver_dir, upto)
    later = _later_runs(spark, silver_dir, base.schema).where(F.col(RUN) > upto)
    # Usually few rows, which Spark then broadcasts by their size; the compacted ones are not shuffled.
    arrived = materialize(keep_latest(later, ["order_id"], [RUN]), "later-runs")
    untouched = base.join(arrived, base["order_id"].eqNullSafe(arrived["order_id"]), "left_anti")
    return untouched.unionByName(arrived.select(*base.columns)).drop(RUN)


def compact_silver(spark: SparkSession, silver_dir: str, upto: int) -> None:
    """Store the rows that the runs up to ``upto`` leave, so that a read needs only these and the later runs.

    ``upto`` must be finished: it and earlier runs cannot be repeated afterwards. The compaction counts once its
    one-row note is written; the folders it replaces are removed last, and a compaction that died in between
    is finished by the next. Readers of the removed folders have to read again.
    """
    known = _compacted_upto(spark, silver_dir)
    schema = None if known is None else _compacted(spark, silver_dir, known).schema
    runs = _later_runs(spark, silver_dir, schema).where(F.col(RUN) <= upto)
    if known is None or upto > known:
        rows = runs if known is None else _compacted(spark, silver_dir, known).unionByName(runs.where(F.col(RUN) > known))
        keep_latest(rows, ["order_id"], [RUN]).write.mode("overwrite").parquet(f"{silver_dir}/_compacted/upto={upto}")
        spark.range(0, 1, 1, 1).select(F.lit(upto).cast("bigint").alias("upto")).write.mode("append").parquet(f"{silver_dir}/_compactions")
        if known is not None:
            delete_folder(spark, f"{silver_dir}/_compacted/upto={known}")
    # One row for each run since the last compaction.
    for (run,) in runs.select(RUN).distinct().collect():
        delete_folder(spark, f"{silver_dir}/{RUN}={run}")


def refresh_gold(silver: DataFrame, products: DataFrame, gold_dir: str, run_id: int, exact: bool = False) -> DataFrame:
    """Recompute the category summary and write it as this run's version."""
    path = f"{gold_dir}/{RUN}={run_id}"
    category_summary(enrich_orders(silver, products), exact).write.mode("overwrite").parquet(path)
    return silver.sparkSession.read.parquet(path)


def log_run(spark: SparkSession, log_dir: str, run_id: int, name: str, schema_name: str, body) -> object:
    """Run one step and append its outcome to the run log; errors are logged and raised."""
    started = datetime.now(timezone.utc).replace(tzinfo=None)
    state, message = "SUCCEEDED", None
    try:
        return body()
    except Exception as error:
        state, message = "FAILED", str(error)
        raise
    finally:
        ended = datetime.now(timezone.utc).replace(tzinfo=None)
        row = (run_id, name, schema_name, state, started, started, ended, message)
        spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").parquet(log_dir)


def run_medallion(
    landing: DataFrame,
    products: DataFrame,
    root: str,
    run_id: int,
    tie_break: list[str] | None = None,
    exact: bool = False,
) -> DataFrame:
    """Ingest, merge and refresh in order; returns the Gold table of this run."""
    spark = landing.sparkSession

    def step(name, schema_name, body):
        return log_run(spark, f"{root}/runs", run_id, name, schema_name, body)

    arrived = step("bronze_ingest", "BRONZE", lambda: ingest_bronze(landing, f"{root}/bronze", run_id))
    step("silver_merge", "SILVER", lambda: merge_silver(arrived, f"{root}/silver", run_id, tie_break))
    silver = read_silver(spark, f"{root}/silver")
    return step("gold_refresh", "GOLD", lambda: refresh_gold(silver, products, f"{root}/gold", run_id, exact))


def build_silver_table(bronze: DataFrame, path: str, tie_break: list[str] | None = None) -> str:
    """The named procedure: clean and deduplicate into a table, answer with a status."""
    build_silver_orders(bronze, tie_break).write.mode("overwrite").parquet(path)
    return f"Silver orders written to {path}"


def refresh_summary_if_changed(
    summary: DataFrame, feed: DataFrame, group: list[str], measure: str
) -> tuple[DataFrame, bool]:
    """The refreshed summary and whether it had to be touched at all."""
    if not has_data(feed):
        return summary, False
    return merge_summary(summary, summary_deltas(feed, group, measure), group), True

