"""File ingest in batch and as a stream, change streams, load and run reports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stockpond.catalog.changes import KEY, PLAIN_SQL, VERSIONS_SQL, all_versions
from stockpond.catalog.registry import plain, query
from stockpond.operators import changes, usage
from stockpond.operators.history import VERSION
from stockpond.session import scratch_path
from stockpond.sources.ledger import load_new_files, read_ledger, read_loaded
from stockpond.sources.tables import list_files, read_csv, read_table
from stockpond.streaming.changes import current_state, current_summary, stream_apply, stream_summary
from stockpond.streaming.files import file_stream, ingest

PRODUCT_SCHEMA = (
    StructType()
    .add("product_id", "long")
    .add("product_name", "string")
    .add("category", "string")
    .add("price", "decimal(10,2)")
)
PRODUCT_SQL = "SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, CAST(p_retailprice AS DOUBLE) AS price FROM part"
FIRST_LOAD = "2026-09-15 10:00:00"
SECOND_LOAD = "2026-09-15 10:30:00"


def product_files(spark, sf_dir, folder, condition):
    """Deliver part of the products as CSV files."""
    part = read_table(spark, sf_dir, "part").where(condition)
    part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    ).write.mode("append").option("header", True).csv(folder)


def load_twice(spark, sf_dir):
    """Two deliveries; each is loaded, and loading again finds nothing new."""
    folder, table = scratch_path(spark, "delivery"), scratch_path(spark, "products")
    small = F.col("p_size") <= 25
    for condition, at in ((small, FIRST_LOAD), (~small, SECOND_LOAD)):
        product_files(spark, sf_dir, folder, condition)
        for _ in range(2):
            load_new_files(spark, folder, PRODUCT_SCHEMA, table, "PRODUCTS", F.lit(at))
    return table


@query("csv_scan", PRODUCT_SQL)
def csv_scan(spark, sf_dir):
    folder = scratch_path(spark, "delivery")
    product_files(spark, sf_dir, folder, F.lit(True))
    return plain(read_csv(spark, folder, PRODUCT_SCHEMA))


@query("csv_idempotent_load", PRODUCT_SQL)
def csv_idempotent_load(spark, sf_dir):
    return plain(read_loaded(spark, load_twice(spark, sf_dir), PRODUCT_SCHEMA))


@query(
    "load_history",
    f"""SELECT 'PRODUCTS' AS table_name, TIMESTAMP '{SECOND_LOAD}' AS loaded_at, COUNT(*) AS row_count FROM part WHERE p_size > 25
        UNION ALL SELECT 'PRODUCTS', TIMESTAMP '{FIRST_LOAD}', COUNT(*) FROM part WHERE p_size <= 25""",
)
def load_history(spark, sf_dir):
    ledger = read_ledger(spark, load_twice(spark, sf_dir))
    recent = usage.load_history(ledger, "PRODUCTS", F.lit("2026-09-15 09:45:00").cast("timestamp_ntz"))
    return recent.groupBy("table_name", "loaded_at").agg(F.sum("row_count").alias("row_count"))


@query("file_listing", "SELECT p_brand AS brand, COUNT(*) AS rows, TRUE AS bytes_fit FROM part GROUP BY p_brand")
def file_listing(spark, sf_dir):
    """Listed files with the rows found in them; a row takes ten bytes at least."""
    folder = scratch_path(spark, "brands")
    read_table(spark, sf_dir, "part").write.partitionBy("p_brand").option("header", True).csv(folder)
    files = list_files(spark, folder, "*.csv", recursive=True)
    brand = F.url_decode(F.regexp_extract("file_path", "p_brand=([^/]+)/", 1))
    stored = spark.read.option("header", True).option("recursiveFileLookup", "true").csv(folder)
    rows = stored.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("rows"))
    found = files.join(rows, "file_path", "left").groupBy(F.url_decode(brand).alias("brand"))
    return found.agg(F.sum("rows").alias("rows"), (F.sum("file_size") >= 10 * F.sum("rows")).alias("bytes_fit"))


@query("stream_file_ingest", PRODUCT_SQL)
def stream_file_ingest(spark, sf_dir):
    """Refresh, new files, refresh, and one refresh without new files."""
    folder, table = scratch_path(spark, "pipe"), scratch_path(spark, "products")
    checkpoint = scratch_path(spark, "pipe-checkpoint")
    small = F.col("p_size") <= 25
    product_files(spark, sf_dir, folder, small)
    ingest(spark, folder, PRODUCT_SCHEMA, table, checkpoint).awaitTermination()
    product_files(spark, sf_dir, folder, ~small)
    for _ in range(2):
        ingest(spark, folder, PRODUCT_SCHEMA, table, checkpoint).awaitTermination()
    return plain(spark.read.schema(PRODUCT_SCHEMA).parquet(table))


@query("stream_interval_ingest", PRODUCT_SQL)
def stream_interval_ingest(spark, sf_dir):
    """A running load that looks for new files at an interval; files arrive while it runs."""
    folder, table = scratch_path(spark, "pipe"), scratch_path(spark, "products")
    small = F.col("p_size") <= 25
    product_files(spark, sf_dir, folder, small)
    running = ingest(spark, folder, PRODUCT_SCHEMA, table, scratch_path(spark, "pipe-checkpoint"), every="1 second")
    running.processAllAvailable()
    product_files(spark, sf_dir, folder, ~small)
    running.processAllAvailable()
    running.stop()
    return plain(spark.read.schema(PRODUCT_SCHEMA).parquet(table))


def change_stream(spark, sf_dir):
    """Both feeds of the orders versions as files, read a few at a time."""
    folder = scratch_path(spark, "feeds")
    v0, v1, v2 = all_versions(spark, sf_dir)
    for number, (old, new) in enumerate(((v0, v1), (v1, v2)), start=1):
        feed = changes.change_feed(old, new, KEY).withColumn(VERSION, F.lit(number).cast("bigint"))
        feed.write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    return v0, file_stream(spark, folder, schema, "parquet", files_per_batch=4)


@query("stream_merge_apply", f"WITH {VERSIONS_SQL} SELECT {PLAIN_SQL} FROM v2")
def stream_merge_apply(spark, sf_dir):
    base, stream = change_stream(spark, sf_dir)
    log = scratch_path(spark, "orders-log")
    stream_apply(stream, log, KEY, [VERSION], scratch_path(spark, "apply-checkpoint")).awaitTermination()
    return plain(current_state(base, log, KEY, [VERSION]))


@query(
    "stream_incremental_summary",
    f"""WITH {VERSIONS_SQL}
    SELECT priority, COUNT(*) AS row_count, COUNT(price) AS value_count, CAST(SUM(price) AS DOUBLE) AS total
    FROM v2 GROUP BY priority""",
)
def stream_incremental_summary(spark, sf_dir):
    base, stream = change_stream(spark, sf_dir)
    deltas = scratch_path(spark, "summary-deltas")
    stream_summary(stream, deltas, ["priority"], "price", scratch_path(spark, "summary-checkpoint")).awaitTermination()
    return plain(current_summary(changes.summarize(base, ["priority"], "price"), deltas, ["priority"]))


REFRESH_NOW = "2024-01-31 00:00:00"


@query(
    "refresh_freshness",
    f"""SELECT name, refreshed_at, data_at, lag_seconds, lag_seconds <= 300 AS within_target FROM (
          SELECT event_type AS name, ts AS refreshed_at, date_trunc('minute', ts) AS data_at,
                 date_diff('second', date_trunc('minute', ts), TIMESTAMP '{REFRESH_NOW}') AS lag_seconds FROM events)
        ORDER BY refreshed_at DESC, name LIMIT 10""",
)
def refresh_freshness(spark, sf_dir):
    refreshes = read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("name"),
        F.col("ts").alias("refreshed_at"),
        F.date_trunc("MINUTE", "ts").cast("timestamp_ntz").alias("data_at"),
    )
    return usage.freshness(refreshes, F.lit(REFRESH_NOW).cast("timestamp_ntz"), 300)


@query(
    "run_history",
    """SELECT event_id AS run_id, event_type AS name, CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS state,
              ts AS scheduled_at FROM events
       WHERE event_type IN ('signup', 'purchase', 'error') AND ts >= TIMESTAMP '2024-01-10 00:00:00'
       ORDER BY scheduled_at DESC, run_id DESC LIMIT 10""",
)
def run_history(spark, sf_dir):
    runs = read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("name"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCEEDED").alias("state"),
        F.col("ts").alias("scheduled_at"),
    )
    since = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    return usage.run_history(runs, ["signup", "purchase", "error"], since, k=10)
