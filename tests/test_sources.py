import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fixtures import CUSTOMERS, DOCUMENTS, PRODUCT_SCHEMA, PRODUCTS_START, money
from stockpond.functions.scalars import clean_text, register_category_revenue, register_clean_text, try_to_number, variant_type
from stockpond.operators import govern, semi, usage
from stockpond.session import scratch_path, shared_root
from stockpond.sources.ledger import load_new_files, read_ledger, read_loaded
from stockpond.sources.tables import layer_row_counts, list_files, read_csv
from stockpond.streaming.files import ingest


@pytest.fixture(scope="module")
def schema(spark):
    return spark.createDataFrame([], PRODUCT_SCHEMA).schema


def deliver(spark, folder, rows):
    spark.createDataFrame(rows, PRODUCT_SCHEMA).repartition(1).write.mode("append").option("header", True).csv(folder)


def test_load_is_idempotent(spark, schema):
    folder, table = scratch_path(spark, "in"), scratch_path(spark, "table")
    now = F.lit("2026-09-15 10:00:00")
    assert read_loaded(spark, table, schema).count() == 0
    deliver(spark, folder, PRODUCTS_START[:3])
    assert load_new_files(spark, folder, schema, table, "PRODUCTS", now) == 1
    assert load_new_files(spark, folder, schema, table, "PRODUCTS", now) == 0
    assert read_loaded(spark, table, schema).count() == 3
    deliver(spark, folder, PRODUCTS_START[3:])
    assert load_new_files(spark, folder, schema, table, "PRODUCTS", F.lit("2026-09-15 11:00:00")) == 1
    assert sorted(read_loaded(spark, table, schema).collect()) == PRODUCTS_START
    recent = usage.load_history(read_ledger(spark, table), "PRODUCTS", F.lit("2026-09-15 10:30:00").cast("timestamp_ntz"))
    assert [r.row_count for r in recent.collect()] == [2]


def test_interrupted_load_is_invisible(spark, schema):
    """Rows written without a ledger entry are not read, and the next load replaces them."""
    folder, table = scratch_path(spark, "in"), scratch_path(spark, "table")
    deliver(spark, folder, PRODUCTS_START[:3])
    load_new_files(spark, folder, schema, table, "PRODUCTS", F.lit("2026-09-15 10:00:00"))
    spark.read.parquet(f"{table}/data/load_id=1").write.parquet(f"{table}/data/load_id=2")
    assert read_loaded(spark, table, schema).count() == 3
    deliver(spark, folder, PRODUCTS_START[3:])
    load_new_files(spark, folder, schema, table, "PRODUCTS", F.lit("2026-09-15 11:00:00"))
    assert read_loaded(spark, table, schema).count() == 5


def test_bad_value_fails_the_load(spark, schema):
    folder = scratch_path(spark, "in")
    spark.createDataFrame([("x", "Lamp", "Light", "1.00")], "product_id string, product_name string, category string, price string").write.option("header", True).csv(folder)
    with pytest.raises(Exception):
        read_csv(spark, folder, schema).collect()


def test_stream_ingest(spark, schema):
    folder, table, checkpoint = (scratch_path(spark, n) for n in ("pipe", "table", "cp"))
    for rows, expected in ((PRODUCTS_START[:3], 3), ([], 3), (PRODUCTS_START[3:], 5)):
        if rows:
            deliver(spark, folder, rows)
        ingest(spark, folder, schema, table, checkpoint).awaitTermination()
        assert spark.read.schema(schema).parquet(table).count() == expected


def test_running_stream_ingest(spark, schema):
    folder, table = scratch_path(spark, "pipe"), scratch_path(spark, "table")
    deliver(spark, folder, PRODUCTS_START)
    running = ingest(spark, folder, schema, table, scratch_path(spark, "cp"), every="1 second")
    running.processAllAvailable()
    running.stop()
    assert spark.read.schema(schema).parquet(table).count() == 5


def test_listing(spark):
    folder = scratch_path(spark, "list")
    deliver(spark, folder, PRODUCTS_START)
    files = list_files(spark, folder, "*.csv").collect()
    assert len(files) == 1 and files[0].file_size > 100 and files[0].modified_at is not None


def test_layer_counts(spark):
    report = layer_row_counts({"A": spark.range(3), "B": spark.range(0)})
    assert {r.layer: r.row_count for r in report.collect()} == {"A": 3, "B": 0}


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir", shared_root(spark)).rstrip("/")


# --- JSON -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def documents(spark):
    raw = spark.createDataFrame(DOCUMENTS, "event_id int, event_data string")
    return semi.parse_documents(raw, "event_data")


FIELDS = {"order_id": ("$.id", "bigint"), "amount": ("$.amount", "decimal(18,2)")}


def test_flatten(documents):
    items = semi.flatten_array(documents, "doc", "$.orders", FIELDS)
    found = sorted((r.event_id, r.order_id, r.amount) for r in items.collect())
    assert found == [(1, 71, money(12)), (1, 72, money("30.50")), (2, 73, money(8)), (6, 74, money("19.99"))]


def test_sum_by_name(documents):
    items = semi.flatten_array(documents, "doc", "$.orders", FIELDS)
    sums = items.groupBy(semi.path("doc", "$.customer.name", "string").alias("name")).agg(F.sum("amount").alias("s"))
    assert {r.name: r.s for r in sums.collect()} == {"Mia": money("42.50"), "Noor": money(8), "Pavel": money("19.99")}


def test_strict_parsing_fails(spark):
    raw = spark.createDataFrame([('{"a": 1}',), ("not json",)], "t string")
    assert semi.parse_documents(raw, "t").where("doc IS NULL").count() == 1
    with pytest.raises(Exception):
        semi.parse_documents(raw, "t", strict=True).select(F.to_json("doc")).collect()


def test_types(spark):
    raw = spark.createDataFrame([('{"a": 1}',), ("[1]",), ('"x"',), ("1",), ("true",), ("null",), ("1.5",)], "t string")
    kinds = [r[0] for r in semi.parse_documents(raw, "t").select(variant_type(F.col("doc"))).collect()]
    assert kinds == ["OBJECT", "ARRAY", "VARCHAR", "INTEGER", "BOOLEAN", "NULL_VALUE", "DECIMAL"]


# --- governance -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(CUSTOMERS, "customer_id int, name string, email string, region string")


def policies():
    return govern.Policies(lambda: F.col("region") == "COAST", {"DATA_ENGINEER"}, {"email": ({"DATA_ENGINEER"}, govern.MASK_TEXT)})


def test_engineer_sees_everything(customers):
    assert sorted(govern.governed(customers, policies(), "DATA_ENGINEER").collect()) == CUSTOMERS


@pytest.mark.parametrize("role", ["DATA_ANALYST", "ACCOUNTADMIN"])
def test_others_see_masked_coast(customers, role):
    seen = govern.governed(customers, policies(), role).collect()
    assert {(r.name, r.email) for r in seen} == {("Mia", "***MASKED***"), ("Pavel", "***MASKED***")}


def test_null_mask_keeps_the_type(spark):
    goods = spark.createDataFrame(PRODUCTS_START, PRODUCT_SCHEMA)
    masked = govern.mask(goods, "price", {"ACCOUNTADMIN"}, "DATA_ENGINEER", None)
    assert masked.schema["price"].dataType == goods.schema["price"].dataType
    assert masked.where("price IS NOT NULL").count() == 0
    assert govern.mask(goods, "price", {"ACCOUNTADMIN"}, "ACCOUNTADMIN", None).where("price IS NULL").count() == 0


def test_tag_survives_other_steps(customers):
    tagged = govern.tag_columns(customers, {"name": "PII", "email": "PII"}).where("customer_id > 1").select("email", "region", "name")
    masked = govern.mask_tagged(tagged, "PII", {"DATA_ENGINEER"}, "DATA_ANALYST")
    assert {(r.name, r.email) for r in masked.collect()} == {("***MASKED***", "***MASKED***")}
    assert govern.mask_tagged(masked, "PII", {"DATA_ENGINEER"}, "DATA_ENGINEER").columns == masked.columns


# --- functions --------------------------------------------------------------------------


def test_clean_text(spark):
    register_clean_text(spark)
    texts = spark.createDataFrame([("\t shirt \n",), (None,), ("  ",)], "t string")
    rows = texts.select(clean_text(F.col("t")).alias("a"), F.call_function("clean_text", "t").alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [("SHIRT", "SHIRT"), (None, None), ("", "")]


def test_category_revenue_function(spark):
    summary = spark.createDataFrame([("Electronics", money(313900)), ("Furniture", money(30000))], "category string, total_revenue decimal(18,2)")
    register_category_revenue(spark, summary, "revenue_of")
    row = spark.sql("SELECT revenue_of('electronics') AS a, revenue_of('Furniture') AS b, revenue_of('Toys') AS c").first()
    assert (row.a, row.b, row.c) == (money(313900), money(30000), None)


def test_try_to_number(spark):
    df = spark.createDataFrame([("1280.00",), ("1.2.3",), (None,)], "t string")
    assert [r[0] for r in df.select(try_to_number(F.col("t"))).collect()] == [money(1280), None, None]


# --- usage ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def metering(spark):
    rows = [
        ("A", "2026-01-03 10:00:00", "5.00"),
        ("B", "2026-01-03 10:00:30", "31.00"),
        ("A", "2026-01-20 09:00:00", "1.50"),
        ("B", "2026-01-20 09:00:00", "1.00"),
        ("A", "2026-01-20 09:00:20", "12.00"),
        ("A", "2026-02-01 00:00:00", "49.99"),
    ]
    df = spark.createDataFrame(rows, "warehouse_name string, start_time string, credits_used string")
    start = F.col("start_time").cast("timestamp_ntz")
    return df.select(
        "warehouse_name", start.alias("start_time"), F.timestamp_add("HOUR", F.lit(1), start).alias("end_time"), F.col("credits_used").cast("decimal(18,2)").alias("credits_used")
    )


def test_credits_below_zero_are_refused(metering):
    with pytest.raises(Exception, match="below zero"):
        usage.budget_crossings(metering.withColumn("credits_used", (-F.col("credits_used")).cast(metering.schema["credits_used"].dataType)), 50, {"NOTIFY": 0.75}).collect()


def test_budget(metering):
    crossed = {(str(r.month), r.action): str(r.crossed_at) for r in usage.budget_crossings(metering, 50, {"NOTIFY": 0.75, "SUSPEND": 1.0}).collect()}
    assert crossed == {
        ("2026-01-01", "NOTIFY"): "2026-01-20 09:00:00",
        ("2026-01-01", "SUSPEND"): "2026-01-20 09:00:20",
        ("2026-02-01", "NOTIFY"): "2026-02-01 00:00:00",
    }


def test_usage_rollups(metering):
    by_source = {r.warehouse_name: r.credits_used for r in usage.usage_rollup(metering, ["warehouse_name"]).collect()}
    assert by_source == {"A": money("68.49"), "B": money(32)}
    since = F.lit("2026-02-01").cast("timestamp_ntz")
    assert usage.usage_rollup(metering, ["warehouse_name"], since).count() == 1
    shares = {r.warehouse_name: r.share for r in usage.usage_share(metering).collect()}
    assert shares["A"] == pytest.approx(68.49 / 100.49)
    assert usage.usage_by_day(metering).count() == 5


def test_slow_runs_put_unknown_durations_last(spark):
    runs = spark.createDataFrame(
        [(1, "create DYNAMIC table t", "CREATE", None, "x"), (2, "select", "SELECT", 5, "day05"), (3, "show dynamic tables", "SHOW", 99, "x"), (4, "y" * 300, "SELECT", 7, "day01"), (5, "other", "SELECT", 8, "x")],
        "query_id int, query_text string, query_type string, total_elapsed_time int, query_tag string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("user_name", "warehouse_name", "bytes_scanned", "start_time")})
    found = usage.slow_runs(runs, ["%dynamic table%"], "day0%", ["SHOW"], 20).collect()
    assert [r.query_id for r in found] == [4, 2, 1]
    assert len(found[0].query_text_preview) == 180
