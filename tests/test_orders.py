from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import LANDING, ORDER_SCHEMA, ORDERS, PRODUCT_SCHEMA, PRODUCTS_FINAL, UNTIDY, money
from stockpond.operators import marts
from stockpond.operators.clean import build_silver_orders
from stockpond.operators.keyed_scan import keyed_scan, running_sum, sequence_number
from stockpond.plans import metrics
from stockpond.plans.jobs import build_silver_table, compact_silver, merge_silver, read_silver, run_medallion
from stockpond.session import scratch_path


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(PRODUCTS_FINAL, PRODUCT_SCHEMA)


def orders(spark, rows):
    return spark.createDataFrame(rows, ORDER_SCHEMA)


@pytest.fixture(scope="module")
def facts(spark, products):
    silver = build_silver_orders(orders(spark, ORDERS + LANDING))
    return marts.enrich_orders(silver, products)


def test_latest_version_wins(spark):
    silver = build_silver_orders(orders(spark, ORDERS))
    assert silver.count() == 7
    assert silver.where("order_id = 4").first().quantity == 3


def test_late_arrival_does_not_matter(spark):
    forwards = build_silver_orders(orders(spark, ORDERS)).collect()
    backwards = build_silver_orders(orders(spark, ORDERS[::-1])).collect()
    assert sorted(forwards) == sorted(backwards)


def test_untidy_rows(spark):
    silver = {r.order_id: r for r in build_silver_orders(orders(spark, UNTIDY)).collect()}
    assert silver[31].quantity == 0
    assert silver[32].order_status == "COMPLETED"
    assert silver[33].order_status is None
    assert silver[34].quantity == 5


def test_category_summary(facts):
    rows = {r.category: r for r in marts.category_summary(facts, exact=True).collect()}
    assert (rows["Kitchen"].total_revenue, rows["Kitchen"].order_count, rows["Kitchen"].unique_customers) == (money(353), 7, 6)
    assert (rows["Lighting"].total_revenue, rows["Lighting"].order_count, rows["Lighting"].unique_customers) == (money(165), 2, 2)
    approx = {r.category: r.unique_customers for r in marts.category_summary(facts).collect()}
    assert approx == {"Kitchen": 6, "Lighting": 2}


def test_daily_revenue_and_average(facts):
    daily = {r.order_date: r for r in marts.orders_over_time(facts).collect()}
    assert daily[date(2027, 2, 8)].total_revenue == money(172)
    average = {r.category: r.avg_order_value for r in marts.average_order_value(facts).collect()}
    assert round(average["Kitchen"], 2) == Decimal("50.43")


def test_missing_status_counts_differently(spark, products):
    """Dropped by the inequality, kept as an order without revenue by the daily table."""
    facts = marts.enrich_orders(build_silver_orders(orders(spark, [UNTIDY[2]])), products)
    assert marts.category_summary(facts).count() == 0
    day = marts.orders_over_time(facts).first()
    assert (day.order_count, day.total_revenue) == (1, 0)


def test_category_lookup(spark, facts):
    asked = spark.createDataFrame([("kitchen",), ("LIGHTING",), ("Toys",)], "category string")
    found = {r.category: r.total_revenue for r in marts.category_lookup(asked, marts.category_summary(facts)).collect()}
    assert found == {"kitchen": money(353), "LIGHTING": money(165), "Toys": None}


def test_running_total(facts):
    scanned = keyed_scan(
        facts.select("order_id", "customer_id", "order_ts", "order_value"),
        ["customer_id"],
        ["order_ts", "order_id"],
        [sequence_number("n"), running_sum("total", "order_value")],
    )
    mine = {r.order_id: (r.n, r.total) for r in scanned.where("customer_id = 51").collect()}
    assert mine == {1: (1, money(80)), 4: (2, money(185))}


def test_explorer_counts_cancelled_orders_only_as_orders(spark, products):
    cancelled = [(1, 1, 11, 1, "CANCELLED", None), (2, 2, 12, 1, "PENDING", None)]
    facts = marts.enrich_orders(build_silver_orders(orders(spark, cancelled)), products)
    row = marts.category_explorer(facts, "Kitchen").first()
    assert (row.orders, row.revenue, row.customers) == (2, money("6.50"), 1)
    empty = marts.category_explorer(facts, "Lighting").first()
    assert (empty.orders, empty.revenue, empty.customers) == (0, 0, 0)


def test_kpis(facts):
    row = marts.category_kpis(facts).first()
    assert (row.top_category, row.top_category_customers) == ("Kitchen", 6)


def test_medallion_runs(spark, products):
    root = scratch_path(spark, "medallion-test")
    assert run_medallion(orders(spark, ORDERS), products, root, 1, exact=True).count() == 2
    gold = run_medallion(orders(spark, LANDING), products, root, 2, exact=True)
    assert {r.category: r.total_revenue for r in gold.collect()} == {"Kitchen": money(353), "Lighting": money(165)}
    assert spark.read.parquet(f"{root}/bronze").count() == 11
    again = run_medallion(orders(spark, LANDING), products, root, 3, exact=True)
    assert sorted(again.collect()) == sorted(gold.collect())
    assert spark.read.parquet(f"{root}/bronze").count() == 11
    runs = spark.read.parquet(f"{root}/runs")
    assert runs.where("state = 'SUCCEEDED'").count() == 9


def test_compacted_runs_read_the_same(spark):
    folder = scratch_path(spark, "silver-test")
    wanted = {}

    def merge(run, ids):
        rows = [(i, 50, 11, run, "COMPLETED", None) for i in ids]
        merge_silver(orders(spark, rows), folder, run)
        wanted.update({i: run for i in ids})

    def found():
        return {r.order_id: r.quantity for r in read_silver(spark, folder).collect()}

    for run in range(1, 4):
        merge(run, [0, run, None])
    before = read_silver(spark, folder).columns
    compact_silver(spark, folder, 2)
    assert found() == wanted
    for refused in (1, 2):
        with pytest.raises(ValueError, match="compacted"):
            merge(refused, [9])
    merge(4, [1, 7])
    assert found() == wanted
    compact_silver(spark, folder, 4)
    compact_silver(spark, folder, 4)
    assert found() == wanted
    assert not [f for f in read_silver(spark, folder).inputFiles() if "_run=" in f]
    assert not [f for f in read_silver(spark, folder).inputFiles() if "upto=2" in f]
    merge(5, [0])
    assert found() == wanted and read_silver(spark, folder).columns == before


def test_a_compaction_that_died_is_finished_later(spark):
    folder = scratch_path(spark, "silver-test")
    for run in (1, 2):
        merge_silver(orders(spark, [(1, 50, 11, run, "COMPLETED", None)]), folder, run)
    spark.read.parquet(folder).limit(0).write.parquet(f"{folder}/_compacted/upto=2")
    assert read_silver(spark, folder).first().quantity == 2
    compact_silver(spark, folder, 2)
    assert read_silver(spark, folder).first().quantity == 2


def test_known_orders_are_not_corrected_by_ingest(spark, products):
    root = scratch_path(spark, "medallion-test")
    run_medallion(orders(spark, ORDERS), products, root, 1)
    newer = [(1, 51, 11, 9, "COMPLETED", None)]
    run_medallion(orders(spark, newer), products, root, 2)
    assert spark.read.parquet(f"{root}/silver").where("order_id = 1").first().quantity == 2


def test_failed_step_is_logged(spark, products):
    from stockpond.plans.jobs import log_run

    folder = scratch_path(spark, "runs-test")

    def fail():
        raise RuntimeError("no source")

    with pytest.raises(RuntimeError):
        log_run(spark, folder, 1, "bronze_ingest", "BRONZE", fail)
    row = spark.read.parquet(folder).first()
    assert (row.state, row.error_message) == ("FAILED", "no source")


def test_procedure_status(spark):
    path = scratch_path(spark, "procedure-test")
    assert path in build_silver_table(orders(spark, ORDERS), path)
    assert spark.read.parquet(path).count() == 7


def gold(facts):
    return {
        "category_summary": marts.category_summary(facts, exact=True),
        "orders_over_time": marts.orders_over_time(facts),
        "order_facts": facts,
    }


def test_metric_layer(facts):
    spec, tables = metrics.load_spec(), gold(facts)
    by_category = metrics.verified_query(tables, spec, "revenue_by_category").collect()
    assert [(r.category, r.total_revenue) for r in by_category] == [("Kitchen", money(353)), ("Lighting", money(165))]
    assert metrics.verified_query(tables, spec, "total_revenue").first().total_revenue == money(518)
    customers = metrics.metric_query(tables, spec, ["shoppers"], ["assortment"])
    assert {r.category: r.unique_customers for r in customers.collect()} == {"Kitchen": 6, "Lighting": 2}
    some = metrics.metric_query(tables, spec, ["turnover"], filters=[("category", "=", "Lighting")])
    assert some.first().total_revenue == money(165)


def test_metric_layer_refuses(facts):
    spec, tables = metrics.load_spec(), gold(facts)
    with pytest.raises(ValueError, match="cannot be added up"):
        metrics.metric_query(tables, spec, ["unique_customers"])
    with pytest.raises(ValueError, match="no table offers"):
        metrics.metric_query(tables, spec, ["profit"], ["category"])
    with pytest.raises(ValueError, match="does not offer"):
        metrics.metric_query(tables, spec, ["turnover"], ["store"], table="category_summary")
    with pytest.raises(ValueError, match="unknown question"):
        metrics.verified_query(tables, spec, "profit")


def sketched(df):
    return metrics.metric_query({"customer_sketches": df}, metrics.load_spec(), ["distinct_customers"], table="customer_sketches")


def test_sketches_count_over_any_grouping(facts):
    spec, tables = metrics.load_spec(), {"customer_sketches": marts.customer_sketches(facts)}
    by_category = metrics.metric_query(tables, spec, ["different buyers"], ["kind of product"])
    assert {r.category: r.distinct_customers for r in by_category.collect()} == {"Kitchen": 6, "Lighting": 2}
    whole = facts.where(marts.not_cancelled()).select("customer_id").where("customer_id IS NOT NULL").distinct().count()
    assert sketched(tables["customer_sketches"]).first().distinct_customers == whole
    assert sketched(tables["customer_sketches"].where("false")).first().distinct_customers == 0


def test_sketches_stay_within_their_bound(spark):
    made = spark.range(300_000).selectExpr(
        "id % 40000 AS customer_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', id % 7) END AS category",
        "timestamp_ntz'2026-01-01' + make_interval(0, CAST(id % 12 AS INT)) AS order_ts", "'PAID' AS order_status",
    )
    old, late = made.where("customer_id < 30000"), made.where("customer_id >= 20000")
    stored = marts.extend_sketches(marts.customer_sketches(old), late)
    assert abs(sketched(stored).first().distinct_customers - 40000) <= 40000 * marts.SKETCH_ERROR
    again = marts.extend_sketches(stored, late)
    assert sketched(again).first() == sketched(stored).first()
    exact = {r.category: r.n for r in made.groupBy("category").agg(F.count_distinct("customer_id").alias("n")).collect()}
    found = metrics.metric_query({"customer_sketches": stored}, metrics.load_spec(), ["distinct_customers"], ["category"])
    for row in found.collect():
        assert abs(row.distinct_customers - exact[row.category]) <= exact[row.category] * marts.SKETCH_ERROR
