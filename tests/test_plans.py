"""Properties of the plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from stockpond.catalog import changes
from stockpond.operators.changes import apply_changes, change_feed, new_rows
from stockpond.operators.clean import keep_latest
from stockpond.session import materialize, materialize_by_key
from stockpond.sources import retail
from stockpond.sources.tables import read_table

# Windows without a key are allowed where one row per sort range, bin or calendar day is left.
SMALL_WINDOWS = {"global_row_number", "prediction_drift", "trailing_f1", "feature_psi", "feature_ks", "layout_report"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = sorted(
    n
    for n, f in entry_points.queries().items()
    if n in entry_points.oracle_sql() and not f.__module__.endswith("ingest") and n != "medallion_gold"
)


@pytest.mark.parametrize("name", LAZY)
def test_no_pairing_of_all_rows(spark, sf_dir, name):
    text = plan(entry_points.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"PythonUDF|BatchEvalPython", text)
    if name not in SMALL_WINDOWS:
        assert not windows_in_one_task(text)


def windows_in_one_task(text):
    """Window nodes fed, below their sort, by an exchange into a single partition."""
    lines = text.splitlines()
    below = [" ".join(lines[i + 1 : i + 4]) for i, line in enumerate(lines) if re.match(r"[\s:+\-*()\d]*Window \[", line)]
    return [b for b in below if "Exchange SinglePartition" in b]


def test_one_task_windows_are_recognised(spark):
    from pyspark.sql import Window

    one = spark.range(5).withColumn("n", F.row_number().over(Window.orderBy("id")))
    many = spark.range(5).withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("id")))
    assert windows_in_one_task(plan(one)) and not windows_in_one_task(plan(many))


def test_versions_are_reduced_before_the_shuffle(spark, sf_dir):
    versions = retail.order_versions(spark, sf_dir)
    text = plan(keep_latest(versions, ["order_id"], retail.VERSION_ORDER))
    assert text.index("row_number(), 1, Final") < text.index("Exchange hashpartitioning") < text.index("row_number(), 1, Partial")


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(entry_points.queries()["filtered_count"](spark, sf_dir))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_orderstatus:string>" in text


def test_topk_does_not_sort_everything(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(entry_points.queries()["wide_sort_topk"](spark, sf_dir))


def test_small_feed_leaves_the_target_unshuffled(spark, sf_dir):
    target = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    new = target.withColumn("o_totalprice", F.col("o_totalprice") + (F.col("o_orderkey") == 5).cast("int"))
    feed = materialize(change_feed(target, new, ["o_orderkey"]), "feed")
    assert "Exchange hashpartitioning" not in plan(apply_changes(target, feed, ["o_orderkey"]))


def test_size_decides_about_broadcast(spark, sf_dir):
    facts = lambda: plan(retail.order_facts(spark, sf_dir))
    assert re.search(r"BroadcastHashJoin \[product_id", facts())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in facts() and "SortMergeJoin [product_id" in facts()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_crossings_read_the_rows_of_a_minute_only(spark, sf_dir):
    text = plan(entry_points.queries()["budget_crossings"](spark, sf_dir))
    assert text.count("FileScan parquet") == 2
    assert re.search(r"PushedFilters: \[[^]]*(GreaterThanOrEqual|Or)\(", text)


def test_equal_ranges_are_left_out_before_the_shuffle(spark, sf_dir):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8000")
    try:
        text = plan(entry_points.queries()["change_feed_by_range"](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    sides = text.split("Exchange hashpartitioning(")[1:]
    assert len(sides) == 2 and all("LeftSemi" in side and "BroadcastExchange" in side for side in sides)


def test_rows_kept_by_key_are_joined_without_moving_them(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, None)], "order_id bigint, v string")
    kept = materialize_by_key(rows, "landing", "order_id")
    assert sorted(map(str, kept.collect())) == sorted(map(str, rows.collect()))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("landing")]
    known = spark.createDataFrame([(1,), (1,), (4,)], "order_id bigint")
    assert sorted(map(str, new_rows(kept, known, ["order_id"]).collect())) == sorted(map(str, rows.where("order_id IS NULL OR order_id <> 1").collect()))


def test_medallion_runs_do_not_shuffle_the_landing_table(spark, sf_dir, monkeypatch):
    landed = []
    run = changes.run_medallion
    monkeypatch.setattr(changes, "run_medallion", lambda landing, *rest, **named: landed.append(landing) or run(landing, *rest, **named))
    entry_points.queries()["medallion_gold"](spark, sf_dir)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(new_rows(landed[-1], landed[0], ["order_id"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    # The one exchange is that of the known keys.
    assert "LeftAnti" in text and text.count("Exchange hashpartitioning") == 1
