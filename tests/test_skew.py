"""Hot keys: one key holding a third of the rows must not end up whole in one task."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from stockpond.operators.asof import leakage_report
from stockpond.operators.changes import new_rows
from stockpond.operators.clean import keep_latest
from stockpond.operators.keyed_scan import in_chunks, key_minimum, keyed_scan, last_known, previous_value, prior_sum, running_sum, sequence_number
from stockpond.operators.marts import enrich_orders
from stockpond.operators.ordering import range_sorted
from stockpond.plans.features import transform_ordinal

HOT = 7


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def small_tasks(spark):
    """The cluster situation in small: nothing is broadcast, and a few kilobytes are a big partition."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    ):
        yield


def final_plan(df):
    # The query execution of the collected frame itself holds the adaptive plan.
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    """30,000 rows over 3,000 keys, a third of them with one key, in 12 splits."""
    key = F.when(F.col("id") % 3 == 0, HOT).otherwise(F.col("id") % 3000)
    text = F.md5(F.col("id").cast("string"))
    return spark.range(0, 30000, 1, 12).select("id", key.alias("k"), text.alias("payload"))


def test_enrichment_splits_a_hot_product(spark, rows):
    orders = rows.select(
        F.col("id").alias("order_id"), F.col("id").alias("customer_id"), F.col("k").alias("product_id"), F.lit(1).alias("quantity"),
        F.col("payload").alias("order_status"), F.lit(None).cast("timestamp_ntz").alias("order_ts"),
    )
    products = spark.range(3000).select(
        F.col("id").alias("product_id"), F.lit("p").alias("product_name"), F.lit("c").alias("category"), F.lit(1).cast("decimal(10,2)").alias("price")
    )
    with small_tasks(spark):
        facts = enrich_orders(orders, products)
        assert "skew=true" in final_plan(facts)
        assert facts.count() == 30000


def test_ingest_splits_a_hot_order(spark, rows):
    known = rows.where("k % 2 = 1")
    with small_tasks(spark):
        fresh = new_rows(rows, known.select("k"), ["k"])
        assert "skew=true" in final_plan(fresh)
        assert fresh.count() == rows.where("k % 2 = 0").count()


def test_leakage_report_splits_a_hot_customer(spark, rows):
    events = rows.select("k", F.col("id").alias("ts"), "payload")
    with small_tasks(spark):
        report = leakage_report(events, events, "k", "ts")
        assert "skew=true" in final_plan(report)
        assert report.first().rows == 30000


def test_encoding_splits_a_hot_value(spark, rows):
    from stockpond.session import materialize

    vocabulary = materialize(rows.select(F.col("k").alias("value"), F.col("k").alias("ordinal")).distinct(), "vocabulary")
    with small_tasks(spark):
        assert "skew=true" in final_plan(transform_ordinal(rows, vocabulary, "k", "o"))


def test_versions_of_a_hot_key_are_reduced_before_the_shuffle(spark, rows):
    latest = keep_latest(rows, ["k"], ["id"])
    assert latest.where(F.col("k") == HOT).first().id == rows.where(F.col("k") == HOT).agg(F.max("id")).first()[0]
    metrics = shuffled_rows(latest)
    assert max(metrics) < 30000 * 0.7


def shuffled_rows(df):
    """Records written by each exchange of the executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return found


def scan_tasks(df, keys):
    """Rows in the ranges of the scan's sort, largest last."""
    placed = range_sorted(df, [*keys, "ts", "id"], "skew-test")
    return sorted(r["count"] for r in placed.groupBy("_part").count().collect())


@pytest.mark.parametrize("key", [HOT, None])
@pytest.mark.parametrize("days", [1, 50])
def test_scan_splits_a_hot_key(spark, rows, key, days):
    """Half of all rows with one key, or with none, over many days or on a single one."""
    hot = F.col("id") % 2 == 0
    dated = rows.select(
        "id", F.when(hot, F.lit(key).cast("bigint")).otherwise(F.col("k") + 10_000).alias("k"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % days).cast("int")).alias("ts")
    )
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        sizes = scan_tasks(dated, ["k"])
    assert len(sizes) > 3 and sizes[-1] < 2 * sum(sizes) / len(sizes)
    got = keyed_scan(dated, ["k"], ["ts", "id"], [sequence_number("n"), running_sum("total", "id")])
    last = got.where(F.col("k").eqNullSafe(F.lit(key))).orderBy(F.desc("n")).first()
    whole = dated.where(F.col("k").eqNullSafe(F.lit(key))).agg(F.count("*"), F.sum("id")).first()
    assert (last.n, last.total) == tuple(whole)
    assert got.count() == 30000


@pytest.mark.parametrize("key", [HOT, None])
@pytest.mark.parametrize("days", [1, 50])
def test_scan_deals_a_hot_key_in_chunks(spark, rows, key, days):
    """The same rows: the hot key is cut, the others are not, and one exchange by key and chunk serves the windows."""
    hot = F.col("id") % 2 == 0
    dated = rows.select(
        "id", F.when(hot, F.lit(key).cast("bigint")).otherwise(F.col("k") + 10_000).alias("k"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % days).cast("int")).alias("ts")
    )
    dealt = in_chunks(dated, ["k"], ["ts", "id"], 6_000)
    sizes = {(r.k, r["_chunk"]): r["count"] for r in dealt.groupBy("k", "_chunk").count().collect()}
    cut = sorted(n for (k, _), n in sizes.items() if k == key)
    assert len(cut) == 3 and cut[-1] < 8_500 and sum(cut) == 15_000
    assert all(chunk == 0 for k, chunk in sizes if k != key)
    columns = [sequence_number("n"), running_sum("total", "id"), prior_sum("before", "id"), previous_value("last", "id"), key_minimum("least", "id"), last_known("known", "odd")]
    marked = dated.withColumn("odd", F.when(F.col("id") % 7 == 0, F.col("id")))
    whole = keyed_scan(marked, ["k"], ["ts", "id"], columns)
    assert in_chunks(marked, ["k"], ["ts", "id"]) is None
    for most in (6_000, 200):
        cut = keyed_scan(marked, ["k"], ["ts", "id"], columns, most)
        assert cut.schema == whole.schema and cut.exceptAll(whole).isEmpty() and cut.count() == 30_000
    # Joins on the small tables of bounds and carried rows aside, the rows are shuffled once.
    with settings(spark, spark__sql__adaptive__enabled="false"):
        for scan in (whole, keyed_scan(marked, ["k"], ["ts", "id"], columns, 6_000)):
            assert scan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
