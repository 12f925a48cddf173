import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import PRODUCT_SCHEMA, PRODUCTS_CHANGED, PRODUCTS_START, money
from stockpond.operators import changes, history
from stockpond.operators.changes import ACTION, IS_UPDATE
from stockpond.session import scratch_path
from stockpond.streaming.changes import current_state, current_summary, stream_apply, stream_summary
from stockpond.streaming.files import file_stream

KEY = ["product_id"]


@pytest.fixture(scope="module")
def before(spark):
    return spark.createDataFrame(PRODUCTS_START, PRODUCT_SCHEMA)


@pytest.fixture(scope="module")
def after(spark):
    return spark.createDataFrame(PRODUCTS_CHANGED, PRODUCT_SCHEMA)


def rows(df):
    return sorted(df.collect(), key=repr)


def test_feed(before, after):
    feed = changes.change_feed(before, after, KEY)
    found = {(r.product_id, r.price, r[ACTION], r[IS_UPDATE]) for r in feed.collect()}
    assert found == {
        (16, money("12.25"), "INSERT", False),
        (14, money(30), "DELETE", True),
        (14, money(33), "INSERT", True),
        (15, money(9), "DELETE", False),
    }
    assert changes.has_data(feed)
    assert not changes.has_data(changes.change_feed(after, after, KEY))


def test_feed_sees_null_values(spark):
    old = spark.createDataFrame([(1, None), (2, 5), (3, None)], "id int, v int")
    new = spark.createDataFrame([(1, 4), (2, None), (3, None)], "id int, v int")
    feed = changes.change_feed(old, new, ["id"])
    assert {(r.id, r.v, r[ACTION]) for r in feed.collect()} == {(1, None, "DELETE"), (1, 4, "INSERT"), (2, 5, "DELETE"), (2, None, "INSERT")}


def test_applying_a_feed_is_repeatable(before, after):
    feed = changes.change_feed(before, after, KEY)
    once = changes.apply_changes(before, feed, KEY)
    assert rows(once) == rows(after)
    assert rows(changes.apply_changes(once, feed, KEY)) == rows(after)


def test_unmatched_delete_is_ignored(spark, before):
    feed = spark.createDataFrame([(999, "Ghost", "None", None, "DELETE", False)], f"{PRODUCT_SCHEMA}, {ACTION} string, {IS_UPDATE} boolean")
    assert rows(changes.apply_changes(before, feed, KEY)) == rows(before)


def test_null_conditions(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "id int, v int")
    assert [r.v for r in rows(changes.update_where(df, F.col("v") > 6, {"v": F.lit(0)}))] == [None, 5, 0]
    assert {r.id for r in changes.delete_where(df, F.col("v") > 6).collect()} == {1, 2}


def test_upsert_and_new_rows(spark, before):
    source = spark.createDataFrame([(14, "Skillet", "Kitchen", money(1)), (200, "Lamp", "Light", money(2))], PRODUCT_SCHEMA)
    merged = {r.product_id: r.price for r in changes.upsert(before, source, KEY).collect()}
    assert len(merged) == 6 and merged[14] == money(1) and merged[200] == money(2)
    assert [r.product_id for r in changes.new_rows(source, before, KEY).collect()] == [200]


def test_product_summary_goldens(before, after):
    stored = changes.summarize(before, ["category"], "price")
    refreshed = changes.refresh_summary(stored, changes.change_feed(before, after, KEY), ["category"], "price")
    assert {r.category: (r.row_count, r.total) for r in refreshed.collect()} == {
        "Kitchen": (4, money("91.75")),
        "Lighting": (1, money(55)),
    }
    dearer = changes.update_where(after, F.col("product_id") == 14, {"price": F.lit(34)})
    second = changes.refresh_summary(refreshed, changes.change_feed(after, dearer, KEY), ["category"], "price")
    assert {r.category: r.total for r in second.collect()}["Kitchen"] == money("92.75")


@pytest.mark.parametrize("seed", range(4))
def test_random_versions(spark, seed):
    """Feed, merge and incremental summary agree with the full computation, NULLs included."""
    rng = random.Random(seed)
    schema = "id int, grp string, v decimal(10,2)"

    def version():
        ids = rng.sample(range(40), rng.randint(0, 30))
        return [(i, rng.choice(["a", "b", "c", None]), rng.choice([None, Decimal("1.25"), Decimal("7.00")])) for i in ids]

    old, new = (spark.createDataFrame(version(), schema) for _ in range(2))
    feed = changes.change_feed(old, new, ["id"])
    assert rows(changes.apply_changes(old, feed, ["id"])) == rows(new)
    incremental = changes.refresh_summary(changes.summarize(old, ["grp"], "v"), feed, ["grp"], "v")
    assert rows(incremental) == rows(changes.summarize(new, ["grp"], "v"))


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert [(r.id, r.rows) for r in changes.duplicate_keys(df, ["id"]).collect()] == [(1, 2)]


# --- history ----------------------------------------------------------------------------

PEOPLE = "customer_id int, name string, region string"


@pytest.fixture(scope="module")
def people(spark):
    v0 = spark.createDataFrame([(1, "Mia", "COAST"), (2, "Noor", "HILLS"), (3, "Pavel", "COAST")], PEOPLE)
    v1 = changes.update_where(v0, F.col("customer_id") == 2, {"region": F.lit("PLAIN")})
    log = history.log_entry(history.snapshot_as_changes(v0), 0, F.lit("2026-01-01")).unionByName(
        history.log_entry(changes.change_feed(v0, v1, ["customer_id"]), 1, F.lit("2026-01-02"))
    )
    return v0, v1, log


def regions(df):
    return {r.name: r.region for r in df.collect()}


def test_past_states(people):
    _, _, log = people
    assert regions(history.state_before(log, ["customer_id"], 1))["Noor"] == "HILLS"
    assert regions(history.state_before(log, ["customer_id"], 2))["Noor"] == "PLAIN"
    early = F.lit("2026-01-01 18:00:00").cast("timestamp_ntz")
    assert regions(history.state_as_of(log, ["customer_id"], early))["Noor"] == "HILLS"


def test_drop_and_restore(people):
    _, _, log = people
    key = ["customer_id"]
    dropped = log.unionByName(history.drop_entry(log, key, 2, F.lit("2026-01-03")))
    assert history.state_before(dropped, key, 3).count() == 0
    restored = dropped.unionByName(history.restore_entry(log, key, 2, 3, F.lit("2026-01-04")))
    assert regions(history.state_before(restored, key, 4)) == {"Mia": "COAST", "Noor": "PLAIN", "Pavel": "COAST"}


def test_clone_is_independent(people):
    _, v1, _ = people
    own = changes.update_where(v1.where("customer_id = 1"), F.lit(True), {"region": F.lit("VALLEY")}).withColumn(ACTION, F.lit("INSERT"))
    clone = history.overlay(v1, own, ["customer_id"])
    assert regions(clone) == {"Mia": "VALLEY", "Noor": "PLAIN", "Pavel": "COAST"}
    assert regions(v1) == {"Mia": "COAST", "Noor": "PLAIN", "Pavel": "COAST"}


def test_layout_of_one_file(spark):
    path = scratch_path(spark, "one-file")
    spark.range(100).repartition(1).write.parquet(path)
    report = history.layout_report(history.file_ranges(spark.read.parquet(path), "id")).first()
    assert (report.file_count, report.average_overlaps, report.average_depth) == (1, 0.0, 1.0)


@pytest.mark.parametrize("seed", range(5))
def test_layout_against_pairs(spark, seed):
    rng = random.Random(seed)
    ranges = []
    for i in range(rng.randint(1, 25)):
        low = rng.randint(0, 30)
        ranges.append((f"f{i}", low, low + rng.randint(0, 12)))
    met = [sum(a[1] <= b[2] and b[1] <= a[2] for b in ranges) - 1 for a in ranges]
    depth = [sum(b[1] <= a[1] <= b[2] for b in ranges) for a in ranges]
    report = history.layout_report(spark.createDataFrame(ranges, "file_path string, low int, high int")).first()
    assert report.file_count == len(ranges)
    assert report.average_overlaps == pytest.approx(sum(met) / len(ranges))
    assert report.average_depth == pytest.approx(sum(depth) / len(ranges))


# --- streams ----------------------------------------------------------------------------


def write_feed(spark, folder, old, new, version):
    feed = changes.change_feed(old, new, KEY).withColumn(history.VERSION, F.lit(version).cast("bigint"))
    feed.repartition(1).write.mode("append").parquet(folder)


def test_streams_survive_replay(spark, before, after):
    """A lost checkpoint replays all batches: folders are overwritten, results unchanged."""
    folder, log, deltas = (scratch_path(spark, n) for n in ("feed", "log", "deltas"))
    write_feed(spark, folder, before, after, 1)
    cheaper = changes.update_where(after, F.col("product_id") == 14, {"price": F.lit(1), "category": F.lit("Sale")})
    write_feed(spark, folder, after, cheaper, 2)
    schema = spark.read.parquet(folder).schema

    def run():
        stream = file_stream(spark, folder, schema, "parquet", files_per_batch=1)
        stream_apply(stream, log, KEY, [history.VERSION], scratch_path(spark, "cp")).awaitTermination()
        stream = file_stream(spark, folder, schema, "parquet", files_per_batch=1)
        stream_summary(stream, deltas, ["category"], "price", scratch_path(spark, "cp")).awaitTermination()

    for _ in range(2):
        run()
        assert rows(current_state(before, log, KEY, [history.VERSION])) == rows(cheaper)
        stored = changes.summarize(before, ["category"], "price")
        assert rows(current_summary(stored, deltas, ["category"])) == rows(changes.summarize(cheaper, ["category"], "price"))


def test_nothing_streamed_yet(spark, before):
    assert rows(current_state(before, scratch_path(spark, "none"), KEY, [history.VERSION])) == rows(before)
