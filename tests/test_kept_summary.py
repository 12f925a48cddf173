"""Summaries in buckets against computing them anew."""

import random

import pytest
from pyspark.sql import functions as F

from stockpond.operators import changes, kept_summary
from stockpond.session import scratch_path

KEY = ["id"]


def rows(df):
    return sorted(df.collect(), key=repr)


def versions(spark, seed, n=200):
    rng = random.Random(seed)
    made, current = [], {i: (f"g{rng.randrange(20)}", rng.choice([None, 1, 2, 5])) for i in range(n)}
    for _ in range(4):
        made.append(spark.createDataFrame([(i, *v) for i, v in current.items()], "id int, grp string, v int"))
        for i in rng.sample(sorted(current), n // 20):
            if rng.random() < 0.4:
                del current[i]
            else:
                current[i] = (rng.choice([None, "g1", "new"]), rng.choice([None, 7]))
    return made


def log_of(made):
    feeds = [changes.change_feed(a, b, KEY).withColumn("_version", F.lit(i).cast("bigint")) for i, (a, b) in enumerate(zip(made, made[1:]), 1)]
    log = feeds[0]
    for feed in feeds[1:]:
        log = log.unionByName(feed)
    return log


@pytest.mark.parametrize("buckets, additions", [(1, 0), (16, 0), (16, 1)])
def test_refresh_equals_computing_anew(spark, buckets, additions):
    made, root = versions(spark, buckets), scratch_path(spark, "kept")
    log = log_of(made).cache()
    kept_summary.create(made[0], root, ["grp"], "v", 0, buckets)
    for upto in (1, 2, 3):
        assert kept_summary.refresh(log, root, "_version", upto, additions) > 0
        assert rows(kept_summary.read(spark, root)) == rows(changes.summarize(made[upto], ["grp"], "v"))
        assert kept_summary.refresh(log, root, "_version", upto) == 0
    named = kept_summary.read(spark, root).inputFiles()
    assert kept_summary.forget_superseded(spark, root) > 0
    assert sorted(kept_summary.read(spark, root).inputFiles()) == sorted(named)
    assert rows(kept_summary.read(spark, root)) == rows(changes.summarize(made[3], ["grp"], "v"))
    assert spark.read.schema(kept_summary.POINTER).parquet(f"{root}/pointer").count() == 1


def test_only_touched_buckets_are_written(spark):
    old = spark.createDataFrame([(i, f"g{i % 50}", i) for i in range(500)], "id int, grp string, v int")
    new = changes.update_where(old, F.col("id") == 7, {"v": F.lit(1000)})
    root = scratch_path(spark, "kept")
    kept_summary.create(old, root, ["grp"], "v", 0, 32)
    before = set(kept_summary.read(spark, root).inputFiles())
    assert kept_summary.refresh(log_of([old, new]), root, "_version", 1, additions=0) == 1
    assert len(before - set(kept_summary.read(spark, root).inputFiles())) == 1
    assert rows(kept_summary.read(spark, root)) == rows(changes.summarize(new, ["grp"], "v"))


def test_a_refresh_adds_one_small_part(spark):
    old = spark.createDataFrame([(i, f"g{i % 50}", i) for i in range(500)], "id int, grp string, v int")
    new = changes.update_where(old, F.col("id") == 7, {"v": F.lit(1000)})
    root = scratch_path(spark, "kept")
    kept_summary.create(old, root, ["grp"], "v", 0, 32)
    before = set(kept_summary.read(spark, root).inputFiles())
    kept_summary.refresh(log_of([old, new]), root, "_version", 1)
    after = set(kept_summary.read(spark, root).inputFiles())
    assert before < after and len(after) == len(before) + 1
    assert rows(kept_summary.read(spark, root)) == rows(changes.summarize(new, ["grp"], "v"))


def test_emptied_and_empty_tables(spark):
    full = spark.createDataFrame([(1, "a", 5), (2, None, None)], "id int, grp string, v int")
    empty, root = full.where("false"), scratch_path(spark, "kept")
    log = log_of([empty, full, empty]).cache()
    kept_summary.create(empty, root, ["grp"], "v", 0, 4)
    assert kept_summary.read(spark, root).count() == 0
    kept_summary.refresh(log, root, "_version", 1)
    assert rows(kept_summary.read(spark, root)) == rows(changes.summarize(full, ["grp"], "v"))
    kept_summary.refresh(log, root, "_version", 2)
    assert kept_summary.read(spark, root).count() == 0


def test_a_run_that_died_changes_nothing(spark):
    old = spark.createDataFrame([(1, "a", 5)], "id int, grp string, v int")
    root = scratch_path(spark, "kept")
    kept_summary.create(old, root, ["grp"], "v", 0, 4)
    old.selectExpr("grp", "1L row_count", "1L value_count", "9L total", "0 _bucket").write.partitionBy("_bucket").parquet(f"{root}/rows/run=dead")
    assert rows(kept_summary.read(spark, root)) == rows(changes.summarize(old, ["grp"], "v"))


def test_feed_by_range_equals_the_plain_feed(spark):
    made = versions(spark, 5)
    for old, new in ((made[0], made[1]), (made[1], made[1]), (made[2].where("false"), made[3]), (made[3], made[0].where("false"))):
        assert rows(changes.change_feed_by_range(old, new, KEY, F.expr("id div 10"))) == rows(changes.change_feed(old, new, KEY))
    kept = changes.range_digests(made[0], F.expr("id div 10"))
    assert rows(changes.change_feed_by_range(made[0], made[1], KEY, F.expr("id div 10"), kept)) == rows(changes.change_feed(made[0], made[1], KEY))


def test_digests_see_a_value_that_moves_beside_a_null(spark):
    old = spark.createDataFrame([(1, None, 5), (None, 2, 2)], "id int, a int, b int")
    new = spark.createDataFrame([(1, 5, None), (None, 2, 2)], "id int, a int, b int")
    assert changes.change_feed_by_range(old, new, KEY, F.col("id")).count() == 2
    assert changes.changed_ranges(*[changes.range_digests(df, F.col("id")) for df in (old, new)]).collect() == [(1,)]
    with pytest.raises(ValueError):
        changes.range_digests(old.withColumn("s", F.struct("a")), F.col("id"))
