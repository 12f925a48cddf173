"""Past states from snapshots and tails against the whole log."""

import random

import pytest
from pyspark.sql import functions as F

from stockpond.operators import changes, history, kept_history
from stockpond.session import scratch_path

KEY = ["id"]


def rows(df):
    return sorted(df.collect(), key=repr)


def states(spark):
    rng = random.Random(3)
    current, made = {i: rng.choice([None, 1, 2]) for i in range(40)} | {None: 9}, []
    for step in range(6):
        made.append(spark.createDataFrame(list(current.items()), "id int, v int"))
        for i in rng.sample(range(40), 8):
            if i in current and rng.random() < 0.5:
                del current[i]
            else:
                current[i] = step + 10
    return made


@pytest.fixture(scope="module")
def made(spark):
    return [df.cache() for df in states(spark)]


def committed(spark, made, every):
    root = scratch_path(spark, "kept-log")
    feeds = [history.snapshot_as_changes(made[0])] + [changes.change_feed(a, b, KEY) for a, b in zip(made, made[1:])]
    for number, feed in enumerate(feeds):
        assert kept_history.commit(feed, root, KEY, F.lit(f"2026-01-0{number + 1} 12:00:00"), every) == number
    return root


@pytest.mark.parametrize("every", [1, 3, 10])
def test_states_equal_the_versions(spark, made, every):
    root = committed(spark, made, every)
    for version in (0, 2, 3, 5):
        assert rows(kept_history.state_of(spark, root, KEY, version)) == rows(made[version])
    assert rows(kept_history.state_at(spark, root, KEY, F.lit("2026-01-04 13:00:00"))) == rows(made[3])
    for early in (lambda: kept_history.state_of(spark, root, KEY, 6), lambda: kept_history.state_at(spark, root, KEY, F.lit("2025-01-01"))):
        with pytest.raises(ValueError):
            early()


def test_change_files_before_the_snapshot_are_not_read(spark, made):
    root = committed(spark, made, 2)
    kept = kept_history.state_of(spark, root, KEY, 4)
    assert not [f for f in kept.inputFiles() if "/log/" in f and "_version=4" not in f]
    assert not [f for f in kept_history.state_of(spark, root, KEY, 5).inputFiles() if "/log/" in f]
    for version in range(4):
        spark.createDataFrame([], "broken string").write.mode("overwrite").parquet(f"{root}/log/_version={version}")
    assert rows(kept_history.state_of(spark, root, KEY, 4)) == rows(made[4])


def test_a_commit_that_died_is_not_there(spark, made):
    root = committed(spark, made[:2], 10)
    feed = changes.change_feed(made[1], made[2], KEY)
    history.log_entry(feed, 2, F.lit("2026-01-03")).drop("_version").limit(3).write.parquet(f"{root}/log/_version=2")
    assert rows(kept_history.state_at(spark, root, KEY, F.lit("2026-02-01"))) == rows(made[1])
    assert kept_history.commit(feed, root, KEY, F.lit("2026-01-03"), 10) == 2
    assert rows(kept_history.state_at(spark, root, KEY, F.lit("2026-02-01"))) == rows(made[2])
