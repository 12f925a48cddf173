import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F

from stockpond.catalog import QUERIES
from stockpond.operators.asof import asof_join, latest_features, leakage_report
from stockpond.operators.keyed_scan import (
    key_minimum,
    keyed_scan,
    last_known,
    previous_value,
    prior_sum,
    running_sum,
    sequence_number,
)
from stockpond.operators.ordering import fixed_sample, global_row_number, global_running_sums, hash_split
from stockpond.plans import drift, features, forecast, models
from stockpond.session import materialize, scratch_path


def skewed_rows(seed, n=600):
    """One key with a third of the rows, spread over days with many equal times; some NULLs."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 7 if rng.random() < 0.34 else rng.choice([1, 2, 3, 4, 5, 6, None])
        day = None if rng.random() < 0.02 else f"2026-03-{rng.randint(1, 20):02d} {rng.randint(0, 3):02d}:00:00"
        value = None if rng.random() < 0.1 else rng.randint(-5, 20)
        rows.append((key, day, i, value, rng.choice(["a", "b", None])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_keyed_scan_equals_plain_windows(spark, seed):
    raw = spark.createDataFrame(skewed_rows(seed), "k int, ts string, id int, v int, p string")
    df = raw.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    w = Window.partitionBy("k").orderBy("ts", "id")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    expected = df.select(
        "id",
        F.row_number().over(w).cast("bigint").alias("n"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("total"),
        F.sum("v").over(before).alias("prior"),
        F.lag("p").over(w).alias("prev"),
        F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("known"),
        F.min("ts").over(Window.partitionBy("k")).alias("first"),
    )
    got = keyed_scan(
        df,
        ["k"],
        ["ts", "id"],
        [
            sequence_number("n"),
            running_sum("total", "v"),
            prior_sum("prior", "v"),
            previous_value("prev", "p"),
            last_known("known", "v"),
            key_minimum("first", "ts"),
        ],
    )
    assert sorted(got.select(expected.columns).collect(), key=lambda r: r.id) == sorted(expected.collect(), key=lambda r: r.id)


def test_asof_takes_the_largest_of_equal_times(spark):
    at = F.lit("2026-01-01").cast("timestamp_ntz")
    feats = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (1, 7, "c")], "k int, v int, f string").withColumn("ts", at)
    spine = spark.createDataFrame([(1, 0), (2, 0), (None, 1)], "k int, label int").withColumn("ts", at)
    assert {r.k: r.f for r in asof_join(spine, feats, "k", "ts", ["f"], tie_break="v").collect()} == {1: "b", 2: None, None: None}


def frames(spark, seed):
    rng = random.Random(seed)
    at = lambda: pd.Timestamp("2026-01-01") + pd.Timedelta(hours=rng.randint(0, 200))
    feats = pd.DataFrame([(rng.choice([1, 1, 1, 2, 3]), at(), float(i)) for i in range(150)], columns=["k", "ts", "f"]).drop_duplicates(["k", "ts"])
    spine = pd.DataFrame([(rng.choice([1, 1, 2, 3, 4]), at(), i) for i in range(200)], columns=["k", "ts", "label"])
    return feats, spine


@pytest.mark.parametrize("seed", range(3))
def test_asof_against_merge_asof(spark, seed):
    feats, spine = frames(spark, seed)
    as_ntz = lambda pdf: spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = asof_join(as_ntz(spine), as_ntz(feats), "k", "ts", ["f"]).toPandas()
    expected = pd.merge_asof(spine.sort_values("ts"), feats.sort_values("ts"), on="ts", by="k")
    merged = got.merge(expected, on="label", suffixes=("", "_expected"))
    assert len(got) == len(spine) == len(merged)
    assert np.array_equal(merged.f.fillna(-1), merged.f_expected.fillna(-1))


def test_plain_join_leaks(spark):
    feats = spark.createDataFrame([(1, "2026-01-01", 1.0), (1, "2026-01-03", 2.0)], "k int, ts string, f double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    spine = spark.createDataFrame([(1, "2026-01-02", 0), (1, "2026-01-04", 1)], "k int, ts string, label int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert {r.label: r.f for r in asof_join(spine, feats, "k", "ts", ["f"]).collect()} == {0: 1.0, 1: 2.0}
    assert latest_features(feats, "k", "ts", ["f"]).first().f == 2.0
    row = leakage_report(spine, feats, "k", "ts").first()
    assert (row.rows, row.leaked_rows) == (2, 1)


EVENT_SCHEMA = "customer_id int, order_id int, ts string, order_priority string, order_value decimal(18,2), is_fulfilled int"


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        (1, 10, "2026-01-01", "2-HIGH", 100, 1),
        (1, 11, "2026-01-05", "5-LOW", 50, 0),
        (1, 12, "2026-01-05", "1-URGENT", 70, 0),
        (1, 13, "2026-02-01", "2-HIGH", 10, 1),
        (2, 20, "2026-01-09", "5-LOW", 5, 0),
    ]
    from decimal import Decimal

    rows = [(*r[:4], Decimal(r[4]), r[5]) for r in rows]
    return spark.createDataFrame(rows, EVENT_SCHEMA).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_prior_features(events):
    got = {r.order_id: r for r in features.prior_order_features(events).collect()}
    assert [float(got[i].prior_spend) for i in (10, 11, 12, 13, 20)] == [0, 100, 150, 220, 0]
    assert [got[i].days_since_first_order for i in (10, 11, 12, 13, 20)] == [0, 4, 4, 31, 0]
    assert [got[i].prior_priority for i in (10, 11, 12, 13, 20)] == ["NONE", "2-HIGH", "5-LOW", "1-URGENT", "NONE"]


def test_same_time_orders_share_the_leak_free_features(events):
    rows = {(r.customer_id, str(r.ts)[:10]): r for r in features.feature_table(events).collect()}
    assert len(rows) == 4
    assert rows[(1, "2026-01-05")].log_prior_spend == pytest.approx(np.log1p(100))
    training = features.training_set(events, features.feature_table(events))
    assert training.count() == 5
    assert {r.order_id: round(np.expm1(r.log_prior_spend)) for r in training.collect()} == {10: 0, 11: 100, 12: 100, 13: 220, 20: 0}


def test_encoders(spark):
    fitted = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "p string")
    seen = spark.createDataFrame([("a",), ("z",), ("c",), (None,)], "p string")
    vocabulary = features.fit_ordinal(fitted, "p")
    assert [r.o for r in features.transform_ordinal(seen, vocabulary, "p", "o").collect()] == [0, -1, 2, -1]
    encoded = features.fit_one_hot(fitted, "p", "v").transform(seen.where("p IS NOT NULL")).select(vector_to_array("v").alias("v"))
    assert [r.v for r in encoded.collect()] == [[1, 0, 0], [0, 0, 0], [0, 0, 1]]


def test_scaling_of_a_constant(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "v int, c int")
    rows = features.standard_scale(df, {"v": "vs", "c": "cs"}).collect()
    assert [r.cs for r in rows] == [0.0] * 3
    assert [r.vs for r in rows] == pytest.approx([-np.sqrt(1.5), 0, np.sqrt(1.5)])


def view_rows(spark, root):
    return sorted(features.read_feature_view(spark, root, "v", 1).select("customer_id", "ts", *features.FEATURES).collect())


def test_view_refresh_takes_late_rows(spark, events):
    root = scratch_path(spark, "view-test")
    vocabulary = features.fit_ordinal(features.prior_order_features(events), "prior_priority")

    def compute(rows):
        return features.first_per_time(features.transform_ordinal(features.prior_order_features(rows), vocabulary, "prior_priority", "priority_ordinal"))

    everything = sorted(compute(events).select("customer_id", "ts", *features.FEATURES).collect())
    oldest = events.orderBy("ts", "order_id").first().order_id
    part = events.where(F.col("order_id") != oldest).where("ts < '2026-01-20'")
    assert features.refresh_feature_view(part, compute, root, "v", 1)
    assert len(view_rows(spark, root)) < len(everything)
    assert features.refresh_feature_view(events, compute, root, "v", 1)
    assert view_rows(spark, root) == everything
    assert not features.refresh_feature_view(events, compute, root, "v", 1)
    assert view_rows(spark, root) == everything


def test_view_refresh_notices_corrected_and_removed_events(spark, events):
    root = scratch_path(spark, "view-test")
    vocabulary = features.fit_ordinal(features.prior_order_features(events), "prior_priority")

    def compute(rows):
        return features.first_per_time(features.transform_ordinal(features.prior_order_features(rows), vocabulary, "prior_priority", "priority_ordinal"))

    first = events.orderBy("ts", "order_id").first()
    one = F.col("order_id") == first.order_id
    types = dict(events.dtypes)
    dearer = events.withColumn("order_value", F.when(one, F.col("order_value") + 10).otherwise(F.col("order_value")).cast(types["order_value"]))
    moved = dearer.withColumn("ts", F.when(one, F.col("ts") + F.expr("INTERVAL 400 DAYS")).otherwise(F.col("ts")).cast(types["ts"]))
    without = moved.where(F.col("customer_id") != first.customer_id)
    for state in (events, dearer, moved, without, events):
        assert features.refresh_feature_view(state, compute, root, "v", 1)
        assert view_rows(spark, root) == sorted(compute(state).select("customer_id", "ts", *features.FEATURES).collect())
        assert not features.refresh_feature_view(state, compute, root, "v", 1)


def test_a_killed_refresh_changes_nothing(spark, events, monkeypatch):
    root = scratch_path(spark, "view-test")
    features.refresh_feature_view(events.where("ts < '2026-01-20'"), features.feature_table, root, "v", 1)
    before = view_rows(spark, root)

    class Killed(Exception):
        pass

    writer = type(events.write)
    parquet = writer.parquet

    def dies(self, path, *args, **kwargs):
        if path.endswith("/pointer"):
            raise Killed
        return parquet(self, path, *args, **kwargs)

    monkeypatch.setattr(writer, "parquet", dies)
    with pytest.raises(Killed):
        features.refresh_feature_view(events, features.feature_table, root, "v", 1)
    monkeypatch.undo()
    assert view_rows(spark, root) == before
    assert features.refresh_feature_view(events, features.feature_table, root, "v", 1)
    assert len(view_rows(spark, root)) == features.feature_table(events).count()


def test_profile(spark):
    df = spark.createDataFrame([(1, None, 0), (2, 5, 0), (2, 6, 0)], "k int, v int, c int")
    rows = {r.column: r for r in features.table_profile(df, "k").collect()}
    assert (rows["v"].nulls, rows["c"].constant, rows["v"].constant, rows["k"].rows, rows["k"]["keys"]) == (1, True, False, 3, 2)


# --- global order -----------------------------------------------------------------------


def test_global_row_number(spark):
    df = spark.range(5000).withColumn("v", F.col("id") % 7).repartition(6)
    got = global_row_number(df, ["v", "id"], "n").toPandas().sort_values("n")
    assert list(got.n) == list(range(1, 5001))
    assert list(zip(got.v, got.id)) == sorted(zip(got.v, got.id))
    assert global_row_number(df.where("id < 0"), ["v", "id"]).count() == 0


def test_global_running_sums(spark):
    df = spark.range(1000).withColumn("one", F.lit(1))
    got = global_running_sums(df, ["id"], {"seen": "one", "total": "id"}).toPandas().sort_values("id")
    assert list(got.seen) == list(range(1, 1001)) and list(got.total) == list(np.cumsum(range(1000)))


def test_sample_and_split_do_not_depend_on_partitions(spark):
    df = spark.range(2000)
    samples = [sorted(r.id for r in fixed_sample(df.repartition(n), ["id"], 50).collect()) for n in (1, 7)]
    assert samples[0] == samples[1] and len(samples[0]) == 50
    train, test = hash_split(df, ["id"], 80)
    assert train.count() + test.count() == 2000 and 0.75 < train.count() / 2000 < 0.85


# --- series and drift -------------------------------------------------------------------


def test_forecast_of_a_weekly_pattern(spark):
    days = pd.date_range("2026-01-01", periods=70)
    y = [100 + 2 * i + (30 if d.dayofweek == 6 else -5) for i, d in enumerate(days)]
    series = spark.createDataFrame([(d.date(), float(v)) for d, v in zip(days, y)], "ts date, y double")
    ahead = forecast.forecast(series, 14).orderBy("ts").collect()
    assert len(ahead) == 14 and str(ahead[0].ts) == "2026-03-12"
    for r in ahead:
        i = (pd.Timestamp(r.ts) - days[0]).days
        assert r.forecast == pytest.approx(100 + 2 * i + (30 if pd.Timestamp(r.ts).dayofweek == 6 else -5), abs=3)
        assert r.lower_bound <= r.forecast <= r.upper_bound


def test_calendar_gap_counts_zero(spark):
    series = spark.createDataFrame([("a", "2026-01-01", 5.0), ("a", "2026-01-03", 7.0)], "k string, ts string, y double").withColumn("ts", F.to_date("ts"))
    assert [r.y for r in forecast.complete_calendar(series, ["k"]).orderBy("ts").collect()] == [5.0, 0.0, 7.0]


def test_anomaly(spark):
    days = pd.date_range("2026-01-01", periods=100)
    rows = [(d.date(), 500.0 if i == 50 else 100.0 + i % 3) for i, d in enumerate(days)]
    found = forecast.anomalies(spark.createDataFrame(rows, "ts date, y double")).collect()
    assert [str(r.ts) for r in found] == ["2026-02-20"]


def test_drift_of_equal_and_shifted_data(spark):
    reference = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    same = drift.population_stability(reference, reference, "x").first()
    assert same.psi == pytest.approx(0) and not same.alert
    shifted = reference.select((F.col("x") + 400).alias("x"))
    moved = drift.population_stability(reference, shifted, "x").first()
    assert moved.alert
    assert drift.kolmogorov_smirnov(reference, shifted, "x").first().ks == pytest.approx(0.4)
    constant = reference.select(F.lit(1.0).alias("x"))
    assert drift.population_stability(constant, constant, "x").first().psi == pytest.approx(0)


def test_trailing_f1(spark):
    rows = [("2026-01-01", 1, 1), ("2026-01-01", 0, 1), ("2026-01-20", 1, 0), ("2026-03-01", 1, 1)]
    scored = spark.createDataFrame(rows, "ts string, y int, p int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {str(r.day): (r.f1, r.alert) for r in drift.trailing_f1(scored, "ts", "y", "p", 0.9).collect()}
    assert got == {"2026-01-01": (pytest.approx(2 / 3), True), "2026-01-20": (0.5, True), "2026-03-01": (1.0, False)}


# --- models -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(400).select(
        "id", (F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"), (F.col("id") % 20 >= 10).cast("int").alias("y")
    )


def test_forest_and_metrics(labelled):
    scored = models.forest(["x", "z"], "y").fit(labelled).transform(labelled)
    assert models.accuracy(scored, "y").first().accuracy == 1.0
    assert models.f1_of(scored, "y").first().f1 == 1.0 == models.f1_evaluator("y").evaluate(scored)
    assert models.auc_evaluator("y").evaluate(scored) == pytest.approx(1.0)


def test_f1_matches_the_evaluator(spark):
    scored = spark.createDataFrame([(1, 1.0), (1, 0.0), (0, 1.0), (0, 0.0), (1, 1.0)], "y int, predicted double")
    assert models.f1_of(scored, "y").first().f1 == pytest.approx(models.f1_evaluator("y").evaluate(scored))


def test_search(labelled):
    best, results = models.grid_search(labelled, ["x", "z"], "y", ["id"], {"numTrees": [2, 5], "maxDepth": [1, 3]}, folds=3)
    assert results.count() == 4 and results.first().f1 == pytest.approx(1.0)
    assert models.f1_of(best.transform(labelled), "y").first().f1 == pytest.approx(1.0)


def test_forest_sees_rows_only_through_their_marks(spark):
    rows = spark.range(30_000).select(
        (F.rand(3) * F.rand(4)).alias("x"), (F.col("id") % 3).cast("int").alias("z"), (F.col("id") % 40).cast("int").alias("k"), "id"
    )
    rows = materialize(rows.withColumn("y", (F.col("x") + F.rand(5) / 5 > 0.3).cast("int")), "marked-rows")
    counted = models.cells(rows, ["x", "z", "k"], "y", 32, F.col("id") % 2)
    assert counted.agg(F.sum("_n")).first()[0] == 30_000 and counted.select("_x0").distinct().count() <= 32 and counted.select("_x1").distinct().count() == 3
    packed = models.packets(counted, "y")
    whole = counted.groupBy("y", "_x0", "_x1", "_x2").agg(F.sum("_n").alias("_n"))
    assert packed.count() == whole.agg(F.sum(F.least("_n", F.lit(models.PACKETS)))).first()[0] and packed.agg(F.sum("_weight")).first()[0] == 30_000
    model = models.forest(["x", "z", "k"], "y", trees=5, depth=4).fit(rows)
    chosen = models.marks(rows.select(F.col("x").alias("_x0")), ["_x0"], 32)["_x0"]
    moved = model.transform(rows).select("id", "z", "k", F.col("predicted").alias("plain"), models.nearest_mark("x", chosen).alias("x"))
    assert model.transform(moved).where("plain <> predicted").count() == 0
    assert models.accuracy(model.transform(rows), "y").first().accuracy > 0.8


def test_search_learns_from_counts(spark, monkeypatch):
    tables, plain = [], models.materialize
    monkeypatch.setattr(models, "materialize", lambda df, name: tables.append((name, plain(df, name))) or tables[-1][1])
    rows = spark.range(20_000).select("id", (F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 20 >= 10).cast("int").alias("y"))
    best, results = models.grid_search(rows, ["x"], "y", ["id"], {"numTrees": [2], "maxDepth": [1, 3]}, folds=2)
    assert [r.f1 for r in results.collect()] == [1.0, 1.0] and models.accuracy(best.transform(rows), "y").first().accuracy == 1.0
    assert max(t.count() for name, t in tables if name == "packets") == 20 * models.PACKETS


def test_forests_from_one_count_are_those_of_their_own_fits(spark, labelled, monkeypatch):
    learners = [models.forest(["x", "z"], "y", trees=3, depth=4, min_leaf=2), models.forest(["x", "z"], "y", trees=2, depth=3)]
    apart = [learner.fit(labelled) for learner in learners]
    counted, cells = [], models.cells
    monkeypatch.setattr(models, "cells", lambda *rest: counted.append(1) or cells(*rest))
    together = models.fit_all(learners, labelled)
    assert len(counted) == 1
    assert [m.stages[-1].toDebugString.split("\n", 1)[1] for m in together] == [m.stages[-1].toDebugString.split("\n", 1)[1] for m in apart]
    with pytest.raises(ValueError):
        models.fit_all([*learners, models.forest(["x"], "y")], labelled)


@pytest.mark.parametrize("name", ["batch_scores", "champion_challenger"])
def test_queries_of_two_forests_count_once(spark, sf_dir, monkeypatch, name):
    counted, cells = [], models.cells
    monkeypatch.setattr(models, "cells", lambda *rest: counted.append(1) or cells(*rest))
    assert QUERIES[name](spark, sf_dir).count() > 0 and len(counted) == 1


def test_registry(spark, labelled):
    root = scratch_path(spark, "models-test")
    good = models.forest(["x", "z"], "y").fit(labelled)
    flipped = labelled.withColumn("y", 1 - F.col("y"))
    bad = models.forest(["x", "z"], "y").fit(flipped)
    models.log_model(good, root, "m", "v1", {"f1": 1.0})
    models.log_model(bad, root, "m", "v2", {"f1": 0.0})
    with pytest.raises(ValueError):
        models.log_model(bad, root, "m", "v2")
    with pytest.raises(ValueError):
        models.set_alias(spark, root, "m", "v9")
    with pytest.raises(ValueError):
        models.resolve(spark, root, "m")
    for version, expected in (("v1", 1.0), ("v2", 0.0), ("v1", 1.0)):
        models.set_alias(spark, root, "m", version)
        scores = models.batch_scores(labelled, root, "m", ["id", "y"])
        assert models.accuracy(scores, "y", "prediction").first().accuracy == expected
    row = models.champion_challenger(labelled, good, bad, "y").first()
    assert (row.champion_f1, row.challenger_f1, row.promote) == (1.0, 0.0, False)
