"""Forests as SQL text against the models they come from, in Spark and in another engine."""

import duckdb
import pytest
from pyspark.sql import functions as F

from stockpond.plans import forest_sql, models
from stockpond.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    made = spark.range(600).select(
        "id",
        F.when(F.col("id") % 11 != 0, (F.col("id") * 7 % 20).cast("double")).alias("x"),
        (F.col("id") * 13 % 29 / 3).alias("z y"),
        (F.col("id") % 5).cast("int").alias("k"),
        ((F.col("id") * 7 % 20 + F.col("id") * 13 % 29) % 3).cast("int").alias("three"),
    )
    return made.withColumn("two", (F.col("three") > 0).cast("int")).cache()


def stored(spark, rows, label, **size):
    root = scratch_path(spark, "forest")
    model = models.forest(["x", "z y", "k"], label, **size).fit(rows.dropna())
    models.log_model(model, root, "m", "v1")
    models.set_alias(spark, root, "m", "v1")
    return root, {r.id: int(r.predicted) for r in model.transform(rows).collect()}


@pytest.mark.parametrize("label, size", [("two", {"trees": 12, "depth": 5}), ("three", {"trees": 7, "depth": 6}), ("two", {"trees": 1, "depth": 0})])
def test_text_predicts_as_the_model(spark, rows, label, size):
    root, wanted = stored(spark, rows, label, **size)
    scored = forest_sql.batch_scores_by_sql(rows, root, "m", ["id"])
    assert {r.id: r.prediction for r in scored.collect()} == wanted
    assert size["depth"] == 0 or len(set(wanted.values())) > 1

    names = ['"x"', '"z y"', '"k"']
    votes = forest_sql.vote_sql(forest_sql.stored_nodes(spark, f"{root}/models/m/v1"), names)
    table = rows.toArrow()
    columns = ", ".join(f"{v} AS v{c}" for c, v in enumerate(votes))
    chosen = forest_sql.prediction_sql([f"v{c}" for c in range(len(votes))])
    found = duckdb.sql(f"SELECT id, {chosen} AS p FROM (SELECT id, {columns} FROM scored_rows)", connection=connected(table))
    assert dict(found.fetchall()) == wanted


def connected(table):
    con = duckdb.connect()
    con.register("scored_rows", table)
    return con


def test_sets_of_categories_and_ties(spark):
    leaf = lambda i, stats: {"id": i, "leftChild": -1, "rightChild": -1, "impurityStats": stats, "split": None}
    split = {"featureIndex": 0, "leftCategoriesOrThreshold": [0.0, 2.0], "numCategories": 3}
    tree = {0: {"id": 0, "leftChild": 1, "rightChild": 2, "impurityStats": [3.0, 3.0], "split": split}, 1: leaf(1, [1.0, 1.0]), 2: leaf(2, [0.0, 2.0])}
    votes = forest_sql.vote_sql({0: tree}, ["c"])
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (None,)], "c double").select("c", *[F.expr(v).alias(f"v{i}") for i, v in enumerate(votes)])
    assert [r.p for r in df.select(F.expr(forest_sql.prediction_sql(["v0", "v1"])).alias("p")).collect()] == [0, 1, 0, 1]
