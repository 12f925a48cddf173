"""A stored forest as SQL text: scoring that needs neither the model object nor Spark.

The text uses CASE, CAST and comparisons only. A missing feature counts as NaN, which is greater
than every threshold, as in the assembler of ``models.forest``.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockpond.plans.models import resolve


def _number(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def stored_features(spark: SparkSession, path: str) -> list[str]:
    """The columns that the stored model assembles, in their order; all must be numbers."""
    text = spark.read.text(f"{path}/stages/*_VectorAssembler_*/metadata").first()[0]
    return json.loads(text)["paramMap"]["inputCols"]


def stored_nodes(spark: SparkSession, path: str) -> dict[int, dict[int, dict]]:
    """The nodes of each tree by number: as many as the model has, whatever the data."""
    nodes = spark.read.parquet(f"{path}/stages/*_RandomForestClassifier_*/data")
    trees: dict[int, dict[int, dict]] = {}
    for row in nodes.select("treeID", "nodeData.*").collect():
        trees.setdefault(row.treeID, {})[row.id] = row.asDict(recursive=True)
    return trees


def _goes_left(split: dict, features: list[str]) -> str:
    value = f"COALESCE(CAST({features[split['featureIndex']]} AS DOUBLE), CAST('NaN' AS DOUBLE))"
    numbers = [_number(v) for v in split["leftCategoriesOrThreshold"]]
    if split["numCategories"] == -1:
        return f"{value} <= {numbers[0]}"
    return f"{value} IN ({', '.join(numbers)})" if numbers else "FALSE"


def _tree_vote(nodes: dict[int, dict], features: list[str], which: int, node: int = 0) -> str:
    """The share of class ``which`` in the leaf that a row reaches."""
    at = nodes[node]
    if at["leftChild"] < 0:
        total = reduce(add, at["impurityStats"], 0.0)
        return _number(at["impurityStats"][which] / total if total else 0.0)
    left, right = (_tree_vote(nodes, features, which, at[side]) for side in ("leftChild", "rightChild"))
    return f"CASE WHEN {_goes_left(at['split'], features)} THEN {left} ELSE {right} END"


def vote_sql(trees: dict[int, dict[int, dict]], features: list[str]) -> list[str]:
    """For each class the votes of all trees; ``features`` are column names or SQL expressions.

    Votes are added tree after tree, as the model adds them, so that near ties fall the same way.
    """
    classes = len(trees[0][0]["impurityStats"])
    return [" + ".join(["CAST('0' AS DOUBLE)", *(_tree_vote(trees[t], features, c) for t in sorted(trees))]) for c in range(classes)]


def prediction_sql(votes: list[str]) -> str:
    """The class with most votes, the lowest one of equals; ``votes`` are best names of columns that hold them."""
    cases = [
        f"WHEN {' AND '.join(f'{votes[c]} >= {other}' for other in votes[c + 1 :])} THEN {c}" for c in range(len(votes) - 1)
    ]
    return f"CASE {' '.join(cases)} ELSE {len(votes) - 1} END" if cases else "0"


def stored_votes(spark: SparkSession, path: str) -> list[str]:
    quoted = [f"`{f}`" for f in stored_features(spark, path)]
    return vote_sql(stored_nodes(spark, path), quoted)


def batch_scores_by_sql(df: DataFrame, root: str, name: str, keep: list[str], alias: str = "default") -> DataFrame:
    """``models.batch_scores`` from the stored nodes; columns named ``_vote0``, ``_vote1``… are not kept."""
    spark = df.sparkSession
    votes = stored_votes(spark, f"{root}/models/{name}/{resolve(spark, root, name, alias)}")
    names = [f"_vote{c}" for c in range(len(votes))]
    voted = df.withColumns({n: F.expr(v) for n, v in zip(names, votes)})
    return voted.select(*keep, F.expr(prediction_sql(names)).alias("prediction"))
