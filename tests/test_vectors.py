"""The inverted file against all pairs of vectors."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockpond.operators import vectors


def unit_sums(a, b):
    size = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
    return round(sum(x * y for x, y in zip(a, b)) / size * 1_000_000) if size else 0


def brute(questions, docs, k):
    out = set()
    for q, a in questions:
        ranked = sorted((-unit_sums(a, b), d) for d, b in docs if b is not None) if a is not None else []
        out |= {(q, d, -s, n + 1) for n, (s, d) in enumerate(ranked[:k])}
    return out


def frames(spark, questions, docs, id_type="bigint"):
    return (
        spark.createDataFrame(questions, "question_id bigint, vector array<double>"),
        spark.createDataFrame(docs, f"doc_id {id_type}, vector array<double>"),
    )


def found(df):
    rows = [tuple(r) for r in df.select("question_id", "doc_id", "score", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def clustered(seed, groups, each, size=16):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(groups, size))
    return [(i, (centres[i % groups] + 0.1 * draw.normal(size=size)).tolist()) for i in range(groups * each)]


@pytest.fixture(scope="module")
def looks(monkeypatch_module):
    """Shares of (question, vector) pairs that each scan scored."""
    shares, scan = [], vectors.scan

    def counted(index, questions, cells, k):
        sizes = np.r_[index.sizes, index.no_length]
        shares.append((cells * sizes).sum() / len(questions) / sizes.sum())
        return scan(index, questions, cells, k)

    monkeypatch_module.setattr(vectors, "scan", counted)
    return shares


@pytest.fixture(scope="module")
def monkeypatch_module():
    with pytest.MonkeyPatch.context() as patch:
        yield patch


def test_exact_search_prunes_cells(spark, looks):
    docs = clustered(1, 40, 25)
    asked, known = frames(spark, docs[::50], docs)
    index = vectors.build(known, 30)
    looks.clear()
    assert found(vectors.nearest(asked, index, 10, probes=1)) == brute(docs[::50], docs, 10)
    assert sum(looks) < 0.5
    # Every vector is in one cell, within its radius.
    assert index.sizes.sum() == len(docs) and index.table.count() == len(docs)


@pytest.mark.parametrize("settings", [{}, {"SAMPLE": 20, "QUESTIONS_AT_ONCE": 3, "HELD_ROWS": 5}])
def test_exact_search_without_structure(spark, settings, monkeypatch):
    for name, value in settings.items():
        monkeypatch.setattr(vectors, name, value)
    draw = random.Random(3)
    docs = [(i, [draw.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    docs += [(1000 + i, docs[0][1]) for i in range(50)] + [(2000 + i, [0.0] * 8) for i in range(30)] + [(3000, None)]
    questions = [(i, docs[i][1]) for i in range(6)] + [(7, [0.0] * 8), (8, None), (9, [-x for x in docs[0][1]])]
    asked, known = frames(spark, questions, docs)
    for k in (1, 20, 400):
        assert found(vectors.nearest(asked, vectors.build(known), k)) == brute(questions, docs, k)


def test_recall_of_the_approximate_search(spark, looks):
    """Embeddings of the given tables have no structure at all; their own vector is left out."""
    known = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    asked = known.where("doc_id % 10 = 0").withColumnRenamed("doc_id", "question_id")
    index = vectors.build(known)
    best = {(q, d) for q, d, _, _ in found(vectors.nearest(asked, index, 11)) if q != d}
    looks.clear()
    near = {(q, d) for q, d, _, _ in found(vectors.nearest(asked, index, 11, exact=False))}
    assert len(best & near) / len(best) >= 0.9 and sum(looks) < 0.7


def test_cells_that_hold_too_few_are_widened(spark):
    docs = clustered(4, 20, 3)
    asked, known = frames(spark, docs[:5], docs)
    hits = found(vectors.nearest(asked, vectors.build(known, 20), 10, exact=False, probes=1))
    assert all(sum(q == i for q, *_ in hits) == 10 for i in range(5))


def test_odd_tables(spark):
    asked, known = frames(spark, [(1, [1.0, 0.0])], [("b", [1.0, 0.0]), ("a", [2.0, 0.0]), ("é", [0.0, 1.0])], "string")
    assert found(vectors.nearest(asked, vectors.build(known), 2)) == {(1, "a", 1_000_000, 1), (1, "b", 1_000_000, 2)}
    assert vectors.nearest(asked, vectors.build(known.limit(0)), 2).count() == 0
    assert vectors.nearest(asked.limit(0), vectors.build(known), 2).count() == 0
    assert vectors.nearest(asked, vectors.build(known.withColumn("vector", F.lit(None).cast("array<double>"))), 2).count() == 0
