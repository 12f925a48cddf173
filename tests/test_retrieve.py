import math
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from fixtures import HELP_TEXTS, INVOICE, money
from stockpond.operators import retrieve

QUESTIONS = [
    (1, "How long do I have to return a laptop?", "faq-returns"),
    (2, "What does the laptop hardware warranty cover?", "faq-warranty"),
    (3, "Do analysts see unmasked customer emails?", "policy-masking"),
    (4, "how long does desk assembly take?", "faq-desk"),
    (5, "Is it so?", "policy-privacy"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(HELP_TEXTS, "doc_id string, text string, source string")


@pytest.fixture(scope="module")
def questions(spark):
    return spark.createDataFrame([q[:2] for q in QUESTIONS], "question_id int, question string")


@pytest.fixture(scope="module")
def hits(questions, docs):
    return retrieve.keyword_retrieve(questions, docs, 3)


def test_expected_documents_are_found(spark, hits):
    expected = spark.createDataFrame([(q[0], q[2]) for q in QUESTIONS], "question_id int, doc_id string")
    assert all(r.retrieved for r in retrieve.recall_at_k(hits, expected, 3).collect())
    assert retrieve.recall_at_k(hits, expected.withColumn("doc_id", F.lit("none")), 3).where("retrieved").count() == 0


def test_answers_quote_and_cite(spark, hits, docs, questions):
    asked = questions.unionByName(spark.createDataFrame([(9, "zzzz?")], "question_id int, question string"))
    answers = {r.question_id: r.answer for r in retrieve.extractive_answers(asked, retrieve.with_text(hits, docs)).collect()}
    assert answers[2].endswith("[faq-warranty]") and answers[2].startswith("Every laptop")
    assert answers[9] == retrieve.NO_ANSWER


def test_prompt(spark, hits, docs, questions):
    prompts = {r.question_id: r.prompt for r in retrieve.prompts(questions, retrieve.with_text(hits, docs)).collect()}
    assert prompts[4].startswith(retrieve.SYSTEM_TEXT)
    assert "[faq-desk] (faq) Desk assembly" in prompts[4]
    assert prompts[4].endswith("Question: how long does desk assembly take?\nAnswer:")


def test_source_filter(spark, questions, docs):
    vectors = spark.createDataFrame([("policy-masking", [1.0, 0.0])], "doc_id string, vector array<double>")
    asked = questions.withColumn("vector", F.array(F.lit(2.0), F.lit(0.0)))
    found = retrieve.hybrid_retrieve(asked, docs, vectors, 3, "policy").collect()
    assert found and all(r.doc_id.startswith("policy") for r in found)


def test_recall_scans_the_texts_once(spark, sf_dir, monkeypatch):
    scans, plain = [], retrieve.matched_tokens
    monkeypatch.setattr(retrieve, "matched_tokens", lambda *args: scans.append(1) or plain(*args))
    found = entry_points.queries()["recall_at_k"](spark, sf_dir).collect()
    assert found and len(scans) == 1


def test_vector_settles_equal_words(spark):
    docs = spark.createDataFrame([(1, "green apple", "s"), (2, "green apple", "s")], "doc_id int, text string, source string")
    asked = spark.createDataFrame([(1, "green apple", [0.0, 1.0])], "question_id int, question string, vector array<double>")
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 3.0])], "doc_id int, vector array<double>")
    assert [r.doc_id for r in retrieve.hybrid_retrieve(asked, docs, vectors, 2).orderBy("rank").collect()] == [2, 1]
    assert [r.doc_id for r in retrieve.keyword_retrieve(asked.drop("vector"), docs, 2).orderBy("rank").collect()] == [1, 2]


@pytest.mark.parametrize("seed", range(4))
def test_scores_against_brute_force(spark, seed):
    """Substring matches over random texts with long runs, accents and digits."""
    rng = random.Random(seed)
    syllables = ["ab", "cd", "ef", "gh", "é", "12", " ", "-", "AB", "x"]
    text = lambda n: "".join(rng.choice(syllables) for _ in range(n))
    docs = [(i, text(rng.randint(0, 80)), "s") for i in range(60)] + [(60, "abcd" * 500, "s")]
    questions = [(i, text(30)) for i in range(8)]

    def tokens(question):
        return [t for t in re.findall(r"[a-z0-9]+", question.lower()) if len(t) > 3][:6] or ["policy"]

    asked = {q: tokens(question) for q, question in questions}
    vocabulary = {t for ts in asked.values() for t in ts}
    df = {t: sum(t in d[1].lower() for d in docs) for t in vocabulary}
    weight = {t: round(math.log((1 + len(docs)) / (n + 0.5)) * 1e6) for t, n in df.items() if n}
    expected = {}
    for q, ts in asked.items():
        for doc_id, body, _ in docs:
            matched = [t for t in ts if t in body.lower()]
            if matched:
                expected[(q, doc_id)] = sum(weight[t] for t in matched)
    weights, matches = retrieve.question_weights(
        spark.createDataFrame(questions, "question_id int, question string"), spark.createDataFrame(docs, "doc_id int, text string, source string")
    )
    everything = retrieve.lexical_candidates(weights, matches, 1000)
    assert {(r.question_id, r.doc_id): r.score for r in everything.collect()} == expected
    best = retrieve.best_k(retrieve.lexical_candidates(weights, matches, 2), 2).collect()
    want = set()
    for q in asked:
        mine = sorted(((-s, d) for (other, d), s in expected.items() if other == q))[:2]
        want |= {(q, d, -s) for s, d in mine}
    assert {(r.question_id, r.doc_id, r.score) for r in best} == want


@pytest.mark.parametrize("n", [200, 2000])
def test_a_common_word_is_not_expanded(spark, n):
    """Every document has the common word, three have the rare ones: only these become candidates."""
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("common "), F.when(F.col("id") < 3, "quixotic zephyr").otherwise("other")).alias("text"))
    asked = spark.createDataFrame([(q, "common quixotic zephyr") for q in range(4)], "question_id int, question string")
    weights, matches = retrieve.question_weights(asked, docs)
    assert retrieve.lexical_candidates(weights, matches, 3).count() == 12


def test_vectors_bring_in_documents(spark):
    """No shared word: the k nearest vectors of the cells looked into are the hits."""
    docs = spark.createDataFrame([(i, f"text{i}", "s") for i in range(6)], "doc_id int, text string, source string")
    vectors = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)] + [(5, [-1.0, -9.0])], "doc_id int, vector array<double>")
    asked = spark.createDataFrame([(1, "nothing alike", [1.0, 4.0]), (2, "nothing alike", None)], "question_id int, question string, vector array<double>")
    found = [(r.question_id, r.doc_id) for r in retrieve.hybrid_retrieve(asked, docs, vectors, 3).orderBy("question_id", "rank").collect()]
    assert found == [(1, 4), (1, 3), (1, 2)]


def test_invoice(spark):
    docs = spark.createDataFrame([("inv-77", INVOICE), ("letter", "Dear customer"), ("bad", "Amount Due: 1.2.3")], "doc_id string, doc_text string")
    rows = {r.doc_id: r for r in retrieve.extract_fields(docs, "doc_text", retrieve.INVOICE_PATTERNS, ("amount_due",)).collect()}
    assert (rows["inv-77"].invoice_id, rows["inv-77"].due_date, rows["inv-77"].amount_due) == ("INV-77", "2027-01-31", money("45.90"))
    assert (rows["letter"].invoice_id, rows["letter"].due_date, rows["letter"].amount_due) == (None, None, None)
    assert rows["bad"].amount_due is None
