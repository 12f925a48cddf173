"""Ranked word search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import prose
from stockpond.llm import bloom_search

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(SMALL))


def scored(items, docs):
    """{item row: {document row: score}}."""
    counts = [Counter(terms(t)) for _, t in docs]
    n_docs, total = sum(1 for c in counts if c), sum(c.total() for c in counts)
    df = Counter(w for c in counts for w in c)
    out = {}
    for i, (_, text) in enumerate(items):
        out[i] = {}
        for j, tf in enumerate(counts):
            m = 100 - 25 + (25 * tf.total() * n_docs) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 12 * m)) for w in terms(text) if w in tf)
            if score > 0:
                out[i][j] = score
    return out


def ranked(items, docs, k):
    out = Counter()
    for i, found in scored(items, docs).items():
        rows = sorted((-s, docs[j][0] is None, docs[j][0]) for j, s in found.items())[:k]
        out.update((items[i][0], n + 1, d, -s) for n, (s, _, d) in enumerate(rows))
    return out


def frames(spark, items, docs):
    return spark.createDataFrame(items, "item_id bigint, text string"), spark.createDataFrame(docs, "doc_id bigint, text string")


def found(df):
    return Counter(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(6)
    docs = [(i, prose(i, draw.choice([3, 20, 150, 600]))) for i in range(300)]
    docs += [(1000 + i, docs[i % 7][1]) for i in range(60)] + [(5, "common " * 900 + "rare"), (6, "RARE common été"), (7, "日本 étés x y"), (8, prose(8, 30_000))]
    docs += [(2000 + i, None) for i in range(3)] + [(2003, ""), (2004, " !? "), (None, docs[0][1])] + [docs[3]] * 3
    items = [(i, prose(i, 25)) for i in range(40)] + [(50, "rare common common"), (51, "été"), (51, "日本"), (52, None), (53, "?"), (None, prose(2, 20)), (54, "nowhere else"), (55, prose(9, 900))]
    return items, docs


@pytest.mark.parametrize("settings", [{}, {"MOST_DOCS": 8, "FIRST": 3, "TERMS_IN_RUN": 40, "TERMS_AT_ONCE": 200}, {"MOST_WIDTH": 256, "STRIPE_BYTES": 64, "LEVELS": 1}])
def test_search_against_all_scores(spark, corpus, settings, monkeypatch):
    for name, value in settings.items():
        monkeypatch.setattr(bloom_search, name, value)
    items, docs = corpus
    for k in (20, 3):
        assert found(bloom_search.search(*frames(spark, items, docs), k)) == ranked(items, docs, k)


def test_bounds_hold_and_exclude(corpus):
    items, docs = corpus
    scores = scored(items, docs)
    members = []
    for j, (_, text) in enumerate(docs):
        count = Counter(bloom_search.terms(text or ""))
        if count:
            members.append(bloom_search.Member(j, count.total(), bloom_search.term_hashes(list(count)), np.array(list(count.values()))))
    n_docs, total = len(members), sum(m.length for m in members)
    df = Counter(w for _, t in docs for w in set(terms(t)))
    weight = lambda w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
    asked = []
    for i, (_, text) in enumerate(items):
        words = Counter(w for w in terms(text) if w in df)
        asked.append((i, bloom_search.term_hashes([w.encode() for w in words]), np.array([weight(w) * n for w, n in words.items()], float)))
    short = [m for m in members if m.length < 300]
    rows = bloom_search.block_rows(0, 2048, short)
    ((matrix, keys, lengths),) = bloom_search.blocks([rows])
    assert keys.tolist() == [m.key for m in short] and lengths.tolist() == [m.length for m in short]
    hits = close = 0
    for i, hashes, weights in asked:
        if len(hashes):
            run = bloom_search.Run(hashes, [(i, np.arange(len(hashes)), weights)])
            ((_, bound),) = bloom_search.bounds(matrix, lengths, run, n_docs, total)
            for key, most in zip(keys, bound):
                assert most >= scores[i].get(int(key), 0)
                hits += 1
                close += most <= 2 * scores[i].get(int(key), 0) + 1000
    assert close > 0.5 * hits


def test_odd_tables(spark, mixed, none):
    items = spark.createDataFrame([(1, prose(1, 30))], "item_id bigint, text string").withColumn("key", F.lit("x")).withColumn("rank", F.lit("y"))
    rows = [(r.doc_id, r.text) for r in mixed.collect()]
    assert found(bloom_search.search(items, mixed.withColumn("key", F.lit("k")))) == ranked([(1, prose(1, 30))], rows, 20)
    assert bloom_search.search(items, none).count() == 0 and bloom_search.search(items.limit(0), mixed).count() == 0
    assert bloom_search.search(items, mixed.where("text IS NULL")).count() == 0
