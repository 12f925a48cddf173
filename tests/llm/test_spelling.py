"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from llm.conftest import prose
from stockpond.llm import spelling

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    """Words of (doc_id, text) with one letter gone where 199 divides the checksum."""
    out = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'null' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                out[run] += 1
    return out


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def groups(words, fewest=5):
    words = {w: n for w, n in words.items() if n >= fewest}
    out = {}
    for w, n in words.items():
        around = [(-m, v) for v, m in words.items() if near(w, v)]
        best = min(around, default=None)
        ok = best is not None and -best[0] >= 5 * n
        out[w] = [n, len(around), best[1] if ok else None, -best[0] if ok else None]
    for w, row in out.items():
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        row.append(root)
    return {w: tuple(row) for w, row in out.items()}


def frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n bigint")


def found(df):
    rows = df.collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


def variants(seed, n, alphabet="abcde"):
    draw = random.Random(seed)
    words = Counter()
    while len(words) < n:
        word = "".join(draw.choice(alphabet) for _ in range(draw.randrange(6, 10)))
        for _ in range(6):
            words[word] += draw.choice([1, 5, 30, 200, 1200, 6000])
            i = draw.randrange(len(word))
            word = draw.choice([word[:i] + word[i + 1 :], word[:i] + draw.choice(alphabet) + word[i:], word[:i] + draw.choice(alphabet) + word[i + 1 :]])
            if len(word) < 6:
                break
    return words


@pytest.mark.parametrize("alphabet", ["ab", "abcde", "abcdefghijklmnopqrstuvwxyzàéÉ÷ÿ"])
def test_groups_against_all_pairs(spark, alphabet, monkeypatch):
    words = variants(1, 500, alphabet)
    want = groups(words)
    assert found(spelling.variant_groups(frame(spark, words))) == want
    assert alphabet == "ab" or any(r[-1] not in (w, r[2]) for w, r in want.items())  # chains of more than one step
    # Deep upper trees over a small part of the words lose nothing either.
    monkeypatch.setattr(spelling, "SAMPLE", 60)
    monkeypatch.setattr(spelling, "SAMPLE_LEAF", 2)
    monkeypatch.setattr(spelling, "LEAF", 1)
    monkeypatch.setattr(spelling, "PAIRS_AT_ONCE", 7)
    assert found(spelling.variant_groups(frame(spark, words))) == want


def test_reach_prunes_and_keeps():
    words = list(variants(2, 600, "abcdefgh"))
    counts = spelling.letter_counts(words)
    tree = spelling.LetterTree(counts, 8)
    at, leaf = tree.reach(counts, 0, 0)
    assert sorted(at) == list(range(len(words))) and tree.n_leaves > 30
    home = dict(zip(at, leaf))
    for fewer in (0, 1):
        rows, leaves = tree.reach(counts, fewer, 1)
        reached = set(zip(rows, leaves))
        for i in range(0, len(words), 17):
            apart = counts - counts[i]
            hit = np.flatnonzero((np.maximum(apart, 0).sum(axis=1) <= 1) & (np.maximum(-apart, 0).sum(axis=1) <= fewer))
            assert all((i, home[j]) in reached for j in hit)
        assert len(reached) < len(words) * tree.n_leaves / 2


def test_odd_words(spark):
    long = "ab" * 5000
    words = {"strasse": 9, "strase": 50, "trasse": 9, "aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "abcdef": 4, "bacdef": 5, "abcdfe": 5, long: 5, long + "a": 30, "×÷×÷×÷": 7, "×÷×÷×÷×": 35}
    assert found(spelling.variant_groups(frame(spark, words))) == groups(words)
    twice = frame(spark, words).unionByName(spark.createDataFrame([("strase", 3), (None, 9), ("", 9), ("trasse", None)], "word string, n bigint")).withColumn("root", F.lit("x"))
    assert found(spelling.variant_groups(twice)) == groups(words | {"strase": 53})
    assert spelling.variant_groups(twice.limit(0)).count() == 0


def test_many_words_of_the_same_letters(spark):
    """Anagrams share one vector, which no tree can divide."""
    draw = random.Random(4)
    words = {"".join(draw.sample("aabbccdd", 8)): draw.randrange(5, 90) for _ in range(700)} | {"".join(draw.sample("aabbccde", 8)): 100 for _ in range(300)}
    assert found(spelling.variant_groups(frame(spark, words))) == groups(words)


def test_counts(spark, mixed, none, monkeypatch):
    for held in (spelling.HELD_CHARS, 100):
        monkeypatch.setattr(spelling, "HELD_CHARS", held)
        rows = spelling.run_counts(mixed, spoil=199).collect()
        assert {r.word: r.n for r in rows} == counted((r.doc_id, r.text) for r in mixed.collect())
    texts = [(i, "İstanbul KELVINKKELVIN Straße ÀÉÎõü×÷ÿ naïveté " + prose(i, 50).upper()) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert {r.word: r.n for r in spelling.run_counts(docs, spoil=199).collect()} == counted(texts)
    plain = Counter(w.translate(SMALL) for _, t in texts for w in re.findall("[A-Za-zÀ-ÿ]{6,}", t))
    assert {r.word: r.n for r in spelling.run_counts(docs).collect()} == plain
    assert spelling.run_counts(none).count() == 0


def test_query_against_all_pairs(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    (name,) = [n for n in entry_points.queries() if n.startswith("op11_")]
    df = entry_points.queries()[name](spark, sf_dir)
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"] and found(df) == groups(counted(texts))
