"""Spelling variants: words one edit apart, found by range searches in k-d trees over letter counts.

One inserted or deleted letter changes a word's letter counts by one, one replaced letter takes one
from a count and adds one to another: the vectors lie at L1 distance two at most. So per pair of
lengths (equal, or one apart) a k-d tree over the vectors is searched with that radius, boxes of the
tree that lie farther away are pruned, and the order of the letters is checked last.

1. An upper tree per length, fitted on the letter counts of at most ``SAMPLE`` words, deals all words:
   each word is a point of one of its leaves and a query to every leaf that its range reaches.
2. A task takes the points and queries of a leaf, builds the lower tree over the different vectors
   of its points and searches it. The trees only decide where to look; no pair is lost.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stockpond.session import materialize

# What a word is made of, by code points.
RUN = "[A-Za-zÀ-ÿ]"
LATIN, ACCENTED = (ord("a"), 26), (0xC0, 64)
LETTERS = LATIN[1] + ACCENTED[1]

SAMPLE = 50_000
SAMPLE_LEAF = 64  # sampled words in a leaf of an upper tree
LEAF = 24  # different vectors in a leaf of a lower tree
PAIRS_AT_ONCE = 1 << 14
CELLS_AT_ONCE = 1 << 22
HELD_CHARS = 1 << 23  # letters of the words that a task counts before it hands them on

FEWEST_LETTERS = 6
FEWEST = 5
RATIO = 5


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all letters in a row, and the lengths of the words."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    placed = np.where(codes < ACCENTED[0], codes - LATIN[0], codes - ACCENTED[0] + LATIN[1])
    return placed.astype(np.uint8), np.fromiter(map(len, words), np.int64, len(words))


def letter_counts(words: list[str]) -> np.ndarray:
    placed, lengths = letters(words)
    rows = np.repeat(np.arange(len(words)), lengths)
    return np.bincount(rows * LETTERS + placed, minlength=len(words) * LETTERS).reshape(-1, LETTERS).astype(np.int32)


class LetterTree:
    """A k-d tree over letter counts: inner nodes cut one letter's count, leaves are numbered."""

    def __init__(self, counts: np.ndarray, most: int):
        self.nodes: list[tuple[int, int, int, int]] = []  # letter, cut, node up to the cut, node above it; leaves: -1, leaf, 0, 0
        self.n_leaves = 0
        # A node is known to its parent before its children exist.
        work = [(np.arange(len(counts)), -1, 0)]
        while work:
            rows, parent, side = work.pop()
            if parent >= 0:
                node = list(self.nodes[parent])
                node[2 + side] = len(self.nodes)
                self.nodes[parent] = tuple(node)
            cut = self._cut(counts[rows]) if len(rows) > most else None
            if cut is None:
                self.nodes.append((-1, self.n_leaves, 0, 0))
                self.n_leaves += 1
                continue
            letter, value = cut
            below = counts[rows, letter] <= value
            here = len(self.nodes)
            self.nodes.append((letter, value, 0, 0))
            work += [(rows[~below], here, 1), (rows[below], here, 0)]

    @staticmethod
    def _cut(counts: np.ndarray) -> tuple[int, int] | None:
        """The letter that varies most and the count that halves the rows best; None where all are equal."""
        letter = int(np.argmax(counts.var(axis=0)))
        values = np.sort(counts[:, letter])
        if values[0] == values[-1]:
            return None
        cuts = np.flatnonzero(values[1:] != values[:-1])  # cut after one of these places
        at = cuts[np.argmin(np.abs(cuts + 1 - len(values) / 2))]
        return letter, int(values[at])

    def reach(self, counts: np.ndarray, fewer: int, more: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for the leaves whose box holds a vector at most ``fewer`` letters short of the row's and ``more`` beyond it."""
        rows_out, leaves_out = [], []
        start = np.zeros(len(counts), np.int32)
        work = [(0, np.arange(len(counts)), start, start, {}, {})]
        while work:
            node, rows, short, beyond, low, high = work.pop()
            if not len(rows):
                continue
            letter, cut, left, right = self.nodes[node]
            if letter < 0:
                rows_out.append(rows)
                leaves_out.append(np.full(len(rows), cut, np.int64))
                continue
            here = counts[rows, letter]
            # What the sides of the box cost on this letter so far, and with the new cut.
            was = np.maximum(here - high[letter], 0) if letter in high else 0
            now = short + np.maximum(here - cut, 0) - was
            keep = now <= fewer
            work.append((left, rows[keep], now[keep], beyond[keep], low, high | {letter: cut}))
            was = np.maximum(low[letter] - here, 0) if letter in low else 0
            now = beyond + np.maximum(cut + 1 - here, 0) - was
            keep = now <= more
            work.append((right, rows[keep], short[keep], now[keep], low | {letter: cut + 1}, high))
        if not rows_out:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(rows_out), np.concatenate(leaves_out)


def expand(first: np.ndarray, sizes_first: np.ndarray, second: np.ndarray, sizes_second: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of members of paired groups, given where their members begin, in bounded runs."""
    totals = sizes_first * sizes_second
    ends = np.cumsum(totals)
    for low in range(0, int(ends[-1]) if len(ends) else 0, PAIRS_AT_ONCE):
        place = np.arange(low, min(low + PAIRS_AT_ONCE, int(ends[-1])))
        pair = np.searchsorted(ends, place, side="right")
        inside = place - (ends[pair] - totals[pair])
        yield first[pair] + inside // sizes_second[pair], second[pair] + inside % sizes_second[pair]


def grouped(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different vectors, the rows ordered by vector, where each vector's rows begin there, and how many."""
    vectors, group = np.unique(counts, axis=0, return_inverse=True)
    group = group.ravel()
    sizes = np.bincount(group, minlength=len(vectors))
    return vectors, np.argsort(group, kind="stable"), np.cumsum(sizes) - sizes, sizes


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Per row, whether the words (letter numbers; equal lengths or one apart) differ by exactly one edit."""
    if short.shape[1] == long.shape[1]:
        return (short != long).sum(axis=1) == 1
    before = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    after = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return before + after >= short.shape[1]


def near_in_leaf(points: list[str], queries: list[str], fewer: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, point) numbers of words one edit apart. Points have one length, queries the same (``fewer`` 1) or one less (0)."""
    if not points or not queries:
        return
    p_vectors, p_rows, p_start, p_size = grouped(letter_counts(points))
    q_vectors, q_rows, q_start, q_size = grouped(letter_counts(queries))
    p_words = letters(points)[0].reshape(len(points), -1)
    q_words = letters(queries)[0].reshape(len(queries), -1)
    tree = LetterTree(p_vectors, LEAF)
    home = np.empty(len(p_vectors), np.int64)
    at, leaf = tree.reach(p_vectors, 0, 0)
    home[at] = leaf
    by_leaf = np.argsort(home, kind="stable")
    leaf_size = np.bincount(home, minlength=tree.n_leaves)
    leaf_start = np.cumsum(leaf_size) - leaf_size
    asked, found = tree.reach(q_vectors, fewer, 1)
    one = np.ones(len(asked), np.int64)
    for q, p in expand(np.arange(len(asked)), one, leaf_start[found], leaf_size[found]):
        q, p = asked[q], by_leaf[p]
        apart = p_vectors[p] - q_vectors[q]
        near = (np.maximum(apart, 0).sum(axis=1) == 1) & (np.maximum(-apart, 0).sum(axis=1) == fewer)
        q, p = q[near], p[near]
        for a, b in expand(q_start[q], q_size[q], p_start[p], p_size[p]):
            a, b = q_rows[a], p_rows[b]
            step = max(1, CELLS_AT_ONCE // p_words.shape[1])
            for i in range(0, len(a), step):
                x, y = a[i : i + step], b[i : i + step]
                edit = one_edit(q_words[x], p_words[y])
                if edit.any():
                    yield x[edit], y[edit]


def texts(values) -> pd.Series:
    """A plain column of strings: others may come in several pieces, which Arrow takes back in one only."""
    return pd.Series(values, dtype=object)


def run_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", spoil: int = 0, fewest_letters: int = FEWEST_LETTERS) -> DataFrame:
    """(word, n): occurrences over all whole texts of the letter runs, A-Z lower-cased, that have enough letters.

    With ``spoil`` > 0, a run loses one letter in documents where that number divides the checksum of
    id and run; the place is the checksum's remainder by the length. Tasks add up words before they
    hand them on, so a word of any frequency is a few rows of the shuffle. A null id counts as the
    text "null"; null and empty texts have no runs; repeated rows count as often as they occur.
    """
    pattern = re.compile(f"{RUN}{{{fewest_letters},}}")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        chars = 0
        for batch in batches:
            for key, body in zip(batch["key"], batch["body"]):
                # bytes.lower() touches A-Z only.
                runs = Counter(pattern.findall(body.encode().lower().decode()))
                seed = zlib.crc32(f"{key}:".encode())
                for run, times in runs.items():
                    if spoil:
                        check = zlib.crc32(run.encode(), seed)
                        if check % spoil == 0:
                            gone = check % len(run)
                            run = run[:gone] + run[gone + 1 :]
                            if len(run) < fewest_letters:
                                continue
                    if run not in held:
                        chars += len(run)
                    held[run] += times
                if chars > HELD_CHARS:
                    yield pd.DataFrame({"word": texts(list(held)), "n": list(held.values())})
                    held.clear()
                    chars = 0
        if held:
            yield pd.DataFrame({"word": texts(list(held)), "n": list(held.values())})

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    return rows.mapInPandas(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def upper_trees(words: DataFrame) -> dict[int, LetterTree]:
    """A tree for each length among the sampled words; what comes to the driver is at most ``SAMPLE`` vectors."""

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = letter_counts(batch["word"].tolist())
            yield pd.DataFrame({"length": counts.sum(axis=1), "counts": [c.tobytes() for c in counts]})

    sampled = words.select("word").orderBy(F.xxhash64("word"), "word").limit(SAMPLE)
    rows = sampled.mapInPandas(vectors, "length bigint, counts binary").toPandas()
    out = {}
    for length, part in rows.groupby("length"):
        counts = np.frombuffer(b"".join(part["counts"]), np.int32).reshape(-1, LETTERS)
        out[int(length)] = LetterTree(counts, SAMPLE_LEAF)
    return out


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n), each pair of words of ``words`` (word, n; distinct) once, that are exactly one edit apart."""
    trees = words.sparkSession.sparkContext.broadcast(upper_trees(words))

    def leaves(length: int, counts: np.ndarray, fewer: int, more: int) -> tuple[np.ndarray, np.ndarray]:
        tree = trees.value.get(length)
        if tree is None:  # no word of the sample has this length: one leaf
            return np.arange(len(counts)), np.zeros(len(counts), np.int64)
        return tree.reach(counts, fewer, more)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, part in batch.groupby(batch["word"].str.len()):
                counts = letter_counts(part["word"].tolist())
                home = np.empty(len(part), np.int64)
                at, leaf = leaves(length, counts, 0, 0)
                home[at] = leaf
                for there, fewer in ((length, 1), (length + 1, 0)):
                    at, leaf = leaves(there, counts, fewer, 1)
                    point = (home[at] == leaf) & (there == length)
                    yield pd.DataFrame({"length": there, "leaf": leaf, "word": texts(part["word"].to_numpy(object)[at]), "n": part["n"].to_numpy()[at], "point": point})

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        length = int(rows["length"].iloc[0])
        word, n, point = rows["word"].to_numpy(object), rows["n"].to_numpy(), rows["point"].to_numpy()
        same = (rows["word"].str.len() == length).to_numpy()
        points = np.flatnonzero(point)
        found = [], []
        for queries, fewer in ((np.flatnonzero(same), 1), (np.flatnonzero(~same), 0)):
            for q, p in near_in_leaf(word[points].tolist(), word[queries].tolist(), fewer):
                q, p = queries[q], points[p]
                if fewer:  # of equal length: both ask for each other
                    first = word[q] < word[p]
                    q, p = q[first], p[first]
                found[0].append(q)
                found[1].append(p)
        q, p = (np.concatenate([np.empty(0, np.int64), *side]) for side in found)
        return pd.DataFrame({"word": texts(word[q]), "n": n[q], "other": texts(word[p]), "other_n": n[p]})

    dealt = words.select("word", "n").mapInPandas(deal, "length bigint, leaf bigint, word string, n bigint, point boolean")
    return dealt.groupBy("length", "leaf").applyInPandas(search, "word string, n bigint, other string, other_n bigint")


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form; written) with the last word that following ``form`` leads to, the word itself without one.

    Each round doubles the steps taken. A form is more frequent than its word, so no chain is a ring.
    """
    ahead = materialize(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "root-0")
    step = 0
    while True:
        beyond = ahead.select(F.col("word").alias("root"), F.col("root").alias("_root"))
        joined = ahead.join(beyond, "root", "left").select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved"))
        step += 1
        after = materialize(joined, f"root-{step}")
        if after.where("moved").isEmpty():
            break
        ahead = after.drop("moved")
    return forms.join(ahead, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variant_groups(words: DataFrame, fewest: int = FEWEST, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for the words that occur ``fewest`` times or more.

    ``words`` is (word, n) of a-z and U+00C0 to U+00FF; rows of one word are added up, null and empty words and
    null counts left out. Words are near if one inserted, deleted or replaced code point makes one the other;
    ``form`` is the near word of largest ``n`` (ties: smallest in code-point order) if that is
    ``ratio`` times the word's own, else null; ``root`` is where following the forms ends. Other
    columns are not looked at.
    """
    whole = words.where("word <> ''").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)
    kept = materialize(whole, "words")
    pairs = materialize(near_pairs(kept), "near-words")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    enough = -F.col("best.less") >= F.col("n") * ratio
    forms = kept.join(materialize(best, "best-near"), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    return with_roots(materialize(forms, "forms"))
