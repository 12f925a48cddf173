"""Document quality by Bradley-Terry ranking: scores learned from preference pairs.

A pair is a document labelled good and one labelled bad; the logistic loss is that of the
difference of their features, so the weights are a ranking and have no intercept. Cut-off and
scale come from quantiles of the labelled scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from stockpond.operators.ordering import global_row_number
from stockpond.session import materialize

# Partners of each labelled row of the larger class.
PARTNERS = 3
# The score at the cut-off.
CUT = 0.7
EDGE = 0.02
REGULARISATION = 1e-4

FEATURES = (
    "log_words", "letters", "upper", "digits", "marks", "odd_marks", "spaces", "word_length", "word_length_spread", "variety",
    "echoes", "short_words", "marked_words", "line_variety", "plain_line_ends", "log_line_words", "longest_word",
)

LETTER, UPPER, DIGIT, SPACE, MARK, ODD = range(6)


def character_classes() -> np.ndarray:
    """Class of each code point below 256 by its Unicode properties; the last entry is for all above."""
    sentence = set(".,;:!?'\"-()")
    kinds = []
    for c in map(chr, range(256)):
        if c.isalpha():
            kinds.append(UPPER if c.isupper() else LETTER)
        elif c.isdigit():
            kinds.append(DIGIT)
        elif c.isspace():
            kinds.append(SPACE)
        else:
            kinds.append(MARK if c in sentence else ODD)
    return np.array([*kinds, LETTER], np.uint8)


CLASSES = character_classes()


def describe(text: str) -> list[float]:
    """The features of one whole text; an empty one has zeros."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters, upper, digits, spaces, marks, odd = np.bincount(CLASSES[np.minimum(codes, 256)], minlength=6) / len(codes)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = [line for line in text.split("\n") if line]
    n = len(words)
    alphabetic = letters + upper
    return [
        np.log1p(n),
        alphabetic,
        upper / alphabetic if alphabetic else 0.0,
        digits,
        marks,
        odd,
        spaces,
        np.log(lengths.mean()),
        np.log1p(lengths.std()),
        np.log1p(len(set(words))) / np.log1p(n),
        sum(map(eq, words, words[1:])) / n,
        float((lengths <= 3).mean()),
        sum(not w.isalnum() for w in words) / n,
        len(set(lines)) / len(lines),
        sum(line[-1] in ".!?" for line in lines) / len(lines),
        np.log1p(n / len(lines)),
        np.log1p(float(lengths.max())),
    ]


@F.pandas_udf(ArrayType(DoubleType()))
def text_features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([np.array(describe(t)) for t in batch.fillna("")])


@dataclass(frozen=True)
class Ranking:
    """Scaled weights, the raw score at the cut-off, and the raw score that makes one unit of log odds."""

    weights: tuple[float, ...]
    cut: float
    unit: float

    def raw(self, features: Column) -> Column:
        total = F.lit(0.0)
        for i, weight in enumerate(self.weights):
            total = total + F.element_at(features, i + 1) * F.lit(weight)
        return total

    def score(self, text: Column) -> Column:
        """0 to 1, ``CUT`` at the cut-off; null and empty texts have the features of an empty one."""
        return self.score_of(text_features(text))

    def score_of(self, features: Column) -> Column:
        odds = (self.raw(features) - self.cut) / self.unit + float(np.log(CUT / (1 - CUT)))
        return 1 / (1 + F.exp(-odds))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: a quarter by the checksum of the id (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def described(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``features`` of every row, written once: learning and scoring can share it."""
    return materialize(docs.select("doc_id", text_features("text").alias("features")), "features")


def labelled_rows(features: DataFrame, labels: DataFrame) -> DataFrame:
    """``good`` (boolean), ``doc_id`` and ``features`` of all labelled rows that are not held out, once for each id and label."""
    known = labels.where(F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", (F.col("quality") == 1).alias("good")).where("good IS NOT NULL").distinct()
    rows = features.join(known, "doc_id").groupBy("doc_id", "good").agg(F.min("features").alias("features"))
    return materialize(rows.select("good", "doc_id", "features"), "labelled-rows")


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``labelled_rows`` of documents with a text; all of them, in spite of the name."""
    return labelled_rows(described(docs), labels)


def quantile(values: DataFrame, n: int, share: float) -> float:
    """The quantile of the ``n`` values in the column ``raw``, between its two neighbours in the sorted table; ids part equal values."""
    low = int(share * (n - 1))
    beside = global_row_number(values.select("raw", "doc_id"), ["raw", F.xxhash64("doc_id")]).where(F.col("row_number").between(low + 1, low + 2))
    found = sorted(r.raw for r in beside.collect())  # two rows
    return found[0] + (share * (n - 1) - low) * (found[-1] - found[0])


def learn(docs: DataFrame, labels: DataFrame) -> Ranking:
    """The ranking learned from ``labels`` (``doc_id``, ``quality`` 0/1) of all rows that are not held out.

    Only ids, labels and texts are read; other columns may have any name. Without a row of either class there is
    no pair to learn from: all weights are zero and every text scores ``CUT``.
    """
    return learn_described(described(docs), labels)


def learn_described(features: DataFrame, labels: DataFrame) -> Ranking:
    """``learn`` from the written table of ``described``.

    Each row of the larger class meets ``PARTNERS`` rows of the smaller one, dealt in turn along a hash of the id, so that
    every labelled row is in a pair and the number of pairs grows with the rows, not with their square.
    """
    rows = labelled_rows(features, labels)
    spread = [F.stddev_pop(F.element_at("features", i + 1)) for i in range(len(FEATURES))]
    known = rows.agg(F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_bad"), F.array(*spread).alias("spread")).first()
    if not known.n_good or not known.n_bad:
        return Ranking((0.0,) * len(FEATURES), 0.0, 1.0)
    spread = [s or 1.0 for s in known.spread]
    scaled = rows.withColumn("features", F.zip_with("features", F.array(*map(F.lit, spread)), lambda x, s: x / s))
    more, fewer, n_fewer = ("good", "NOT good", known.n_bad) if known.n_good >= known.n_bad else ("NOT good", "good", known.n_good)

    def placed(which: str, alias: str) -> DataFrame:
        numbered = global_row_number(scaled.where(which), [F.xxhash64("doc_id"), "doc_id"], "number")
        return numbered.select((F.col("number") - 1).alias("place"), F.col("features").alias(alias))

    partners = F.array(*[(F.col("place") + j * (n_fewer // PARTNERS)) % n_fewer for j in range(PARTNERS)])
    left = placed(more, "x").select("place", "x", F.explode(partners).alias("partner"))
    pairs = left.join(placed(fewer, "y").withColumnRenamed("place", "partner"), "partner")
    better, worse = ("x", "y") if more == "good" else ("y", "x")
    # Every second pair is turned round, so that both outcomes occur; without an intercept the loss stays the same.
    turned = F.col("place") % 2 == 1
    difference = F.zip_with(better, worse, lambda a, b: F.when(turned, b - a).otherwise(a - b))
    training = materialize(pairs.select((~turned).cast("double").alias("label"), difference.alias("difference")), "preferences")
    fit = LogisticRegression(fitIntercept=False, standardization=False, regParam=REGULARISATION, maxIter=60).fit(
        training.select("label", array_to_vector("difference").alias("features"))
    )
    weights = tuple(float(w / s) for w, s in zip(fit.coefficients.toArray(), spread))
    scores = rows.select("good", "doc_id", Ranking(weights, 0.0, 1.0).raw(F.col("features")).alias("raw"))
    high_bad, low_good = quantile(scores.where("NOT good"), known.n_bad, 1 - EDGE), quantile(scores.where("good"), known.n_good, EDGE)
    return Ranking(weights, (high_bad + low_good) / 2, max(abs(low_good - high_bad) / 8, 1e-6))


def scored(docs: DataFrame, ranking: Ranking, score: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with a score column (replaced if there is one); row by row, so repeated rows stay."""
    return docs.withColumn(score, ranking.score(F.col(text)))


def accepted(docs: DataFrame, ranking: Ranking, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches ``CUT``."""
    return docs.where(ranking.score(F.col(text)) >= CUT)
