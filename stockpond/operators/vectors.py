"""Nearest vectors by cosine through an inverted file.

The cells are spherical k-means centres of a bounded sample; every vector is put into its nearest
cell, of which size and radius (greatest angle to the centre) are kept. A block of questions looks
into its nearest cells first, more of them until they hold ``k`` vectors. By the radius no vector of
a cell can be more alike than a bound; the exact search then also looks into every cell
whose bound reaches the k-th best so far. A task scores the questions of a cell against the
cell's vectors as one matrix product and hands on its ``k`` best for each question, so no pairs are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from stockpond.session import materialize

UNIT = 1_000_000  # similarities are whole millionths, so that ties are ties everywhere
CELLS = 64
SAMPLE = 20_000  # vectors that the cells are trained on, taken by a hash of the id
ROUNDS = 10
FIRST = 8  # cells that the exact search begins with
PROBES = 40  # cells of the approximate search; on vectors without any structure, ten in ten thousand, it finds over nine in ten
QUESTIONS_AT_ONCE = 1024
HELD_ROWS = 1 << 17
# Vectors of no length have similarity 0 to everything.
NO_CELL = -1


@dataclass(frozen=True)
class Index:
    """A written table (doc_id, vector, cell) sorted by cell, and per cell its centre, size and radius."""

    table: DataFrame
    centres: np.ndarray
    sizes: np.ndarray
    radii: np.ndarray
    no_length: int


def units(vectors: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return np.divide(vectors, lengths, out=np.zeros_like(vectors), where=lengths > 0)


def stacked(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), -1)


def train(sample: np.ndarray, cells: int) -> np.ndarray:
    """Centres of length one, of a sample of unit vectors."""
    centres = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)] if len(sample) else sample
    for _ in range(ROUNDS if len(sample) else 0):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        moved = units(sums)
        centres = np.where(moved.any(axis=1, keepdims=True), moved, centres)
    return np.unique(centres, axis=0)


def build(vectors: DataFrame, cells: int = CELLS) -> Index:
    """Index of ``vectors`` (doc_id, vector of one length for all); null vectors are left out."""
    known = vectors.where("vector IS NOT NULL").select("doc_id", F.col("vector").cast("array<double>").alias("vector"))
    sampled = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).select("vector").toPandas()
    sample = units(stacked(sampled["vector"])) if len(sampled) else np.zeros((0, 1))
    centres = train(sample[sample.any(axis=1)], cells)

    def place(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            unit = units(stacked(batch)) if len(batch) else np.zeros((0, centres.shape[1]))
            near = unit @ centres.T if len(centres) else np.zeros((len(unit), 1))
            cell = np.where(unit.any(axis=1), near.argmax(axis=1), NO_CELL)
            yield pd.DataFrame({"cell": cell, "likeness": near.max(axis=1) if len(unit) else np.zeros(0)})

    placed = known.withColumn("_p", F.pandas_udf(place, "cell int, likeness double")("vector"))
    placed = placed.select("doc_id", "vector", "_p.cell", "_p.likeness")
    table = materialize(placed.repartitionByRange("cell", F.xxhash64("doc_id")).sortWithinPartitions("cell"), "vector-cells")
    sizes, radii, no_length = np.zeros(len(centres), np.int64), np.zeros(len(centres)), 0
    for row in table.groupBy("cell").agg(F.count("*").alias("n"), F.min("likeness").alias("least")).collect():  # one row for each cell
        if row.cell == NO_CELL:
            no_length = row.n
        else:
            sizes[row.cell], radii[row.cell] = row.n, np.arccos(np.clip(row.least, -1, 1))
    return Index(table.select("doc_id", "vector", "cell"), centres, sizes, radii, no_length)


def best_of(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = frame.sort_values(["question", "score", "doc_id"], ascending=[True, False, True], kind="stable")
    return ordered.groupby("question", sort=False).head(k)


def block_best(questions: np.ndarray, asked: np.ndarray, unit: np.ndarray, ids: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` best of some vectors for the questions numbered ``asked``; ties go by id."""
    scores = np.rint(questions[asked] @ unit.T * UNIT).astype(np.int64)
    place = np.empty(len(ids), np.int64)
    place[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    if len(ids) > k:
        ranked = scores * len(ids) - place  # all different
        top = np.argpartition(-ranked, k - 1, axis=1)[:, :k]
    else:
        top = np.tile(np.arange(len(ids)), (len(asked), 1))
    return pd.DataFrame(
        {
            "question": np.repeat(asked, top.shape[1]),
            "doc_id": pd.Series(ids[top.ravel()], dtype=object),
            "score": np.take_along_axis(scores, top, axis=1).ravel(),
        }
    )


def scan(index: Index, questions: np.ndarray, looks: np.ndarray, k: int) -> DataFrame:
    """(question, doc_id, score): each task's ``k`` best for each question, in the cells (with ``NO_CELL`` last) that ``looks`` names."""
    id_type = index.table.schema["doc_id"].dataType.simpleString()
    cells = [NO_CELL if c == len(index.centres) else int(c) for c in np.flatnonzero(looks.any(axis=0))]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for batch in batches:
            unit, ids, cell = units(stacked(batch["vector"])), batch["doc_id"].to_numpy(object), batch["cell"].to_numpy()
            for number in np.unique(cell):
                inside = cell == number
                asked = np.flatnonzero(looks[:, number])
                held.append(block_best(questions, asked, unit[inside], ids[inside], k))
                rows += len(held[-1])
            if rows > HELD_ROWS:
                held = [best_of(pd.concat(held, ignore_index=True), k)]
                rows = len(held[0])
        if held:
            best = best_of(pd.concat(held, ignore_index=True), k)
            yield pd.DataFrame({"question": best["question"].to_numpy(), "doc_id": pd.Series(best["doc_id"].tolist(), dtype=object), "score": best["score"].to_numpy()})

    wanted = index.table.where(F.col("cell").isin(cells))
    return wanted.mapInPandas(search, f"question int, doc_id {id_type}, score bigint")


def top(found: DataFrame, k: int) -> DataFrame:
    best_first = Window.partitionBy("question").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)


def bounds(index: Index, questions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per question and cell: the angle to the centre, and the greatest similarity that the cell can hold. The last column is ``NO_CELL``."""
    angle = np.arccos(np.clip(questions @ index.centres.T, -1, 1))
    most = np.cos(np.maximum(0, angle - index.radii))
    no_cell = np.zeros((len(questions), 1))
    return np.hstack([angle, no_cell + np.pi]), np.hstack([most, no_cell])


def nearest(questions: DataFrame, index: Index, k: int, exact: bool = True, probes: int | None = None) -> DataFrame:
    """(question_id, doc_id, score, rank): the ``k`` most similar documents of each question with a vector.

    Without ``exact`` only the ``probes`` nearest cells are looked into, more where they hold fewer than ``k``
    vectors; with it they are those looked into first. Questions come to the driver in blocks of ``QUESTIONS_AT_ONCE``, and go to the tasks
    as such. Similarity is the cosine in whole millionths, 0 for vectors of no length; equal ones go by id.
    """
    asked = questions.where("vector IS NOT NULL").select("question_id", F.col("vector").cast("array<double>").alias("vector"))
    types = [frame.schema[c].dataType.simpleString() for frame, c in ((asked, "question_id"), (index.table, "doc_id"))]
    out = asked.sparkSession.createDataFrame([], f"question_id {types[0]}, doc_id {types[1]}, score bigint, rank int")
    sizes = np.r_[index.sizes, index.no_length]
    probes = probes or (FIRST if exact else PROBES)
    for block in batched(asked.toLocalIterator(), QUESTIONS_AT_ONCE) if sizes.sum() else ():
        vectors = units(np.array([r.vector for r in block], np.float64))
        angle, most = bounds(index, vectors) if len(index.centres) else (np.zeros((len(block), 1)), np.zeros((len(block), 1)))
        order = np.argsort(angle, axis=1, kind="stable")
        held = np.cumsum(sizes[order], axis=1)
        # The first cells, and those after them while all before hold fewer than k.
        chosen = (np.arange(order.shape[1]) < probes) | (held - sizes[order] < k)
        looks = np.zeros(angle.shape, bool)
        np.put_along_axis(looks, order, chosen, axis=1)
        found = materialize(scan(index, vectors, looks, k), "nearest-cells")
        if exact:
            kth = np.full(len(block), -UNIT - 1)
            for row in top(found, k).where(F.col("rank") == k).collect():  # one number for each question
                kth[row.question] = row.score
            # One unit more covers rounding.
            more = ~looks & (most * UNIT + 1 >= kth[:, None]) & (sizes > 0)
            if more.any():
                found = materialize(found.unionByName(scan(index, vectors, more, k)), "all-cells")
        names = asked.sparkSession.createDataFrame([(i, r.question_id) for i, r in enumerate(block)], f"question int, question_id {types[0]}")
        out = out.unionByName(top(found, k).join(names, "question").select("question_id", "doc_id", "score", "rank"))
    return out
