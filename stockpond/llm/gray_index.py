"""SimHash near-duplicates through a hierarchical index in Gray order.

Equal fingerprints are one entry. Within ``RADIUS`` bits of each other, two fingerprints agree
on two of the six blocks their bits are cut into, so they meet under one of 15 upper nodes that
hold a shared pattern of two blocks. Below an upper node the entries are sorted by Gray rank,
which puts fingerprints with long common patterns next to each other; nodes above runs of
entries hold the bits that all of these share. The search goes down pairs of nodes, adds up the
bits on which the shared patterns differ and drops a whole pair of groups beyond the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from stockpond.llm.components import connected
from stockpond.llm.native import free_name, row_digest
from stockpond.session import materialize

RADIUS = 4
SHINGLE = 4
SEED = 42
BITS = 64
BLOCKS = 6
PAIRS_AT_ONCE = 1 << 16


def fingerprint(words: list[bytes], size: int = SHINGLE) -> int:
    """Bits that more than half of the shingle hashes have; no words: zero."""
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = (ends - [len(w) for w in words]).tolist()
    ends = ends.tolist()
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        hashes = [digest(line, SEED)]
    else:
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends[size - 1 :])]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
    over = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def text_fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Of lower-cased words; bytes methods touch A-Z and ASCII white space only, as wanted."""
    for batch in batches:
        yield pd.Series([fingerprint(t.encode("utf-8", "surrogatepass").lower().split()) for t in batch.fillna("")], dtype="int64")


def upper_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """One mask for each choice of ``blocks - radius`` blocks; with at most ``radius`` bits changed one choice is unchanged."""
    cuts = np.linspace(0, BITS, blocks + 1).round().astype(int)
    masks = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(masks, blocks - radius)]


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def gray_rank(fingerprint: Column) -> Column:
    """Place in the Gray sequence, as a signed number that sorts like the unsigned one."""
    for step in (1, 2, 4, 8, 16, 32):
        fingerprint = fingerprint.bitwiseXOR(F.shiftrightunsigned(fingerprint, step))
    return fingerprint.bitwiseXOR(F.lit(signed(1 << (BITS - 1))))


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest label of each connected group after linking ``a`` and ``b``."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels = up


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class GrayIndex:
    """Nodes over entries that are sorted by (upper node, Gray rank); a node has two children."""

    def __init__(self, upper: np.ndarray, prints: np.ndarray):
        self.prints = prints
        n = len(prints)
        first = np.flatnonzero(np.r_[True, upper[1:] != upper[:-1]])
        counts = np.diff(np.r_[first, n])
        self.levels = []  # per level: ones that all share, ones that any has, first entry, group
        ones = any_ones = prints
        start, group = np.arange(n), np.repeat(np.arange(len(first)), counts)
        while True:
            self.levels.append((ones, any_ones, start, group))
            if len(start) == len(first):
                break
            head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            place = np.arange(len(group)) - np.repeat(head, np.diff(np.r_[head, len(group)]))
            pick = np.flatnonzero(place % 2 == 0)
            ones, any_ones = np.bitwise_and.reduceat(ones, pick), np.bitwise_or.reduceat(any_ones, pick)
            start, group = start[pick], group[pick]
        self.group_of = self.levels[0][3]

    def _children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First child one level below, and how many (1 or 2)."""
        start, below = self.levels[level][2], self.levels[level - 1][2]
        first = np.searchsorted(below, start[nodes])
        next_start = np.r_[start, len(self.prints)][nodes + 1]
        return first, np.searchsorted(below, next_start) - first

    def _uniform(self, labels: np.ndarray) -> list[np.ndarray]:
        """Per level, the label of a node whose entries all have it, else -1 - the node."""
        out = []
        for _, _, start, _ in self.levels:
            low, high = np.minimum.reduceat(labels, start), np.maximum.reduceat(labels, start)
            out.append(np.where(low == high, low, -1 - np.arange(len(start))))
        return out

    def groups(self, radius: int) -> np.ndarray:
        """Smallest entry that each entry is linked to within its upper node, over any number of links."""
        n = len(self.prints)
        labels = np.arange(n)
        for step in range(1, min(16, n - 1) + 1):  # neighbours in Gray order first: they settle most groups
            near = np.flatnonzero((self.group_of[step:] == self.group_of[:-step]) & (distance(self.prints[step:], self.prints[:-step]) <= radius))
            labels = merge_labels(labels, near, near + step)
        uniform = self._uniform(labels)
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][2]))
        work = [(top, roots, roots)]
        while work:
            level, a, b = work.pop()
            if len(a) > PAIRS_AT_ONCE:
                half = len(a) // 2
                work += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
                continue
            keep = uniform[level][a] != uniform[level][b]  # a pair of groups that are one group already needs no look
            if level:
                keep |= (a == b) & (uniform[level][a] < 0)
            ones, any_ones, _, _ = self.levels[level]
            apart = (ones[a] & ~any_ones[b]) | (ones[b] & ~any_ones[a])
            keep &= np.bitwise_count(apart) <= radius
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            if level == 0:
                labels = merge_labels(labels, a, b)
                uniform = self._uniform(labels)
                continue
            (a0, an), (b0, bn) = self._children(level, a), self._children(level, b)
            pairs = [(a0, b0)]
            for i, j in ((0, 1), (1, 0), (1, 1)):
                there = (an > i) & (bn > j)
                if (i, j) == (1, 0):
                    there &= a != b  # of a node with itself, each pair of children once
                pairs.append((a0[there] + i, b0[there] + j))
            work.append((level - 1, np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])))
        return labels


def _links(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Entries come sorted; whole upper nodes are searched as soon as the next one begins."""
    rest = None
    for batch in batches:
        rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        table, pattern = rest["upper"].to_numpy(), rest["pattern"].to_numpy()
        new = np.flatnonzero((table[1:] != table[:-1]) | (pattern[1:] != pattern[:-1])) + 1
        if len(new):
            whole, rest = rest.iloc[: new[-1]], rest.iloc[new[-1] :].reset_index(drop=True)
            yield _linked(whole, radius)
    if rest is not None and len(rest):
        yield _linked(rest, radius)


def _linked(rows: pd.DataFrame, radius: int) -> pd.DataFrame:
    table, pattern = rows["upper"].to_numpy(), rows["pattern"].to_numpy()
    upper = np.cumsum(np.r_[True, (table[1:] != table[:-1]) | (pattern[1:] != pattern[:-1])])
    prints = rows["fingerprint"].to_numpy()
    labels = GrayIndex(upper, prints.view("<u8")).groups(radius)
    linked = np.flatnonzero(labels != np.arange(len(labels)))
    return pd.DataFrame({"a": prints[linked], "b": prints[labels[linked]]})


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints that join all that lie within ``radius`` bits.

    Of each group below an upper node the links to its smallest entry come back, not all pairs;
    whoever can be reached over links within the radius can be reached over these. A task holds
    the entries of one upper node, 16 bytes each; pairs of nodes are worked off in bounded runs.
    """
    tables = F.array(*[F.struct(F.lit(i).alias("upper"), F.lit(signed(m)).alias("mask")) for i, m in enumerate(upper_masks(blocks, radius))])
    entries = prints.select("fingerprint", F.explode(tables).alias("t")).select(
        F.col("t.upper").alias("upper"), F.col("fingerprint").bitwiseAND(F.col("t.mask")).alias("pattern"), "fingerprint"
    )
    placed = entries.repartition("upper", "pattern").sortWithinPartitions("upper", "pattern", gray_rank(F.col("fingerprint")))
    return placed.mapInPandas(lambda batches: _links(batches, radius), "a bigint, b bigint")


def _grouped(rows: DataFrame, radius: int) -> DataFrame:
    """``rows`` (a written table with ``_id``, ``fingerprint``) with ``label`` and ``component_id`` of their group."""
    classes = materialize(rows.groupBy("fingerprint").agg(F.min("_id").alias("_first")), "classes")
    labels = connected(fingerprint_links(classes.select("fingerprint"), radius)).withColumnRenamed("node", "fingerprint")
    labelled = materialize(
        classes.join(labels, "fingerprint", "left").withColumn("label", F.coalesce("label", "fingerprint")), "labelled"
    )
    first = materialize(labelled.groupBy("label").agg(F.min("_first").alias("component_id")), "first")
    groups = materialize(labelled.join(first, "label").select("fingerprint", "label", "component_id"), "groups")
    return rows.join(groups, "fingerprint")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``id_col``, ``fingerprint`` (bigint), ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id among all rows that can be reached over links of at most
    ``radius`` differing bits, the row itself included. Null and empty texts have fingerprint zero.
    Repeated rows stay repeated. A null id never is the smallest, unless the group has no other:
    then ``component_id`` is null. Other columns are not looked at.
    """
    rows = materialize(docs.select(F.col(id_col).alias("_id"), text_fingerprint(F.col(text)).alias("fingerprint")), "fingerprints")
    return _grouped(rows, radius).select(F.col("_id").alias(id_col), "fingerprint", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` from each group, with its columns as they are.

    The row with the smallest id stays (null after all others); of rows that share this id, the
    one with the smallest digest of id and text; of equal rows, one.
    """
    rows = docs.select(F.col(id_col).alias("_id"), row_digest(id_col, text).alias("_digest"), text_fingerprint(F.col(text)).alias("fingerprint"))
    ranked = F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_digest")
    first = _grouped(materialize(rows, "fingerprints"), radius).groupBy("label").agg(F.min(ranked).alias("first"))
    chosen = materialize(first.select(F.col("first._digest").alias("_digest")), "chosen")
    name = free_name(docs, "_digest")
    kept = docs.withColumn(name, row_digest(id_col, text)).join(chosen.withColumnRenamed("_digest", name), name, "left_semi")
    return kept.dropDuplicates([name]).drop(name)
