"""Ranked word search through bit-sliced Bloom signatures.

Documents with about as many different terms form blocks. A block has one bitmap per bit of the
signatures, with one column per document: the bitmaps of a term's bits, ANDed, hold every document
with the term and some without it. A term is entered once for each power of two that its
frequency reaches, so the ANDed slices also bound the frequency from above.

1. One pass over the documents writes the blocks, their sizes, and how many documents hold the terms of the items.
2. Weighted sums of the slices give each document an upper bound for each item. The exact scores of
   those with the highest bounds give each item a score that its k-th best document reaches.
3. The slices are summed again; every document whose bound reaches that score is scored exactly,
   all others are excluded by their bounds.

Items are worked off in runs of ``TERMS_AT_ONCE`` terms, which is what a task is sent of them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from stockpond.llm.native import FILTER_BITS, PROBES, WORD, bit_filter, may_hold
from stockpond.operators.ordering import global_running_sums
from stockpond.session import materialize

K = 20
FIRST = 32  # documents per item whose exact scores set the bar

LEVELS = 7  # frequencies of 1, 2, 4, ... 64 and more
HASHES = 4
BITS_PER_ENTRY = 8
LEAST_WIDTH, MOST_WIDTH = 1 << 8, 1 << 20  # signature bits; texts with more terms get weaker bounds, not wrong ones
MOST_DOCS = 1 << 10
CELLS = 1 << 22  # bits of a block
STRIPE_BYTES = 1 << 14
HELD_TERMS = 1 << 17
TERMS_AT_ONCE = 100_000
TERMS_IN_RUN = 1 << 11

# The weights' and scores' scale, and how length counts.
SCALE, TF, LENGTH, SHARE = 1_000_000_000, 1000, 12, 25

# Letters and digits stay, A-Z in lower case, and all bytes of characters beyond ASCII; the rest separates.
TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()

INDEX = "kind int, block bigint, width int, stripe int, docs int, total bigint, bits binary, term string, df bigint"
SLICES, MEMBERS, FREQUENCIES = range(3)


def terms(text: str) -> list[bytes]:
    return text.encode().translate(TERM_BYTES).split()


def term_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def slots(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """Places of the terms' bits in a signature of ``width`` bits, one column for each hash."""
    mixed = (hashes + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    step = (mixed >> np.uint64(32)) | np.uint64(1)
    return ((mixed[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(width - 1)).astype(np.int64)


def filter_holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """``native.may_hold`` for an array."""
    passes = np.ones(len(hashes), bool)
    for probe in range(PROBES):
        slot = (hashes >> np.uint64(probe * FILTER_BITS)) & np.uint64((1 << FILTER_BITS) - 1)
        passes &= (bits[slot >> np.uint64(WORD)] >> (slot & np.uint64((1 << WORD) - 1))) & np.uint64(1) == 1
    return passes


def width_of(entries: int) -> int:
    return min(max(LEAST_WIDTH, 1 << max(0, entries * BITS_PER_ENTRY - 1).bit_length()), MOST_WIDTH)


def docs_in_block(width: int) -> int:
    return max(8, min(MOST_DOCS, CELLS // width))


class Member(NamedTuple):
    key: int
    length: int
    hashes: np.ndarray
    counts: np.ndarray


def block_rows(block: int, width: int, members: list[Member]) -> pd.DataFrame:
    """The slices of a block in stripes, and its members: keys, then lengths."""
    columns = -(-len(members) // 8) * 8
    hashes = np.concatenate([m.hashes for m in members])
    counts = np.concatenate([m.counts for m in members])
    doc = np.repeat(np.arange(len(members)), [len(m.hashes) for m in members])
    cells = np.zeros((width, columns), bool)
    for level in range(LEVELS):
        often = counts >= 1 << level
        hashes, counts, doc = hashes[often], counts[often], doc[often]
        if not len(doc):
            break
        cells[slots(hashes, level, width), doc[:, None]] = True
    packed = np.packbits(cells, axis=1, bitorder="little")
    per_stripe = max(1, STRIPE_BYTES // packed.shape[1])
    stripes = [packed[i : i + per_stripe].tobytes() for i in range(0, width, per_stripe)]
    lengths = np.array([m.length for m in members], "<i8")
    keys = np.array([m.key for m in members], "<i8")
    rows = {
        "kind": [MEMBERS] + [SLICES] * len(stripes),
        "stripe": range(-1, len(stripes)),
        "bits": [keys.tobytes() + lengths.tobytes(), *stripes],
    }
    return pd.DataFrame(rows).assign(block=block, width=width, docs=len(members), total=int(lengths.sum()), term=None, df=None)[_names(INDEX)]


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def frequency_rows(held: Counter) -> pd.DataFrame:
    rows = pd.DataFrame({"term": pd.Series([t.decode() for t in held], dtype=object), "df": list(held.values())})
    return rows.assign(kind=FREQUENCIES, block=None, width=None, stripe=None, docs=None, total=None, bits=None)[_names(INDEX)]


def index(docs: DataFrame, asked_filter: np.ndarray) -> DataFrame:
    """Blocks of all documents of ``docs`` (key, text) with a term, and document frequencies of the terms that pass the filter."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = TaskContext.get().partitionId() << 32
        open_: dict[int, list[Member]] = {}
        held: Counter = Counter()
        for key, words, counts in _documents(batches):
            hashes = term_hashes(words)
            for i in np.flatnonzero(filter_holds(asked_filter, hashes)):
                held[words[i]] += 1
            entries = sum(int((counts >= 1 << level).sum()) for level in range(LEVELS)) if counts.max() > 1 else len(words)
            width = width_of(entries)
            members = open_.setdefault(width, [])
            members.append(Member(key, int(counts.sum()), hashes, counts))
            if len(members) == docs_in_block(width):
                yield block_rows(block, width, open_.pop(width))
                block += 1
            if len(held) > HELD_TERMS:
                yield frequency_rows(held)
                held.clear()
        for width, members in open_.items():
            yield block_rows(block, width, members)
            block += 1
        if held:
            yield frequency_rows(held)

    return docs.mapInPandas(build, INDEX)


def _documents(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    for batch in batches:
        for key, text in zip(batch["key"], batch["text"]):
            found = Counter(terms(text))
            if found:
                yield int(key), list(found), np.fromiter(found.values(), np.int64, len(found))


class Run(NamedTuple):
    """Some items and their terms, numbered from 0."""

    hashes: np.ndarray
    items: list[tuple[int, np.ndarray, np.ndarray]]  # item, terms, weights


def runs_of(asked: pd.DataFrame) -> list[Run]:
    """``asked`` (item, h, weight) cut into runs of items that fit into ``TERMS_IN_RUN`` terms, or of one item."""
    out, items, size = [], [], 0

    def close():
        hashes, place = np.unique(np.concatenate([h for _, h, _ in items]), return_inverse=True)
        ends = np.cumsum([len(h) for _, h, _ in items])
        out.append(Run(hashes, [(item, place[e - len(h) : e], w) for (item, h, w), e in zip(items, ends)]))

    for item, part in asked.sort_values("item", kind="stable").groupby("item"):
        if items and size + len(part) > TERMS_IN_RUN:
            close()
            items, size = [], 0
        items.append((int(item), part["h"].to_numpy(np.int64).view(np.uint64), part["weight"].to_numpy(np.float64)))
        size += len(part)
    if items:
        close()
    return out


def most_of_frequency(lengths: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """What a term adds at most, by level of its frequency, to the score of documents of these lengths; as steps from level to level."""
    m = 100 - SHARE + SHARE * lengths * n_docs // total
    highest = [np.minimum(lengths, (2 << level) - 1) for level in range(LEVELS - 1)] + [lengths]
    return np.diff([SCALE * tf // (TF * tf + LENGTH * m) for tf in highest], axis=0, prepend=0).astype(np.float64)


def bounds(matrix: np.ndarray, lengths: np.ndarray, run: Run, n_docs: int, total: int) -> Iterator[tuple[int, np.ndarray]]:
    """(item, upper bounds of the scores of the block's documents)."""
    width, columns = len(matrix), len(lengths)
    steps = most_of_frequency(lengths, n_docs, total)
    most = np.zeros((len(run.hashes), columns))
    here, held = np.arange(len(run.hashes)), None
    for level in range(LEVELS):
        found = np.bitwise_and.reduce(matrix[slots(run.hashes[here], level, width)], axis=1)
        held = found if held is None else held & found
        some = held.any(axis=1)
        here, held = here[some], held[some]
        if not len(here):
            break
        most[here] += np.unpackbits(held, axis=1, count=columns, bitorder="little") * steps[level]
    # Sums in doubles are exact up to 2^53; the margin covers what may be lost beyond.
    for item, of, weights in run.items:
        yield item, (weights @ most[of]) * (1 + 1e-9)


def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(slices, keys, lengths) of block after block; rows come sorted by block and stripe."""
    open_, width, docs, parts = None, 0, 0, []

    def whole():
        keys, lengths = np.frombuffer(parts[0], "<i8").reshape(2, docs)
        return np.frombuffer(b"".join(parts[1:]), np.uint8).reshape(width, -1), keys, lengths

    for batch in batches:
        for block, w, d, bits in zip(batch["block"], batch["width"], batch["docs"], batch["bits"]):
            if block != open_:
                if open_ is not None:
                    yield whole()
                open_, width, docs, parts = block, w, d, []
            parts.append(bits)
    if open_ is not None:
        yield whole()


def sorted_blocks(indexed: DataFrame) -> DataFrame:
    rows = indexed.where(F.col("kind") < FREQUENCIES).select("block", "stripe", "width", "docs", "bits")
    return rows.repartition("block").sortWithinPartitions("block", "stripe")


def highest_bounds(indexed: DataFrame, runs, n_docs: int, total: int, first: int) -> DataFrame:
    """(item, key) of the ``first`` documents with the highest bounds for each item."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for matrix, keys, lengths in blocks(batches):
            for run in runs.value:
                for item, bound in bounds(matrix, lengths, run, n_docs, total):
                    old, old_keys = best.get(item, (np.zeros(0), np.zeros(0, np.int64)))
                    over = np.flatnonzero(bound > (old.min() if len(old) == first else 0))
                    if not len(over):
                        continue
                    all_, all_keys = np.concatenate([old, bound[over]]), np.concatenate([old_keys, keys[over]])
                    if len(all_) > first:
                        top = np.argpartition(-all_, first - 1)[:first]
                        all_, all_keys = all_[top], all_keys[top]
                    best[item] = all_, all_keys
        for item, (bound, keys) in best.items():
            yield pd.DataFrame({"item": item, "key": keys, "bound": bound})

    found = sorted_blocks(indexed).mapInPandas(search, "item bigint, key bigint, bound double")
    highest_first = Window.partitionBy("item").orderBy(F.desc("bound"), "key")
    return found.withColumn("_place", F.row_number().over(highest_first)).where(F.col("_place") <= first).select("item", "key").distinct()


def not_excluded(indexed: DataFrame, runs, bars, n_docs: int, total: int) -> DataFrame:
    """(key, items): each document that has bounds at the items' bars, with these items."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for matrix, keys, lengths in blocks(batches):
            doc, item_of = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for run in runs.value:
                for item, bound in bounds(matrix, lengths, run, n_docs, total):
                    over = np.flatnonzero(bound >= max(1, bars.value.get(item, 0)))
                    doc.append(over)
                    item_of.append(np.full(len(over), item))
            doc, item_of = np.concatenate(doc), np.concatenate(item_of)
            order = np.argsort(doc, kind="stable")
            doc, item_of = doc[order], item_of[order]
            head = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else doc
            yield pd.DataFrame({"key": keys[doc[head]], "items": pd.Series(np.split(item_of, head[1:]) if len(doc) else [], dtype=object)})

    return sorted_blocks(indexed).mapInPandas(search, "key bigint, items array<bigint>")


def exact_scores(docs: DataFrame, wanted: DataFrame, queries, n_docs: int, total: int) -> DataFrame:
    """(item, doc_id, score) of the documents of ``docs`` (doc_id, key, text) for the items that ``wanted`` (key, items) names."""
    type_of = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [], [], []
            for at, (text, items) in enumerate(zip(batch["text"], batch["items"])):
                tf = Counter(terms(text))
                n = tf.total()
                m = 100 - SHARE + SHARE * n * n_docs // total
                for item in items:
                    value = 0
                    for term, weight in queries.value[item]:
                        if term in tf:
                            value += weight * (SCALE * tf[term] // (TF * tf[term] + LENGTH * m))
                    if value:
                        for column, x in zip(out, (item, at, value)):
                            column.append(x)
            rows = batch["doc_id"].iloc[out[1]].reset_index(drop=True)
            yield pd.DataFrame({"item": np.array(out[0], np.int64), "doc_id": rows, "score": np.array(out[2], np.int64)})

    # Ids need no doubles on the way through pandas.
    keys = materialize(wanted.select("key").distinct(), "wanted-keys")
    near = docs.where(may_hold(bit_filter(keys, "key"), F.col("key")))
    joined = near.join(wanted, "key").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "items")
    found = joined.mapInPandas(score, "item bigint, doc_id string, score bigint")
    return found.withColumn("doc_id", F.col("doc_id").cast(type_of))


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term, h, times) of ``items`` (item, text)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, text in zip(batch["item"], batch["text"]):
                found = Counter(terms(text))
                words = list(found)
                names = pd.Series([w.decode() for w in words], dtype=object)
                yield pd.DataFrame({"item": item, "term": names, "h": term_hashes(words).view(np.int64), "times": list(found.values())})

    return items.mapInPandas(cut, "item bigint, term string, h bigint, times bigint")


def best(scores: DataFrame, k: int) -> DataFrame:
    """``scores`` with ``rank``, the ``k`` best of each item; a task keeps only its own before the shuffle."""
    best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)


def search(items: DataFrame, docs: DataFrame, k: int = K, item_col: str = "item_id", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(``item_col``, rank, ``id_col``, score): the ``k`` best documents of each row of ``items``, of those with a score above 0.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased. Null and
    empty texts have none: such items find nothing, such documents count nowhere. Equal scores
    go by ascending id, a null id last. A repeated row is a document, or an item, of its own; the
    ranks of one item are unique. Whole texts count, however long. Without documents or items the
    result is empty. Other columns are not looked at.
    """
    spark = docs.sparkSession
    filled = F.coalesce(F.col(text), F.lit(""))
    numbered = materialize(items.select(F.col(item_col).alias("item_id"), filled.alias("text")).withColumn("item", F.monotonically_increasing_id()), "items")
    asked = materialize(item_terms(numbered.select("item", "text")), "item-terms")
    held = np.array(bit_filter(asked.select("h").distinct(), "h").first().bits, np.int64).view(np.uint64)  # 256 KB
    # The key only names candidates: of two documents with one key, both are scored.
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), filled).alias("key"), filled.alias("text"))
    indexed = materialize(index(keyed.select("key", "text"), held), "signatures", ["kind"])
    n_docs, total = (x or 0 for x in indexed.where(F.col("kind") == MEMBERS).agg(F.sum("docs"), F.sum("total")).first())
    frequencies = indexed.where(F.col("kind") == FREQUENCIES).groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weighted = asked.join(frequencies, "term").select("item", "term", "h", (F.col("times") * weight).alias("weight")).where("weight > 0")
    per_item = weighted.groupBy("item").agg(F.count("*").alias("n_terms"))
    placed = global_running_sums(per_item, ["item"], {"upto": "n_terms"})
    part = placed.select("item", F.floor((F.col("upto") - F.col("n_terms")) / TERMS_AT_ONCE).alias("part"))
    weighted = materialize(weighted.join(part, "item"), "item-weights")
    zero = F.lit(0).cast("bigint")
    found = keyed.select(zero.alias("item"), "doc_id", zero.alias("score")).limit(0)
    last = weighted.agg(F.max("part")).first()[0]  # null without a term that any document holds
    for number in range(0 if last is None else last + 1):
        found = found.unionByName(_scored(keyed, indexed, weighted.where(F.col("part") == number), n_docs, total, k))
    ranked = best(found, k).join(numbered.select("item", "item_id"), "item")
    return ranked.select(F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score")


def _scored(docs: DataFrame, indexed: DataFrame, weighted: DataFrame, n_docs: int, total: int, k: int) -> DataFrame:
    """Exact scores of all documents that may be among the ``k`` best of the items of ``weighted``, whose terms are bounded in number."""
    context = docs.sparkSession.sparkContext
    rows = weighted.select("item", "term", "h", "weight").toPandas()
    runs = context.broadcast(runs_of(rows))
    lists: dict[int, list[tuple[bytes, int]]] = {}
    for item, term, weight in zip(rows["item"].tolist(), rows["term"], rows["weight"].tolist()):
        lists.setdefault(item, []).append((term.encode(), weight))
    queries = context.broadcast(lists)
    first = materialize(highest_bounds(indexed, runs, n_docs, total, max(FIRST, k)), "highest-bounds")
    known = exact_scores(docs, first.groupBy("key").agg(F.collect_list("item").alias("items")), queries, n_docs, total)
    kth = best(known, k).where(F.col("rank") == k).select("item", "score").collect()  # one number per item
    bars = context.broadcast({r.item: r.score for r in kth})
    # Equal rows of the table have one key and the same items.
    wanted = materialize(not_excluded(indexed, runs, bars, n_docs, total).distinct(), "not-excluded")
    items = F.array_distinct(F.flatten(F.collect_list("items")))
    return materialize(exact_scores(docs, wanted.groupBy("key").agg(items.alias("items")), queries, n_docs, total), "exact-scores")
