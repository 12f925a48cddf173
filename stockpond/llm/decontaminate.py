"""Benchmark passages in documents: SimHash of item-sized windows, Hamming blocks, weighted shingles.

1. Where a document shares a five-word shingle with an item, the shared shingle says where the
   item would start. The window of the item's size that starts there is the one to judge.
2. Windows and items get a SimHash of their weighted shingles. ``RADIUS + 1`` blocks of its bits
   are an index: whatever lies within the radius agrees on one whole block at least.
3. Pairs within the radius are kept if the weighted Jaccard similarity of their shingles
   reaches ``SIMILARITY``, computed on whole numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stockpond.llm.native import bit_filter, free_name, may_hold, row_digest, signs, votes, with_shingles
from stockpond.session import materialize

SHINGLE = 5
SIMILARITY = (4, 5)
RADIUS = 16
BITS = 64
WEIGHT_UNIT = 16


def blocks(print_col: str, radius: int = RADIUS) -> Column:
    """The pieces of a fingerprint with their number; two fingerprints within the radius share one."""
    cuts = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    pieces = [
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(print_col, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
    ]
    return F.array(*pieces)


def _counted(rows: DataFrame, key: str, rarity: DataFrame, common: Column) -> DataFrame:
    """``key``, ``shingle``, its count and its weight; shingles no item has weigh as much as those of one item."""
    counted = rows.groupBy(key, F.col("shingle")).agg(F.count("*").alias("times"))
    return counted.join(rarity, "shingle", "left").withColumn("weight", F.coalesce("weight", common))


def _prints(counted: DataFrame, key: str) -> DataFrame:
    return counted.groupBy(key).agg(*votes(F.col("shingle"), F.col("times") * F.col("weight"))).select(
        key, signs().alias("print"), F.col("_weight").alias("total")
    )


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Windows that hold an item: ``_digest`` (of the document's id and text), ``id_col``, ``item_id``,
    ``start``, ``size`` (in words, from 0), ``shared``, ``either`` (weights), ``similarity``.

    A window is as long as its item, or the whole document if that is shorter. Null and empty
    texts have no shingles and match nothing; items under five words match documents of
    just these words. Rows equal in id and text count once, rows that share an id only are
    told apart. Any number of documents may hold the same item.
    """
    item_rows = items.select(F.col(item_id).alias("_item_id"), row_digest(item_id, item_text).alias("item"), F.col(item_text).alias("_text")).dropDuplicates(["item"])
    listed = materialize(
        with_shingles(item_rows, "_text", SHINGLE).select("item", "_item_id", F.size("shingles").alias("runs"), F.posexplode_outer("shingles").alias("offset", "shingle")).where("shingle IS NOT NULL"),
        "item-shingles",
    )
    n_items = listed.agg(F.count_distinct("item")).scalar()
    weight = F.round(WEIGHT_UNIT * (1 + F.ln(n_items / F.count_distinct("item")))).cast("bigint")
    rarity = materialize(listed.groupBy("shingle").agg(weight.alias("weight")), "rarity")
    common = F.coalesce(rarity.agg(F.max("weight")).scalar(), F.lit(WEIGHT_UNIT).cast("bigint"))

    keyed = docs.select(row_digest(id_col, text).alias("_digest"), F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    shared = (
        with_shingles(keyed, "_text", SHINGLE)
        .select("_digest", F.size("shingles").alias("doc_runs"), F.posexplode_outer("shingles").alias("at", "shingle"))
        .where(F.col("shingle").isNotNull() & may_hold(bit_filter(rarity, "shingle"), F.col("shingle")))
    )
    start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("offset"), F.col("doc_runs") - F.col("runs")))
    places = materialize(
        shared.join(listed.select("shingle", "offset", "runs"), "shingle")
        .select("_digest", start.alias("start"), F.least("runs", "doc_runs").alias("taken"), "runs")
        .distinct(),
        "places",
    )
    # A document has at most as many windows as shared shingles.
    per_doc = materialize(places.groupBy("_digest").agg(F.collect_list(F.struct("start", "taken", "runs")).alias("places")), "places-by-document")
    found = with_shingles(keyed.dropDuplicates(["_digest"]).join(per_doc, "_digest"), "_text", SHINGLE)
    windows = found.select("_digest", "_id", "shingles", F.explode_outer("places").alias("p")).select(
        "_digest", "_id", "p.start", "p.runs", F.slice("shingles", F.col("p.start") + 1, F.col("p.taken")).alias("shingles")
    )
    windows = materialize(windows.withColumn("window", F.md5(F.concat_ws("|", "_digest", "start", "runs"))), "windows")

    window_counts = materialize(_counted(windows.select("window", F.explode_outer("shingles").alias("shingle")), "window", rarity, common), "window-counts")
    item_counts = materialize(_counted(listed.select("item", "shingle"), "item", rarity, common), "item-counts")
    window_prints = _prints(window_counts, "window").join(windows.select("window", "runs"), "window")
    item_prints = materialize(_prints(item_counts, "item").join(listed.select("item", "runs").distinct(), "item"), "item-prints")

    index = item_prints.select("item", "runs", F.col("print").alias("item_print"), F.col("total").alias("item_total"), F.explode(blocks("print")).alias("b"))
    asked = window_prints.select("window", "runs", "print", "total", F.explode(blocks("print")).alias("b"))
    close = (
        asked.join(index, ["runs", "b"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select("window", "total", "item", "item_total")
        .distinct()
    )
    close = materialize(close, "close-pairs")
    common_runs = close.join(window_counts, "window").join(item_counts.select("item", "shingle", F.col("times").alias("item_times")), ["item", "shingle"])
    overlap = common_runs.groupBy("window", "item", "total", "item_total").agg(F.sum(F.least("times", "item_times") * F.col("weight")).alias("shared"))
    either = F.col("total") + F.col("item_total") - F.col("shared")
    held = overlap.withColumn("either", either).where(F.col("shared") * SIMILARITY[1] >= F.col("either") * SIMILARITY[0])
    names = listed.select("item", "_item_id").distinct()
    return (
        held.join(windows.select("window", "_digest", "_id", "start", "runs"), "window")
        .join(names, "item")
        .select(
            "_digest",
            F.col("_id").alias(id_col),
            F.col("_item_id").alias(item_id),
            "start",
            (F.col("runs") + SHINGLE - 1).alias("size"),
            "shared",
            "either",
            (F.col("shared") / F.col("either")).alias("similarity"),
        )
    )


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without any window that holds an item; columns and repeated rows stay."""
    held = materialize(leaks(docs, items, id_col, text).select("_digest").distinct(), "leaking")
    name = free_name(docs, "_digest")
    return docs.withColumn(name, row_digest(id_col, text)).join(held.withColumnRenamed("_digest", name), name, "left_anti").drop(name)
