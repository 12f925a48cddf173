"""Shards of nearly equal size by longest-processing-time scheduling of groups that stay together."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, functions as F

from stockpond.operators.ordering import global_row_number
from stockpond.session import materialize

# Groups of at least 1 / SINGLES of all bytes are scheduled one by one: at most SINGLES of them.
SINGLES = 1 << 15
# All smaller groups are dealt into this many bundles, each scheduled as one.
BUNDLES = 1 << 15


def least_loaded(items: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Largest item first, each to the shard with the least load (ties: lowest number)."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for item, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        placed[item] = shard
    return placed


def schedule(groups: DataFrame, shards: int) -> DataFrame:
    """``groups`` (``group``: hex digest, ``weight``) with ``shard``.

    Only the schedule goes through the driver: at most SINGLES + BUNDLES items, whatever the
    size of the table. A bundle is a part of the digests, so the small groups in it are whole.
    """
    total = groups.agg(F.sum("weight")).scalar()
    bundle = F.conv(F.substring("group", 1, 8), 16, 10).cast("bigint") % BUNDLES
    item = F.when(F.col("weight") * SINGLES >= total, F.col("group")).otherwise(bundle.cast("string"))
    named = materialize(groups.withColumn("item", item), "shard-items")
    items = [tuple(row) for row in named.groupBy("item").agg(F.sum("weight")).collect()]
    placed = groups.sparkSession.createDataFrame(list(least_loaded(items, shards).items()), "item string, shard int")
    # One row for each scheduled item: at most SINGLES + BUNDLES.
    return named.join(F.broadcast(placed), "item").drop("item")


def with_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col``, ``size`` (UTF-8 bytes + 1), ``text_crc32``, ``shard``, ``slot`` (0, 1, … in each shard) for every row.

    Rows with equal texts go to one shard; a null text counts as an empty one. The slots of a
    shard follow the id (null first), then the checksum. Repeated rows have slots of their own.
    Shard sizes differ by about one bundle (a 32,768th of all bytes), unless a single group outweighs a whole
    share. Other columns are not looked at. Texts are read once and never shuffled.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = materialize(
        docs.select(
            F.col(id_col).alias("_id"),
            (F.octet_length(body) + 1).cast("bigint").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.md5(body).alias("group"),
        ),
        "sizes",
    )
    groups = materialize(rows.groupBy("group").agg(F.sum("size").alias("weight")), "groups")
    placed = rows.join(materialize(schedule(groups, shards).select("group", "shard"), "schedule"), "group").drop("group")
    numbered = materialize(global_row_number(placed, ["shard", "_id", "text_crc32", "size"], "place"), "numbered")
    # One row for each shard.
    first = F.broadcast(numbered.groupBy("shard").agg(F.min("place").alias("first")))
    return numbered.join(first, "shard").select(
        F.col("_id").alias(id_col), "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot")
    )
