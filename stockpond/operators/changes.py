"""Change feeds between table versions, merges and incrementally kept summaries."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from stockpond.session import materialize

ACTION = "_action"
IS_UPDATE = "_is_update"


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once; must be empty for both sides of a feed."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")


def same_key(left: DataFrame, right: DataFrame, key: list[str]) -> Column:
    """Equal keys, NULL equal to NULL."""
    same = F.lit(True)
    for c in key:
        same = same & left[c].eqNullSafe(right[c])
    return same


def change_feed(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Net difference of two versions with unique keys.

    An update gives two rows, the old one as DELETE and the new one as INSERT, both marked
    as update; unchanged rows give none. A NULL key is a key like any other. Both sides are
    shuffled once, on the key. Keys must be unique on either side (``duplicate_keys`` tells).
    """
    columns = new.columns
    before = old.select(*key, F.struct(*columns).alias("_old"))
    after = new.select(*key, F.struct(*columns).alias("_new"))
    paired = before.join(after, same_key(before, after, key), "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))
    is_update = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    change = F.explode(
        F.filter(
            F.array(
                F.struct(F.lit("DELETE").alias(ACTION), F.col("_old").alias("row")),
                F.struct(F.lit("INSERT").alias(ACTION), F.col("_new").alias("row")),
            ),
            lambda c: c["row"].isNotNull(),
        )
    )
    return paired.select(is_update.alias(IS_UPDATE), change.alias("_change")).select(
        "_change.row.*", f"_change.{ACTION}", IS_UPDATE
    )


def row_digest(df: DataFrame) -> Column:
    """A 64-bit hash of all columns of a row, whatever their order.

    NULLs are hashed as flags of their own, because a hash skips them. Nested columns, in which that
    is not possible, are refused.
    """
    nested = [f.name for f in df.schema if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]
    if nested:
        raise ValueError(f"no digest of nested columns {nested}")
    columns = sorted(df.columns)
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def range_digests(df: DataFrame, range_of: Column) -> DataFrame:
    """Per key range the number of rows and two digests of all their columns."""
    return (
        df.select(range_of.alias("_range"), row_digest(df).alias("_row"))
        .groupBy("_range")
        .agg(F.count("*").alias("rows"), F.bit_xor("_row").alias("xor"), F.sum(F.col("_row").cast("decimal(20,0)")).alias("sum"))
    )


def changed_ranges(old_digests: DataFrame, new_digests: DataFrame) -> DataFrame:
    """The key ranges whose rows differ, also those that only one version has."""
    sides = old_digests.withColumn("_side", F.lit(1)).unionByName(new_digests.withColumn("_side", F.lit(-1)))
    even = F.sum(F.col("_side") * F.col("rows")) == 0
    even = even & (F.bit_xor("xor") == 0) & (F.sum(F.col("_side") * F.col("sum")) == 0)
    return sides.groupBy("_range").agg(even.alias("_even")).where("NOT _even").select("_range")


def change_feed_by_range(
    old: DataFrame, new: DataFrame, key: list[str], range_of: Column, old_digests: DataFrame | None = None
) -> DataFrame:
    """``change_feed``, in which ranges of keys with equal digests are scanned but neither shuffled nor joined.

    ``range_of`` is an expression of the key alone; it should keep apart what changes from what stays and give
    far fewer ranges than rows. ``old_digests``, stored with the old version, spare its first scan. A change is
    missed only if 64-bit hashes of different rows are equal.
    """
    kept = range_digests(old, range_of) if old_digests is None else old_digests
    touched = materialize(changed_ranges(kept, range_digests(new, range_of)), "changed-ranges")

    def of_touched(df: DataFrame) -> DataFrame:
        return df.join(touched, range_of.eqNullSafe(touched["_range"]), "left_semi")

    return change_feed(of_touched(old), of_touched(new), key)


def has_data(changes: DataFrame) -> bool:
    return not changes.isEmpty()


def effective_changes(feed: DataFrame) -> DataFrame:
    """The feed without the delete half of updates: at most one row per key."""
    return feed.where(~((F.col(ACTION) == "DELETE") & F.col(IS_UPDATE)))


def apply_changes(target: DataFrame, feed: DataFrame, key: list[str]) -> DataFrame:
    """Next version of ``target``.

    Matched deletes go, other matches are replaced, unmatched inserts are added and
    unmatched deletes ignored. Written as anti-join plus union, so a small feed is
    broadcast by its size and the target is not shuffled.
    """
    changes = effective_changes(feed)
    changed = changes.select(*key)
    untouched = target.join(changed, same_key(target, changed, key), "left_anti")
    arrived = changes.where(F.col(ACTION) == "INSERT").select(*target.columns)
    return untouched.select(*target.columns).unionByName(arrived)


def upsert(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Source rows replace target rows of the same key; all other target rows stay."""
    kept = target.join(source.select(*key), key, "left_anti").select(*target.columns)
    return kept.unionByName(source.select(*target.columns))


def new_rows(source: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Source rows whose key the target does not have yet.

    A corrected version of a known key is left out, as the ingest rule wants it. The known
    keys are reduced before the join, so that a key repeated very often costs nothing there.
    """
    known = materialize(target.select(*key).distinct(), "known-keys")
    return source.join(known, key, "left_anti")


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Next version after ``UPDATE … SET … WHERE``; a NULL condition leaves the row alone."""
    types = dict(df.dtypes)
    return df.withColumns({c: F.when(condition, v.cast(types[c])).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Next version after ``DELETE … WHERE``; rows with a NULL condition stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def summarize(df: DataFrame, group: list[str], measure: str) -> DataFrame:
    """Full computation of the stored summary: rows, non-NULL measures, sum."""
    return df.groupBy(*group).agg(
        F.count("*").alias("row_count"),
        F.count(measure).alias("value_count"),
        F.sum(measure).alias("total"),
    )


def summary_deltas(feed: DataFrame, group: list[str], measure: str) -> DataFrame:
    """What a feed adds to each group, negative where rows leave.

    Every change row counts with its sign, both halves of an update included, so a row
    that moves to another group is taken from one and added to the other.
    """
    sign = F.when(F.col(ACTION) == "INSERT", 1).otherwise(-1)
    return feed.groupBy(*group).agg(
        F.sum(sign).alias("row_count"),
        F.sum(F.when(F.col(measure).isNotNull(), sign).otherwise(0)).alias("value_count"),
        F.sum(sign * F.col(measure)).alias("total"),
    )


def settle(parts: DataFrame, group: list[str], types: dict[str, str]) -> DataFrame:
    """Summary rows and deltas added up; emptied groups go, a group without measures has no total."""
    merged = parts.groupBy(*group).agg(*[F.sum(c).alias(c) for c in ("row_count", "value_count", "total")])
    return merged.where("row_count > 0").select(
        *group,
        F.col("row_count").cast(types["row_count"]).alias("row_count"),
        F.col("value_count").cast(types["value_count"]).alias("value_count"),
        F.when(F.col("value_count") > 0, F.col("total")).cast(types["total"]).alias("total"),
    )


def merge_summary(summary: DataFrame, deltas: DataFrame, group: list[str]) -> DataFrame:
    """Stored summary plus deltas."""
    return settle(summary.unionByName(deltas), group, dict(summary.dtypes))


def refresh_summary(summary: DataFrame, feed: DataFrame, group: list[str], measure: str) -> DataFrame:
    """The summary after a feed, from the old summary and the changed rows only."""
    return merge_summary(summary, summary_deltas(feed, group, measure), group)


def passthrough_refresh(copy: DataFrame, old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Bring a plain copy of ``old`` up to ``new``; the feed is written once, as merging reads it twice."""
    return apply_changes(copy, materialize(change_feed(old, new, key), "feed"), key)


OFFSETS = "consumer string, upto bigint, consumed_at timestamp_ntz"


def consumed_upto(spark: SparkSession, offsets: str, consumer: str) -> int:
    """The last version of a feed that a consumer has taken, -1 at first."""
    try:
        known = spark.read.schema(OFFSETS).parquet(offsets)
    except AnalysisException:
        return -1
    last = known.where(F.col("consumer") == consumer).agg(F.max("upto")).first()[0]
    return -1 if last is None else last


def pending_changes(log: DataFrame, offsets: str, consumer: str, version: str) -> DataFrame:
    """The part of a change log that a consumer hasn't taken yet."""
    return log.where(F.col(version) > consumed_upto(log.sparkSession, offsets, consumer))


def mark_consumed(taken: DataFrame, offsets: str, consumer: str, version: str) -> None:
    """Note how far a consumer is, after it has stored what it made of ``taken``; nothing taken, nothing noted."""
    last = taken.agg(F.max(version).cast("bigint").alias("upto")).where("upto IS NOT NULL")
    last.select(F.lit(consumer).alias("consumer"), "upto", F.localtimestamp().alias("consumed_at")).coalesce(1).write.mode("append").parquet(offsets)
