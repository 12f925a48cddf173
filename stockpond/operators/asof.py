"""Point-in-time joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockpond.operators.keyed_scan import keyed_scan, last_known
from stockpond.session import materialize


def asof_join(
    spine: DataFrame,
    features: DataFrame,
    key: str,
    ts: str,
    feature_columns: list[str],
    tie_break: str | None = None,
) -> DataFrame:
    """Every spine row with the latest features of its key whose time is not later.

    Of feature rows with the same key and time the one with the largest ``tie_break`` counts;
    without that argument there must be one row per (key, ts). Both sides are stacked and scanned along time,
    features first on equal times, which is one shuffle by key and no range join. Spine
    rows without an earlier feature row keep NULLs.
    """
    tie = F.col(tie_break) if tie_break else F.lit(0)
    spine_columns = [c for c in spine.columns if c not in (key, ts)]
    observed = features.select(
        key,
        ts,
        F.lit(0).alias("_side"),
        tie.alias("_tie"),
        F.lit(None).cast(spine.select(F.struct(key, *spine_columns)).schema[0].dataType).alias("_spine"),
        F.struct(*feature_columns).alias("_features"),
    )
    asked = spine.select(
        key,
        ts,
        F.lit(1).alias("_side"),
        F.lit(None).cast(observed.schema["_tie"].dataType).alias("_tie"),
        F.struct(key, *spine_columns).alias("_spine"),
        F.lit(None).cast(observed.schema["_features"].dataType).alias("_features"),
    )
    stacked = observed.unionByName(asked)
    scanned = keyed_scan(
        stacked,
        [key],
        [ts, "_side", "_tie"],
        [last_known("_known", "_features")],
    )
    return scanned.where("_side = 1").select(
        key, ts, *[F.col(f"_spine.{c}").alias(c) for c in spine_columns], *[F.col(f"_known.{c}").alias(c) for c in feature_columns]
    )


def latest_features(features: DataFrame, key: str, ts: str, feature_columns: list[str]) -> DataFrame:
    """The newest features per key, whatever the time of the label: leaks the future."""
    newest = F.max_by(F.struct(ts, *feature_columns), ts).alias("_latest")
    return features.groupBy(key).agg(newest).select(
        key, F.col(f"_latest.{ts}").alias("feature_ts"), *[F.col(f"_latest.{c}").alias(c) for c in feature_columns]
    )


def leakage_report(spine: DataFrame, features: DataFrame, key: str, ts: str) -> DataFrame:
    """How many spine rows a plain join on the latest features would feed with later data."""
    newest = materialize(features.groupBy(key).agg(F.max(ts).alias("feature_ts")), "newest-features")
    joined = spine.join(newest, key)
    leaked = F.count_if(F.col("feature_ts") > F.col(ts))
    return joined.agg(
        F.count("*").alias("rows"), leaked.alias("leaked_rows"), (leaked / F.count("*")).alias("leaked_share")
    )
