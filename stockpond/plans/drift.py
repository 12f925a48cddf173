"""Feature, prediction and performance drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockpond.operators.ordering import range_sorted
from stockpond.session import materialize

# Alert limits.
PSI_ALERT = 0.2
F1_DROP_ALERT = 0.05

EMPTY_BIN = 1e-6


def sorted_values(reference: DataFrame, live: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, r, l): how often each value of each feature occurs on both sides, written in one range sort for all features."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    both = reference.select(*columns, F.lit(1).alias("r"), F.lit(0).alias("l")).unionByName(live.select(*columns, F.lit(0).alias("r"), F.lit(1).alias("l")))
    long = both.select(F.explode(pairs).alias("p"), "r", "l").select("p.feature", "p.value", "r", "l").where("value IS NOT NULL")
    return range_sorted(long.groupBy("feature", "value").agg(F.sum("r").alias("r"), F.sum("l").alias("l")), ["feature", "value"], "feature-values")


def range_totals(placed: DataFrame) -> DataFrame:
    """Per range of the sort and feature, rows of both sides before it (``from_``), up to its end (``to_``) and in all; one row for each."""
    totals = placed.groupBy("_part", "feature").agg(F.sum("r").alias("_r"), F.sum("l").alias("_l"))
    of_feature, whole = Window.partitionBy("feature").orderBy("_part"), Window.partitionBy("feature")
    upto = of_feature.rowsBetween(Window.unboundedPreceding, 0)
    summed = totals.withColumns({f"to_{c}": F.sum(f"_{c}").over(upto) for c in "rl"} | {f"all_{c}": F.sum(f"_{c}").over(whole) for c in "rl"})
    return summed.select("_part", "feature", *[(F.col(f"to_{c}") - F.col(f"_{c}")).alias(f"from_{c}") for c in "rl"], "to_r", "to_l", "all_r", "all_l")


def running_shares(placed: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows of ``placed`` that lie in ``ranges``, with ``cum_r`` and ``cum_l`` within their feature."""
    inside = Window.partitionBy("_part", "feature").orderBy("_position").rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.join(F.broadcast(ranges), ["_part", "feature"])
    return joined.withColumns({f"cum_{c}": F.col(f"from_{c}") + F.sum(c).over(inside) for c in "rl"})


def quantile_edges(placed: DataFrame, ranges: DataFrame, bins: int = 10) -> DataFrame:
    """(feature, edges, all_r, all_l): inner bin edges at equal shares of the reference, exact; one row for each feature.

    Edge i is the smallest value with at least i / bins of the reference rows up to it. Only the
    ranges of the sort that hold an edge are looked into.
    """
    share = lambda c: F.floor(F.col(c) * bins / F.col("all_r"))
    running = running_shares(placed, ranges.where(share("to_r") > share("from_r")))
    edges = [F.min(F.when(F.col("cum_r") * bins >= F.col("all_r") * i, F.col("value"))) for i in range(1, bins)]
    found = running.groupBy("feature").agg(F.array_compact(F.array(*edges)).alias("edges"))
    whole = ranges.groupBy("feature").agg(F.max("all_r").alias("all_r"), F.max("all_l").alias("all_l"))
    return whole.join(found, "feature", "left")


def equal_edges(low: float, high: float, bins: int = 10) -> list[Column]:
    return [F.lit(low + (high - low) * i / bins) for i in range(1, bins)]


def bin_of(value: Column, edges: list[Column]) -> Column:
    """Number of edges below the value: 0 for the first bin. Equal edges leave bins empty."""
    return sum((F.when(edge < value, 1).otherwise(0) for edge in edges), F.lit(0))


def binned_shares(reference: DataFrame, live: DataFrame, column: str, edges: list[Column]) -> DataFrame:
    """Share of reference and of live rows per bin."""
    both = reference.select(column, F.lit(1).alias("_ref")).unionByName(live.select(column, F.lit(0).alias("_ref")))
    counted = (
        both.where(F.col(column).isNotNull())
        .groupBy(bin_of(F.col(column), edges).alias("bin"))
        .agg(F.sum("_ref").alias("_r"), F.sum(1 - F.col("_ref")).alias("_l"))
    )
    # One row per bin from here on.
    whole = Window.partitionBy()
    return counted.select(
        "bin",
        (F.col("_r") / F.sum("_r").over(whole)).alias("reference_share"),
        (F.col("_l") / F.sum("_l").over(whole)).alias("live_share"),
    )


def population_stability(reference: DataFrame, live: DataFrame, columns: str | list[str], bins: int = 10) -> DataFrame:
    """PSI of each feature over quantile bins of the reference, with the alert flag; NULLs are left out."""
    placed = sorted_values(reference, live, [columns] if isinstance(columns, str) else columns)
    # One row for each feature.
    edges = F.broadcast(materialize(quantile_edges(placed, range_totals(placed), bins), "bin-edges"))
    below = F.size(F.filter("edges", lambda edge: edge < F.col("value")))
    counted = placed.join(edges, "feature").groupBy("feature", "all_r", "all_l", below.alias("bin")).agg(F.sum("r").alias("r"), F.sum("l").alias("l"))
    p = F.greatest(F.try_divide("r", "all_r"), F.lit(EMPTY_BIN))
    q = F.greatest(F.try_divide("l", "all_l"), F.lit(EMPTY_BIN))
    return counted.groupBy("feature").agg(F.sum((q - p) * F.log(q / p)).alias("psi")).select("feature", "psi", (F.col("psi") > PSI_ALERT).alias("alert"))


def kolmogorov_smirnov(reference: DataFrame, live: DataFrame, columns: str | list[str]) -> DataFrame:
    """Greatest gap between the two cumulative distributions of each feature, exact over all values."""
    placed = sorted_values(reference, live, [columns] if isinstance(columns, str) else columns)
    running = running_shares(placed, range_totals(placed))
    gap = F.abs(F.try_divide("cum_r", "all_r") - F.try_divide("cum_l", "all_l"))
    return running.groupBy("feature").agg(F.max(gap).alias("ks"))


def prediction_drift(reference: DataFrame, live: DataFrame, score: str, threshold: float = 0.5, bins: int = 10) -> DataFrame:
    """Share of scores per fixed bin, and the rate of predicted ones, live against reference."""
    shares = binned_shares(reference, live, score, equal_edges(0.0, 1.0, bins))

    def positive_rate(df: DataFrame) -> Column:
        return df.agg(F.avg((F.col(score) >= threshold).cast("int")).alias("rate")).scalar()

    return shares.select(
        "bin",
        "reference_share",
        "live_share",
        (F.col("live_share") - F.col("reference_share")).alias("difference"),
        (positive_rate(live) - positive_rate(reference)).alias("positive_rate_change"),
    )


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return F.try_divide(2 * tp, 2 * tp + fp + fn)


def trailing_f1(scored: DataFrame, ts: str, label: str, prediction: str, baseline: float, days: int = 30) -> DataFrame:
    """F1 over the trailing days for every day with data, and whether it fell too far."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    daily = scored.groupBy(F.to_date(ts).alias("day")).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn")
    )
    # One row per calendar day.
    trailing = Window.orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    sums = {c: F.sum(c).over(trailing) for c in ("tp", "fp", "fn")}
    value = f1(sums["tp"], sums["fp"], sums["fn"])
    return daily.select("day", value.alias("f1")).withColumn("alert", F.col("f1") < baseline - F1_DROP_ALERT)
