"""Column statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def column_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per numeric column, in one pass."""

    def stats(c: str):
        return F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).cast("double").alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )

    return df.agg(F.array(*[stats(c) for c in columns]).alias("_s")).select(F.inline("_s"))
