"""Daily series, trend-and-weekday forecasts and anomalies, for one or many series at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

Z95 = 1.96


def daily_series(df: DataFrame, ts: str, value: Column, keys: list[str] | None = None) -> DataFrame:
    """Sum per day."""
    return df.groupBy(*(keys or []), F.to_date(ts).alias("ts")).agg(F.sum(value).cast("double").alias("y"))


def complete_calendar(series: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Every day between the first and last of a series; missing days count 0."""
    by = keys or []
    span = series.groupBy(*by).agg(F.min("ts").alias("_first"), F.max("ts").alias("_last"))
    days = span.select(*by, F.explode(F.sequence("_first", "_last", F.expr("interval 1 day"))).alias("ts"))
    return days.join(series, [*by, "ts"], "left").select(*by, "ts", F.coalesce("y", F.lit(0.0)).alias("y"))


def _day_number(ts: str) -> Column:
    return F.unix_date(ts).cast("double")


def _attach(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Add the statistics of its series to each row; those of a single series are one row."""
    if keys:
        return df.join(stats, keys)
    row = stats.select(F.struct("*")).scalar()
    return df.withColumns({c: row[c] for c in stats.columns})


def fit(series: DataFrame, keys: list[str]) -> DataFrame:
    """The days of each series with its trend, the weekday effect and what remains."""
    trend = series.groupBy(*keys).agg(
        F.regr_slope("y", _day_number("ts")).alias("_slope"),
        F.regr_intercept("y", _day_number("ts")).alias("_intercept"),
        F.max("ts").alias("_last"),
    )
    fitted = _attach(series, trend, keys).withColumns(
        {
            "_weekday": F.dayofweek("ts"),
            "_residual": F.col("y") - (F.col("_intercept") + F.col("_slope") * _day_number("ts")),
        }
    )
    effect = fitted.groupBy(*keys, "_weekday").agg(F.avg("_residual").alias("_effect"))
    return fitted.join(effect, [*keys, "_weekday"]).withColumn("_rest", F.col("_residual") - F.col("_effect"))


def forecast(series: DataFrame, horizon: int = 14, keys: list[str] | None = None) -> DataFrame:
    """The next days of each series: trend plus weekday effect, with a 95 % band.

    The trend is the least-squares line over the days, the weekday effect the mean residual
    of that weekday, and the band 1.96 deviations of what remains.
    """
    by = keys or []
    fitted = fit(complete_calendar(series, by), by)
    model = fitted.groupBy(*by).agg(
        F.first("_slope").alias("_slope"),
        F.first("_intercept").alias("_intercept"),
        F.first("_last").alias("_last"),
        F.coalesce(F.stddev_samp("_rest"), F.lit(0.0)).alias("_sigma"),
    )
    effects = fitted.groupBy(*by, "_weekday").agg(F.first("_effect").alias("_effect"))
    ahead = model.withColumn(
        "ts", F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon), F.expr("interval 1 day")))
    ).withColumn("_weekday", F.dayofweek("ts"))
    level = F.col("_intercept") + F.col("_slope") * _day_number("ts") + F.coalesce("_effect", F.lit(0.0))
    band = F.col("_sigma") * Z95
    return ahead.join(effects, [*by, "_weekday"], "left").select(
        *by, "ts", level.alias("forecast"), (level - band).alias("lower_bound"), (level + band).alias("upper_bound")
    )


def anomalies(series: DataFrame, sigmas: float = 3.0, keys: list[str] | None = None) -> DataFrame:
    """Days whose distance from trend and weekday effect exceeds ``sigmas`` deviations."""
    by = keys or []
    fitted = fit(complete_calendar(series, by), by)
    spread = fitted.groupBy(*by).agg(F.stddev_samp("_rest").alias("_sigma"))
    return (
        _attach(fitted, spread, by)
        .where(F.abs("_rest") > F.col("_sigma") * sigmas)
        .select(
            *by,
            "ts",
            "y",
            (F.col("y") - F.col("_rest")).alias("expected"),
            (F.col("_rest") / F.col("_sigma")).alias("deviations"),
        )
    )
