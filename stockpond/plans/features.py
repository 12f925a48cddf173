"""Customer features from prior orders, encoders, feature views and training sets."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockpond.operators.asof import asof_join
from stockpond.operators.changes import row_digest
from stockpond.operators.keyed_scan import (
    key_minimum,
    keyed_scan,
    previous_value,
    prior_sum,
)
from stockpond.operators.ordering import global_row_number
from stockpond.session import materialize

NO_PRIORITY = "NONE"
FEATURES = ["log_prior_spend", "days_since_first_order", "priority_ordinal"]


def prior_order_features(events: DataFrame) -> DataFrame:
    """Per order, what was known about the customer before it."""
    scanned = keyed_scan(
        events,
        ["customer_id"],
        ["ts", "order_id"],
        [
            prior_sum("prior_spend", "order_value"),
            key_minimum("first_ts", "ts"),
            previous_value("prior_priority", "order_priority"),
        ],
    )
    spend = F.coalesce(F.col("prior_spend").cast("double"), F.lit(0.0))
    return scanned.select(
        *events.columns,
        F.coalesce("prior_spend", F.lit(0)).alias("prior_spend"),
        F.log1p(spend).alias("log_prior_spend"),
        F.date_diff("ts", "first_ts").alias("days_since_first_order"),
        F.coalesce("prior_priority", F.lit(NO_PRIORITY)).alias("prior_priority"),
    )


def fit_ordinal(df: DataFrame, column: str) -> DataFrame:
    """The vocabulary of a column with positions in sorted order, from 0; a written table."""
    values = df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    numbered = global_row_number(values, ["value"], "position")
    return materialize(numbered.select("value", (F.col("position") - 1).alias("ordinal")), "vocabulary")


def transform_ordinal(df: DataFrame, vocabulary: DataFrame, column: str, output: str) -> DataFrame:
    """Replace values by their position, unknown ones by -1."""
    known = vocabulary.select(F.col("value").alias(column), F.col("ordinal").alias("_ordinal"))
    return df.join(known, column, "left").select(
        *df.columns, F.coalesce("_ordinal", F.lit(-1)).cast("int").alias(output)
    )


def fit_one_hot(df: DataFrame, column: str, output: str) -> PipelineModel:
    """One column per value in sorted order; unknown values become all zeros."""
    index = f"_{column}_index"
    return Pipeline(
        stages=[
            StringIndexer(inputCol=column, outputCol=index, handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCol=index, outputCol=output, dropLast=True),
        ]
    ).fit(df)


def standard_scale(df: DataFrame, columns: dict[str, str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Centre and divide by the population deviation; a constant column becomes 0."""
    source = df if fitted_on is None else fitted_on
    stats = source.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns], *[F.stddev_pop(c).alias(f"dev_{c}") for c in columns]
        ).alias("stats")
    ).scalar()

    def scaled(c: str) -> Column:
        centred = F.col(c) - stats[f"mean_{c}"]
        return F.when(stats[f"dev_{c}"] > 0, centred / stats[f"dev_{c}"]).otherwise(centred * 0.0)

    return df.select(*[c for c in df.columns if c not in columns], *[scaled(c).alias(o) for c, o in columns.items()])


def first_per_time(encoded: DataFrame) -> DataFrame:
    """One feature row per customer and time.

    Orders at the same time share the features of the first of them: those are the only
    ones that contain none of these orders.
    """
    first = F.min_by(F.struct(*FEATURES), "order_id").alias("_first")
    return encoded.groupBy("customer_id", "ts").agg(first).select("customer_id", "ts", "_first.*")


def feature_table(events: DataFrame) -> DataFrame:
    """(customer_id, ts, features), one row per customer and time."""
    features = materialize(prior_order_features(events), "prior-features")
    vocabulary = fit_ordinal(features, "prior_priority")
    return first_per_time(transform_ordinal(features, vocabulary, "prior_priority", "priority_ordinal"))


def labels(events: DataFrame) -> DataFrame:
    return events.select("customer_id", "order_id", "ts", "is_fulfilled")


def training_set(events: DataFrame, features: DataFrame) -> DataFrame:
    """Every label with the features known at its time."""
    return asof_join(labels(events), features, "customer_id", "ts", FEATURES)


BUILDS = "feature_month date, build string, seq bigint"
SEEN = ["customer_id", "order_id"]


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def _current_builds(spark: SparkSession, folder: str) -> DataFrame:
    """Which build holds each month now."""
    return _table(spark, f"{folder}/pointer", BUILDS).groupBy("feature_month").agg(F.max_by("build", "seq").alias("build"))


def read_feature_view(spark: SparkSession, root: str, name: str, version: int) -> DataFrame:
    """The stored rows of a view; builds that no pointer names are not there yet."""
    folder = f"{root}/features/{name}/v={version}"
    # One row for each month.
    return spark.read.parquet(f"{folder}/rows").join(F.broadcast(_current_builds(spark, folder)), ["feature_month", "build"]).drop("build")


def _changed_events(events: DataFrame, seen: DataFrame) -> DataFrame:
    """Keys whose events are not as they were last seen: new, corrected or gone (``now`` is NULL).

    One aggregate over both sides by key; events of the same key are added up, so their order does not matter.
    """
    digest = row_digest(events).cast("decimal(38,0)")
    now = events.select(*SEEN, digest.alias("digest"), F.lit(None).cast("bigint").alias("seq"))
    both = now.unionByName(seen.select(*SEEN, "digest", "seq"))
    state = both.groupBy(*SEEN).agg(
        F.sum(F.when(F.col("seq").isNull(), F.col("digest"))).alias("now"), F.max_by("digest", "seq").alias("before")
    )
    return state.where(~F.col("now").eqNullSafe(F.col("before")))


def refresh_feature_view(events: DataFrame, compute, root: str, name: str, version: int) -> bool:
    """Bring a stored view up to date with ``events``, which is the whole table; False if it was.

    New, corrected and removed events are found by key and digest, whatever their time. Features look back, so ``compute`` gets the
    whole history of the customers with such events, and of them only. The months in which they have rows, or had, are
    written as a new build, next to the old one; the view changes when one small file of the
    pointer is added. A run that died before leaves a build that nobody reads.
    """
    spark, folder = events.sparkSession, f"{root}/features/{name}/v={version}"
    pointer = materialize(_table(spark, f"{folder}/pointer", BUILDS), "feature-pointer")
    last = pointer.agg(F.max("seq")).first()[0]
    key = events.select(*SEEN).schema
    seen = _table(spark, f"{folder}/seen", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in key) + ", digest decimal(38,0), build string")
    seen = seen.join(pointer.select("build", "seq").distinct(), "build")
    changed = materialize(_changed_events(events, seen), "changed-events")
    if changed.isEmpty():
        return False
    touched = materialize(changed.select("customer_id").distinct(), "touched-customers")

    def of_touched(df: DataFrame, how: str) -> DataFrame:
        return df.join(touched, df["customer_id"].eqNullSafe(touched["customer_id"]), how)

    month = F.trunc(F.to_date("ts"), "MONTH")
    recomputed = materialize(compute(materialize(of_touched(events, "left_semi"), "feature-history")).withColumn("feature_month", month), "recomputed")
    months = recomputed.select("feature_month")
    rows = recomputed
    if last is not None and not changed.where("before IS NOT NULL").isEmpty():
        # Corrected events may have left a month; new ones can't.
        months = months.unionByName(of_touched(read_feature_view(spark, root, name, version), "left_semi").select("feature_month"))
    months = materialize(months.distinct(), "touched-months")
    if last is not None:
        # One row for each month.
        stored = read_feature_view(spark, root, name, version).join(F.broadcast(months), "feature_month", "left_semi")
        rows = rows.unionByName(of_touched(stored, "left_anti").select(*rows.columns))
    build = f"b-{uuid.uuid4().hex}"
    placed = rows.withColumn("build", F.lit(build)).repartitionByRange("feature_month", "customer_id").sortWithinPartitions("feature_month", "customer_id", "ts")
    placed.write.mode("append").partitionBy("build", "feature_month").parquet(f"{folder}/rows")
    digests = changed.select(*SEEN, F.col("now").alias("digest"), F.lit(build).alias("build"))
    digests.write.mode("append").partitionBy("build").parquet(f"{folder}/seen")
    entry = months.select("feature_month", F.lit(build).alias("build"), F.lit((last or 0) + 1).cast("bigint").alias("seq"))
    entry.coalesce(1).write.mode("append").parquet(f"{folder}/pointer")
    return True


def table_profile(df: DataFrame, distinct_of: str) -> DataFrame:
    """Per column: NULLs, distinct-or-constant flag; computed in one pass over the table."""
    measures = []
    for c in df.columns:
        measures += [
            F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"),
            F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(f"constant_{c}"),
        ]
    wide = df.agg(F.count("*").alias("rows"), F.count_distinct(distinct_of).alias("keys"), *measures)
    per_column = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(f"nulls_{c}").alias("nulls"), F.col(f"constant_{c}").alias("constant"))
                for c in df.columns
            ]
        )
    )
    return wide.select("rows", "keys", per_column.alias("_c")).select("_c.*", "rows", "keys")


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs of every column in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
