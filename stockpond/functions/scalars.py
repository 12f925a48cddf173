"""Scalar expressions used across the layers. All of them stay on the JVM."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


# All that str.strip takes for white space.
WHITE_SPACE = r"[\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


def clean_text(text: Column) -> Column:
    """Surrounding white space of any kind removed, upper case; NULL stays NULL."""
    return F.upper(F.regexp_replace(text, rf"\A{WHITE_SPACE}+|{WHITE_SPACE}+\z", ""))


def register_clean_text(spark: SparkSession, name: str = "clean_text") -> None:
    """The same function for SQL callers, as an Arrow-batched UDF."""

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in batches:
            yield text.str.strip().str.upper()

    spark.udf.register(name, clean)


def register_category_revenue(spark: SparkSession, summary: DataFrame, name: str = "category_revenue") -> None:
    """A SQL function looking one category up in a summary; NULL when it is unknown."""
    view = f"_{name}_summary"
    summary.createOrReplaceTempView(view)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(cat STRING) RETURNS DECIMAL(38, 2) "
        f"RETURN SELECT SUM(total_revenue) FROM {view} WHERE UPPER(category) = UPPER(cat)"
    )


def first_group(text: Column, pattern: str) -> Column:
    """First capture group of the first match, NULL without a match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def try_to_number(text: Column, precision: int = 18, scale: int = 2) -> Column:
    return text.try_cast(f"decimal({precision},{scale})")


def day_of(ts: Column) -> Column:
    """Midnight of the day, still without a time zone."""
    return F.date_trunc("DAY", ts).cast("timestamp_ntz")


def approx_distinct(column: Column | str, log2_size: int = 14) -> Column:
    """Approximate distinct count from a mergeable sketch, within about 1 % at this size."""
    return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(column, F.lit(log2_size))), F.lit(0))


def preview(text: Column, length: int = 180) -> Column:
    return F.left(text, F.lit(length))


def variant_type(value: Column) -> Column:
    """Kind of a document: OBJECT, ARRAY, INTEGER, VARCHAR, …"""
    head = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    named = {"BIGINT": "INTEGER", "STRING": "VARCHAR", "VOID": "NULL_VALUE"}
    out = head
    for spark_name, name in named.items():
        out = F.when(head == spark_name, name).otherwise(out)
    return out


def search_tokens(question: Column, limit: int = 6, default: str = "policy") -> Column:
    """Lower-case words of more than three characters, in order, the first ``limit``."""
    words = F.regexp_extract_all(F.lower(question), F.lit("([a-z0-9]+)"), F.lit(1))
    tokens = F.slice(F.filter(words, lambda w: F.length(w) > 3), 1, limit)
    return F.when(F.size(tokens) > 0, tokens).otherwise(F.array(F.lit(default)))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays, NULL for a zero vector."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
