"""JSON documents: paths, exploded arrays and aggregates over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stockpond.functions.scalars import variant_type


def parse_documents(df: DataFrame, text: str, alias: str = "doc", strict: bool = False) -> DataFrame:
    """The text column as a VARIANT; malformed text gives NULL, or fails the query if ``strict``."""
    parse = F.parse_json if strict else F.try_parse_json
    return df.withColumn(alias, parse(text)).drop(text)


def path(doc: Column | str, json_path: str, data_type: str) -> Column:
    return F.try_variant_get(F.col(doc) if isinstance(doc, str) else doc, json_path, data_type)


def flatten_array(df: DataFrame, doc: str, array_path: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per array element with typed fields ``alias -> (path, type)``.

    Documents without the array, or with an empty one, give no row.
    """
    exploded = df.withColumn("_item", F.explode(path(doc, array_path, "array<variant>")))
    return exploded.select(
        *[c for c in df.columns if c != doc],
        doc,
        *[path("_item", p, t).alias(alias) for alias, (p, t) in fields.items()],
    )


def document_types(df: DataFrame, doc: str) -> DataFrame:
    return df.groupBy(variant_type(F.col(doc)).alias("data_type")).agg(F.count("*").alias("documents"))
