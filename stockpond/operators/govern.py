"""Masking and row filters as transforms; the acting role is a parameter."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: what masked text reads.
MASK_TEXT = "***MASKED***"


def mask(df: DataFrame, column: str, allowed_roles: set[str], role: str, replacement: str | None = MASK_TEXT) -> DataFrame:
    """Allowed roles see the column, all others the replacement in the same type."""
    if role in allowed_roles:
        return df
    field_ = df.schema[column]
    return df.withColumn(column, F.lit(replacement).cast(field_.dataType).alias(column, metadata=field_.metadata))


def row_filter(df: DataFrame, predicate: Column, exempt_roles: set[str], role: str) -> DataFrame:
    return df if role in exempt_roles else df.where(predicate)


def tag_columns(df: DataFrame, tags: dict[str, str]) -> DataFrame:
    """Attach a tag to columns; it travels with the schema."""
    return df.withColumns({c: F.col(c).alias(c, metadata={**df.schema[c].metadata, "tag": t}) for c, t in tags.items()})


def mask_tagged(df: DataFrame, tag: str, allowed_roles: set[str], role: str, replacement: str | None = MASK_TEXT) -> DataFrame:
    for column in [f.name for f in df.schema.fields if f.metadata.get("tag") == tag]:
        df = mask(df, column, allowed_roles, role, replacement)
    return df


@dataclass(frozen=True)
class Policies:
    """What protects a table: the row filter first, then the column masks."""

    rows: Callable[[], Column] | None = None
    row_exempt: set[str] = field(default_factory=set)
    masks: dict[str, tuple[set[str], str | None]] = field(default_factory=dict)


def governed(df: DataFrame, policies: Policies, role: str) -> DataFrame:
    """The table as ``role`` may see it; counts and aggregates belong on this frame."""
    if policies.rows is not None:
        df = row_filter(df, policies.rows(), policies.row_exempt, role)
    for column, (allowed, replacement) in policies.masks.items():
        df = mask(df, column, allowed, role, replacement)
    return df
