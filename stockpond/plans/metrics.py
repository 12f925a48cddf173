"""A small metric layer: named measures and dimensions over Gold tables."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

AGGREGATES = {
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "count_distinct": F.count_distinct,
    # Distinct values from stored sketches, which unite over any grouping; no sketches, no values.
    "sketch_distinct": lambda c: F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0).cast("bigint")),
}
COMPARISONS = {
    "=": lambda c, v: c == v,
    "<>": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),
}


def load_spec(path: str | Path | None = None) -> dict:
    """A semantic model; the one for the retail tables by default."""
    return yaml.safe_load(Path(path or Path(__file__).with_name("retail_metrics.yaml")).read_text())


def read_tables(spark: SparkSession, spec: dict, root: str) -> dict[str, DataFrame]:
    """The tables of a model, each read from its ``base_table`` below ``root``."""
    return {t["name"]: spark.read.parquet(f"{root.rstrip('/')}/{t['base_table']}") for t in spec["tables"]}


def _lookup(entries: list[dict], name: str) -> dict | None:
    wanted = name.lower()
    for entry in entries:
        names = [entry["name"], *entry.get("synonyms", [])]
        if wanted in (n.lower() for n in names):
            return entry
    return None


def _dimensions(table: dict) -> list[dict]:
    return [*table.get("dimensions", []), *table.get("time_dimensions", [])]


def _find_table(spec: dict, measures: Sequence[str], dimensions: Sequence[str]) -> dict:
    for table in spec["tables"]:
        if all(_lookup(table.get("measures", []), m) for m in measures) and all(
            _lookup(_dimensions(table), d) for d in dimensions
        ):
            return table
    raise ValueError(f"no table offers measures {list(measures)} by {list(dimensions)}")


def _roll_up(measure: dict, keeps_rows: bool) -> Column:
    if measure.get("additive", True) is False and not keeps_rows:
        raise ValueError(f"{measure['name']} cannot be added up; group by the table's unique dimension")
    return AGGREGATES[measure.get("default_aggregation", "sum")](F.expr(measure["expr"])).alias(measure["name"])


def metric_query(
    tables: dict[str, DataFrame],
    spec: dict,
    measures: Sequence[str],
    dimensions: Sequence[str] = (),
    filters: Sequence[tuple[str, str, object]] = (),
    order_by: Sequence[tuple[str, str]] | None = None,
    table: str | None = None,
) -> DataFrame:
    """Measures by dimensions, from the first table offering all names.

    Names may be synonyms; unknown ones are refused, and so is adding up a measure that is
    marked as not additive. Filters are (dimension, comparison, value).
    """
    wanted_dimensions = [*dimensions, *[f[0] for f in filters]]
    if table is None:
        model = _find_table(spec, measures, wanted_dimensions)
    else:
        model = next((t for t in spec["tables"] if t["name"] == table), None)
        if model is None:
            raise ValueError(f"unknown table {table}")
        missing = [m for m in measures if not _lookup(model.get("measures", []), m)]
        missing += [d for d in wanted_dimensions if not _lookup(_dimensions(model), d)]
        if missing:
            raise ValueError(f"{table} does not offer {missing}")

    rows = tables[model["name"]]
    for name, comparison, value in filters:
        rows = rows.where(COMPARISONS[comparison](F.expr(_lookup(_dimensions(model), name)["expr"]), value))

    chosen = [_lookup(_dimensions(model), d) for d in dimensions]
    keeps_rows = any(d.get("unique", False) for d in chosen)
    result = rows.groupBy(*[F.expr(d["expr"]).alias(d["name"]) for d in chosen]).agg(
        *[_roll_up(_lookup(model["measures"], m), keeps_rows) for m in measures]
    )
    if order_by:
        result = result.orderBy(*[F.desc(n) if way == "desc" else F.asc(n) for n, way in order_by])
    return result


def verified_query(tables: dict[str, DataFrame], spec: dict, name: str) -> DataFrame:
    """One of the named questions kept in the model."""
    entry = next((q for q in spec.get("verified_queries", []) if q["name"] == name), None)
    if entry is None:
        raise ValueError(f"unknown question {name}")
    order_by = [tuple(o) for o in entry.get("order_by", [])]
    return metric_query(tables, spec, entry["measures"], entry.get("dimensions", []), order_by=order_by)
