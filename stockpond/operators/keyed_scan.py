"""Running results per key that survive a hot key.

A window ``partitionBy(key)`` is one exchange, but puts a whole key into one task. So the rows of each
key are counted first, added up before they are shuffled. Only keys of more rows than a task should
sort are dealt in chunks: their bounds come from a sample of the key's rows, known before the one exchange
of the rows by key and chunk. Windows run inside the chunks, and what a chunk needs from those before it
is added afterwards, from one row for each chunk.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from stockpond.session import materialize

# Rows of one key that a task sorts at most, chunks of a key at most (as a power of two), and sampled rows for each chunk.
CHUNK_ROWS = 1_000_000
CHUNK_STEPS = 12
PER_CHUNK = 32


def _same(value: Column) -> Column:
    return value


@dataclass(frozen=True)
class Running:
    """How a running column is computed inside a range, summed up, carried and combined."""

    name: str
    local: Callable[[WindowSpec], Column]
    total: Callable[[Column], Column]
    carry: Callable[[Column, WindowSpec], Column]
    combine: Callable[[Column, Column], Column]
    finish: Callable[[Column], Column] = _same


def _before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def _upto(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _add(local: Column, carried: Column) -> Column:
    return F.coalesce(local + carried, local, carried)


def sequence_number(name: str) -> Running:
    return Running(
        name,
        lambda w: F.row_number().over(w).cast("bigint"),
        lambda order: F.count("*"),
        lambda total, w: F.sum(total).over(_before(w)),
        _add,
    )


def running_sum(name: str, value: str) -> Running:
    return Running(
        name,
        lambda w: F.sum(value).over(_upto(w)),
        lambda order: F.sum(value),
        lambda total, w: F.sum(total).over(_before(w)),
        _add,
    )


def prior_sum(name: str, value: str) -> Running:
    """Sum over the rows before the current one; NULL when there are none."""
    return Running(
        name,
        lambda w: F.sum(value).over(_before(w)),
        lambda order: F.sum(value),
        lambda total, w: F.sum(total).over(_before(w)),
        _add,
    )


def previous_value(name: str, value: str) -> Running:
    """The value of the row before, NULL on the first row of a key."""
    return Running(
        name,
        lambda w: F.lag(F.struct(value)).over(w),
        lambda order: F.max_by(F.struct(value), order),
        lambda total, w: F.lag(total).over(w),
        F.coalesce,
        lambda row: row[value],
    )


def last_known(name: str, value: str) -> Running:
    """The latest non-NULL value up to and including the current row."""
    return Running(
        name,
        lambda w: F.last(value, ignorenulls=True).over(_upto(w)),
        lambda order: F.max_by(value, F.when(F.col(value).isNotNull(), order)),
        lambda total, w: F.last(total, ignorenulls=True).over(_before(w)),
        F.coalesce,
    )


def key_minimum(name: str, value: str) -> Running:
    """Minimum over all rows of the key."""
    everything = (Window.unboundedPreceding, Window.unboundedFollowing)
    return Running(
        name,
        lambda w: F.min(value).over(w.rowsBetween(*everything)),
        lambda order: F.min(value),
        lambda total, w: F.min(total).over(w.rowsBetween(*everything)),
        F.least,
    )


def _renamed(keys: list[str]) -> dict[str, str]:
    return {k: f"_k{i}" for i, k in enumerate(keys)}


def _same_key(keys: list[str]) -> Column:
    """Of a side with the keys and one with their renamed copies."""
    same = F.lit(True)
    for k, other in _renamed(keys).items():
        same = same & F.col(k).eqNullSafe(F.col(other))
    return same


def hot_keys(df: DataFrame, keys: list[str], most: int = CHUNK_ROWS) -> DataFrame:
    """The keys with more than ``most`` rows, and how many; a written table, of at most a row for each ``most`` rows of ``df``."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > most)
    return materialize(counted.withColumnsRenamed(_renamed(keys)), "hot-keys")


def _chunk_bounds(df: DataFrame, hot: DataFrame, keys: list[str], order_by: list[str], most: int) -> DataFrame:
    """Of each hot key, the places in the order at which its chunks end, from about ``PER_CHUNK`` sampled rows a chunk."""
    chunks = F.least(F.ceil(F.col("_rows") / most), F.lit(1 << CHUNK_STEPS))
    sampled = df.join(hot, _same_key(keys)).where(F.rand(7) < chunks * PER_CHUNK / F.col("_rows"))
    ordered = F.sort_array(F.collect_list(F.struct(*order_by)))
    bounds = F.filter(ordered, lambda _, i: i % PER_CHUNK == PER_CHUNK - 1)
    return materialize(sampled.groupBy(*_renamed(keys).values()).agg(bounds.alias("_bounds")), "chunk-bounds")


def _chunk(order_by: list[str]) -> Column:
    """How many bounds lie before the row, by halving; 0 for keys without bounds."""
    steps = F.array(*[F.lit(1 << i) for i in range(CHUNK_STEPS - 1, -1, -1)])
    here = F.struct(*order_by)
    search = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("_bounds", at + step - 1) < here, at + step).otherwise(at))
    return F.when(F.col("_bounds").isNull(), F.lit(0)).otherwise(search)


def in_chunks(df: DataFrame, keys: list[str], order_by: list[str], most: int = CHUNK_ROWS, counted: DataFrame | None = None) -> DataFrame | None:
    """``df`` with ``_bounds`` (null for all but hot keys) and ``_chunk``; None without a hot key."""
    hot = hot_keys(df if counted is None else counted, keys, most)
    if hot.isEmpty():
        return None
    bounds = _chunk_bounds(df, hot, keys, order_by, most)
    return df.join(bounds, _same_key(keys), "left").drop(*_renamed(keys).values()).withColumn("_chunk", _chunk(order_by))


def keyed_scan(df: DataFrame, keys: list[str], order_by: list[str], columns: list[Running], most: int = CHUNK_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """Add running columns per key in ascending ``order_by``.

    The rows go through one exchange. A key of more than ``most`` rows, NULL or not, is worked off in chunks
    of about ``most`` rows, at most ``2 ** CHUNK_STEPS`` of them; rows that are equal in ``order_by`` stay together.
    ``df`` is read again for the counts, and where there are hot keys for their bounds and totals; ``counted``
    names a cheaper table to count, which has no fewer rows of any key.
    """
    names = {c.name for c in columns}
    kept = [c for c in df.columns if c not in names]
    dealt = in_chunks(df, keys, order_by, most, counted)
    if dealt is None:
        inside = Window.partitionBy(*keys).orderBy(*order_by)
        scanned = df.withColumns({f"_l{i}": c.local(inside) for i, c in enumerate(columns)})
        return scanned.select(*kept, *[c.finish(F.col(f"_l{i}")).alias(c.name) for i, c in enumerate(columns)])
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order_by)
    scanned = dealt.withColumns({f"_l{i}": c.local(inside) for i, c in enumerate(columns)})
    position = F.struct(*order_by)
    totals = dealt.where("_bounds IS NOT NULL").groupBy(*keys, "_chunk").agg(*[c.total(position).alias(f"_t{i}") for i, c in enumerate(columns)])
    chunks_of_key = Window.partitionBy(*keys).orderBy("_chunk")
    carried = totals.select(
        *[F.col(k).alias(other) for k, other in _renamed(keys).items()],
        F.col("_chunk").alias("_at"),
        *[c.carry(F.col(f"_t{i}"), chunks_of_key).alias(f"_c{i}") for i, c in enumerate(columns)],
    )
    joined = scanned.join(materialize(carried, "carried"), _same_key(keys) & (F.col("_chunk") == F.col("_at")), "left")
    # As text, so that the parts of a structure may be NULL.
    types = {f.name: f.dataType.simpleString() for f in scanned.schema.fields}
    combined = [
        c.finish(c.combine(F.col(f"_l{i}"), F.col(f"_c{i}")).cast(types[f"_l{i}"])).alias(c.name)
        for i, c in enumerate(columns)
    ]
    return joined.select(*kept, *combined)
