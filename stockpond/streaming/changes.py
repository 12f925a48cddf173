"""Change streams applied to a table and to a summary of it.

A micro-batch writes only its own changes, to a folder named after the batch, so its cost
follows the changes and a replayed batch overwrites itself instead of counting twice. The
current state is put together when read, and can be compacted into a new base at any time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stockpond.operators.changes import (
    ACTION,
    IS_UPDATE,
    apply_changes,
    effective_changes,
    merge_summary,
    summary_deltas,
)
from stockpond.operators.clean import keep_latest


def _start(changes: DataFrame, step, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = changes.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def stream_apply(
    changes: DataFrame, log_dir: str, key: list[str], order_by: list[str], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Collect the last change per key of every micro-batch; empty batches write nothing."""

    def step(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        latest = keep_latest(effective_changes(batch), key, order_by)
        latest.write.mode("overwrite").parquet(f"{log_dir}/_batch_id={batch_id}")

    return _start(changes, step, checkpoint, every)


def current_state(base: DataFrame, log_dir: str, key: list[str], order_by: list[str]) -> DataFrame:
    """The base with all collected changes applied; the greatest ``order_by`` wins, however late it came."""
    spark = base.sparkSession
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in base.schema)}, {ACTION} string, {IS_UPDATE} boolean"
    extra = [c for c in order_by if c not in base.columns]
    try:
        # The types of other order columns are those the feed was written with.
        stored = spark.read.parquet(log_dir).schema if extra else None
        schema += "".join(f", `{c}` {stored[c].dataType.simpleString()}" for c in extra)
        log = spark.read.schema(f"{schema}, _batch_id bigint").parquet(log_dir)
    except AnalysisException:
        return base
    latest = keep_latest(log, key, [*order_by, "_batch_id"])
    return apply_changes(base, latest, key)


def stream_summary(
    changes: DataFrame, delta_dir: str, group: list[str], measure: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Collect the signed changes of a summary, one small result per micro-batch."""

    def step(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        deltas = summary_deltas(batch, group, measure)
        deltas.write.mode("overwrite").parquet(f"{delta_dir}/_batch_id={batch_id}")

    return _start(changes, step, checkpoint, every)


def current_summary(summary: DataFrame, delta_dir: str, group: list[str]) -> DataFrame:
    """The stored summary plus all collected changes; emptied groups are dropped."""
    try:
        deltas = summary.sparkSession.read.parquet(delta_dir).drop("_batch_id")
    except AnalysisException:
        return summary
    return merge_summary(summary, deltas, group)
