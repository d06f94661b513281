"""Applying a stream of change rows batch by batch.

Every micro-batch is one merge commit. The commit carries the stream's name and the batch
number, so a batch that is delivered again after a failure is recognised and skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablesync.operators.changes import change_key
from tablesync.operators.merge import latest_per_key
from tablesync.operators.shape import quoted
from tablesync.sinks.files import stage, staging_scope
from tablesync.sinks.table import TargetTable


def applied_batch(target: TargetTable, stream: str) -> int:
    """Number of the last batch of a stream that the target holds; -1 if none.

    Every commit carries the last batches of all streams, so only the newest one is read.
    """
    latest = target.ledger.latest()
    return -1 if latest is None else latest.streams.get(stream, -1)


def apply_batch(
    target: TargetTable,
    changes: DataFrame,
    batch: int,
    keys: Sequence[str],
    version: str,
    stream: str,
) -> bool:
    """Apply one batch of change rows unless the target holds it already.

    A batch may hold several changes of a key: the one with the highest version counts.
    """
    if batch <= applied_batch(target, stream):
        return False
    change_keys = [change_key(key) for key in keys]
    with staging_scope(target.spark):
        latest = stage(latest_per_key(changes, change_keys, version))
        newest = latest.agg(F.max(quoted(version))).first()[0]
        cursor = target.cursor() if newest is None else int(newest)
        target.apply_changes(
            latest.drop(version), keys, cursor, stream=stream, batch=batch, stage_source=False
        )
    return True


def apply_change_stream(
    changes: DataFrame,
    target: TargetTable,
    keys: Sequence[str],
    version: str,
    stream: str,
    checkpoint: str,
) -> StreamingQuery:
    """Start a query that applies all available change rows to the target, then stops."""
    def apply(batch_rows: DataFrame, batch: int) -> None:
        apply_batch(target, batch_rows, batch, keys, version, stream)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .queryName(stream)
        .trigger(availableNow=True)
        .start()
    )
