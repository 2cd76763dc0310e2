"""Appending a stream of rows to a log."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from topiclog.sources.log import TopicLog


def append_stream(
    rows: DataFrame,
    log: TopicLog,
    order_by: Sequence[str],
    checkpoint: str,
    name: str,
    keyed: bool = True,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Append each micro-batch to the log; offsets go on where the last batch ended.

    The append is named after the micro-batch, so one that is run again replaces itself: each row gets
    into the log once. One query may write a log at a time.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        target = log.within(batch.sparkSession)
        append = target.append_keyed if keyed else target.append_unkeyed
        # Numbering reads the batch more than once.
        batch.persist()
        try:
            append(batch, order_by, f"{name}-{batch_id}")
        finally:
            batch.unpersist()

    return (
        rows.writeStream.queryName(name).foreachBatch(run)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )
