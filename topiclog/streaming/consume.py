"""Consuming a stream of messages: process, then commit, at least once.

Spark's checkpoint decides what a restarted query reads next; the commit ledger records the group's
position for everything else (lag, backlog, other readers). A micro-batch that failed is delivered
again under the same id, so sinks should be idempotent on (topic, partition, offset).
"""

from __future__ import annotations

import logging
import os
from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from topiclog.errors import ProcessingError
from topiclog.functions.positions import known_or_zero, read_storage
from topiclog.operators.assignment import changes
from topiclog.operators.offsets import lag, processed, stored_storage
from topiclog.sources.ledger import CommitLedger

_log = logging.getLogger(__name__)
_KEYS = ["topic", "partition"]


def consume(
    messages: DataFrame,
    process: Callable[[DataFrame, int], Any],
    ledger: CommitLedger,
    group_id: str,
    checkpoint: str,
    name: str,
    storage: str | None = None,
    auto_commit: bool = True,
    starts: DataFrame | None = None,
    heads: Callable[[SparkSession], DataFrame] | None = None,
    watch: PartitionWatch | None = None,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Run ``process(batch, batch_id)`` on each micro-batch, then commit behind its last messages.

    A log directory may deliver the files of one append in any order. Give ``starts`` (``topic, partition,
    start``, the offsets the stream begins at) for such a source: a partition is then committed only
    once nothing before the commit is missing. The first run stores them. ``heads`` gives the partitions
    with their ``next_offset``, where those start that were added since.

    The trigger sets how often that is: ``{"availableNow": True}`` reads what is there and stops,
    ``{"processingTime": "1 second"}`` goes on. With ``auto_commit`` off, ``process`` commits through
    the ledger itself, all it processed or a part.
    """
    progress = None if starts is None else _Progress(os.path.join(checkpoint, "progress"), starts, heads)

    def run(batch: DataFrame, batch_id: int) -> None:
        if watch is not None:
            watch.check(batch.sparkSession, batch_id)
        try:
            process(batch, batch_id)
        except Exception as cause:
            raise ProcessingError(f"processing of micro-batch {batch_id} failed: {cause}") from cause
        if auto_commit:
            done = processed(batch) if progress is None else progress.committable(batch, batch_id)
            ledger.commit(group_id, done, storage, entry=f"{name}-{batch_id}")

    return (
        messages.writeStream.queryName(name).foreachBatch(run)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


# Snapshots kept per stream: the last one is read, and a micro-batch that runs again finds the one before it.
_SLOTS = 4


def _slot(path: str, batch_id: int) -> str:
    return os.path.join(path, f"slot={batch_id % _SLOTS}")


def _snapshot(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """The table that micro-batch ``batch_id`` left; empty if there is none."""
    if batch_id >= 0:
        try:
            return spark.read.schema(schema + ", batch_id bigint").parquet(_slot(path, batch_id)).where(F.col("batch_id") == batch_id).drop("batch_id")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)


def _keep(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(_slot(path, batch_id))


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """``topic, partition, first, last`` ranges of offsets with those that overlap or touch made one."""
    order = Window.partitionBy(*_KEYS).orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("first") <= reach + 1, 0).otherwise(1)
    return (
        ranges.withColumn("_opens", opens).withColumn("_range", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*_KEYS, "_range").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_range")
    )


class _Progress:
    """Per partition, the ranges of offsets that came; one small table per micro-batch, a few of them kept.

    Messages that come twice, as those of a repeated append, change no range. The starts are stored with the first run,
    so a restart goes on from the same ones. A partition that was not among them, being new, starts at its
    ``next_offset`` in ``heads``, or at 0.
    """

    _RANGES = "topic string, partition int, first bigint, last bigint"

    def __init__(self, path: str, starts: DataFrame, heads: Callable[[SparkSession], DataFrame] | None):
        self._path = path
        self._heads = heads
        starts.select(*_KEYS, F.col("start").cast("bigint")).write.mode("ignore").parquet(os.path.join(path, "starts"))

    def committable(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Offsets behind the last message of each partition before which nothing is missing."""
        spark = batch.sparkSession
        offsets = batch.select(*_KEYS, "offset").distinct()
        # The rows of a micro-batch: neighbours have the same distance to their place.
        place = F.row_number().over(Window.partitionBy(*_KEYS).orderBy("offset"))
        came = (
            offsets.withColumn("_run", F.col("offset") - place).groupBy(*_KEYS, "_run")
            .agg(F.min("offset").alias("first"), F.max("offset").alias("last")).drop("_run")
        )
        before = _snapshot(spark, self._path, batch_id - 1, self._RANGES)
        _keep(merged_ranges(came.unionByName(before)), self._path, batch_id)
        starts = spark.read.schema("topic string, partition int, start bigint").parquet(os.path.join(self._path, "starts"))
        if self._heads is not None:
            heads = self._heads(spark).select(*_KEYS, "next_offset")
            starts = heads.join(starts, _KEYS, "full").select(*_KEYS, F.coalesce("start", "next_offset").alias("start"))
        return (
            _snapshot(spark, self._path, batch_id, self._RANGES).join(starts, _KEYS, "left")
            .withColumn("start", F.coalesce("start", F.lit(0)))
            .where((F.col("first") <= F.col("start")) & (F.col("last") >= F.col("start")))
            .select(*_KEYS, (F.col("last") + 1).alias("offset"))
        )


class PartitionWatch:
    """Tells user code when the set of topic-partitions changed since the last micro-batch.

    ``before`` gets the partitions that are gone, ``after`` the new ones, both as DataFrames and before any message
    of the batch. Both may be called again with the same rows when a batch is repeated.
    """

    def __init__(
        self,
        catalog: Callable[[SparkSession], DataFrame],
        path: str,
        before: Callable[[DataFrame], Any] | None = None,
        after: Callable[[DataFrame], Any] | None = None,
    ):
        self._catalog = catalog
        self._path = path
        self._before = before
        self._after = after

    def check(self, spark: SparkSession, batch_id: int) -> None:
        partitions = "topic string, partition int"
        _keep(self._catalog(spark).select(*_KEYS).distinct(), self._path, batch_id)
        before = _snapshot(spark, self._path, batch_id - 1, partitions)
        after = _snapshot(spark, self._path, batch_id, partitions)
        changed = changes(before, after, _KEYS).where(F.col("change") != "kept")
        gone = changed.where(F.col("change") == "removed").select(*_KEYS)
        new = changed.where(F.col("change") == "added").select(*_KEYS)
        if self._before is not None and not gone.isEmpty():
            self._before(gone)
        if self._after is not None and not new.isEmpty():
            self._after(new)


class MessageProcessor:
    """Base of per-message user code, one instance per task and micro-batch.

    Spark opens and closes it once per task of every micro-batch, not once per query; put set-up that has
    to happen once on the driver.
    """

    def initialize(self) -> None:
        """Called before the first message."""

    def process(self, message: Row) -> None:
        """Called for every message."""

    def dispose(self) -> None:
        """Called after the last message, unless one failed."""


class _ProcessorSink:
    """``foreach`` sink around a processor."""

    def __init__(self, factory: Callable[[], MessageProcessor]):
        self._factory = factory

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self._processor = self._factory()
        self._processor.initialize()
        return True

    def process(self, message: Row) -> None:
        try:
            self._processor.process(message)
        except Exception as cause:
            raise ProcessingError(
                f"processing failed at {message.topic}-{message.partition} offset {message.offset}: {cause!r}"
            ) from cause

    def close(self, error: Exception | None) -> None:
        if error is None:
            self._processor.dispose()


def process_each(
    messages: DataFrame, factory: Callable[[], MessageProcessor], checkpoint: str, trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Hand every message of the stream to a :class:`MessageProcessor`."""
    return (
        messages.writeStream.foreach(_ProcessorSink(factory))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def live_lag(
    messages: DataFrame,
    ledger: CommitLedger,
    group_id: str,
    report: Callable[[DataFrame, int], Any],
    checkpoint: str,
    storage: str | None = None,
    heads: DataFrame | None = None,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Report ``topic, partition, lag`` of a group after each micro-batch.

    Messages and the group's commits are two streams, and the state is one row per topic-partition: its marks and the last committed
    offset. So a commit changes the lag as a message does, and a micro-batch reads what is new, not the ledger. ``heads`` (``topic,
    partition, next_offset``) adds the partitions that have had no message yet.
    """
    seen = messages.select(
        *_KEYS, F.col("offset").alias("_low"), (F.col("offset") + 1).alias("_high"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("committed", "bigint"), ("_seq", "bigint"), ("_at", "timestamp"))])
    commits = (
        ledger.stream(group_id).where(stored_storage() == read_storage(storage))
        .select(*_KEYS, F.lit(None).cast("bigint").alias("_low"), F.lit(None).cast("bigint").alias("_high"),
                F.col("offset").alias("committed"), F.col("commit_seq").alias("_seq"), F.col("committed_at").alias("_at")))
    state = seen.unionByName(commits).groupBy(*_KEYS).agg(
        F.min("_low").alias("lowmark"), F.max("_high").alias("highmark"),
        F.max_by("committed", F.when(F.col("_seq").isNotNull(), F.struct("_seq", "_at"))).alias("committed"))

    def run(rows: DataFrame, batch_id: int) -> None:
        known = rows
        if heads is not None:
            known = heads.join(rows, _KEYS, "left").select(*_KEYS, F.coalesce("highmark", "next_offset").alias("highmark"), "committed")
        found = known.where(F.col("highmark").isNotNull()).select(*_KEYS, "highmark", known_or_zero(F.col("committed")).alias("current"))
        report(lag(found), batch_id)

    return (
        state.writeStream.outputMode("complete").foreachBatch(run)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def wait(query: StreamingQuery, timeout_ms: float) -> bool:
    """Wait for a query to end: forever if the timeout is negative, else stop it when time is up.

    True if the query ended by itself. A failure of the query is raised.
    """
    if timeout_ms < 0:
        query.awaitTermination()
        return True
    ended = bool(query.awaitTermination(timeout_ms / 1000))
    if not ended:
        query.stop()
    return ended


def close(query: StreamingQuery, final_commit: Callable[[], Any] | None = None) -> None:
    """Stop a query after the micro-batch in flight; a failing last commit is logged, not raised."""
    query.stop()
    if final_commit is not None:
        try:
            final_commit()
        except Exception:
            _log.exception("stopped without the final commit; the group will read some messages again")
