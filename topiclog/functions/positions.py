"""Rules for committed offsets, watermarks, start positions and commit storages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from topiclog.errors import InvalidStorageError

# Offset storages and reset policies.
ZOOKEEPER = "zookeeper"
KAFKA = "kafka"
DUAL = "dual"
SMALLEST = "smallest"
LARGEST = "largest"

# The offset that stands for "no commit" and for "watermark request failed".
NO_OFFSET = -1


def read_storage(storage: str | None) -> str:
    """Storage to read commits from; none given means ZooKeeper."""
    chosen = ZOOKEEPER if storage is None else storage
    if chosen not in (ZOOKEEPER, KAFKA):
        raise InvalidStorageError(f"cannot read offsets from storage {storage!r}")
    return chosen


def write_storages(storage: str | None) -> list[str]:
    """Storages one commit goes to."""
    chosen = ZOOKEEPER if storage is None else storage
    if chosen == DUAL:
        return [ZOOKEEPER, KAFKA]
    if chosen not in (ZOOKEEPER, KAFKA):
        raise InvalidStorageError(f"cannot commit offsets to storage {storage!r}")
    return [chosen]


def known_or_zero(offset: Column) -> Column:
    """Position of a group: 0 where it never committed."""
    return F.when(offset == NO_OFFSET, F.lit(0).cast("bigint")).otherwise(
        F.coalesce(offset, F.lit(0).cast("bigint")))


def mark_or_failed(offset: Column, error: Column) -> Column:
    """Watermark of a response, -1 where the response carries an error."""
    return F.when(F.coalesce(error, F.lit(0)) != 0, F.lit(NO_OFFSET).cast("bigint")).otherwise(offset)


def distance(highmark: Column, current: Column) -> Column:
    """Messages left to read; negative where the position lies beyond the end."""
    return highmark - current


def start_offset(committed: Column, lowmark: Column, highmark: Column, reset: str) -> Column:
    """Where a reader starts: its commit while that is still in the log, else the reset policy's end."""
    if reset not in (SMALLEST, LARGEST):
        raise ValueError(f"reset must be {SMALLEST!r} or {LARGEST!r}, not {reset!r}")
    fallback = lowmark if reset == SMALLEST else highmark
    return F.when(committed.between(lowmark, highmark), committed).otherwise(fallback)
