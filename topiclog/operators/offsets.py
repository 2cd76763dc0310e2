"""Watermarks, committed positions, lag, and new commits, as rows per topic-partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiclog.functions.positions import (
    distance, known_or_zero, mark_or_failed, read_storage, start_offset)

KEYS = ["topic", "partition"]


def watermarks(messages: DataFrame) -> DataFrame:
    """First offset and next offset of each topic-partition that has messages.

    Partial aggregation leaves one row per partition and task to shuffle. For a stored log
    :meth:`topiclog.sources.log.TopicLog.watermarks` gets the same from file footers.
    """
    return messages.groupBy(*KEYS).agg(
        F.min("offset").alias("lowmark"), (F.max("offset") + 1).alias("highmark"))


def response_watermarks(responses: DataFrame) -> DataFrame:
    """``topic, partition, kind ('low'/'high'), offset, error`` responses merged per partition; -1 marks an error."""
    offset = mark_or_failed(F.col("offset"), F.col("error"))
    return responses.groupBy(*KEYS).agg(
        F.min(F.when(F.col("kind") == "low", offset)).alias("lowmark"),
        F.min(F.when(F.col("kind") == "high", offset)).alias("highmark"))


def failed(responses: DataFrame) -> DataFrame:
    """Commit responses that carry an error."""
    return responses.where(F.col("error").isNotNull() & (F.col("error") != 0))


def current_commits(commits: DataFrame) -> DataFrame:
    """Last write of each group, storage and partition; not the largest, since a rewind lowers it."""
    return commits.groupBy("group_id", stored_storage().alias("storage"), *KEYS).agg(
        F.max_by("offset", "commit_seq").alias("offset"))


def stored_storage() -> Column:
    """The storage of a commit; one without counts as ZooKeeper's."""
    return F.coalesce(F.col("storage"), F.lit(read_storage(None)))


def _of_group(commits: DataFrame, group_id: str, storage: str | None) -> DataFrame:
    return commits.where((F.col("group_id") == group_id) & (stored_storage() == read_storage(storage)))


def committed_offsets(partitions: DataFrame, commits: DataFrame, group_id: str, storage: str | None = None) -> DataFrame:
    """``topic, partition, committed``: the group's last commit, NULL where it has none."""
    last = _of_group(commits, group_id, storage).groupBy(*KEYS).agg(
        F.max_by("offset", "commit_seq").alias("committed"))
    return partitions.select(*KEYS).join(last, KEYS, "left")


def positions(partitions: DataFrame, commits: DataFrame, group_id: str, storage: str | None = None) -> DataFrame:
    """``topic, partition, current``: the group's position, 0 where it never committed."""
    return committed_offsets(partitions, commits, group_id, storage).select(
        *KEYS, known_or_zero(F.col("committed")).alias("current"))


def offsets_metadata(
    partitions: DataFrame, commits: DataFrame, marks: DataFrame, group_id: str, storage: str | None = None,
) -> DataFrame:
    """``topic, partition, current, highmark, lowmark`` of a group."""
    return (
        positions(partitions, commits, group_id, storage).join(marks, KEYS)
        .select(*KEYS, "current", "highmark", "lowmark")
    )


def lag(metadata: DataFrame) -> DataFrame:
    """``topic, partition, lag`` from offsets metadata."""
    return metadata.select(*KEYS, distance(F.col("highmark"), F.col("current")).alias("lag"))


def by_topic(rows: DataFrame, value: str) -> DataFrame:
    """One row per topic with ``value`` as a map by partition, in partition order."""
    entries = F.array_sort(F.collect_list(F.struct("partition", value)))
    return rows.groupBy("topic").agg(F.map_from_entries(entries).alias(value))


def start_positions(
    partitions: DataFrame, commits: DataFrame, marks: DataFrame, group_id: str, reset: str, storage: str | None = None,
) -> DataFrame:
    """``topic, partition, start``: where a reader of the group begins.

    Unlike :func:`positions`, a missing or out-of-range commit goes to the end that ``reset`` names.
    """
    start: Column = start_offset(F.col("committed"), F.col("lowmark"), F.col("highmark"), reset)
    return (
        committed_offsets(partitions, commits, group_id, storage).join(marks, KEYS)
        .select(*KEYS, start.alias("start"))
    )


def advanced(partitions: DataFrame, marks: DataFrame) -> DataFrame:
    """Offsets that put a group at the end of each partition; partitions whose mark failed are left alone."""
    return _at_mark(partitions, marks, "highmark")


def rewound(partitions: DataFrame, marks: DataFrame) -> DataFrame:
    """Offsets that put a group at the start of each partition; partitions whose mark failed are left alone."""
    return _at_mark(partitions, marks, "lowmark")


def _at_mark(partitions: DataFrame, marks: DataFrame, mark: str) -> DataFrame:
    return (
        partitions.select(*KEYS).join(marks, KEYS).where(F.col(mark) >= 0)
        .select(*KEYS, F.col(mark).alias("offset"))
    )


def uncommittable(partitions: DataFrame, marks: DataFrame, mark: str) -> DataFrame:
    """``topic, partition, error`` for partitions that :func:`advanced` (``mark`` highmark) or :func:`rewound` (lowmark)
    leaves alone: those whose mark failed or is not known."""
    if mark not in ("lowmark", "highmark"):
        raise ValueError(f"mark must be lowmark or highmark, not {mark!r}")
    return (
        partitions.select(*KEYS).join(marks, KEYS, "left")
        .where(F.coalesce(F.col(mark), F.lit(-1)) < 0)
        .select(*KEYS, F.concat(F.lit(mark), F.lit(" not available")).alias("error"))
    )


def set_to(new_offsets: DataFrame, partitions: DataFrame) -> DataFrame:
    """New offsets of valid partitions; the offsets themselves are not checked."""
    return new_offsets.select(*KEYS, "offset").join(partitions, KEYS, "left_semi")


def processed(messages: DataFrame) -> DataFrame:
    """Offsets to commit after processing: behind the last message of each partition."""
    return messages.groupBy(*KEYS).agg((F.max("offset") + 1).alias("offset"))


def up_to_message(messages: DataFrame) -> DataFrame:
    """Offsets to commit a message itself: its own offset, so it is read again after a restart."""
    return messages.groupBy(*KEYS).agg(F.max("offset").alias("offset"))
