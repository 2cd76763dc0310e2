"""Which topics and partitions a caller asks for, checked against the catalog.

Requests are rows ``topic, partition``; a NULL partition asks for all partitions of the topic.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclog.errors import UnknownPartitionError, UnknownTopicError

_NAMED_IN_ERROR = 20
_KEYS = ["topic", "partition"]


def requests_frame(spark: SparkSession, topics) -> DataFrame:
    """Requests from Python: a list, set or tuple of topics, or a dict of topic to partitions.

    An empty partition list asks for all partitions.
    """
    if isinstance(topics, Mapping):
        rows = [(t, p) for t, partitions in topics.items() for p in (list(partitions) or [None])]
    elif isinstance(topics, (list, set, tuple)):
        rows = [(t, None) for t in topics]
    else:
        raise TypeError(f"topics must be a list, set, tuple or dict of partitions, not {topics!r}")
    return spark.createDataFrame(rows, "topic string, partition int")


def offsets_frame(spark: SparkSession, offsets) -> DataFrame:
    """``topic, partition, offset`` rows from a dict of topic to dict of partition to offset."""
    if not isinstance(offsets, Mapping) or not all(isinstance(p, Mapping) for p in offsets.values()):
        raise TypeError(f"offsets must be a dict of topic to dict of partition to offset, not {offsets!r}")
    rows = [(t, p, o) for t, partitions in offsets.items() for p, o in partitions.items()]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint")


def valid_topics(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Requested topics that exist."""
    return requests.select("topic").distinct().join(catalog, "topic", "left_semi")


def unknown_topics(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Requested topics that do not exist."""
    return requests.select("topic").distinct().join(catalog, "topic", "left_anti")


def unknown_partitions(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Requested partitions that an existing topic does not have."""
    named = requests.where(F.col("partition").isNotNull()).select(*_KEYS).distinct()
    return named.join(catalog, "topic", "left_semi").join(catalog, _KEYS, "left_anti")


def valid_partitions(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Existing partitions that are requested by number or through their whole topic.

    A request naming only partitions that do not exist yields none, not all.
    """
    whole = requests.where(F.col("partition").isNull())
    named = requests.where(F.col("partition").isNotNull())
    known = catalog.select(*_KEYS)
    return (
        known.join(whole, "topic", "left_semi")
        .unionByName(known.join(named, _KEYS, "left_semi"))
        .distinct()
    )


def _listing(what: str, named: list, all_of_them: DataFrame) -> str:
    count = len(named) if len(named) < _NAMED_IN_ERROR else all_of_them.count()
    return f"{count} {what} do not exist: {named}{' and others' if count > len(named) else ''}"


def checked_partitions(requests: DataFrame, catalog: DataFrame, raise_on_error: bool = True) -> DataFrame:
    """:func:`valid_partitions`, after raising for anything unknown unless told to skip it."""
    if raise_on_error:
        topics = unknown_topics(requests, catalog)
        if named := topics.limit(_NAMED_IN_ERROR).collect():
            raise UnknownTopicError(_listing("topics", sorted(r.topic for r in named), topics))
        lost = unknown_partitions(requests, catalog)
        if named := lost.limit(_NAMED_IN_ERROR).collect():
            raise UnknownPartitionError(_listing("partitions", sorted((r.topic, r.partition) for r in named), lost))
    return valid_partitions(requests, catalog)
