"""Topic catalogs, clusters and logs: what exists and what matches.

A catalog has ``cluster_type, cluster_name, topic, partition``; clusters have ``type, name, broker_list,
zookeeper``; regions have ``region, superregion, cluster_type, cluster_name``. Matches come
as rows (one per topic and cluster); :func:`topics_by_cluster` turns them into lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiclog.errors import DiscoveryError, TopicNameError
from topiclog.functions.clusters import cluster_identity, split_hosts
from topiclog.functions.names import is_well_formed, topic_datacenter, topic_stream
from topiclog.functions.patterns import contains_matching, ends_with_stream, starts_matching
from topiclog.session import pinned

CLUSTER_KEYS = ["cluster_type", "cluster_name"]


def discover_partitions(messages: DataFrame, cluster_columns: Sequence[str] = ()) -> DataFrame:
    """Topic-partitions that have messages, per cluster if the log tells clusters apart."""
    return messages.select(*cluster_columns, "topic", "partition").distinct()


def parsed_topics(rows: DataFrame, topic: str = "topic", datacenter: str = "datacenter", stream: str = "stream") -> DataFrame:
    """``rows`` with the datacenter and stream of their topic names; malformed or missing names raise before anything is returned.

    The check is a job of its own that stops at the first few: an error inside a column is lost where the column is not read.
    """
    wrong = [r[0] for r in rows.where(~F.coalesce(is_well_formed(F.col(topic)), F.lit(False))).select(topic).limit(3).collect()]
    if wrong:
        raise TopicNameError(f"not a well-formed topic name: {', '.join(map(repr, wrong))}")
    return rows.withColumns({datacenter: topic_datacenter(F.col(topic)), stream: topic_stream(F.col(topic))})


def partition_lists(catalog: DataFrame) -> DataFrame:
    """Topic to sorted list of its partitions."""
    return (
        catalog.select("topic", "partition").distinct()
        .groupBy("topic").agg(F.array_sort(F.collect_list("partition")).alias("partitions"))
    )


def with_identity(clusters: DataFrame) -> DataFrame:
    """Clusters with ``cluster``, the struct by which equal clusters are equal.

    ``broker_list`` may be an array or comma-separated text.
    """
    brokers = F.col("broker_list")
    if isinstance(clusters.schema["broker_list"].dataType, T.StringType):
        brokers = split_hosts(brokers)
    return clusters.withColumn(
        "cluster", cluster_identity(F.col("type"), F.col("name"), brokers, F.col("zookeeper")))


def _found(matches: DataFrame, required: bool, what: str) -> DataFrame:
    if not required:
        return matches
    matches = pinned(matches)
    if matches.isEmpty():
        raise DiscoveryError(f"{what} not found")
    return matches


def _topics_in(catalog: DataFrame, clusters: DataFrame, condition: Column) -> DataFrame:
    listed = clusters.select(F.col("type").alias("cluster_type"), F.col("name").alias("cluster_name"),
                             "broker_list", "zookeeper")
    return catalog.where(condition).select(*CLUSTER_KEYS, "topic").distinct().join(listed, CLUSTER_KEYS)


def search_topic(catalog: DataFrame, clusters: DataFrame, topic: str, required: bool = False) -> DataFrame:
    """Clusters among ``clusters`` that have the topic; ``required`` raises when none has."""
    return _found(_topics_in(catalog, clusters, F.col("topic") == topic), required, f"topic {topic!r}")


def search_topics(catalog: DataFrame, clusters: DataFrame, pattern: str, required: bool = False) -> DataFrame:
    """Topics of ``clusters`` whose name matches from its start."""
    return _found(_topics_in(catalog, clusters, starts_matching(F.col("topic"), pattern)), required,
                  f"topic matching {pattern!r}")


def topics_by_cluster(matches: DataFrame) -> DataFrame:
    """One row per cluster with the sorted list of its matching topics; duplicates stay.

    A list is as long as the cluster has matching topics, which is catalog size, not log size.
    """
    return (
        with_identity(matches.withColumnsRenamed({"cluster_type": "type", "cluster_name": "name"}))
        .groupBy("cluster").agg(F.array_sort(F.collect_list("topic")).alias("topics"))
    )


def find_clusters(
    clusters: DataFrame,
    cluster_type: str,
    regions: DataFrame | None = None,
    region: str | None = None,
    superregion: str | None = None,
    name: str | None = None,
    required: bool = False,
) -> DataFrame:
    """Clusters of a type, optionally in a region or superregion, or with a name."""
    found = clusters.where(F.col("type") == cluster_type)
    if name is not None:
        found = found.where(F.col("name") == name)
    if region is not None or superregion is not None:
        if regions is None:
            raise ValueError("searching by region needs the regions table")
        placed = regions.where(F.col("cluster_type") == cluster_type)
        if region is not None:
            placed = placed.where(F.col("region") == region)
        if superregion is not None:
            placed = placed.where(F.col("superregion") == superregion)
        names = placed.select(F.col("cluster_name").alias("name"))
        found = found.join(names, "name", "left_semi").select(*clusters.columns)
    where = {"region": region, "superregion": superregion, "name": name}
    return _found(found, required, f"cluster of type {cluster_type!r} with { {k: v for k, v in where.items() if v} }")


def topic_exists(catalog: DataFrame, clusters: DataFrame, topic: str) -> DataFrame:
    """One row, ``found``: does any of ``clusters`` have the topic?"""
    return search_topic(catalog, clusters, topic).agg((F.count("*") > 0).alias("found"))


def find_logs(
    logs: DataFrame,
    region: str | None = None,
    superregion: str | None = None,
    stream: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Logs of a region or superregion whose name ends with a stream name or contains a pattern."""
    found = logs
    if region is not None:
        found = found.where(F.col("region") == region)
    if superregion is not None:
        found = found.where(F.col("superregion") == superregion)
    if stream is not None:
        found = found.where(ends_with_stream(F.col("name"), stream))
    if pattern is not None:
        found = found.where(contains_matching(F.col("name"), pattern))
    return found


def log_topics(logs: DataFrame) -> DataFrame:
    """The nested topics of logs as one row per topic and cluster."""
    return (
        logs.select(F.explode("topics").alias("entry"))
        .select(F.col("entry.cluster.type").alias("type"), F.col("entry.cluster.name").alias("name"),
                F.col("entry.cluster.broker_list").alias("broker_list"),
                F.col("entry.cluster.zookeeper").alias("zookeeper"), F.col("entry.topic").alias("topic"))
    )


def log_regions(logs: DataFrame) -> DataFrame:
    """Regions that have logs."""
    return logs.select("region").distinct()
