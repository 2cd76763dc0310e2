"""Cluster identity that ignores the order of hosts and empty entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_hosts(text: Column) -> Column:
    """Comma-separated hosts to an array."""
    return F.split(text, ",")


def canonical_hosts(hosts: Column) -> Column:
    """Sorted, non-empty hosts of an array as one comma-separated text."""
    return F.array_join(F.array_sort(F.filter(hosts, lambda host: host != "")), ",")


def cluster_identity(cluster_type: Column, name: Column, hosts: Column, zookeeper: Column) -> Column:
    """Struct that is equal exactly for equal clusters, to group and join by."""
    return F.struct(
        cluster_type.alias("type"),
        name.alias("name"),
        canonical_hosts(hosts).alias("brokers"),
        canonical_hosts(split_hosts(zookeeper)).alias("zookeeper"),
    )
