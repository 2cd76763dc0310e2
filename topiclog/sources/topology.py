"""Cluster topologies read from JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclog import schemas
from topiclog.errors import TopologyError


def read_topologies(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Topology documents: one JSON document per file, or one per line."""
    return spark.read.schema(schemas.TOPOLOGY).json(path, multiLine=one_per_file, mode="FAILFAST")


def _cluster_columns(name, cluster) -> list:
    return [F.col("cluster_type").alias("type"), name.alias("name"),
            cluster["broker_list"].alias("broker_list"), cluster["zookeeper"].alias("zookeeper")]


def topology_clusters(topologies: DataFrame) -> DataFrame:
    """Every cluster of every topology."""
    return (
        topologies.select("cluster_type", F.explode("clusters").alias("name", "cluster"))
        .select(*_cluster_columns(F.col("name"), F.col("cluster")))
    )


def topology_cluster(topologies: DataFrame, name: str, required: bool = False) -> DataFrame:
    """The cluster with the given name in each topology that has it."""
    found = (
        topologies.select("cluster_type", F.try_element_at("clusters", F.lit(name)).alias("cluster"))
        .where(F.col("cluster").isNotNull())
        .select(*_cluster_columns(F.lit(name), F.col("cluster")))
    )
    if required and found.isEmpty():
        raise TopologyError(f"no cluster with name {name!r}")
    return found


def local_clusters(topologies: DataFrame, strict: bool = False) -> DataFrame:
    """The cluster each topology calls local, with the optional local topic prefix.

    A topology without a local part has none. ``strict`` raises where the local cluster is not listed.
    """
    looked_up = (
        topologies.where(F.col("local_config").isNotNull())
        .select("cluster_type", F.col("local_config.cluster").alias("name"),
                F.col("local_config.prefix").alias("prefix"),
                F.try_element_at("clusters", F.col("local_config.cluster")).alias("cluster"))
    )
    if strict:
        lost = looked_up.where(F.col("cluster").isNull()).select("cluster_type", "name").first()
        if lost is not None:
            raise TopologyError(f"{lost.cluster_type}: local cluster {lost.name!r} is not listed")
    return (
        looked_up.where(F.col("cluster").isNotNull())
        .select(*_cluster_columns(F.col("name"), F.col("cluster")), "prefix")
    )
