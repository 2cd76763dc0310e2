"""Explicit schemas; the package never infers one (topic ``007`` must stay text)."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of Spark's Kafka source, so that a deployment with that connector only changes the reader.
MESSAGE_COLUMNS = ["topic", "partition", "offset", "key", "value", "timestamp"]

# On disk: data columns first, then the three directory levels.
LOG = T.StructType([
    T.StructField("offset", T.LongType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("append", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
])

HEADS = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("next_offset", T.LongType()),
])

COMMITS = T.StructType([
    T.StructField("group_id", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("metadata", T.StringType()),
    T.StructField("storage", T.StringType()),
    T.StructField("commit_seq", T.LongType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("entry", T.StringType()),
])

METRIC_SAMPLES = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("dimensions", T.MapType(T.StringType(), T.StringType())),
    T.StructField("ts", T.TimestampType()),
])

CLUSTER = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("broker_list", T.ArrayType(T.StringType())),
    T.StructField("zookeeper", T.StringType()),
])

LOGS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("superregion", T.StringType()),
    T.StructField("topics", T.ArrayType(T.StructType([
        T.StructField("cluster", CLUSTER),
        T.StructField("topic", T.StringType()),
    ]))),
])

TOPOLOGY = T.StructType([
    T.StructField("cluster_type", T.StringType()),
    T.StructField("clusters", T.MapType(T.StringType(), T.StructType([
        T.StructField("broker_list", T.ArrayType(T.StringType())),
        T.StructField("zookeeper", T.StringType()),
    ]))),
    T.StructField("local_config", T.StructType([
        T.StructField("cluster", T.StringType()),
        T.StructField("prefix", T.StringType()),
    ])),
])
