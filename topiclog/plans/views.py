"""Logs, ledgers and catalogs derived from the benchmark tables, for the registered queries.

Two logs are built with the package's own append, once per session and data folder, in the shared folder:
``events`` (one message per event) and ``shipments`` (one per line item). Everything
else is a view over the tables, so the work of every query grows with them.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclog import schemas
from topiclog.functions.names import as_bytes, make_topic
from topiclog.operators.discovery import discover_partitions
from topiclog.session import new_dir
from topiclog.sources.ledger import CommitLedger
from topiclog.sources.log import TopicLog

GROUP = "g1"
_EVENT_PARTITIONS = 4
_SHIPMENT_PARTITIONS = 8
SHIPMENT_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]

_built: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Path of a table that ``build(path)`` writes the first time it is asked for."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), name)
    if key not in _built:
        path = new_dir(spark, name)
        build(path)
        _built[key] = path
    return _built[key]


# -- messages ----------------------------------------------------------------------------------

def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages that have no partition and offset yet."""
    return table(spark, sf_dir, "events").select(
        make_topic(F.concat(F.lit("dc"), (F.col("user_id") % 2).cast("string")), F.col("event_type")).alias("topic"),
        as_bytes(F.col("user_id").cast("string")).alias("key"),
        as_bytes(F.col("props")).alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "event_id",
    )


def shipment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as messages that have no partition and offset yet."""
    return table(spark, sf_dir, "lineitem").select(
        shipment_topic().alias("topic"),
        as_bytes(F.col("l_orderkey").cast("string")).alias("key"),
        as_bytes(F.concat_ws(":", "l_partkey", "l_suppkey", "l_linenumber")).alias("value"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        *SHIPMENT_ORDER,
    )


def shipment_topic() -> Column:
    return make_topic(F.concat(F.lit("dc"), "l_returnflag"), F.concat(F.lit("ship_"), "l_linestatus"))


def new_partitions(rows: DataFrame, count: int, base: int) -> DataFrame:
    """``count`` partitions for each topic of ``rows``; partition p starts at offset ``base * (p + 1)``."""
    return (
        rows.select("topic").distinct()
        .select("topic", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("partition"))
        .withColumn("next_offset", base * (F.col("partition") + 1))
    )


def new_event_log(spark: SparkSession, sf_dir: str, path: str) -> TopicLog:
    """A log with the partitions of the event topics and no message."""
    return TopicLog.create(spark, path, new_partitions(event_rows(spark, sf_dir), _EVENT_PARTITIONS, 100))


def new_shipment_log(spark: SparkSession, sf_dir: str, path: str) -> TopicLog:
    return TopicLog.create(spark, path, new_partitions(shipment_rows(spark, sf_dir), _SHIPMENT_PARTITIONS, 1000))


def event_log(spark: SparkSession, sf_dir: str) -> TopicLog:
    def build(path: str) -> None:
        new_event_log(spark, sf_dir, path).append_keyed(event_rows(spark, sf_dir), ["event_id"], "events")
    return TopicLog(spark, _once(spark, sf_dir, "event-log", build))


def shipment_log(spark: SparkSession, sf_dir: str) -> TopicLog:
    def build(path: str) -> None:
        new_shipment_log(spark, sf_dir, path).append_keyed(shipment_rows(spark, sf_dir), SHIPMENT_ORDER, "shipments")
    return TopicLog(spark, _once(spark, sf_dir, "shipment-log", build))


# -- commits -----------------------------------------------------------------------------------

def _history(messages: DataFrame, base: int) -> DataFrame:
    """A commit per message: a group that has done half of what arrived, with every special case.

    Partition 1 rewinds at every other commit, partition 3 belongs to another group, error topics commit
    "no offset" on partition 0, and O and view topics commit below the log's start on partition 2.
    """
    start = base * (F.col("partition") + 1)
    done = F.col("offset") - start
    half = F.expr("done div 2")
    return (
        messages.withColumn("start", start).withColumn("done", done)
        .select(
            F.when(F.col("partition") == 3, "g2").otherwise(GROUP).alias("group_id"),
            "topic", "partition",
            F.when(F.col("topic").endswith(".error") & (F.col("partition") == 0), F.lit(-1))
            .when(F.col("topic").rlike(r"\.(view|ship_O)$") & (F.col("partition") == 2), half)
            .when((F.col("partition") == 1) & (F.col("offset") % 2 == 1), F.col("start") + F.expr("done div 4"))
            .otherwise(F.col("start") + half).cast("bigint").alias("offset"),
            F.when(F.col("topic").rlike(r"\.dc[1R]\."), "kafka")
            .when(F.col("offset") % 2 == 0, "zookeeper").alias("storage"),
            F.col("offset").alias("commit_seq"),
            F.col("timestamp").alias("committed_at"),
        )
    )


def event_ledger(spark: SparkSession, sf_dir: str) -> CommitLedger:
    def build(path: str) -> None:
        CommitLedger(spark, path).load(_history(event_log(spark, sf_dir).messages(), 100), "history")
    return CommitLedger(spark, _once(spark, sf_dir, "event-ledger", build))


def shipment_ledger(spark: SparkSession, sf_dir: str) -> CommitLedger:
    def build(path: str) -> None:
        CommitLedger(spark, path).load(_history(shipment_log(spark, sf_dir).messages(), 1000), "history")
    return CommitLedger(spark, _once(spark, sf_dir, "shipment-ledger", build))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests out of the events: some topics and partitions unknown, whole topics for errors."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("scribe.dc"), F.when(kind == "signup", 9).otherwise(F.col("user_id") % 2).cast("string"),
                 F.lit("."), kind).alias("topic"),
        F.when(kind != "error", F.col("user_id") % 3 * 2).cast("int").alias("partition"),
    ).distinct()


# -- clusters ----------------------------------------------------------------------------------

def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))


def _cluster_type(key: str) -> Column:
    return F.when(F.col(key) % 2 == 0, "standard").otherwise("scribe")


def _cluster_name(key: str) -> Column:
    return F.concat(F.lit("cluster"), F.col(key).cast("string"))


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cluster per supplier, hosts unsorted and with an empty entry."""
    key = F.col("s_suppkey").cast("string")
    return _suppliers(spark, sf_dir).select(
        _cluster_type("s_suppkey").alias("type"), _cluster_name("s_suppkey").alias("name"),
        F.array(F.concat(F.lit("b"), key, F.lit(":9092")), F.lit(""), F.concat(F.lit("a"), key, F.lit(":9092")))
        .alias("broker_list"),
        F.concat(F.lit("z"), key, F.lit(":2181,,y"), key, F.lit(":2181")).alias("zookeeper"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suppliers(spark, sf_dir).select(
        F.col("n_name").alias("region"), F.col("r_name").alias("superregion"),
        _cluster_type("s_suppkey").alias("cluster_type"), _cluster_name("s_suppkey").alias("cluster_name"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic-partitions of every cluster, discovered from the line items each supplier ships."""
    return discover_partitions(
        table(spark, sf_dir, "lineitem").select(
            _cluster_type("l_suppkey").alias("cluster_type"), _cluster_name("l_suppkey").alias("cluster_name"),
            shipment_topic().alias("topic"), (F.col("l_orderkey") % 8).cast("int").alias("partition")),
        ["cluster_type", "cluster_name"])


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested log record per stream and cluster."""
    held = catalog(spark, sf_dir).select("cluster_type", "cluster_name", "topic").distinct()
    listed = clusters(spark, sf_dir).withColumnsRenamed({"type": "cluster_type", "name": "cluster_name"})
    placed = held.join(listed, ["cluster_type", "cluster_name"]).join(
        regions(spark, sf_dir), ["cluster_type", "cluster_name"])
    cluster = F.struct(F.col("cluster_type").alias("type"), F.col("cluster_name").alias("name"),
                       "broker_list", "zookeeper").cast(schemas.CLUSTER)
    # At most one entry per datacenter in an array.
    return (
        placed.withColumn("name", F.concat(F.lit("fleet."), F.split("topic", r"\.", 3)[2]))
        .groupBy("name", "region", "superregion", "cluster_name")
        .agg(F.collect_list(F.struct(cluster.alias("cluster"), "topic")).alias("topics"))
        .select("name", "region", "superregion", "topics")
    )


def topology_files(spark: SparkSession, sf_dir: str) -> str:
    """JSON lines, one topology per supplier: two clusters, every third without a prefix, every fifth not local."""
    def build(path: str) -> None:
        key = F.col("s_suppkey").cast("string")
        entry = F.struct(
            F.array(F.concat(F.lit("b"), key, F.lit(":9092"))).alias("broker_list"),
            F.concat(F.lit("z"), key, F.lit(":2181")).alias("zookeeper"))
        table(spark, sf_dir, "supplier").select(
            F.concat(F.lit("type"), key).alias("cluster_type"),
            F.create_map(F.concat(F.lit("main"), key), entry, F.concat(F.lit("spare"), key), entry).alias("clusters"),
            F.when(F.col("s_suppkey") % 5 != 0, F.struct(
                F.concat(F.lit("main"), key).alias("cluster"),
                F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit("p"), key, F.lit("."))).alias("prefix"),
            )).alias("local_config"),
        ).write.json(path)
    return _once(spark, sf_dir, "topologies", build)


# -- groups and metrics ------------------------------------------------------------------------

def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user is a group subscribed to the topics of its events, some of them in no datacenter."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("group"), F.col("user_id").cast("string")).alias("group_id"),
        F.concat(F.lit("scribe.dc"), F.when(kind == "signup", 9).otherwise(F.col("user_id") % 2).cast("string"),
                 F.lit("."), kind).alias("topic"),
    ).distinct()


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suppliers of a nation are the members of its group."""
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("g"), F.col("s_nationkey").cast("string")).alias("group_id"),
        F.concat(F.lit("consumer-"), F.col("s_suppkey").cast("string")).alias("member_id"))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic-partitions that the suppliers of a nation ship to are the units of its group."""
    shipped = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", shipment_topic().alias("topic"), (F.col("l_orderkey") % 8).cast("int").alias("partition"))
    suppliers = table(spark, sf_dir, "supplier")
    return (
        shipped.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(F.concat(F.lit("g"), F.col("s_nationkey").cast("string")).alias("group_id"), "topic", "partition")
        .distinct()
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw metric samples: two timers, two counters, one unknown name."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.when(kind == "click", "produce_request_timer").when(kind == "view", "fetch_request_timer")
        .when(kind == "error", "failed_paylads_count").when(kind == "signup", "out_of_range_counts")
        .otherwise("unknown_metric").alias("name"),
        (F.col("value") / 1000).alias("value"),
        F.create_map(F.lit("client_id"), F.concat(F.lit("client"), (F.col("user_id") % 5).cast("string")))
        .alias("dimensions"),
    )
