"""The registered queries: each operator over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclog.functions import clusters as cluster_functions
from topiclog.functions import measures, names, positions
from topiclog.operators import assignment, discovery, messages, offsets, reporting, requests
from topiclog.operators.numbering import dense_index
from topiclog.plans import views
from topiclog.session import new_dir
from topiclog.sources import topology
from topiclog.sources.ledger import CommitLedger
from topiclog.sources.log import TopicLog, keyed_partition
from topiclog.streaming.consume import consume, live_lag, wait
from topiclog.streaming.produce import append_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
KEYS = ["topic", "partition"]
_FILES_PER_BATCH = 16


def query(function):
    QUERIES[function.__name__] = function
    return function


def _text(column: str) -> Column:
    return names.as_text(F.col(column)).alias(column)


def _joined(column: str) -> Column:
    return F.array_join(F.transform(F.col(column), lambda x: x.cast("string")), ",").alias(column)


def _readable(found: DataFrame) -> DataFrame:
    return found.select(*KEYS, "offset", _text("key"), _text("value"))


def _with_cluster(found: DataFrame) -> DataFrame:
    """Cluster columns of a match with hosts in canonical form."""
    named = found.withColumnsRenamed({"cluster_type": "type", "cluster_name": "name"})
    return discovery.with_identity(named).select(
        *[c for c in named.columns if c not in ("type", "name", "broker_list", "zookeeper")],
        "cluster.type", "cluster.name", "cluster.brokers", "cluster.zookeeper")


def _listed(by_cluster: DataFrame) -> DataFrame:
    return by_cluster.select("cluster.type", "cluster.name", "cluster.brokers", "cluster.zookeeper", _joined("topics"))


# -- reading -----------------------------------------------------------------------------------

@query
def scan_topic(spark, sf_dir):
    return _readable(views.event_log(spark, sf_dir).topic("scribe.dc0.click", [0, 2]))


@query
def scan_topics_regex(spark, sf_dir):
    return _readable(views.event_log(spark, sf_dir).topics_matching(r"scribe\.dc1\.(click|sign)"))


@query
def scan_assigned(spark, sf_dir):
    log = views.event_log(spark, sf_dir)
    return _readable(log.assigned(requests.valid_partitions(views.requests(spark, sf_dir), log.catalog())))


@query
def project_message(spark, sf_dir):
    found = messages.without_topic(views.shipment_log(spark, sf_dir).messages())
    return found.select("partition", "offset", _text("key"), _text("value"))


def _positions(log: TopicLog, ledger: CommitLedger) -> DataFrame:
    return offsets.positions(log.catalog(), ledger.commits(views.GROUP), views.GROUP)


@query
def poll_n(spark, sf_dir):
    log = views.event_log(spark, sf_dir)
    starts = _positions(log, views.event_ledger(spark, sf_dir)).withColumnRenamed("current", "start")
    return _readable(messages.first_messages(log.after(starts, count=5), 5))


def _read_from_start(spark, sf_dir, reset):
    log = views.event_log(spark, sf_dir)
    starts = offsets.start_positions(
        log.catalog(), views.event_ledger(spark, sf_dir).commits(views.GROUP), log.watermarks(), views.GROUP, reset, "kafka")
    return _readable(log.after(starts))


@query
def read_from_start_smallest(spark, sf_dir):
    return _read_from_start(spark, sf_dir, positions.SMALLEST)


@query
def read_from_start_largest(spark, sf_dir):
    return _read_from_start(spark, sf_dir, positions.LARGEST)


def _backlog(log: TopicLog, ledger: CommitLedger) -> DataFrame:
    return _readable(log.after(_positions(log, ledger).withColumnRenamed("current", "start")))


@query
def backlog(spark, sf_dir):
    return _backlog(views.event_log(spark, sf_dir), views.event_ledger(spark, sf_dir))


@query
def backlog_shipments(spark, sf_dir):
    return _backlog(views.shipment_log(spark, sf_dir), views.shipment_ledger(spark, sf_dir))


@query
def decode_payload(spark, sf_dir):
    found = views.shipment_log(spark, sf_dir).messages()
    text = names.as_text(F.col("value"))
    return found.select(*KEYS, "offset", text.alias("text"),
                        F.length(names.as_bytes(text)).cast("bigint").alias("bytes"),
                        F.col("timestamp").cast("timestamp_ntz").alias("sent_at"))


@query
def ordered_process(spark, sf_dir):
    def lengths(batch: pd.DataFrame) -> pd.DataFrame:
        out = batch[["topic", "partition", "offset"]].copy()
        out["size"] = batch["value"].map(len).astype("int64")
        out["ascending"] = (batch.groupby(["topic", "partition"])["offset"].diff().fillna(1) > 0)
        return out

    return messages.process_messages(
        views.shipment_log(spark, sf_dir).messages(), lengths,
        "topic string, partition int, offset bigint, size bigint, ascending boolean")


@query
def running_totals(spark, sf_dir):
    """Bytes sent to a partition so far and the size of the message before, carried from message to message."""
    def left_behind(batch: pd.DataFrame) -> tuple:
        sizes = batch["value"].map(len)
        return int(sizes.sum()), int(sizes.iloc[-1])

    def totals(batch: pd.DataFrame, state: tuple | None) -> pd.DataFrame:
        sizes = batch["value"].map(len).astype("int64")
        sent, last = state or (0, None)
        out = batch[["topic", "partition", "offset"]].copy()
        out["sent"] = sizes.cumsum() + sent
        out["previous"] = sizes.astype("Int64").shift(1, fill_value=pd.NA if last is None else int(last))
        return out

    return messages.process_in_order(
        views.shipment_log(spark, sf_dir).messages(), left_behind, lambda a, b: (a[0] + b[0], b[1]), totals,
        "sent bigint, last bigint", "topic string, partition int, offset bigint, sent bigint, previous bigint")


@query
def delivery_audit(spark, sf_dir):
    return messages.delivery_audit(views.event_log(spark, sf_dir).messages())


@query
def delivery_audit_shipments(spark, sf_dir):
    return messages.delivery_audit(views.shipment_log(spark, sf_dir).messages())


@query
def offset_gaps(spark, sf_dir):
    # Order keys as offsets: repeated and with holes.
    rows = views.shipment_rows(spark, sf_dir).select(
        "topic", (F.col("l_suppkey") % 4).cast("int").alias("partition"), F.col("l_orderkey").alias("offset"))
    return messages.offset_gaps(rows, stretch=1000)


# -- appending ---------------------------------------------------------------------------------

@query
def assign_offsets(spark, sf_dir):
    rows = views.shipment_rows(spark, sf_dir)
    placed = rows.withColumn("partition", keyed_partition(F.col("key"), F.lit(8)))
    return dense_index(placed, views.SHIPMENT_ORDER, KEYS, "offset").select(*KEYS, "offset", _text("key"), _text("value"))


@query
def append_keyed(spark, sf_dir):
    """Two appends, the second one repeated under its name."""
    log = views.new_event_log(spark, sf_dir, new_dir(spark, "append-keyed"))
    rows = views.event_rows(spark, sf_dir)
    early = F.col("timestamp") < F.lit("2024-01-16 00:00:00").cast("timestamp")
    log.append_keyed(rows.where(early), ["event_id"], "first")
    for _ in range(2):
        log.append_keyed(rows.where(~early), ["event_id"], "second")
    return _readable(log.messages())


@query
def append_mixed_keys(spark, sf_dir):
    """Every third user sends without a key."""
    log = views.new_event_log(spark, sf_dir, new_dir(spark, "append-mixed"))
    rows = views.event_rows(spark, sf_dir)
    some = F.when(F.col("key").cast("string").cast("bigint") % 3 != 0, F.col("key"))
    log.append_keyed(rows.withColumn("key", some), ["event_id"], "only")
    return _readable(log.messages())


@query
def compact_appends(spark, sf_dir):
    """A log of four appends, merged into one generation, whose files then go; read from positions."""
    log = views.new_event_log(spark, sf_dir, new_dir(spark, "compact"))
    rows = views.event_rows(spark, sf_dir)
    week = F.datediff("timestamp", F.lit("2024-01-01")) / 8
    for i in range(4):
        log.append_keyed(rows.where((week >= i) & (week < i + 1) if 0 < i < 3 else week < 1 if i == 0 else week >= 3), ["event_id"], f"week{i}")
    log.compact()
    log.vacuum()
    return _readable(log.after(log.watermarks().select(*KEYS, (F.col("lowmark") + 50).alias("start"))))


@query
def append_unkeyed(spark, sf_dir):
    log = views.new_event_log(spark, sf_dir, new_dir(spark, "append-unkeyed"))
    log.append_unkeyed(views.event_rows(spark, sf_dir).drop("key"), ["event_id"], "only")
    return _readable(log.messages())


@query
def append_keyed_shipments(spark, sf_dir):
    log = views.new_shipment_log(spark, sf_dir, new_dir(spark, "append-shipments"))
    log.append_keyed(views.shipment_rows(spark, sf_dir), views.SHIPMENT_ORDER, "only")
    return _readable(log.messages())


# -- watermarks, positions, lag ----------------------------------------------------------------

@query
def watermarks(spark, sf_dir):
    return views.event_log(spark, sf_dir).watermarks()


@query
def watermarks_shipments(spark, sf_dir):
    return views.shipment_log(spark, sf_dir).watermarks()


@query
def watermarks_of_messages(spark, sf_dir):
    return offsets.watermarks(views.shipment_log(spark, sf_dir).messages())


def _responses(spark, sf_dir) -> DataFrame:
    """Every event answers with a low and a high mark; errors answer with a broker error."""
    answer = views.event_log(spark, sf_dir).messages().select(
        *KEYS, "offset", F.when(F.col("topic").endswith(".error") & (F.col("partition") == 1), 6).otherwise(0).alias("error"))
    return answer.select(*KEYS, F.explode(F.array(F.lit("low"), F.lit("high"))).alias("kind"), "offset", "error")


@query
def watermark_errors(spark, sf_dir):
    return offsets.response_watermarks(_responses(spark, sf_dir))


@query
def commit_errors(spark, sf_dir):
    """What advancing a group to the end of every partition reports where the answers were errors."""
    ledger = CommitLedger.create(spark, new_dir(spark, "ledger"))
    marks = offsets.response_watermarks(_responses(spark, sf_dir))
    return ledger.advance(views.GROUP, views.event_log(spark, sf_dir).catalog(), marks)


@query
def current_commits(spark, sf_dir):
    return offsets.current_commits(views.event_ledger(spark, sf_dir).commits())


@query
def folded_commits(spark, sf_dir):
    """A history of commits taken into snapshots, group by group, and two more commits behind them."""
    log, ledger = views.event_log(spark, sf_dir), CommitLedger.create(spark, new_dir(spark, "ledger"))
    ledger.load(views.event_ledger(spark, sf_dir).commits(), "history")
    ledger.fold(views.GROUP)
    marks = log.watermarks()
    ledger.advance("g2", log.catalog().where("partition = 3"), marks, positions.KAFKA)
    ledger.fold("g2")
    ledger.rewind(views.GROUP, log.catalog().where("partition = 2"), marks, positions.KAFKA)
    return offsets.current_commits(ledger.commits())


@query
def committed_offsets(spark, sf_dir):
    log, ledger = views.event_log(spark, sf_dir), views.event_ledger(spark, sf_dir)
    wanted = requests.valid_partitions(views.requests(spark, sf_dir), log.catalog())
    return offsets.positions(wanted, ledger.commits(views.GROUP), views.GROUP)


def _metadata(log: TopicLog, ledger: CommitLedger, storage: str | None = None) -> DataFrame:
    return offsets.offsets_metadata(log.catalog(), ledger.commits(views.GROUP), log.watermarks(), views.GROUP, storage)


@query
def offsets_metadata(spark, sf_dir):
    return _metadata(views.event_log(spark, sf_dir), views.event_ledger(spark, sf_dir), "kafka")


@query
def lag(spark, sf_dir):
    return offsets.lag(_metadata(views.event_log(spark, sf_dir), views.event_ledger(spark, sf_dir)))


@query
def lag_shipments(spark, sf_dir):
    return offsets.lag(_metadata(views.shipment_log(spark, sf_dir), views.shipment_ledger(spark, sf_dir)))


@query
def lag_one_topic(spark, sf_dir):
    log, ledger = views.event_log(spark, sf_dir), views.event_ledger(spark, sf_dir)
    wanted = requests.checked_partitions(
        requests.requests_frame(spark, {"scribe.dc0.view": [1, 2, 3]}), log.catalog())
    return offsets.lag(offsets.offsets_metadata(wanted, ledger.commits(views.GROUP), log.watermarks(), views.GROUP))


@query
def lag_map(spark, sf_dir):
    rows = offsets.lag(_metadata(views.event_log(spark, sf_dir), views.event_ledger(spark, sf_dir)))
    entries = F.transform(F.map_entries("lag"), lambda e: F.concat(e["key"].cast("string"), F.lit(":"), e["value"].cast("string")))
    return offsets.by_topic(rows, "lag").select("topic", F.array_join(entries, ",").alias("lag"))


# -- committing --------------------------------------------------------------------------------

def _committed(spark, new_offsets: DataFrame, storage: str | None) -> DataFrame:
    """Rows as they come back from a ledger after committing."""
    ledger = CommitLedger(spark, new_dir(spark, "ledger"))
    ledger.load(new_offsets.withColumn("offset", F.lit(0)).withColumn("group_id", F.lit(views.GROUP))
                .withColumn("storage", F.lit("kafka")).withColumn("commit_seq", F.lit(1)), "before")
    ledger.commit(views.GROUP, new_offsets, storage)
    return offsets.current_commits(ledger.commits())


@query
def commit_dual(spark, sf_dir):
    marks = views.shipment_log(spark, sf_dir).watermarks()
    return _committed(spark, offsets.advanced(marks, marks), positions.DUAL)


@query
def advance_offsets(spark, sf_dir):
    log = views.event_log(spark, sf_dir)
    wanted = requests.valid_partitions(views.requests(spark, sf_dir), log.catalog())
    return _committed(spark, offsets.advanced(wanted, log.watermarks()), positions.KAFKA)


@query
def rewind_offsets(spark, sf_dir):
    log = views.event_log(spark, sf_dir)
    wanted = requests.valid_partitions(views.requests(spark, sf_dir), log.catalog())
    return _committed(spark, offsets.rewound(wanted, log.watermarks()), positions.KAFKA)


@query
def set_offsets(spark, sf_dir):
    log = views.event_log(spark, sf_dir)
    asked = views.requests(spark, sf_dir).where(F.col("partition").isNotNull())
    new = asked.withColumn("offset", F.col("partition").cast("bigint") * 1000)
    return _committed(spark, offsets.set_to(new, requests.valid_partitions(asked, log.catalog())), None)


@query
def commit_processed(spark, sf_dir):
    ledger = CommitLedger.create(spark, new_dir(spark, "ledger"))
    ledger.commit_processed(views.GROUP, views.shipment_log(spark, sf_dir).messages())
    return offsets.current_commits(ledger.commits()).select(*KEYS, "offset")


@query
def commit_message(spark, sf_dir):
    log, ledger = views.event_log(spark, sf_dir), CommitLedger.create(spark, new_dir(spark, "ledger"))
    ledger.commit_message(views.GROUP, log.messages(), log.catalog().where("partition <> 3"), "kafka")
    return offsets.current_commits(ledger.commits()).select(*KEYS, "offset")


# -- requests ----------------------------------------------------------------------------------

def _asked(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return views.requests(spark, sf_dir), views.event_log(spark, sf_dir).catalog()


@query
def valid_topics(spark, sf_dir):
    return requests.valid_topics(*_asked(spark, sf_dir))


@query
def unknown_topics(spark, sf_dir):
    return requests.unknown_topics(*_asked(spark, sf_dir))


@query
def valid_partitions(spark, sf_dir):
    return requests.valid_partitions(*_asked(spark, sf_dir))


@query
def unknown_partitions(spark, sf_dir):
    return requests.unknown_partitions(*_asked(spark, sf_dir))


# -- discovery ---------------------------------------------------------------------------------

@query
def discover_topics(spark, sf_dir):
    return views.catalog(spark, sf_dir)


@query
def topic_partition_lists(spark, sf_dir):
    return discovery.partition_lists(views.catalog(spark, sf_dir)).select("topic", _joined("partitions"))


def _typed(spark, sf_dir, cluster_type) -> DataFrame:
    return discovery.find_clusters(views.clusters(spark, sf_dir), cluster_type)


@query
def search_topic(spark, sf_dir):
    near = discovery.find_clusters(views.clusters(spark, sf_dir), "scribe", views.regions(spark, sf_dir), superregion="ASIA")
    return _with_cluster(discovery.search_topic(views.catalog(spark, sf_dir), near, "scribe.dcA.ship_O"))


@query
def search_topics_regex(spark, sf_dir):
    near = discovery.find_clusters(views.clusters(spark, sf_dir), "scribe", views.regions(spark, sf_dir), superregion="ASIA")
    return _with_cluster(discovery.search_topics(views.catalog(spark, sf_dir), near, r"scribe\.dc[AN]\.ship"))


@query
def search_topic_all_clusters(spark, sf_dir):
    return _with_cluster(discovery.search_topic(
        views.catalog(spark, sf_dir), _typed(spark, sf_dir, "standard"), "scribe.dcR.ship_F", required=True))


@query
def search_regex_all_clusters(spark, sf_dir):
    return _with_cluster(discovery.search_topics(
        views.catalog(spark, sf_dir), _typed(spark, sf_dir, "standard"), r"scribe\.dc.\.ship_F", required=True))


@query
def regex_topics_by_cluster(spark, sf_dir):
    return _listed(discovery.topics_by_cluster(discovery.search_topics(
        views.catalog(spark, sf_dir), views.clusters(spark, sf_dir), r"scribe\.dc[AN]|nothing")))


@query
def clusters_by_region(spark, sf_dir):
    return _with_cluster(discovery.find_clusters(
        views.clusters(spark, sf_dir), "standard", views.regions(spark, sf_dir), region="NATION_9"))


@query
def clusters_by_superregion(spark, sf_dir):
    return _with_cluster(discovery.find_clusters(
        views.clusters(spark, sf_dir), "scribe", views.regions(spark, sf_dir), superregion="EUROPE"))


@query
def cluster_by_name(spark, sf_dir):
    return _with_cluster(discovery.find_clusters(views.clusters(spark, sf_dir), "scribe", name="cluster7", required=True))


@query
def all_clusters(spark, sf_dir):
    return _with_cluster(_typed(spark, sf_dir, "scribe"))


@query
def topic_exists(spark, sf_dir):
    near = discovery.find_clusters(views.clusters(spark, sf_dir), "scribe", views.regions(spark, sf_dir), superregion="AFRICA")
    return discovery.topic_exists(views.catalog(spark, sf_dir), near, "scribe.dcN.ship_O")


@query
def logs_topics_by_cluster(spark, sf_dir):
    return _listed(discovery.topics_by_cluster(discovery.log_topics(views.logs(spark, sf_dir))))


@query
def logs_by_stream(spark, sf_dir):
    return _with_cluster(discovery.log_topics(
        discovery.find_logs(views.logs(spark, sf_dir), superregion="ASIA", stream="ship_O")))


@query
def logs_by_region_regex(spark, sf_dir):
    return _with_cluster(discovery.log_topics(
        discovery.find_logs(views.logs(spark, sf_dir), region="NATION_9", pattern=r"ship_[FX]")))


@query
def logs_by_superregion_regex(spark, sf_dir):
    return _with_cluster(discovery.log_topics(
        discovery.find_logs(views.logs(spark, sf_dir), superregion="AMERICA", pattern=r"^fleet\..*_O$")))


@query
def log_regions(spark, sf_dir):
    return discovery.log_regions(views.logs(spark, sf_dir))


@query
def cluster_identity(spark, sf_dir):
    """Clusters written as list and, in another order, as text: every pair counts as one."""
    listed = views.clusters(spark, sf_dir)
    as_text = listed.withColumn("broker_list", F.array_join(F.reverse("broker_list"), ",")).withColumn(
        "zookeeper", F.concat("zookeeper", F.lit(",")))
    both = discovery.with_identity(listed).select("cluster").unionByName(discovery.with_identity(as_text).select("cluster"))
    return both.groupBy("cluster").agg(F.count("*").alias("spellings")).select("cluster.*", "spellings")


@query
def topology_clusters(spark, sf_dir):
    read = topology.read_topologies(spark, views.topology_files(spark, sf_dir), one_per_file=False)
    return topology.topology_clusters(read).select(
        "type", "name", cluster_functions.canonical_hosts(F.col("broker_list")).alias("brokers"), "zookeeper")


@query
def topology_local_cluster(spark, sf_dir):
    read = topology.read_topologies(spark, views.topology_files(spark, sf_dir), one_per_file=False)
    return topology.local_clusters(read, strict=True).select(
        "type", "name", cluster_functions.canonical_hosts(F.col("broker_list")).alias("brokers"), "zookeeper", "prefix")


# -- groups ------------------------------------------------------------------------------------

@query
def partition_units(spark, sf_dir):
    units = assignment.subscribed_units(views.subscriptions(spark, sf_dir), views.event_log(spark, sf_dir).catalog())
    return units.select("group_id", names.unit_name(F.col("topic"), F.col("partition")).alias("unit"))


@query
def missing_topics(spark, sf_dir):
    return assignment.missing_topics(views.subscriptions(spark, sf_dir), views.event_log(spark, sf_dir).catalog())


@query
def assign_partitions(spark, sf_dir):
    return assignment.assign(views.units(spark, sf_dir), views.members(spark, sf_dir))


@query
def acquired_partitions(spark, sf_dir):
    return assignment.acquired_lists(assign_partitions(spark, sf_dir)).select(
        "group_id", "member_id", "topic", _joined("partitions"))


@query
def partition_changes(spark, sf_dir):
    """Catalogs of all clusters before and after a move of partitions."""
    moved = views.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("cluster"), F.col("l_suppkey").cast("string")).alias("cluster_name"),
        views.shipment_topic().alias("topic"), (F.col("l_partkey") % 9).cast("int").alias("partition"))
    return assignment.changes(views.catalog(spark, sf_dir), moved, ["cluster_name", *KEYS])


@query
def assignment_changes(spark, sf_dir):
    """Every group gains a member."""
    members = views.members(spark, sf_dir)
    joined = members.unionByName(members.select("group_id").distinct().withColumn("member_id", F.lit("consumer-0new")))
    units = views.units(spark, sf_dir)
    return assignment.changes(
        assignment.assign(units, members), assignment.assign(units, joined), ["group_id", "member_id", *KEYS])


@query
def group_key(spark, sf_dir):
    topics = views.subscriptions(spark, sf_dir).groupBy("group_id").agg(F.collect_list("topic").alias("topics"))
    return topics.select("group_id", names.group_path(F.col("group_id"), F.col("topics")).alias("path"),
                         names.group_path(F.col("group_id"), F.col("topics"), by_topics=False).alias("plain_path"))


# -- names -------------------------------------------------------------------------------------

def _raw_names(spark, sf_dir) -> DataFrame:
    """Topic names of line items, well formed or broken in one of three ways."""
    stream = F.concat(F.lit("ship."), F.col("l_suppkey").cast("string"))
    flag = F.col("l_returnflag")
    number = F.col("l_linenumber")
    return views.table(spark, sf_dir, "lineitem").select(
        F.when(number == 1, F.concat(F.lit("scribble."), flag, F.lit("."), stream))
        .when(number == 2, F.concat(F.lit("scribe."), flag))
        .when(number == 3, F.concat(F.lit("scribe"), flag))
        .otherwise(names.make_topic(flag, stream)).alias("topic"))


@query
def make_topic(spark, sf_dir):
    stream = F.concat_ws(".", "event_type", "user_id")
    return (
        views.table(spark, sf_dir, "events")
        .select(names.make_topic(F.concat(F.lit("dc"), (F.col("user_id") % 2).cast("string")), stream).alias("topic"))
        .groupBy("topic").agg(F.count("*").alias("messages")))


@query
def parse_topic(spark, sf_dir):
    topic = F.col("topic")
    return (
        _raw_names(spark, sf_dir).where(names.is_well_formed(topic))
        .groupBy(names.topic_datacenter(topic).alias("datacenter"), names.topic_stream(topic).alias("stream"))
        .agg(F.count("*").alias("messages")))


@query
def bad_topics(spark, sf_dir):
    return (
        _raw_names(spark, sf_dir).where(~names.is_well_formed(F.col("topic")))
        .groupBy("topic").agg(F.count("*").alias("messages")))


@query
def unit_codec(spark, sf_dir):
    unit = F.col("unit")
    return (
        views.table(spark, sf_dir, "lineitem")
        .select(names.unit_name(F.concat(F.lit("topic-"), F.col("l_suppkey").cast("string")), F.col("l_linenumber")).alias("unit"))
        .groupBy("unit", names.unit_topic(unit).alias("topic"), names.unit_partition(unit).alias("partition"))
        .agg(F.count("*").alias("messages")))


# -- metrics -----------------------------------------------------------------------------------

def _summary(found: DataFrame) -> DataFrame:
    summed = reporting.summary(found.withColumn("value", F.round("value").cast("bigint")), ["client_id"])
    return summed.select("name", "kind", "client_id", "samples", "total", "largest")


@query
def timer_metrics(spark, sf_dir):
    return _summary(reporting.timer_samples(views.samples(spark, sf_dir), "consumer"))


@query
def counter_metrics(spark, sf_dir):
    return _summary(reporting.counter_samples(views.samples(spark, sf_dir), "consumer"))


@query
def unknown_metrics(spark, sf_dir):
    return reporting.unknown_samples(views.samples(spark, sf_dir))


@query
def metric_dimensions(spark, sf_dir):
    own = F.create_map(F.lit("user"), F.col("user_id").cast("string"), F.lit("group_id"), F.lit("mine"))
    fixed = measures.fixed_dimensions(
        group_id=F.concat(F.lit("g"), (F.col("user_id") % 3).cast("string")), cluster_name="c1", cluster_type="standard")
    merged = measures.merged_dimensions(own, fixed)
    entries = F.array_sort(F.transform(F.map_entries(merged), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return (
        views.table(spark, sf_dir, "events").select(F.array_join(entries, ",").alias("dimensions"))
        .groupBy("dimensions").agg(F.count("*").alias("samples")))


# -- streams, drained with availableNow ----------------------------------------------------------

@query
def stream_topics(spark, sf_dir):
    log, out = views.event_log(spark, sf_dir), new_dir(spark, "stream-topics")
    found = log.stream(pattern=r"scribe\.dc0\.")
    run = (found.writeStream.format("parquet").option("path", out + "/rows")
           .option("checkpointLocation", out + "/checkpoint").trigger(availableNow=True).start())
    wait(run, -1)
    return _readable(spark.read.schema(found.schema).parquet(out + "/rows"))


@query
def stream_append(spark, sf_dir):
    """The messages of the event log, appended to a second log in several micro-batches."""
    source, out = views.event_log(spark, sf_dir), new_dir(spark, "stream-append")
    log = views.new_event_log(spark, sf_dir, out + "/log")
    rows = source.stream(max_files=_FILES_PER_BATCH).withColumnRenamed("partition", "source_partition").withColumnRenamed("offset", "source_offset")
    wait(append_stream(rows, log, ["timestamp", "key", "source_offset"], out + "/checkpoint", "copy"), -1)
    # Which files share a micro-batch is not fixed, so compare what does not depend on it.
    return messages.delivery_audit(log.messages())


@query
def stream_commit(spark, sf_dir):
    """Consume the whole log in micro-batches and commit behind each."""
    log, out = views.event_log(spark, sf_dir), new_dir(spark, "stream-commit")
    ledger = CommitLedger.create(spark, out + "/ledger")

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")

    starts = log.watermarks().select(*KEYS, F.col("lowmark").alias("start"))
    run = consume(log.stream(max_files=_FILES_PER_BATCH), store, ledger, views.GROUP, out + "/checkpoint", "reader", starts=starts)
    wait(run, -1)
    stored = spark.read.schema("topic string, partition int, offset bigint").parquet(out + "/rows")
    done = stored.groupBy(*KEYS).agg(F.count("*").alias("messages"))
    return offsets.current_commits(ledger.commits()).join(done, KEYS).select(*KEYS, "storage", "offset", "messages")


@query
def stream_lag(spark, sf_dir):
    log, ledger, out = views.event_log(spark, sf_dir), views.event_ledger(spark, sf_dir), new_dir(spark, "stream-lag")

    def store(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(out + "/lag")

    wait(live_lag(log.stream(), ledger, views.GROUP, store, out + "/checkpoint", heads=log.heads()), -1)
    return spark.read.schema("topic string, partition int, lag bigint").parquet(out + "/lag")
