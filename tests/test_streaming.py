import datetime
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from topiclog import CommitLedger, TopicLog
from topiclog.functions.measures import SEND_FAILURES, TIMERS
from topiclog.operators import offsets
from topiclog.operators.messages import process_messages
from topiclog.streaming.consume import MessageProcessor, PartitionWatch, close, consume, live_lag, process_each, wait
from topiclog.streaming.metrics import ClientMetrics, MetricsListener, Reporter, TableReporter, observed
from topiclog.streaming.produce import append_stream

GROUP = "g"
LIMIT_MS = 120_000
KEYS = ["topic", "partition"]


def batch(spark, count, topic="t", first=0):
    return spark.range(first, first + count).select(
        F.lit(topic).alias("topic"), F.col("id").cast("string").cast("binary").alias("key"),
        F.col("id").cast("string").cast("binary").alias("value"), F.col("id").alias("seq"))


@pytest.fixture
def log(spark, path):
    parts = spark.createDataFrame([(t, p) for t in ("t", "u") for p in range(3)], "topic string, partition int")
    made = TopicLog.create(spark, path("log"), parts)
    made.append_keyed(batch(spark, 60).unionAll(batch(spark, 30, "u")), ["topic", "seq"], "a1")
    return made


@pytest.fixture
def ledger(spark, path):
    return CommitLedger.create(spark, path("ledger"))


class Sink:
    """Keeps what it is given, on the driver; the logs of these tests are small."""

    def __init__(self, fail_at=()):
        self.seen = []
        self.batches = []
        self.fail_at = set(fail_at)

    def __call__(self, df, batch_id):
        self.batches.append(batch_id)
        self.seen += [(r.topic, r.partition, r.offset) for r in df.collect()]
        if batch_id in self.fail_at:
            self.fail_at.discard(batch_id)
            raise RuntimeError("sink is full")


def positions(spark, log, ledger):
    found = offsets.positions(log.catalog(), ledger.commits(), GROUP)
    return {(r.topic, r.partition): r.current for r in found.collect()}


def highmarks(log):
    return {(r.topic, r.partition): r.highmark for r in log.watermarks().collect()}


def test_a_restart_goes_on_where_the_query_stopped(spark, log, ledger, path):
    sink = Sink()
    for _ in range(2):
        assert wait(consume(log.stream(), sink, ledger, GROUP, path("cp"), "reader"), LIMIT_MS)
        assert len(sink.seen) == len(set(sink.seen)) == 90
        assert positions(spark, log, ledger) == highmarks(log)
    log.append_keyed(batch(spark, 10, first=60), ["seq"], "a2")
    assert wait(consume(log.stream(), sink, ledger, GROUP, path("cp"), "reader"), LIMIT_MS)
    assert len(sink.seen) == len(set(sink.seen)) == 100
    assert positions(spark, log, ledger) == highmarks(log)


def test_only_the_chosen_topics_are_read(spark, log, ledger, path):
    for i, stream in enumerate([log.stream(["u"]), log.stream(pattern="u|nothing")]):
        sink = Sink()
        wait(consume(stream, sink, ledger, GROUP, path(f"cp{i}"), f"reader{i}"), LIMIT_MS)
        assert {s[0] for s in sink.seen} == {"u"} and len(sink.seen) == 30


def test_a_failed_batch_is_not_committed_and_comes_again(spark, log, ledger, path):
    sink = Sink(fail_at=[0])
    query = consume(log.stream(), sink, ledger, GROUP, path("cp"), "reader")
    with pytest.raises(StreamingQueryException, match="micro-batch 0 failed: sink is full"):
        wait(query, LIMIT_MS)
    assert set(positions(spark, log, ledger).values()) == {0}
    assert wait(consume(log.stream(), sink, ledger, GROUP, path("cp"), "reader"), LIMIT_MS)
    assert sink.batches == [0, 0]
    assert len(sink.seen) == 180 and len(set(sink.seen)) == 90
    assert positions(spark, log, ledger) == highmarks(log)


def test_several_micro_batches_commit_one_by_one(spark, log, ledger, path):
    sink = Sink()
    starts = log.watermarks().select(*KEYS, F.col("lowmark").alias("start"))
    wait(consume(log.stream(max_files=2), sink, ledger, GROUP, path("cp"), "reader", storage="kafka", starts=starts), LIMIT_MS)
    assert len(sink.batches) > 1 and len(set(sink.seen)) == len(sink.seen) == 90
    last = offsets.current_commits(ledger.commits()).collect()
    assert {r.storage for r in last} == {"kafka"}
    assert {(r.topic, r.partition): r.offset for r in last} == highmarks(log)


def test_commits_wait_for_missing_offsets(spark, path):
    from topiclog.streaming.consume import _Progress
    starts = spark.createDataFrame([("t", 0, 5), ("t", 1, 0)], "topic string, partition int, start bigint")
    rows = lambda *found: spark.createDataFrame(found, "topic string, partition int, offset bigint")
    progress = _Progress(path("progress"), starts, None)
    answers = [
        (rows(("t", 0, 7), ("t", 0, 8), ("t", 1, 0)), [("t", 1, 1)]),
        (rows(("t", 0, 5),), [("t", 0, 6), ("t", 1, 1)]),
        (rows(("t", 0, 6),), [("t", 0, 9), ("t", 1, 1)]),
    ]
    for batch_id, (batch_rows, expected) in enumerate(answers):
        for _ in range(2):
            found = progress.committable(batch_rows, batch_id)
            assert sorted(tuple(r) for r in found.collect()) == expected


def test_commits_go_on_after_repeats_new_partitions_and_other_starts(spark, path):
    from topiclog.streaming.consume import _Progress
    starts = spark.createDataFrame([("t", 0, 5)], "topic string, partition int, start bigint")
    later = spark.createDataFrame([("t", 0, 7)], "topic string, partition int, start bigint")
    heads = lambda session: session.createDataFrame([("t", 0, 0), ("t", 1, 20)], "topic string, partition int, next_offset bigint")
    rows = lambda *found: spark.createDataFrame(found, "topic string, partition int, offset bigint")
    answers = [
        (rows(*[("t", 0, i) for i in range(5, 9)]), [("t", 0, 9)]),
        (rows(*[("t", 0, i) for i in range(5, 9)], ("t", 0, 9), ("t", 0, 9)), [("t", 0, 10)]),
        (rows(("t", 1, 21), ("t", 1, 22)), [("t", 0, 10)]),
        (rows(("t", 1, 20), ("t", 0, 11), ("new", 0, 0)), [("new", 0, 1), ("t", 0, 10), ("t", 1, 23)]),
        (rows(("t", 0, 10)), [("new", 0, 1), ("t", 0, 12), ("t", 1, 23)]),
        (rows(("t", 0, 12)), [("new", 0, 1), ("t", 0, 13), ("t", 1, 23)]),
    ]
    for batch_id, (batch_rows, expected) in enumerate(answers):
        # A restart with other starts goes on from the first ones.
        progress = _Progress(path("progress"), starts if batch_id < 2 else later, heads)
        assert sorted(tuple(r) for r in progress.committable(batch_rows, batch_id).collect()) == expected


def test_partitions_added_and_appends_repeated_while_reading(spark, log, ledger, path):
    """Read, append to a new partition and repeat an append, read again: every partition is committed to its end."""
    sink = Sink()
    starts = log.watermarks().select(*KEYS, F.col("lowmark").alias("start"))
    heads = lambda session: log.within(session).heads()
    read = lambda name: wait(consume(log.stream(), sink, ledger, GROUP, path("cp"), name, starts=starts, heads=heads), LIMIT_MS)
    read("reader")
    log.add_partitions(spark.createDataFrame([("fresh", 0)], "topic string, partition int"))
    more = spark.createDataFrame([("fresh", f"k{i}", f"v{i}", i) for i in range(30)], "topic string, key string, value string, n int")
    more = more.select("topic", F.col("key").cast("binary"), F.col("value").cast("binary"), "n")
    log.append_keyed(more, ["n"], "late")
    read("reader")
    log.append_keyed(more, ["n"], "late")
    read("reader")
    assert positions(spark, log, ledger) == highmarks(log)


def test_manual_commit(spark, log, ledger, path):
    def some(df, batch_id):
        ledger.commit(GROUP, offsets.processed(df.where("topic = 't' and partition = 1")))

    wait(consume(log.stream(), some, ledger, GROUP, path("cp"), "reader", auto_commit=False), LIMIT_MS)
    assert {k: v for k, v in positions(spark, log, ledger).items() if v} == {("t", 1): highmarks(log)[("t", 1)]}


def test_partition_changes_are_announced(spark, log, ledger, path):
    gone, new = [], []
    hidden = set()
    catalog = lambda session: log.within(session).catalog().where(~F.col("topic").isin(*hidden) if hidden else F.lit(True))
    watch = PartitionWatch(catalog, path("watch"), lambda df: gone.append(sorted(map(tuple, df.collect()))),
                           lambda df: new.append(sorted(map(tuple, df.collect()))))
    run = lambda: wait(consume(log.stream(), Sink(), ledger, GROUP, path("cp"), "reader", watch=watch), LIMIT_MS)
    run()
    assert gone == [] and new == [[(t, p) for t in ("t", "u") for p in range(3)]]
    log.append_keyed(batch(spark, 5, first=90), ["seq"], "a2")
    run()
    assert gone == [] and len(new) == 1
    log.add_partitions(spark.createDataFrame([("t", 3)], "topic string, partition int"))
    hidden.add("u")
    log.append_keyed(batch(spark, 5, first=95), ["seq"], "a3")
    run()
    assert gone == [[("u", 0), ("u", 1), ("u", 2)]] and new[1:] == [[("t", 3)]]


def processor(folder, fail_on=None):
    class Recorder(MessageProcessor):
        def note(self, what):
            with open(os.path.join(folder, f"{os.getpid()}-{id(self)}"), "a") as out:
                out.write(what + "\n")

        def initialize(self):
            self.note("initialize")

        def process(self, message):
            if message.value == fail_on:
                raise ValueError("cannot read this")
            self.note(f"{message.topic}-{message.partition}-{message.offset}")

        def dispose(self):
            self.note("dispose")

    return Recorder


def test_processor_life_cycle(spark, log, path, tmp_path):
    notes = tmp_path / "notes"
    notes.mkdir()
    wait(process_each(log.stream(), processor(str(notes)), path("cp")), LIMIT_MS)
    texts = [f.read_text().split() for f in notes.iterdir()]
    assert all(t[0] == "initialize" and t[-1] == "dispose" and t.count("initialize") == t.count("dispose") for t in texts)
    messages = [line for t in texts for line in t if line not in ("initialize", "dispose")]
    assert len(messages) == len(set(messages)) == 90


def test_a_failing_processor_is_not_disposed_and_names_the_message(spark, log, path, tmp_path):
    notes = tmp_path / "notes"
    notes.mkdir()
    query = process_each(log.stream(["u"]), processor(str(notes), fail_on=b"7"), path("cp"))
    with pytest.raises(StreamingQueryException, match=r"u-\d offset \d+.*cannot read this"):
        wait(query, LIMIT_MS)


def test_ordered_processing_inside_a_batch(spark, log, ledger, path):
    def check(pdf):
        assert (pdf.groupby(KEYS)["offset"].diff().dropna() == 1).all()
        return pdf[["topic", "partition", "offset"]]

    def process(df, batch_id):
        out = process_messages(df, check, "topic string, partition int, offset bigint", whole_partitions=True)
        out.write.mode("overwrite").parquet(path(f"out/batch_id={batch_id}"))

    wait(consume(log.stream(), process, ledger, GROUP, path("cp"), "reader"), LIMIT_MS)
    assert spark.read.parquet(path("out")).count() == 90


def test_live_lag_equals_batch_lag(spark, log, ledger, path):
    ledger.commit(GROUP, spark.createDataFrame([("t", 0, 3), ("u", 1, 2)], "topic string, partition int, offset bigint"))
    reports = {}

    def report(df, batch_id):
        reports[batch_id] = {(r.topic, r.partition): r.lag for r in df.collect()}

    for append in ("a2", "a3"):
        wait(live_lag(log.stream(), ledger, GROUP, report, path("cp")), LIMIT_MS)
        log.append_keyed(batch(spark, 9, "u", first=30), ["seq"], append)
    wait(live_lag(log.stream(), ledger, GROUP, report, path("cp")), LIMIT_MS)
    meta = offsets.offsets_metadata(log.catalog(), ledger.commits(), log.watermarks(), GROUP)
    assert len(reports) == 3
    assert reports[max(reports)] == {(r.topic, r.partition): r.lag for r in offsets.lag(meta).collect()}


def test_a_commit_changes_the_live_lag_without_the_ledger_being_read(spark, log, ledger, path, monkeypatch):
    frame = lambda p, o: spark.createDataFrame([("t", p, o)], "topic string, partition int, offset bigint")
    history = "group_id string, topic string, partition int, offset bigint, storage string, commit_seq bigint"
    ledger.load(spark.createDataFrame([(GROUP, "t", 1, 2, "kafka", 5), (GROUP, "t", 2, 1, "zookeeper", 6), ("other", "t", 1, 9, "kafka", 7)], history), "old")
    ledger.commit(GROUP, frame(0, 3), "kafka")
    reports = []
    read = []
    monkeypatch.setattr(CommitLedger, "commits", lambda self, group_id=None: read.append(group_id))
    run = lambda: wait(live_lag(log.stream(), ledger, GROUP, lambda df, _: reports.append({(r.topic, r.partition): r.lag for r in df.collect()}), path("cp"), "kafka"), LIMIT_MS)
    run()
    high = highmarks(log)
    expected = {**high, ("t", 0): high["t", 0] - 3, ("t", 1): high["t", 1] - 2}
    assert reports[-1] == {k: v for k, v in expected.items() if k in reports[-1]} and ("t", 0) in reports[-1]
    # A rewind and another storage, no message: one more report, after a restart.
    ledger.commit(GROUP, frame(0, 1), "kafka")
    ledger.commit(GROUP, frame(0, 4), "zookeeper")
    ledger.fold(GROUP)
    before = len(reports)
    run()
    assert len(reports) > before and reports[-1]["t", 0] == high["t", 0] - 1
    assert read == []


def test_messages_are_counted_by_the_query_that_reads_them(spark, log, path):
    memory = Memory()
    listener = MetricsListener(ClientMetrics(memory, "reader", {}), {"counted"})
    spark.streams.addListener(listener)
    try:
        counted = observed(log.stream(max_files=2), "passed", [("t", 0), ("u", 9)])
        wait(counted.writeStream.queryName("counted").format("parquet").option("path", path("out")).option("checkpointLocation", path("cp"))
             .trigger(availableNow=True).start(), LIMIT_MS)
        total = lambda name: sum(v for (_, n, _), v in list(memory.records) if n == f"reader.{name}")
        deadline = datetime.datetime.now() + datetime.timedelta(seconds=20)
        while total("messages") < log.messages().count() and datetime.datetime.now() < deadline:
            spark.range(1).count()
    finally:
        spark.streams.removeListener(listener)
    assert total("messages") == log.messages().count()
    assert total("messages.t-0") == log.topic("t", [0]).count() > 0 and total("messages.u-9") == 0


def test_appending_a_stream(spark, log, path, rows):
    copy = TopicLog.create(spark, path("copy"), log.catalog())
    source = log.stream(max_files=2).withColumnsRenamed({"partition": "p", "offset": "seq"})
    wait(append_stream(source, copy, ["topic", "p", "seq"], path("cp"), "copy"), LIMIT_MS)
    assert rows(copy.watermarks()) == rows(log.watermarks())
    assert rows(copy.messages().select("topic", "key", "value")) == rows(log.messages().select("topic", "key", "value"))
    log.append_keyed(batch(spark, 8, first=70), ["seq"], "a2")
    wait(append_stream(source, copy, ["topic", "p", "seq"], path("cp"), "copy"), LIMIT_MS)
    assert rows(copy.watermarks()) == rows(log.watermarks())


def test_a_repeated_append_of_a_batch_replaces_itself(spark, log, path, rows):
    copy = TopicLog.create(spark, path("copy"), log.catalog())
    for append_id in ("copy-0", "copy-1", "copy-1"):
        first = 0 if append_id == "copy-0" else 20
        copy.append_unkeyed(batch(spark, 20, first=first), ["seq"], append_id)
    assert copy.messages().count() == 40
    found = copy.messages().select("offset").distinct().count()
    assert found == 14 and copy.topic("t").groupBy("partition", "offset").count().where("count > 1").isEmpty()


def test_waiting_with_a_timeout(spark, log, ledger, path):
    running = consume(log.stream(), Sink(), ledger, GROUP, path("cp"), "reader", trigger={"processingTime": "1 second"})
    assert wait(running, 1000) is False
    assert not running.isActive
    drained = consume(log.stream(), Sink(), ledger, GROUP, path("cp2"), "reader2")
    assert wait(drained, -1) is True


def test_a_failing_last_commit_does_not_raise(spark, log, ledger, path, caplog):
    query = consume(log.stream(), Sink(), ledger, GROUP, path("cp"), "reader", trigger={"processingTime": "1 second"})
    close(query, lambda: ledger.commit(GROUP, offsets.processed(log.messages()), "nowhere"))
    assert not query.isActive
    assert "stopped without the final commit" in caplog.text
    close(query, lambda: ledger.commit(GROUP, offsets.processed(log.messages())))
    assert positions(spark, log, ledger) == highmarks(log)


class Memory(Reporter):
    def __init__(self):
        self.records = []

    def counter(self, name, dimensions):
        return ("counter", name, dict(dimensions))

    def timer(self, name, dimensions):
        return ("timer", name, dict(dimensions))

    def record(self, handle, value, timestamp=None):
        self.records.append((handle, value))


def test_client_metrics():
    memory = Memory()
    metrics = ClientMetrics(memory, "consumer", {"group_id": "g"})
    assert all(metrics.sample(name, 10) for name in TIMERS)
    assert metrics.sample("failed_paylads_count", 17)
    assert not metrics.sample("unknown_metric", 1)
    assert memory.records == [(("timer", f"consumer.{n}", {"group_id": "g"}), 10_000) for n in TIMERS] + [
        (("counter", "consumer.failed_paylads_count", {"group_id": "g"}), 1)]
    with pytest.raises(TypeError):
        ClientMetrics(object(), "consumer", {})


def test_listener_times_batches_and_counts_failed_sends(spark, log, ledger, path):
    memory = Memory()
    listener = MetricsListener(ClientMetrics(memory, "producer", {}), {"reader"}, {"sender"})
    spark.streams.addListener(listener)
    source = log.stream().withColumnsRenamed({"partition": "p", "offset": "seq"})
    copy = TopicLog.create(spark, path("copy"), log.catalog())
    nothing = TopicLog.create(spark, path("nothing"), log.catalog().where("topic = 'none'"))
    try:
        wait(append_stream(source, copy, ["topic", "p", "seq"], path("cp1"), "sender"), LIMIT_MS)
        # A reader that fails sends nothing; an append that is refused does not send.
        with pytest.raises(StreamingQueryException):
            wait(consume(log.stream(), Sink(fail_at=[0]), ledger, GROUP, path("cp2"), "reader"), LIMIT_MS)
        with pytest.raises(StreamingQueryException):
            wait(append_stream(source, nothing, ["topic", "p", "seq"], path("cp3"), "sender"), LIMIT_MS)
        names = lambda: [handle[1] for handle, _ in list(memory.records)]
        deadline = datetime.datetime.now() + datetime.timedelta(seconds=20)
        while f"producer.{SEND_FAILURES}" not in names() and datetime.datetime.now() < deadline:
            spark.range(1).count()
    finally:
        spark.streams.removeListener(listener)
    assert names().count(f"producer.{SEND_FAILURES}") == 1
    assert "producer.micro_batch.latestOffset" in names()


def test_table_reporter(spark, path, rows):
    reporter = TableReporter(spark, path("metrics"))
    metrics = ClientMetrics(reporter, "consumer", {"group_id": "g"})
    metrics.sample("fetch_request_timer", 2)
    reporter.flush()
    metrics.sample("out_of_range_counts", 5)
    reporter.flush()
    reporter.flush()
    found = spark.read.parquet(path("metrics")).select("name", "kind", "value", F.col("dimensions")["group_id"])
    assert rows(found) == [("consumer.fetch_request_timer", "timer", 2000.0, "g"), ("consumer.out_of_range_counts", "counter", 1.0, "g")]


def test_failed_appends_are_counted_and_raised(spark, path):
    found = []

    class Listed(Reporter):
        def counter(self, name, dimensions):
            return name

        timer = counter

        def record(self, handle, value, timestamp=None):
            found.append((handle, value))

    metrics = ClientMetrics(Listed(), "p", {})
    with metrics.sending():
        pass
    with pytest.raises(RuntimeError, match="broken"):
        with metrics.sending():
            raise RuntimeError("broken")
    metrics.phase("addBatch", 12)
    assert found == [(f"p.{SEND_FAILURES}", 1), ("p.micro_batch.addBatch", 12)]
