import os

import pytest
from pyspark.sql import functions as F

from topiclog import CommitLedger
from topiclog.errors import InvalidStorageError, UnknownPartitionError, UnknownTopicError
from topiclog.operators import messages, offsets
from topiclog.operators.requests import checked_partitions, offsets_frame, requests_frame

GROUP = "readers"
MARKS = [("orders", 0, 11, 42), ("orders", 1, 6, 37), ("orders", 2, 4, 33), ("clicks", 0, 8, 61), ("clicks", 1, 7, 54)]
COMMITS = {("orders", 0): 42, ("orders", 1): 25, ("orders", 2): 12, ("clicks", 0): 19}
BOTH = ["orders", "clicks"]


@pytest.fixture(scope="module")
def marks(spark):
    return spark.createDataFrame(MARKS, "topic string, partition int, lowmark bigint, highmark bigint")


@pytest.fixture(scope="module")
def catalog(marks):
    return marks.select("topic", "partition")


@pytest.fixture
def ledger(spark, path):
    found = CommitLedger.create(spark, path("ledger"))
    rows = spark.createDataFrame([(t, p, o) for (t, p), o in COMMITS.items()], "topic string, partition int, offset bigint")
    found.commit(GROUP, rows)
    return found


def wanted(spark, catalog, topics, **how):
    return checked_partitions(requests_frame(spark, topics), catalog, **how)


def as_dict(df):
    return {(r[0], r[1]): r[2] for r in df.collect()}


def current(spark, catalog, ledger, topics=BOTH, group=GROUP, storage=None, **how):
    return as_dict(offsets.positions(wanted(spark, catalog, topics, **how), ledger.commits(), group, storage))


@pytest.mark.parametrize("topics", ["orders", 7, None])
def test_topics_of_a_wrong_type(spark, topics):
    with pytest.raises(TypeError):
        requests_frame(spark, topics)


def test_unknown_topic(spark, catalog, ledger):
    with pytest.raises(UnknownTopicError, match="absent"):
        wanted(spark, catalog, ["absent", "orders"])
    assert current(spark, catalog, ledger, ["absent"], raise_on_error=False) == {}


def test_unknown_partitions(spark, catalog, ledger):
    with pytest.raises(UnknownPartitionError, match="88"):
        wanted(spark, catalog, {"orders": [88]})
    with pytest.raises(UnknownPartitionError, match="88"):
        wanted(spark, catalog, {"orders": [1, 88]})
    assert current(spark, catalog, ledger, {"orders": [88]}, raise_on_error=False) == {}
    assert current(spark, catalog, ledger, {"orders": [1, 88]}, raise_on_error=False) == {("orders", 1): 25}


@pytest.mark.parametrize("topics", [["orders"], {"orders"}, ("orders",), {"orders": []}, {"orders": [0, 1, 2]}])
def test_committed_offsets(spark, catalog, ledger, topics):
    assert current(spark, catalog, ledger, topics) == {("orders", 0): 42, ("orders", 1): 25, ("orders", 2): 12}


def test_unknown_storage(spark, catalog, ledger):
    with pytest.raises(InvalidStorageError):
        current(spark, catalog, ledger, storage="elsewhere")
    with pytest.raises(InvalidStorageError):
        ledger.commit(GROUP, offsets_frame(spark, {"orders": {0: 1}}), "elsewhere")


def test_storages_are_apart(spark, catalog, ledger):
    assert set(current(spark, catalog, ledger, storage="kafka").values()) == {0}
    ledger.commit(GROUP, offsets_frame(spark, {"orders": {0: 3}}), "dual")
    assert current(spark, catalog, ledger, storage="kafka")[("orders", 0)] == 3
    assert current(spark, catalog, ledger, storage="zookeeper")[("orders", 0)] == 3


def test_commit_of_minus_one_counts_as_none(spark, catalog, ledger):
    ledger.commit(GROUP, offsets_frame(spark, {"orders": {0: -1}}))
    assert current(spark, catalog, ledger)[("orders", 0)] == 0


def test_watermark_responses(spark, rows):
    responses = spark.createDataFrame(
        [("orders", 0, "low", 13, 0), ("orders", 0, "high", 77, 0), ("orders", 1, "low", 2, 3), ("orders", 1, "high", 78, 3)],
        "topic string, partition int, kind string, offset bigint, error int")
    assert rows(offsets.response_watermarks(responses)) == [("orders", 0, 13, 77), ("orders", 1, -1, -1)]
    assert rows(offsets.failed(responses).select("topic", "partition").distinct()) == [("orders", 1)]


def test_failed_watermarks_are_not_committed(spark, rows):
    failed = spark.createDataFrame([("orders", 0, 14, 71), ("orders", 1, -1, -1)],
                                   "topic string, partition int, lowmark bigint, highmark bigint")
    assert rows(offsets.advanced(failed, failed)) == [("orders", 0, 71)]
    assert rows(offsets.rewound(failed, failed)) == [("orders", 0, 14)]
    assert rows(offsets.uncommittable(failed, failed, "highmark")) == [("orders", 1, "highmark not available")]


def test_errors_are_those_of_the_mark_used(spark, rows, path):
    """One mark failed: the other can still be committed. A partition without marks is an error for both."""
    marks = spark.createDataFrame([("a", 0, -1, 50), ("a", 1, 7, -1)], "topic string, partition int, lowmark bigint, highmark bigint")
    asked = spark.createDataFrame([("a", 0), ("a", 1), ("a", 2)], "topic string, partition int")
    ledger = CommitLedger.create(spark, path("errors"))
    assert rows(ledger.advance("g", asked, marks)) == [("a", 1, "highmark not available"), ("a", 2, "highmark not available")]
    assert rows(offsets.current_commits(ledger.commits()).select("topic", "partition", "offset").distinct()) == [("a", 0, 50)]
    assert rows(ledger.rewind("h", asked, marks)) == [("a", 0, "lowmark not available"), ("a", 2, "lowmark not available")]
    with pytest.raises(ValueError):
        offsets.uncommittable(asked, marks, "middle")


def test_commits_of_messages_through_the_ledger(spark, rows, path):
    read = spark.createDataFrame([("a", 0, 3), ("a", 0, 4), ("a", 1, 9), ("b", 0, 1)], "topic string, partition int, offset bigint")
    some = spark.createDataFrame([("a", 0), ("b", 0)], "topic string, partition int")
    ledger = CommitLedger.create(spark, path("messages"))
    ledger.commit_processed("g", read, storage="kafka")
    ledger.commit_processed("h", read, some, "kafka")
    ledger.commit_message("i", read.where("topic = 'a' and offset = 3"), storage="kafka")
    found = offsets.current_commits(ledger.commits()).select("group_id", "topic", "partition", "offset")
    assert rows(found) == [("g", "a", 0, 5), ("g", "a", 1, 10), ("g", "b", 0, 2), ("h", "a", 0, 5), ("h", "b", 0, 2), ("i", "a", 0, 3)]


def test_advance(spark, catalog, marks, ledger):
    ledger.commit(GROUP, offsets.advanced(wanted(spark, catalog, BOTH), marks))
    assert current(spark, catalog, ledger) == {(t, p): high for t, p, _, high in MARKS}


def test_rewind(spark, catalog, marks, ledger):
    ledger.commit(GROUP, offsets.rewound(wanted(spark, catalog, BOTH), marks))
    assert current(spark, catalog, ledger) == {(t, p): low for t, p, low, _ in MARKS}


def set_offsets(spark, catalog, ledger, new, **how):
    frame = offsets_frame(spark, new)
    ledger.commit(GROUP, offsets.set_to(frame, checked_partitions(frame, catalog, **how)))
    return current(spark, catalog, ledger)


def test_set_offsets(spark, catalog, ledger):
    found = set_offsets(spark, catalog, ledger, {"orders": {0: 70, 1: 260}, "clicks": {0: 135, 1: 410}})
    assert found == {("orders", 0): 70, ("orders", 1): 260, ("orders", 2): 12, ("clicks", 0): 135, ("clicks", 1): 410}


def test_set_offsets_skips_unknown_partitions(spark, catalog, ledger):
    new = {"orders": {0: 70, 17: 1, 9: 2}, "clicks": {31: 3}}
    assert set_offsets(spark, catalog, ledger, new, raise_on_error=False) == {
        **{(t, p): 0 for t, p, _, _ in MARKS}, **COMMITS, ("orders", 0): 70}
    with pytest.raises(UnknownPartitionError):
        set_offsets(spark, catalog, ledger, new)


@pytest.mark.parametrize("new", [["orders"], {"orders": [0]}, "orders"])
def test_new_offsets_of_a_wrong_type(spark, new):
    with pytest.raises(TypeError):
        offsets_frame(spark, new)


def metadata(spark, catalog, marks, ledger, topics=BOTH, group=GROUP):
    return offsets.offsets_metadata(wanted(spark, catalog, topics), ledger.commits(), marks, group)


def test_offsets_metadata(spark, catalog, marks, ledger, rows):
    assert rows(metadata(spark, catalog, marks, ledger, {"orders": [1]})) == [("orders", 1, 25, 37, 6)]


def test_lag(spark, catalog, marks, ledger):
    assert as_dict(offsets.lag(metadata(spark, catalog, marks, ledger, {"orders": [1, 2]}))) == {
        ("orders", 1): 12, ("orders", 2): 21}
    assert as_dict(offsets.lag(metadata(spark, catalog, marks, ledger))) == {
        ("orders", 0): 0, ("orders", 1): 12, ("orders", 2): 21, ("clicks", 0): 42, ("clicks", 1): 54}


def test_lag_of_an_unknown_group_is_the_high_mark(spark, catalog, marks, ledger):
    assert as_dict(offsets.lag(metadata(spark, catalog, marks, ledger, group="nobody"))) == {
        (t, p): high for t, p, _, high in MARKS}


def test_lag_by_topic(spark, catalog, marks, ledger):
    found = offsets.by_topic(offsets.lag(metadata(spark, catalog, marks, ledger)), "lag")
    assert {r.topic: r.lag for r in found.collect()} == {"orders": {0: 0, 1: 12, 2: 21}, "clicks": {0: 42, 1: 54}}


def test_reader_without_a_commit_follows_the_reset_policy(spark, catalog, marks, ledger):
    for reset, at in (("smallest", 7), ("largest", 54)):
        found = as_dict(offsets.start_positions(catalog, ledger.commits(), marks, GROUP, reset))
        assert found == {**COMMITS, ("clicks", 1): at}


def test_last_write_wins_and_entries_replace_themselves(spark, ledger):
    one = offsets_frame(spark, {"clicks": {1: 40}})
    ledger.commit(GROUP, one, entry="batch-0")
    ledger.commit(GROUP, offsets_frame(spark, {"clicks": {1: 7}}), entry="batch-1")
    ledger.commit(GROUP, offsets_frame(spark, {"clicks": {1: 9}}), entry="batch-1")
    found = ledger.commits().where("topic = 'clicks' and partition = 1").orderBy("commit_seq").collect()
    assert [(r.offset, r.commit_seq) for r in found] == [(40, 2), (9, 3)]
    last = offsets.current_commits(ledger.commits()).where("topic = 'clicks' and partition = 1").first()
    assert last.offset == 9


MESSAGES = "topic string, partition int, offset bigint, key binary, value binary"


def log_of(spark, *positions):
    return spark.createDataFrame([(t, p, o, b"k", b"v") for t, p, o in positions], MESSAGES)


def test_commit_after_processing_and_commit_of_a_message(spark, rows):
    read = log_of(spark, ("t", 0, 41), ("t", 0, 42), ("t", 1, 3))
    assert rows(offsets.processed(read)) == [("t", 0, 43), ("t", 1, 4)]
    assert rows(offsets.up_to_message(read)) == [("t", 0, 42), ("t", 1, 3)]


def test_four_field_message(spark, rows):
    read = spark.createDataFrame([("t", 1, 777, b"a key", b"a payload")], MESSAGES)
    found = messages.without_topic(read)
    assert found.columns == ["partition", "offset", "key", "value"]
    assert rows(found) == [(1, 777, b"a key", b"a payload")]


def test_first_messages(spark, rows):
    read = log_of(spark, *[("t", p, o) for p in (0, 1) for o in (3, 5, 9, 11)])
    found = messages.first_messages(read, 2).select("partition", "offset")
    assert rows(found) == [(0, 3), (0, 5), (1, 3), (1, 5)]
    assert "WindowGroupLimit" in messages.first_messages(read, 2)._jdf.queryExecution().executedPlan().toString()


def test_delivery_audit(spark, rows):
    read = log_of(spark, *[("ok", 0, o) for o in (4, 5, 6)], *[("hole", 0, o) for o in (4, 6)], *[("twice", 0, o) for o in (4, 4, 5)],
                  *[("masked", 0, o) for o in (4, 4, 6)])
    assert rows(messages.delivery_audit(read)) == [
        ("hole", 0, 2, 2, 3, False), ("masked", 0, 3, 2, 3, False), ("ok", 0, 3, 3, 3, True), ("twice", 0, 3, 2, 2, False)]


@pytest.mark.parametrize("stretch", [1, 2, 3, 10, 1_000_000])
def test_offset_gaps_do_not_depend_on_the_stretch(spark, rows, stretch):
    read = log_of(spark, *[("t", 0, o) for o in (0, 1, 2, 5, 5, 5, 6, 20, 21)], *[("u", 0, o) for o in (7, 8, 9)])
    assert rows(messages.offset_gaps(read, stretch)) == [
        ("t", 0, 2, 5, 3, 1), ("t", 0, 5, 5, 0, 2), ("t", 0, 6, 20, 14, 1)]


@pytest.mark.parametrize("whole", [True, False])
def test_messages_are_processed_in_offset_order(spark, whole):
    read = spark.range(5000).select(
        F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"), (F.lit(5000) - F.col("id")).alias("offset"))

    def check(batch):
        assert (batch.groupby("partition")["offset"].diff().dropna() > 0).all()
        return batch

    found = messages.process_messages(read, check, "topic string, partition int, offset bigint", whole)
    assert found.count() == 5000


def test_a_failing_processor_names_the_message(spark):
    read = log_of(spark, ("t", 3, 41))

    def fail(batch):
        raise RuntimeError("broken pipe")

    with pytest.raises(Exception, match=r"t-3 offset 41.*broken pipe"):
        messages.process_messages(read, fail, MESSAGES).collect()


def test_offset_gaps_shuffle_the_messages_once(spark, path):
    log_of(spark, ("t", 0, 1), ("t", 0, 5)).write.parquet(path("gaps"))
    plan = messages.offset_gaps(spark.read.parquet(path("gaps")))._jdf.queryExecution().executedPlan().toString()
    initial = plan.count("REPARTITION_BY_COL")
    found = messages.offset_gaps(spark.read.parquet(path("gaps")))
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("ReusedExchange") == 1 and final.count("REPARTITION_BY_COL") <= initial
    assert final.count("ENSURE_REQUIREMENTS") == 1


def every_other_offset(spark):
    odd = F.col("id") % 2
    return spark.range(40_000).select(
        F.concat(F.lit("t"), odd.cast("string")).alias("topic"), odd.cast("int").alias("partition"), (F.col("id") * 2).alias("offset"))


def test_ranges_in_offset_order_do_not_grow_with_the_messages(spark):
    place = F.struct("topic", "partition", "offset")
    by_task = messages.in_offset_order(every_other_offset(spark), rows_per_range=1_000).groupBy(F.spark_partition_id().alias("task")).agg(
        F.count("*").alias("rows"), F.min(place).alias("first"), F.max(place).alias("last")).orderBy("task").collect()
    assert len(by_task) >= 38 and max(t["rows"] for t in by_task) < 2_000
    assert all(a["last"] < b["first"] for a, b in zip(by_task, by_task[1:]))


def test_tasks_that_look_for_gaps_do_not_grow_with_the_messages(spark):
    gaps = messages.offset_gaps(every_other_offset(spark), stretch=100, rows_per_piece=1_000)
    assert gaps.count() == 39_998
    # The first gap of a stretch is found elsewhere; the others are found where the stretch is.
    held = gaps.where("offset % 100 > 0").groupBy(F.spark_partition_id()).count().collect()
    assert len(held) > 30 and max(t["count"] for t in held) < 3_000


# A ledger that is folded

def files_below(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))


def test_reading_and_committing_does_not_grow_with_the_commits(spark, path, monkeypatch):
    monkeypatch.setattr("topiclog.sources.ledger.FOLD", 4)
    ledger = CommitLedger.create(spark, path("long"))
    read, kept = [], []
    for i in range(42):
        ledger.commit("g", offsets_frame(spark, {"t": {i % 5: i, 7: 2 * i}}), "kafka", entry=f"batch-{i}")
        if i % 4 == 1:
            read.append(len(ledger.commits("g").inputFiles()))
            kept.append(len(files_below(path("long"))))
    # A snapshot and the commits behind it; on disk those that counted until the last switch as well, and the records of two pointers.
    assert read == [2] + [3] * 10
    assert max(kept) <= 1 + 2 + 5 + 4 + 1 and kept[-1] == kept[3]
    expected = {("t", p): max(i for i in range(42) if i % 5 == p) for p in range(5)} | {("t", 7): 82}
    for found in (ledger.commits("g"), ledger.commits()):
        assert {(r.topic, r.partition): r.offset for r in offsets.current_commits(found).collect()} == expected
    assert ledger.next_seq("g") == 43


def test_readers_keep_their_version_while_the_ledger_is_folded(spark, path, rows, monkeypatch):
    monkeypatch.setattr("topiclog.sources.ledger.FOLD", 4)
    ledger = CommitLedger.create(spark, path("versions"))
    for i in range(6):
        ledger.commit("g", offsets_frame(spark, {"t": {0: i}}), "kafka")
    before = ledger.commits("g")
    for i in range(6, 9):
        ledger.commit("g", offsets_frame(spark, {"t": {0: i}}), "kafka")
    assert [r.offset for r in offsets.current_commits(before).collect()] == [5]
    assert [r.offset for r in offsets.current_commits(ledger.commits("g")).collect()] == [8]


def test_groups_loads_and_rewinds_through_a_fold(spark, path, rows):
    history = "group_id string, topic string, partition int, offset bigint, storage string, commit_seq bigint"
    ledger = CommitLedger(spark, path("loaded"))
    ledger.load(spark.createDataFrame([("g", "t", 0, 50, "kafka", 8), ("g", "t", 1, 60, None, 9), ("h.1/x", "t", 0, 7, "kafka", 3), ("g", "t", 0, 40, "kafka", 7)], history), "history")
    state = lambda found: rows(offsets.current_commits(found).select("group_id", "storage", "partition", "offset"))
    loaded = [("g", "kafka", 0, 50), ("g", "zookeeper", 1, 60), ("h.1/x", "kafka", 0, 7)]
    assert state(ledger.commits()) == loaded
    ledger.commit("g", offsets_frame(spark, {"t": {0: 5}}), "kafka")
    ledger.fold("g")
    ledger.fold("h.1/x")
    rewound = [("g", "kafka", 0, 5), *loaded[1:]]
    assert state(ledger.commits()) == rewound
    assert state(ledger.commits("g")) == rewound[:2] and state(ledger.commits("h.1/x")) == rewound[2:]
    assert ledger.commits().count() == 3
    # A load again is read again, and its own numbers say what is last.
    ledger.load(spark.createDataFrame([("g", "t", 0, 99, "kafka", 1), ("g", "t", 1, 61, "zookeeper", 1000), ("i", "t", 0, 1, "kafka", 1)], history), "history")
    assert state(ledger.commits()) == [("g", "kafka", 0, 5), ("g", "zookeeper", 1, 61), ("h.1/x", "kafka", 0, 7), ("i", "kafka", 0, 1)]
    ledger.commit("g", offsets_frame(spark, {"t": {1: 3}}))
    assert state(ledger.commits("g")) == [("g", "kafka", 0, 5), ("g", "zookeeper", 1, 3)]
    ledger.fold("i")
    assert state(ledger.commits("i")) == [("i", "kafka", 0, 1)] and ledger.commits("nobody").count() == 0


def test_a_ledger_of_the_older_layout_is_taken_over(spark, path, rows):
    old = spark.createDataFrame([("g", "t", 0, 4, None, "kafka", 6, None)], "group_id string, topic string, partition int, offset bigint, metadata string, storage string, commit_seq bigint, committed_at timestamp")
    old.write.parquet(path("old") + "/entry=reader-3")
    ledger = CommitLedger(spark, path("old"))
    assert ledger.next_seq("g") == 7
    ledger.commit("g", offsets_frame(spark, {"t": {1: 2}}), "kafka")
    assert rows(offsets.current_commits(ledger.commits()).select("partition", "offset")) == [(0, 4), (1, 2)]


def test_a_commit_begun_and_not_finished_does_not_count(spark, path, rows):
    ledger = CommitLedger.create(spark, path("torn"))
    ledger.commit("g", offsets_frame(spark, {"t": {0: 1}}), "kafka")
    torn = ledger.commits("g").withColumn("offset", F.lit(77)).withColumn("commit_seq", F.lit(2)).withColumn("part", F.lit(2))
    torn.write.parquet(ledger._part("g", 2))
    for found in (ledger.commits("g"), ledger.commits()):
        assert [r.offset for r in offsets.current_commits(found).collect()] == [1]
    ledger.commit("g", offsets_frame(spark, {"t": {0: 3}}), "kafka")
    assert [r.offset for r in offsets.current_commits(ledger.commits()).collect()] == [3]


# State carried through a partition in ranges

@pytest.mark.parametrize("rows_per_range", [150, 1_000_000])
def test_a_carried_state_gives_what_whole_partitions_give(spark, rows_per_range):
    """A hot partition of 3,000 of 4,000 messages; sessions that a gap of more than 5 offsets ends, with their number and size so far."""
    n = F.col("id")
    read = spark.range(0, 4_000, numPartitions=5).select(
        F.when(n % 4 > 0, "hot").otherwise(F.concat(F.lit("t"), (n % 3).cast("string"))).alias("topic"), F.lit(0).alias("partition"),
        (n + F.expr("id div 97") * 9).alias("offset"))

    def left_behind(batch):
        gaps = batch["offset"].diff() > 5
        last = int((~gaps[::-1].cummax()).sum()) + (1 if gaps.any() else 0)
        return int(batch["offset"].iloc[0]), int(batch["offset"].iloc[-1]), int(gaps.sum()), last

    def merge(a, b):
        opens = b[0] - a[1] > 5
        whole = b[2] == 0 and not opens
        return a[0], b[1], a[2] + b[2] + opens, a[3] + b[3] if whole else b[3]

    def sessions(batch, state):
        out = batch[["topic", "offset"]].copy()
        first, end, number, size = state or (None, None, 0, 0)
        numbers, sizes = [], []
        for offset in batch["offset"]:
            if end is not None and offset - end > 5:
                number, size = number + 1, 0
            end, size = offset, size + 1
            numbers.append(number)
            sizes.append(size)
        return out.assign(session=numbers, size=sizes, rows=len(batch))

    found = messages.process_in_order(
        read, left_behind, merge, sessions, "first bigint, last bigint, gaps bigint, size bigint",
        "topic string, offset bigint, session bigint, size bigint, rows bigint", rows_per_range).toPandas()
    whole = [sessions(part.sort_values("offset"), None) for _, part in read.toPandas().groupby("topic")]
    expected = {(r.topic, r.offset): (r.session, r.size) for part in whole for r in part.itertuples()}
    assert len(found) == 4_000 and {(r.topic, r.offset): (r.session, r.size) for r in found.itertuples()} == expected
    if rows_per_range == 150:
        # No task held much more than a range.
        assert found["rows"].max() <= 2 * 150 and (found["rows"][found["topic"] == "hot"]).max() > 50


def test_a_carried_state_without_messages(spark):
    none = spark.createDataFrame([], "topic string, partition int, offset bigint")
    found = messages.process_in_order(none, lambda b: (1,), lambda a, b: a, lambda b, s: b, "n bigint", "topic string, partition int, offset bigint")
    assert found.count() == 0
