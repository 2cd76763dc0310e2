import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from topiclog import TopicLog
from topiclog.errors import AppendError, UnknownTopicError

INPUT = "topic string, key binary, value binary, seq bigint"


def text(df):
    return df.select("topic", "partition", "offset", F.decode("key", "UTF-8").alias("key"), F.decode("value", "UTF-8").alias("value"))


def batch(spark, *messages, topic="topic", key=None):
    return spark.createDataFrame(
        [(topic, key, m.encode(), i) for i, m in enumerate(messages)], INPUT)


@pytest.fixture
def log(spark, path):
    partitions = spark.createDataFrame([("topic", 0), ("wide", 0), ("wide", 1), ("wide", 2), ("wide", 3), ("wide", 4), ("007", 0)],
                                       "topic string, partition int")
    return TopicLog.create(spark, path("log"), partitions)


def test_append_unkeyed(spark, log, rows):
    log.append_unkeyed(batch(spark, "some message 5", "some message 6").drop("key"), ["seq"], "a")
    assert rows(text(log.messages())) == [
        ("topic", 0, 0, None, "some message 5"), ("topic", 0, 1, None, "some message 6")]


def test_append_keyed(spark, log, rows):
    log.append_keyed(batch(spark, "some message 5", "some message 6", key=b"0"), ["seq"], "a")
    assert rows(text(log.messages())) == [
        ("topic", 0, 0, "0", "some message 5"), ("topic", 0, 1, "0", "some message 6")]


def test_appends_continue_and_repeats_replace(spark, log, rows):
    log.append_keyed(batch(spark, "a", "b", key=b"k"), ["seq"], "one")
    for _ in range(2):
        log.append_keyed(batch(spark, "c", "d", key=b"k"), ["seq"], "two")
    log.append_keyed(batch(spark, "e", key=b"k"), ["seq"], "three")
    assert [(r[2], r[4]) for r in rows(text(log.messages()))] == [(0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "e")]


def test_equal_keys_share_a_partition(spark, log):
    source = spark.range(3000).select(
        F.lit("wide").alias("topic"), (F.col("id") % 50).cast("string").cast("binary").alias("key"),
        F.lit(b"v").alias("value"), F.col("id").alias("seq"))
    log.append_keyed(source, ["seq"], "a", rows_per_piece=200)
    messages = log.messages()
    assert messages.groupBy("key").agg(F.countDistinct("partition").alias("n")).where("n > 1").isEmpty()
    assert messages.count() == 3000


@pytest.mark.parametrize("topic, partitions", [("topic", 1), ("wide", 5)])
@pytest.mark.parametrize("rows_per_piece", [7, 1000])
def test_each_of_100_messages_once(spark, log, topic, partitions, rows_per_piece):
    log.append_unkeyed(batch(spark, *[str(i) for i in range(100)], topic=topic), ["seq"], "a", rows_per_piece)
    found = text(log.topic(topic)).collect()
    assert sorted(int(r.value) for r in found) == list(range(100))
    assert {r.partition for r in found} == set(range(partitions))
    assert all(int(r.value) == r.offset * partitions + r.partition for r in found)


def test_unknown_topic_is_refused_before_anything_is_written(spark, log):
    with pytest.raises(UnknownTopicError, match="nowhere"):
        log.append_keyed(batch(spark, "x", topic="nowhere", key=b"k"), ["seq"], "a")
    assert log.messages().count() == 0


def test_topic_names_stay_text(spark, log, rows):
    log.append_unkeyed(batch(spark, "x", topic="007"), ["seq"], "a")
    assert rows(text(log.topic("007"))) == [("007", 0, 0, None, "x")]


def test_watermarks_of_empty_and_truncated_partitions(spark, path, rows):
    partitions = spark.createDataFrame([("t", 0, 5), ("t", 1, 0)], "topic string, partition int, next_offset bigint")
    log = TopicLog.create(spark, path("log"), partitions)
    assert rows(log.watermarks()) == [("t", 0, 5, 5), ("t", 1, 0, 0)]
    log.append_unkeyed(batch(spark, "a", "b", "c", topic="t"), ["seq"], "a")
    assert rows(log.watermarks()) == [("t", 0, 5, 7), ("t", 1, 0, 1)]


def test_partitions_can_be_added(spark, log, rows):
    log.add_partitions(spark.createDataFrame([("topic", 0), ("topic", 1), ("new", 0)], "topic string, partition int"))
    assert [r for r in rows(log.catalog()) if r[0] in ("topic", "new")] == [("new", 0), ("topic", 0), ("topic", 1)]


def test_watermarks_read_footers_only(spark, log):
    log.append_unkeyed(batch(spark, "a", "b"), ["seq"], "a")
    plan = log.footer_extents()._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan parquet" in plan
    scan = log.footer_extents()._jdf.queryExecution().optimizedPlan().toString()
    assert "count(*)" in scan and "value" not in scan


def test_reading_a_topic_prunes_directories_and_columns(spark, log):
    log.append_unkeyed(batch(spark, "a", "b"), ["seq"], "a")
    plan = log.topic("topic", [0]).where("offset >= 1").select("offset")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan and "(topic" in plan
    assert "PushedFilters: [IsNotNull(offset), GreaterThanOrEqual(offset,1)]" in plan
    assert "ReadSchema: struct<offset:bigint>" in plan


def test_reading_from_positions_prunes_appends(spark, log, rows):
    log.append_unkeyed(batch(spark, "a", "b"), ["seq"], "old")
    log.append_unkeyed(batch(spark, "c", "d"), ["seq"], "new")
    starts = spark.createDataFrame([("topic", 0, 3)], "topic string, partition int, start bigint")
    found = log.after(starts)
    assert [r[4] for r in rows(text(found))] == ["d"]
    assert len(found.inputFiles()) == 1 and "append=new" in found.inputFiles()[0]
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()


def test_a_large_side_is_not_broadcast(spark):
    from topiclog.session import broadcast_if_small
    small, large = spark.range(10), spark.range(11)
    joined = lambda side: spark.range(100).join(broadcast_if_small(side, max_rows=10), "id")
    assert "ResolvedHint" in joined(small)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in joined(large)._jdf.queryExecution().analyzed().toString()


def test_reading_past_the_end(spark, log):
    log.append_unkeyed(batch(spark, "a"), ["seq"], "a")
    starts = spark.createDataFrame([("topic", 0, 1)], "topic string, partition int, start bigint")
    assert log.after(starts).isEmpty()


def test_assigned_reads_exactly_the_listed_partitions(spark, log):
    log.append_unkeyed(batch(spark, *"abcdefghij", topic="wide"), ["seq"], "a")
    wanted = spark.createDataFrame([("wide", 1), ("wide", 4), ("topic", 0)], "topic string, partition int")
    assert {(r.topic, r.partition) for r in log.assigned(wanted).collect()} == {("wide", 1), ("wide", 4)}


def test_argument_types(log):
    with pytest.raises(TypeError):
        log.topic(7)
    with pytest.raises(TypeError):
        log.topic("topic", "0")


@pytest.mark.parametrize("rows_per_piece", [50, 100_000])
@pytest.mark.parametrize("keyed", [True, False])
def test_files_are_sorted_by_offset(spark, log, parquet_files, keyed, rows_per_piece):
    source = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "topic").otherwise("wide").alias("topic"),
        F.col("id").cast("string").cast("binary").alias("key"), F.lit(b"v").alias("value"), F.rand(3).alias("seq"), "id")
    (log.append_keyed if keyed else log.append_unkeyed)(source, ["id"], "a", rows_per_piece)
    files = [f for f in parquet_files(log.path) if "/_" not in f.removeprefix(log.path)]
    assert files
    for file in files:
        offsets = pq.ParquetFile(file).read(["offset"]).column("offset").to_pylist()
        assert offsets == sorted(offsets)
    heads = log.watermarks().collect()
    assert sum(r.highmark - r.lowmark for r in heads) == 2000 == log.messages().count()


def test_rows_without_key_are_kept(spark, log, rows):
    source = spark.createDataFrame([("wide", None, b"v1", 0), ("wide", b"k", b"v2", 1), ("wide", None, None, 2), ("wide", None, b"v1", 3)], INPUT)
    log.append_keyed(source, ["seq"], "a")
    found = rows(log.messages().select("key", "value"))
    assert found == sorted([(None, bytearray(b"v1")), (bytearray(b"k"), bytearray(b"v2")), (None, None), (None, bytearray(b"v1"))], key=repr)
    same = log.messages().where("value = cast('v1' as binary)").select("partition").distinct()
    assert same.count() == 1


@pytest.mark.parametrize("append", ["append_keyed", "append_unkeyed"])
def test_rows_without_topic_are_refused(spark, log, append):
    source = spark.createDataFrame([(None, b"k", b"v", 0), ("wide", b"k", b"v", 1)], INPUT)
    with pytest.raises(UnknownTopicError, match="1 rows"):
        getattr(log, append)(source, ["seq"], "a")
    assert log.messages().count() == 0


@pytest.mark.parametrize("append", ["append_keyed", "append_unkeyed"])
def test_tied_rows_keep_their_numbers(spark, log, rows, append):
    """All rows agree in the order: a repeat in another layout must number them alike."""
    source = spark.createDataFrame([("wide", f"k{i % 3}".encode(), f"v{i}".encode(), 7) for i in range(60)], INPUT)
    source = source.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    getattr(log, append)(source.repartition(3, "value"), ["seq"], "a", 10)
    first = rows(text(log.messages()))
    getattr(log, append)(source.orderBy(F.desc("value")), ["seq"], "a", 10)
    assert rows(text(log.messages())) == first and len(first) == 60


def test_reading_a_few_is_bounded_before_the_window(spark, log, rows):
    source = lambda a, b: spark.range(a, b).select(
        F.lit("wide").alias("topic"), (F.col("id") % 40).cast("string").cast("binary").alias("key"), F.lit(b"v").alias("value"), F.col("id").alias("seq"))
    log.append_keyed(source(0, 400), ["seq"], "a")
    log.append_keyed(source(400, 1000), ["seq"], "b")
    starts = log.watermarks().where("topic = 'wide'").select("topic", "partition", (F.col("highmark") - 20 - F.col("partition")).alias("start"))
    expected = [r for r in rows(log.messages().join(starts, ["topic", "partition"]).where("offset >= start and offset < start + 3").select("topic", "partition", "offset"))]
    few = log.after(starts, count=3)
    assert rows(few.select("topic", "partition", "offset")) == expected and len(expected) == 15
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset" in plan and "LessThan(offset" in plan
    everything = log.after(starts)
    assert rows(everything.select("topic", "partition", "offset")) == rows(
        log.messages().join(starts, ["topic", "partition"]).where("offset >= start").select("topic", "partition", "offset"))
    assert log.after(starts.limit(0)).count() == 0
    before = starts.withColumn("start", F.lit(-5).cast("bigint"))
    assert log.after(before, count=2).count() == 10


def one(spark, i):
    return batch(spark, f"m{i}", topic="topic", key=b"k")


def test_an_older_append_repeated_keeps_later_ones(spark, log, rows):
    for i in range(3):
        log.append_keyed(one(spark, i), ["seq"], f"a{i}")
    with_marks = rows(log.watermarks())
    assert with_marks == rows(log._footer_watermarks())
    assert rows(log.extents()) == rows(log.footer_extents().select(*log.extents().columns))


def test_an_append_that_never_finished_is_seen_by_the_next(spark, log, rows):
    """The head table says that an append began: the ends then come from the footers, its messages included."""
    log.append_keyed(one(spark, 0), ["seq"], "a0")
    ends = log._ends("x").select("topic", "partition", F.col("_end").alias("next_offset"), F.col("_end").alias("before"))
    log._marks.publish(ends, "lost", done=False)
    lost = spark.createDataFrame([(1, b"k", b"left behind", "topic", 0)], "offset bigint, key binary, value binary, topic string, partition int")
    lost.withColumn("timestamp", F.current_timestamp()).write.partitionBy("topic", "partition").parquet(log.path + "/append=lost")
    log.append_keyed(one(spark, 1), ["seq"], "a1")
    assert [(r[2], r[4]) for r in rows(text(log.messages()))] == [(0, "m0"), (1, "left behind"), (2, "m1")]
    assert rows(log.after(starts_at(spark, 0))) == rows(log.messages())
    assert {(r.topic, r.partition): r.highmark for r in log.watermarks().collect()}[("topic", 0)] == 3


def test_a_log_without_head_table_goes_on(spark, log, rows, tmp_path):
    import shutil

    for i in range(2):
        log.append_keyed(one(spark, i), ["seq"], f"a{i}")
    old = TopicLog(spark, str(tmp_path / "old"))
    shutil.copytree(log.path, old.path, ignore=shutil.ignore_patterns("_marks", "_last", "_extents", "_manifest"))
    assert rows(old.watermarks()) == rows(log.watermarks())
    old.append_keyed(one(spark, 2), ["seq"], "a2")
    assert [(r[2], r[4]) for r in rows(text(old.messages()))] == [(0, "m0"), (1, "m1"), (2, "m2")]
    assert rows(old.extents()) == rows(old.footer_extents().select(*old.extents().columns)) and old.extents().count() == 3


def test_watermarks_read_as_many_files_after_many_appends(spark, log):
    counts = []
    for i in range(12):
        log.append_keyed(one(spark, i), ["seq"], f"a{i}")
        if i in (4, 11):
            counts.append(len(log.watermarks().inputFiles()))
    assert counts[0] == counts[1] and log.messages().count() == 12


def test_an_empty_append(spark, log, rows):
    log.append_keyed(one(spark, 0).limit(0), ["seq"], "none")
    log.append_keyed(one(spark, 0), ["seq"], "some")
    assert [r[2] for r in rows(text(log.messages()))] == [0]


def test_marks_stay_readable(spark, log, rows):
    """A DataFrame of marks is lazy: later appends must not take its files away."""
    log.append_keyed(one(spark, 0), ["seq"], "a0")
    marks = log.watermarks()
    expected = rows(marks)
    for i in range(1, 4):
        log.append_keyed(one(spark, i), ["seq"], f"a{i}")
    assert rows(marks) == expected


# The manifest

def test_only_wanted_directories_are_listed_among_a_million(spark, log, rows, monkeypatch):
    log.append_unkeyed(batch(spark, "a", "b"), ["seq"], "old")
    log.append_unkeyed(batch(spark, "c", "d"), ["seq"], "new")
    many = spark.range(1_000_000).select(
        F.concat(F.lit("x"), F.col("id") % 1000).alias("append"), F.lit(None).cast("bigint").alias("generation"),
        F.concat(F.lit("other"), F.col("id") % 997).alias("topic"), F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("first_offset"), F.lit(9).cast("bigint").alias("last_offset"), F.lit(10).cast("bigint").alias("messages"))
    kept = log.extents()
    monkeypatch.setattr(type(log), "extents", lambda self: kept.unionByName(many))
    found = log.after(spark.createDataFrame([("topic", 0, 3)], "topic string, partition int, start bigint"))
    assert len(found.inputFiles()) == 1
    assert [r[4] for r in rows(text(found))] == ["d"]


@pytest.mark.parametrize("size", [1, 2, 10_000])
def test_directories_are_read_in_blocks(spark, log, rows, monkeypatch, size):
    monkeypatch.setattr("topiclog.sources.log.BLOCK_DIRECTORIES", size)
    for name in ("one", "two"):
        log.append_unkeyed(batch(spark, *[f"{name}{i}" for i in range(12)], topic="wide"), ["seq"], name)
    starts = spark.createDataFrame([("wide", p, p, f"r{p}") for p in range(5)] + [("topic", 0, 0, "r")], "topic string, partition int, start bigint, tag string")
    whole = log.messages().join(starts, ["topic", "partition"]).where("offset >= start").drop("start")
    assert rows(log.after(starts, ["tag"]).select(*whole.columns)) == rows(whole)
    first_two = whole.select("partition", "offset").join(starts.where("topic = 'wide'").select("partition", "start"), "partition").where("offset < start + 2")
    assert rows(log.after(starts, count=2).select("partition", "offset")) == rows(first_two.select("partition", "offset"))
    assert log.after(starts.where("topic = 'topic'"), ["tag"]).collect() == []


def test_topics_with_odd_names_are_found(spark, path, rows):
    names = ["a b", "50%", "x/y", "k=v", "q?{1}[2]", "star*", "ü#:", "back\\slash", "quote'\"", "^~"]
    log = TopicLog.create(spark, path("odd"), spark.createDataFrame([(n, 0) for n in names], "topic string, partition int"))
    given = spark.createDataFrame([(n, None, n.encode(), i) for i, n in enumerate(names)], INPUT)
    log.append_unkeyed(given, ["seq"], "a")
    assert rows(log.assigned(log.catalog()).select("topic", F.decode("value", "UTF-8"))) == sorted((n, n) for n in names)


def test_the_manifest_is_merged_and_stays_small(spark, log, rows, monkeypatch):
    monkeypatch.setattr("topiclog.sources.manifest.FOLD", 2)
    monkeypatch.setattr("topiclog.sources.marks.KEPT_STEPS", 4)
    for i in range(5):
        log.append_keyed(batch(spark, str(i), key=b"k"), ["seq"], f"a{i}")
    files = log.extents().inputFiles()
    assert sum("base=" in f for f in files) == 1 and len(files) <= 1 + 2 + 2
    assert [(r.append, r.first_offset) for r in log.extents().orderBy("first_offset").collect()] == [(f"a{i}", i) for i in range(5)]
    assert rows(log.extents().drop("generation")) == rows(log.footer_extents().select("append", "topic", "partition", "first_offset", "last_offset", "messages"))
    # An append that is in the base already, repeated with more messages.
    log.append_keyed(batch(spark, "4", "5", key=b"k"), ["seq"], "a4")
    log.append_keyed(batch(spark, "6", key=b"k"), ["seq"], "a9")
    assert [r.value.decode() for r in log.after(starts_at(spark, 3)).orderBy("offset").collect()] == ["3", "4", "5", "6"]
    assert len([d for d in os.listdir(os.path.join(log.path, "_marks")) if d.startswith("step=")]) == 4


def starts_at(spark, offset):
    return spark.createDataFrame([("topic", 0, offset)], "topic string, partition int, start bigint")


def test_compaction_keeps_messages_marks_and_readers(spark, log, rows, monkeypatch):
    monkeypatch.setattr("topiclog.sources.manifest.FOLD", 3)
    for i in range(5):
        log.append_unkeyed(batch(spark, *[f"{i}-{j}" for j in range(5)], topic="wide"), ["seq"], f"a{i}")
    starts = spark.createDataFrame([("wide", p, 3) for p in range(5)], "topic string, partition int, start bigint")
    state = lambda: (rows(log.watermarks()), rows(log.messages()), rows(log.after(starts)), rows(log.topic("wide", [2])))
    before, early, early_after = state(), log.messages(), log.after(starts)
    assert log.compact() == sorted(f"a{i}" for i in range(5))
    assert state() == before
    assert rows(early) == before[1] and rows(early_after) == before[2]
    assert log.messages().select(F.input_file_name()).distinct().count() == 5
    assert {r.generation is None for r in log.extents().collect()} == {False}
    # The log goes on, and a merged append cannot be made again.
    log.append_unkeyed(batch(spark, "later", topic="wide"), ["seq"], "b")
    with pytest.raises(AppendError, match="merged"):
        log.append_unkeyed(batch(spark, "x", topic="wide"), ["seq"], "a3")
    grown = state()
    assert len(grown[1]) == len(before[1]) + 1
    assert log.vacuum() == sorted(f"a{i}" for i in range(5)) and log.vacuum() == []
    assert state() == grown and not any(d.startswith("append=a") for d in os.listdir(log.path))
    # A generation and later appends are not merged again with a single append; two are.
    assert log.compact() == []
    log.append_unkeyed(batch(spark, "last", topic="wide"), ["seq"], "c")
    assert log.compact() == ["b", "c"]
    assert len(rows(log.messages())) == 27 and rows(log.watermarks()) == rows(log._footer_watermarks())


def test_nothing_to_merge_and_unfinished_appends(spark, log):
    with pytest.raises(AppendError):
        log.compact()
    log.append_unkeyed(batch(spark, "a"), ["seq"], "one")
    assert log.compact() == [] and log.vacuum() == []
    log._marks.publish(log._marks.ends(log._marks.last()), "two", False, log._marks.last())
    with pytest.raises(AppendError, match="two"):
        log.compact()


def test_a_task_of_an_append_sorts_one_stored_part(spark, log, parquet_files, path):
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = spark.range(40_000).select(
        F.lit("topic").alias("topic"), F.lit(b"k").alias("key"), F.col("id").cast("string").cast("binary").alias("value"), F.col("id").alias("seq"))
    log.append_keyed(rows, ["seq"], "a", rows_per_piece=1_000)
    # Parts of a thousand messages, none put together with others by a task that writes the log.
    assert len(parquet_files(path("log/append=a"))) >= 38
    assert log.messages().groupBy("offset").count().count() == 40_000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split


def test_the_files_of_a_log_are_zstd(spark, log, parquet_files, path):
    log.append_keyed(batch(spark, "x", key=b"0"), ["seq"], "a")
    log.append_keyed(batch(spark, "y", key=b"0"), ["seq"], "b")
    log.compact()
    for folder in ("log/append=a", "log/append=b", "log/_merged"):
        files = parquet_files(path(folder))
        assert files and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files)
