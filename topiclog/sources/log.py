"""A message log kept as Parquet: ``append=<id>/topic=<t>/partition=<p>/``.

* Topic and partition are directories, so naming them reads only their files.
* Files are sorted by offset, so a start offset skips row groups.
* The directory levels are exactly the grouping of an append's extents, which Parquet answers from
  file footers without reading a message. Each append does so for its own files and keeps the answer in the
  manifest (:mod:`topiclog.sources.manifest`), which tells readers the directories they need.
* An append is one directory, written in ``overwrite`` mode: repeating an append with the same id replaces it.
* Many small appends are merged into ``_merged/generation=<n>/topic=<t>/partition=<p>/`` by :meth:`TopicLog.compact`.

One writer per log is assumed: a broker serialises offsets, a directory does not.
"""

from __future__ import annotations

import contextlib
import functools
import os
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiclog import schemas
from topiclog.errors import AppendError, UnknownTopicError
from topiclog.functions.patterns import starts_matching
from topiclog.operators.numbering import ROWS_PER_PIECE, indexed, store_in_order
from topiclog.session import broadcast_if_small, exists, new_dir, pinned, remove, small_scans
from topiclog.sources.manifest import COLUMNS, Manifest
from topiclog.sources.marks import UNREAD, Marks, Step
from topiclog.sources.pointer import read_or_none

PARTITION_KEYS = ["topic", "partition"]
# Directories named in one scan; more are read by several.
BLOCK_DIRECTORIES = 10_000
# Characters that Spark writes as %XX in a directory name.
_ESCAPED = frozenset(map(chr, range(1, 32))) | frozenset("\x7f\"#%'*/:=?\\{[]^")


_GENERATION = T.StructType([T.StructField("generation", T.LongType()) if f.name == "append" else f for f in schemas.LOG])


def keyed_partition(key: Column, partitions: Column) -> Column:
    """Partition of a keyed message: the first 32 bits of its key's MD5 modulo the partition count."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), partitions).cast("int")


def footer_scan(spark: SparkSession, schema, path: str) -> DataFrame:
    """Parquet reader that can answer min, max and count per directory from the file footers.

    Only the V2 reader can, and only while ``spark.sql.parquet.aggregatePushdown`` is on. All
    other reads stay with the V1 reader, which prunes partitions of joins at run time.
    """
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    v1_sources = spark.conf.get("spark.sql.sources.useV1SourceList")
    kept = ",".join(s for s in v1_sources.split(",") if s.strip().lower() != "parquet")
    spark.conf.set("spark.sql.sources.useV1SourceList", kept)
    try:
        return spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", v1_sources)


def directory(topic: str, partition: int) -> str:
    """The directory levels of a partition as Spark writes them."""
    name = "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in topic)
    return f"topic={name}/partition={partition}"


def _checked_total(rows: DataFrame) -> int:
    """Number of rows to append; raises if one has no topic or one that was not created. Reads the topics only."""
    lost = F.col("_partitions").isNull()
    found = rows.agg(
        F.count("*").alias("total"), F.count_if(lost).alias("lost"), F.min(F.when(lost, F.col("topic"))).alias("unknown")).first()
    if found.lost:
        raise UnknownTopicError(f"{found.lost} rows have no topic of this log; one of their topics is {found.unknown!r}")
    return found.total


def _tie(rows: DataFrame, order_by: Sequence[str]) -> Column:
    """A hash of the message, to order rows that agree in ``order_by``.

    A task that is run again may see its input in another order; with ties left open two messages could swap
    their numbers, one be stored twice and the other lost. Rows that agree in the hash as well are the same message.
    """
    return F.xxhash64(*order_by, *[c for c in ("topic", "key", "value", "timestamp") if c in rows.columns])


class TopicLog:
    """A log directory and the table of its partitions."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    @classmethod
    def create(cls, spark: SparkSession, path: str, partitions: DataFrame) -> TopicLog:
        """Start a log with the given ``topic, partition[, next_offset]`` rows."""
        if "next_offset" not in partitions.columns:
            partitions = partitions.withColumn("next_offset", F.lit(0))
        log = cls(spark, path)
        (partitions.select(*[F.col(f.name).cast(f.dataType) for f in schemas.HEADS])
         .write.mode("error").parquet(log._heads_path))
        return log

    def add_partitions(self, partitions: DataFrame) -> None:
        """Create further empty partitions; those that exist stay as they are."""
        fresh = partitions.select(*PARTITION_KEYS).distinct().join(self.heads(), PARTITION_KEYS, "left_anti")
        (pinned(fresh).withColumn("next_offset", F.lit(0))
         .select(*[F.col(f.name).cast(f.dataType) for f in schemas.HEADS])
         .write.mode("append").parquet(self._heads_path))

    def within(self, spark: SparkSession) -> TopicLog:
        """The same log seen from another session, as ``foreachBatch`` hands one out."""
        return TopicLog(spark, self.path)

    # -- metadata ------------------------------------------------------------------------------

    @property
    def _heads_path(self) -> str:
        return os.path.join(self.path, "_heads")

    def heads(self) -> DataFrame:
        """Partitions created, with the offset each started from."""
        return self.spark.read.schema(schemas.HEADS).parquet(self._heads_path)

    def catalog(self) -> DataFrame:
        """All ``topic, partition`` of the log, empty ones included."""
        return self.heads().select(*PARTITION_KEYS)

    @property
    def _marks(self) -> Marks:
        return Marks(self.spark, self.path)

    def footer_extents(self, append_id: str | None = None) -> DataFrame:
        """First and last offset and message count of each append's part of a partition, of one append or all; footers only."""
        path = self.path if append_id is None else os.path.join(self.path, f"append={append_id}")
        schema = schemas.LOG if append_id is None else T.StructType([f for f in schemas.LOG if f.name != "append"])
        levels = PARTITION_KEYS if append_id is not None else ["append", *PARTITION_KEYS]
        return (
            footer_scan(self.spark, schema, path).groupBy(*levels)
            .agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.count("*").alias("messages"))
            .withColumn("generation", F.lit(None).cast("bigint"))
        )

    @property
    def _manifest(self) -> Manifest:
        return Manifest(self.spark, self.path)

    def extents(self) -> DataFrame:
        """First and last offset and message count of each append's or generation's part of a partition.

        From the manifest; while an append is under way, or without a manifest, from the footers of the log.
        """
        step = self._marks.last()
        kept = self._manifest.extents() if step is not None and step.done else None
        return self._all_footer_extents() if kept is None else kept.select(*COLUMNS)

    def _all_footer_extents(self) -> DataFrame:
        """The extents of everything that counts, from the footers of all files."""
        state = self._merged_state()
        appends = self.footer_extents()
        if state is None:
            return appends.select(*COLUMNS)
        merged = self._generation_extents().where(F.col("generation").isin(list(state.generations))).withColumn("append", F.lit(None).cast("string"))
        return appends.where(~F.col("append").isin(list(state.replaced))).select(*COLUMNS).unionByName(merged.select(*COLUMNS))

    def _generation_extents(self) -> DataFrame:
        return (
            footer_scan(self.spark, _GENERATION, self._merged_path).groupBy("generation", *PARTITION_KEYS)
            .agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.count("*").alias("messages")))

    @property
    def _merged_path(self) -> str:
        return os.path.join(self.path, "_merged")

    def _merged_state(self):
        """What the manifest says of generations; None if there never was one."""
        return self._manifest.state() if exists(self.spark, self._merged_path) else None

    def watermarks(self) -> DataFrame:
        """``topic, partition, lowmark, highmark``; the high mark is the next offset to be written.

        A partition without messages still has both marks, at the place its next message will get. A few small files are
        read, however long the log. An append under way counts once it is done.
        """
        step = self._marks.last()
        if step is None:
            return self._footer_watermarks()
        high = F.coalesce(F.col("_next"), F.col("next_offset"))
        ends = self._marks.ends(step).select(*PARTITION_KEYS, F.col("next_offset").alias("_next"))
        return self.heads().join(ends, PARTITION_KEYS, "left").select(
            *PARTITION_KEYS, F.col("next_offset").alias("lowmark"), high.alias("highmark"))

    def _footer_watermarks(self, without_append: str | None = None) -> DataFrame:
        """The marks from the footers of all files, of all appends but one."""
        extents = self._all_footer_extents()
        if without_append is not None:
            extents = extents.where(F.col("append").isNull() | (F.col("append") != without_append))
        seen = extents.groupBy(*PARTITION_KEYS).agg(
            F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
        high = F.greatest(F.coalesce(F.col("last_offset") + 1, F.lit(0)), F.col("next_offset"))
        return (
            self.heads().join(seen, PARTITION_KEYS, "left")
            .select(*PARTITION_KEYS, F.coalesce("first_offset", high).alias("lowmark"), high.alias("highmark"))
        )

    def _ends(self, append_id: str, step: Step | None = UNREAD) -> DataFrame:
        """``topic, partition, _end``: where an append starts. Its own earlier attempt must not count, or a repeat would
        shift its offsets.

        The head table tells for a new append and for the last one repeated. The footers of the log are asked for an older one
        repeated, and after an append that began and never finished.
        """
        step = self._marks.last() if step is UNREAD else step
        repeated = step is not None and step.append == append_id
        earlier = read_or_none(self.spark, "offset bigint", os.path.join(self.path, f"append={append_id}")) is not None
        if step is None or not repeated and (earlier or not step.done):
            return self._footer_watermarks(append_id).select(*PARTITION_KEYS, F.col("highmark").alias("_end"))
        ends = self._marks.ends(step).select(*PARTITION_KEYS, F.col("before" if repeated else "next_offset").alias("_end"))
        return self.heads().join(ends, PARTITION_KEYS, "left").select(*PARTITION_KEYS, F.coalesce("_end", "next_offset").alias("_end"))

    # -- reading -------------------------------------------------------------------------------

    def _stored(self) -> DataFrame:
        found = self.spark.read.schema(schemas.LOG).parquet(self.path)
        state = self._merged_state()
        if state is None:
            return found
        merged = self.spark.read.schema(_GENERATION).parquet(self._merged_path).where(F.col("generation").isin(list(state.generations)))
        columns = schemas.MESSAGE_COLUMNS
        return found.where(~F.col("append").isin(list(state.replaced))).select(*columns).unionByName(merged.select(*columns))

    def messages(self) -> DataFrame:
        """The whole log with the columns of Spark's Kafka source."""
        return self._stored().select(*schemas.MESSAGE_COLUMNS)

    def topic(self, topic: str, partitions: Sequence[int] | None = None) -> DataFrame:
        """One topic, or some of its partitions."""
        if not isinstance(topic, str):
            raise TypeError("topic must be a string")
        if partitions is not None and not isinstance(partitions, (list, tuple)):
            raise TypeError("partitions must be a list")
        found = self.messages().where(F.col("topic") == topic)
        return found.where(F.col("partition").isin(*partitions)) if partitions else found

    def topics_matching(self, pattern: str) -> DataFrame:
        """Every topic whose name matches from its start; other directories are not read."""
        return self.messages().where(starts_matching(F.col("topic"), pattern))

    def assigned(self, partitions: DataFrame) -> DataFrame:
        """Exactly the listed ``topic, partition`` rows, none of which may be repeated."""
        return self.after(partitions.select(*PARTITION_KEYS, F.lit(0).cast("bigint").alias("start")))

    def after(self, starts: DataFrame, keep: Iterable[str] = (), count: int | None = None) -> DataFrame:
        """Messages at or behind ``start`` of each ``topic, partition`` in ``starts``; with ``count``, the first so many.

        The manifest tells which directories hold such messages at all, and only these are listed and scanned, in blocks. The least
        start and, with ``count``, the greatest end of a block are literals that skip row groups. Offsets of a log have no gaps, so ``count``
        bounds them before anything is sorted. ``keep`` names columns of ``starts`` to carry along.
        """
        unread = F.col("last_offset") >= F.col("start")
        extents = self.extents().join(starts, PARTITION_KEYS).where(unread).withColumn("from", F.greatest("start", "first_offset"))
        first = F.min("from").over(Window.partitionBy(*PARTITION_KEYS))
        wanted = pinned(
            # Without a count the end is behind the last message.
            extents.withColumn("end", F.col("last_offset") + 1 if count is None else first + count).where(F.col("from") < F.col("end"))
            .select("append", "generation", *PARTITION_KEYS, "from", "end", *keep))
        blocks = -(-wanted.count() // BLOCK_DIRECTORIES)
        block = F.pmod(F.xxhash64("append", "generation", *PARTITION_KEYS), F.lit(blocks))
        scans = [self._scanned(wanted if blocks == 1 else wanted.where(block == i), keep) for i in range(blocks)]
        found = [scan for scan in scans if scan is not None]
        if not found:
            return self.messages().where(F.lit(False)).join(wanted.select(*PARTITION_KEYS, *keep), PARTITION_KEYS).select(*schemas.MESSAGE_COLUMNS, *keep)
        return functools.reduce(DataFrame.unionByName, found)

    def _scanned(self, wanted: DataFrame, keep: Iterable[str]) -> DataFrame | None:
        """The messages of one block of directories; None if it names none. At most some ``BLOCK_DIRECTORIES`` rows are collected and broadcast."""
        rows = wanted.select("append", "generation", *PARTITION_KEYS, "from", "end").collect()
        least, most = min((r["from"] for r in rows), default=0), max((r["end"] for r in rows), default=0)
        found = []
        for level, schema, base in (("append", schemas.LOG, self.path), ("generation", _GENERATION, self._merged_path)):
            paths = {os.path.join(base, f"{level}={r[level]}", directory(r.topic, r.partition)) for r in rows if r[level] is not None}
            if paths:
                scan = self.spark.read.schema(schema).option("basePath", base).parquet(*sorted(paths))
                named = wanted.where(F.col(level).isNotNull()).select(level, *PARTITION_KEYS, "from", "end", *keep)
                found.append(
                    scan.where((F.col("offset") >= least) & (F.col("offset") < most)).join(F.broadcast(named), [level, *PARTITION_KEYS])
                    .where((F.col("offset") >= F.col("from")) & (F.col("offset") < F.col("end"))).select(*schemas.MESSAGE_COLUMNS, *keep))
        return functools.reduce(DataFrame.unionByName, found) if found else None

    def stream(self, topics: Sequence[str] | None = None, pattern: str | None = None,
               max_files: int | None = None) -> DataFrame:
        """The log as a stream of the given topics, of those matching a pattern, or of all.

        The log needs one append before the stream starts: Spark learns the directory levels then.
        Appends arrive in the order they were made, but the files of one append in any order.
        """
        reader = self.spark.readStream.schema(schemas.LOG)
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        found = reader.parquet(self.path).select(*schemas.MESSAGE_COLUMNS)
        if topics is not None:
            found = found.where(F.col("topic").isin(*topics))
        return found.where(starts_matching(F.col("topic"), pattern)) if pattern is not None else found

    # -- appending -----------------------------------------------------------------------------

    def append_keyed(self, rows: DataFrame, order_by: Sequence[str], append_id: str,
                     rows_per_piece: int = ROWS_PER_PIECE) -> None:
        """Append ``topic, key, value[, timestamp]`` rows; equal keys share a partition.

        Rows without a key go to the partition that their value has as a key. Rows without a topic of the log are refused.
        """
        placed = self._with_partition_count(rows).withColumn(
            "partition", keyed_partition(F.coalesce("key", "value", F.lit("").cast("binary")), F.col("_partitions")))
        with self._numbered(placed, order_by, PARTITION_KEYS, "_index", rows_per_piece, ["topic", "partition", "key", "value", "timestamp"]) as (numbered, total):
            self._write(numbered, append_id, total)

    def append_unkeyed(self, rows: DataFrame, order_by: Sequence[str], append_id: str,
                       rows_per_piece: int = ROWS_PER_PIECE) -> None:
        """Append ``topic, value[, timestamp]`` rows, dealt to the partitions of their topic in turn.

        One numbering per topic gives both the partition and the place in it.
        """
        counted = self._with_partition_count(rows)
        with self._numbered(counted, order_by, ["topic"], "_turn", rows_per_piece, ["topic", "value", "timestamp", "_partitions"]) as (dealt, total):
            placed = (
                dealt.withColumn("key", F.lit(None).cast("binary"))
                .withColumn("partition", F.pmod("_turn", F.col("_partitions")).cast("int"))
                .withColumn("_index", F.expr("_turn div _partitions"))
            )
            # The turns of a topic are spread over tasks; bring each partition's stretches together to keep files few.
            # A stretch is bounded, so no partition ends up whole in one task.
            stretch = F.expr(f"_index div {int(rows_per_piece)}")
            self._write(placed.repartition(*PARTITION_KEYS, stretch), append_id, total)

    @contextlib.contextmanager
    def _numbered(
        self, rows: DataFrame, order_by: Sequence[str], within: Sequence[str], into: str, rows_per_piece: int, keep: Sequence[str],
    ) -> Iterator[tuple[DataFrame, int]]:
        """The ``keep`` columns of rows with their numbers, and how many they are; what is stored for it goes when the append is done.

        Only ``keep``, the order and the message are shuffled, and only ``keep`` is stored.
        """
        total = _checked_total(rows)
        path = new_dir(rows.sparkSession, "numbered")
        tie = _tie(rows, order_by)
        needed = {*keep, *order_by, "key"}
        try:
            store_in_order(rows.select(*[c for c in rows.columns if c in needed]), order_by, within, path, rows_per_piece, total, tie, keep)
            yield indexed(rows.select(*keep), within, into, path), total
        finally:
            remove(rows.sparkSession, [path])

    def _with_partition_count(self, rows: DataFrame) -> DataFrame:
        """Rows with the number of partitions of their topic, NULL for topics that were not created."""
        heads = self.within(rows.sparkSession).heads()
        counts = broadcast_if_small(heads.groupBy("topic").agg(F.count("*").alias("_partitions")))
        if "timestamp" not in rows.columns:
            rows = rows.withColumn("timestamp", F.current_timestamp())
        return rows.join(counts, "topic", "left")

    def _write(self, numbered: DataFrame, append_id: str, total: int) -> None:
        log = self.within(numbered.sparkSession)
        marks, manifest = log._marks, log._manifest
        merged = log._merged_state()
        if merged is not None and append_id in merged.replaced:
            raise AppendError(f"append {append_id!r} was merged with others and cannot be repeated")
        step = marks.last()
        ends = pinned(log._ends(append_id, step))
        if step is None:
            manifest.keep_all(log.footer_extents().where(F.col("append") != append_id))
        elif not step.done and step.append != append_id and exists(log.spark, lost := os.path.join(log.path, f"append={step.append}")):
            # What an append left behind that never finished counts for readers of the whole log, so it does for all.
            if not log.spark.read.schema(schemas.LOG).parquet(lost).isEmpty():
                manifest.keep(log.footer_extents(step.append), step.append)
        published = ends.select(*PARTITION_KEYS, F.col("_end").alias("next_offset"), F.col("_end").alias("before"))
        step = marks.publish(published, append_id, done=False, last=step)
        placed = (
            numbered.join(broadcast_if_small(ends), PARTITION_KEYS)
            .select((F.col("_end") + F.col("_index")).alias("offset"), "key", "value", "timestamp", *PARTITION_KEYS)
            # Without this the writer sorts by its directories only and offsets lose their order.
            .sortWithinPartitions(*PARTITION_KEYS, "offset")
        )
        # A task sorts one stored part: several together would grow with the append until they spill.
        with small_scans(numbered.sparkSession, files_apart=True):
            (placed.write.mode("overwrite").option("compression", "zstd").partitionBy(*PARTITION_KEYS)
             .parquet(os.path.join(self.path, f"append={append_id}")))
        extents = pinned(log.footer_extents(append_id)) if total else None
        stored = extents.agg(F.sum("messages")).first()[0] if extents is not None else 0
        if stored != total:
            raise AppendError(f"append {append_id!r} was given {total} messages and stored {stored}")
        if extents is not None:
            manifest.keep(extents, append_id)
            after = F.col("_end") + F.coalesce("messages", F.lit(0))
            published = ends.join(extents, PARTITION_KEYS, "left").select(*PARTITION_KEYS, after.alias("next_offset"), F.col("_end").alias("before"))
        marks.publish(published, append_id, done=True, last=step)

    # -- merging appends -------------------------------------------------------------------------

    def compact(self, rows_per_file: int = ROWS_PER_PIECE) -> list[str]:
        """Merge all appends into a generation of larger files; returns the appends that it stands for.

        Messages, offsets and marks stay as they are. The generation is written and counted, and then the manifest is switched: readers that
        began before read the appends, later ones the generation. The appends' files stay until :meth:`vacuum`. Not while an append
        is under way.
        """
        step = self._marks.last()
        if step is None or not step.done:
            raise AppendError("there is no finished append" if step is None else f"append {step.append!r} was begun and not finished")
        extents = pinned(self._manifest.extents().where(F.col("append").isNotNull()))
        appends = sorted(r.append for r in extents.select("append").distinct().collect())
        if len(appends) < 2:
            return []
        total = extents.agg(F.sum("messages")).first()[0]
        generation = step.seq
        order = [*PARTITION_KEYS, "offset"]
        path = os.path.join(self._merged_path, f"generation={generation}")
        (
            self.spark.read.schema(schemas.LOG).option("basePath", self.path)
            .parquet(*[os.path.join(self.path, f"append={a}") for a in appends]).drop("append")
            .repartitionByRange(max(1, -(-total // rows_per_file)), *order).sortWithinPartitions(*order)
            .write.mode("overwrite").option("compression", "zstd").partitionBy(*PARTITION_KEYS).parquet(path))
        written = pinned(self._generation_extents().where(F.col("generation") == generation))
        stored = written.agg(F.sum("messages")).first()[0]
        if stored != total:
            raise AppendError(f"appends of {total} messages were merged into {stored}")
        self._manifest.replace(appends, generation, written)
        return appends

    def vacuum(self) -> list[str]:
        """Remove the files of appends that a generation stands for; returns these appends.

        Readers and streams that began before :meth:`compact` need them: call it when those are done. A stream started afterwards begins with
        the appends that are left; read what was merged with :meth:`after` first.
        """
        state = self._merged_state()
        if state is None or not state.replaced:
            return []
        gone = list(state.replaced)
        remove(self.spark, [os.path.join(self.path, f"append={a}") for a in gone])
        self._manifest.forget(gone)
        return gone
