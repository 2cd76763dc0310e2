"""The commit ledger: the last write of a group, storage and partition is its committed offset.

Commits of a group are kept as a log-structured merge: a snapshot holds the last writes up to some commit, and a few commits lie behind it. A
pointer names the snapshot and the commits that count. Every ``FOLD`` commits the two are merged into the next snapshot and the
pointer is switched, so what is read by a commit, a position or a lag does not grow with the number of commits. Files that a
switch left behind stay for one more such turn, for readers that began before it.

``entry=<id>/`` holds commit rows that were loaded as they are, for any groups; a group's next snapshot takes its rows in.
"""

from __future__ import annotations

import json
import os
import urllib.parse

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from topiclog import schemas
from topiclog.functions.positions import write_storages
from topiclog.operators import offsets
from topiclog.session import exists, make_dir, remove
from topiclog.sources.log import footer_scan
from topiclog.sources.pointer import Pointer, read_or_none

_COLUMNS = [f.name for f in schemas.COMMITS if f.name != "entry"]
# A part, that is a commit or a snapshot; its rows carry its number.
_STORED = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.COMMITS if f.name != "entry") + ", part bigint"
# The record of a group: the snapshot, 0 for none, and the highest sequence number below which all is in it; the commits behind it.
_GROUP = (
    "group_id string, snapshot bigint, top bigint, pending array<struct<entry: string, seq: bigint, part: bigint>>, "
    "retired array<struct<part: bigint, at: bigint>>, loads array<bigint>, turn bigint")
# Commits behind a snapshot before they are merged into the next one.
FOLD = 16


class CommitLedger:
    """A ledger directory; one writer per group is assumed, and one at a time for loads."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    @classmethod
    def create(cls, spark: SparkSession, path: str) -> CommitLedger:
        ledger = cls(spark, path)
        ledger._loads_pointer.write(None, top=0, loads=[])
        return ledger

    def within(self, spark: SparkSession) -> CommitLedger:
        """The same ledger seen from another session."""
        return CommitLedger(spark, self.path)

    # -- where things are ------------------------------------------------------------------------

    @property
    def _loads_pointer(self) -> Pointer:
        return Pointer(self.spark, os.path.join(self.path, "_loads"))

    def _folder(self, group_id: str) -> str:
        return os.path.join(self.path, "_groups", "g" + urllib.parse.quote(group_id, safe="").replace(".", "%2E"))

    def _pointer(self, group_id: str) -> Pointer:
        return Pointer(self.spark, os.path.join(self._folder(group_id), "pointer"))

    def _part(self, group_id: str, part: int) -> str:
        return os.path.join(self._folder(group_id), "parts", f"part={part}")

    def _loads(self) -> Row:
        """The loads that count. A ledger without a pointer, empty or of an older layout, gets one from its file footers."""
        found = self._loads_pointer.read()
        if found is None:
            loads = []
            top = 0
            if read_or_none(self.spark, "commit_seq bigint", self.path) is not None:
                tops = footer_scan(self.spark, schemas.COMMITS, self.path).groupBy("entry").agg(F.max("commit_seq").alias("top")).collect()
                loads = [{"entry": r.entry, "number": i} for i, r in enumerate(sorted(tops, key=lambda r: r.entry))]
                top = max((r.top or 0 for r in tops), default=0)
            self._loads_pointer.write(None, top=top, loads=loads)
            found = self._loads_pointer.read()
        return found

    # -- reading ---------------------------------------------------------------------------------

    def commits(self, group_id: str | None = None) -> DataFrame:
        """Commits that count, of one group or of all: last writes up to some commit, and every one behind it.

        Of one group, a few files are read however many commits it has made: its pointer names them. Of all groups, the files of
        every group are read and joined with the pointers.
        """
        return self._commits_of_all() if group_id is None else self._commits_of(group_id, self._pointer(group_id).read(), self._loads())

    def _commits_of(self, group_id: str, state: Row | None, loads: Row) -> DataFrame:
        paths = [os.path.join(self.path, f"entry={e.entry}") for e in loads.loads if state is None or e.number not in state.loads]
        if state is not None:
            paths += [self._part(group_id, part) for part in _counting(state)]
        if not paths:
            return self._none()
        return self.spark.read.schema(_STORED).option("recursiveFileLookup", "true").parquet(*paths).where(F.col("group_id") == group_id).select(*_COLUMNS)

    def _none(self) -> DataFrame:
        return self.spark.createDataFrame([], schemas.COMMITS).select(*_COLUMNS)

    def _commits_of_all(self) -> DataFrame:
        loaded = self._none()
        loads = self._loads()
        if names := [e.entry for e in loads.loads]:
            # Entries that the pointer does not name were begun and not finished.
            loaded = self.spark.read.schema(schemas.COMMITS).parquet(self.path).where(F.col("entry").isin(names))
        folder = os.path.join(self.path, "_groups", "*")
        if not exists(self.spark, os.path.join(self.path, "_groups")):
            return loaded.select(*_COLUMNS)
        pointers = self.spark.read.schema(_GROUP).option("recursiveFileLookup", "true").json(os.path.join(folder, "pointer"))
        states = pointers.groupBy("group_id").agg(F.max_by(F.struct("snapshot", "pending", "loads"), "turn").alias("state"))
        counting = states.select("group_id", F.explode(F.array_append(F.col("state.pending.part"), F.col("state.snapshot"))).alias("part"))
        parts = read_or_none(self.spark, _STORED, os.path.join(folder, "parts"), deep=True)
        if names:
            numbers = F.from_json(F.lit(json.dumps({e.entry: e.number for e in loads.loads})), "map<string, bigint>")
            folded = states.select("group_id", F.explode("state.loads").alias("_number"))
            loaded = loaded.withColumn("_number", F.element_at(numbers, F.col("entry"))).join(folded, ["group_id", "_number"], "left_anti")
        found = loaded.select(*_COLUMNS)
        return found if parts is None else found.unionByName(parts.join(counting, ["group_id", "part"], "left_semi").select(*_COLUMNS))

    def stream(self, group_id: str) -> DataFrame:
        """The group's commits as a stream, those that are there first; loaded ones are those of loads made before it starts.

        A merged commit may come again with its snapshot, and one that was begun and never named may come too: of a key the
        row with the highest ``commit_seq``, and of these the last ``committed_at``, counts.
        """
        parts = os.path.join(self._folder(group_id), "parts")
        make_dir(self.spark, parts)
        options = {"recursiveFileLookup": "true", "ignoreMissingFiles": "true"}
        found = self.spark.readStream.schema(_STORED).options(**options).parquet(parts).select(*_COLUMNS)
        loads = [os.path.join(self.path, f"entry={e.entry}") for e in self._loads().loads]
        for path in loads:
            found = found.unionByName(self.spark.readStream.schema(_STORED).options(**options).parquet(path).where(F.col("group_id") == group_id).select(*_COLUMNS))
        return found

    # -- writing ---------------------------------------------------------------------------------

    def load(self, rows: DataFrame, entry: str) -> None:
        """Store complete commit rows of any groups as one entry; the same entry again replaces it."""
        loads = self._loads()
        path = os.path.join(self.path, f"entry={entry}")
        self._filled(rows).write.mode("overwrite").parquet(path)
        top = footer_scan(self.spark, _STORED, path).agg(F.max("commit_seq")).first()[0]
        number = max((e.number for e in loads.loads), default=-1) + 1
        kept = [e.asDict() for e in loads.loads if e.entry != entry]
        self._loads_pointer.write(loads, top=max(loads.top, top or 0), loads=[*kept, {"entry": entry, "number": number}])

    @staticmethod
    def _filled(rows: DataFrame) -> DataFrame:
        present = set(rows.columns)
        return rows.select(*[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.COMMITS if f.name != "entry"
        ])

    def next_seq(self, group_id: str, without_entry: str | None = None) -> int:
        """One more than any sequence number of the group or of a load, one entry behind the snapshot left out."""
        return _next_seq(self._loads(), self._pointer(group_id).read(), without_entry)

    def commit(self, group_id: str, positions: DataFrame, storage: str | None = None, entry: str | None = None) -> DataFrame:
        """Commit ``topic, partition, offset`` rows of one group to one or both storages.

        ``positions`` holds one row per partition. An ``entry`` repeated (a micro-batch run again) replaces the earlier one while that
        lies behind the snapshot; after that it is a commit of its own. Returns the rows as stored.
        """
        storages = write_storages(storage)
        ledger = self.within(positions.sparkSession)
        pointer = ledger._pointer(group_id)
        state = pointer.read()
        seq = _next_seq(ledger._loads(), state, entry)
        # A commit is small, however many tasks it comes from.
        part = ledger._write(group_id, state, commit_rows(group_id, positions, storages, seq).hint("rebalance"))
        entry = entry or f"manual-{seq:012d}"
        pending = [] if state is None else state.pending
        replaced = [{"part": e.part, "at": part} for e in pending if e.entry == entry]
        pending = [*(e.asDict() for e in pending if e.entry != entry), {"entry": entry, "seq": seq, "part": part}]
        if state is None:
            pointer.write(None, group_id=group_id, snapshot=0, top=0, pending=pending, retired=[], loads=[])
        else:
            retired = [*(r.asDict() for r in state.retired), *replaced]
            pointer.write(state, group_id=group_id, snapshot=state.snapshot, top=state.top, pending=pending, retired=retired, loads=state.loads)
        if len(pending) >= FOLD:
            ledger.fold(group_id)
        return ledger.spark.read.schema(_STORED).parquet(ledger._part(group_id, part)).select(*_COLUMNS)

    def fold(self, group_id: str) -> None:
        """Merge a group's commits, loaded ones included, into its next snapshot. :meth:`commit` does so by itself now and then.

        The new snapshot is written, then the pointer is switched, then the parts are removed that counted until the switch before this one.
        """
        pointer, loads = self._pointer(group_id), self._loads()
        state = pointer.read()
        last = (
            self._commits_of(group_id, state, loads).groupBy(offsets.stored_storage().alias("_storage"), "topic", "partition")
            .agg(F.max_by(F.struct(*_COLUMNS), "commit_seq").alias("last")).select("last.*"))
        part = self._write(group_id, state, last)
        before, retired = (0, []) if state is None else (state.snapshot, state.retired)
        kept = [r.asDict() for r in retired if r.at > before] + [{"part": p, "at": part} for p in _counting(state)]
        pointer.write(
            state, group_id=group_id, snapshot=part, top=_next_seq(loads, state) - 1, pending=[], retired=kept, loads=[e.number for e in loads.loads])
        remove(self.spark, [self._part(group_id, r.part) for r in retired if r.at <= before])

    def _write(self, group_id: str, state: Row | None, rows: DataFrame) -> int:
        """The number of the part that now holds the rows; one that was begun and never named is replaced."""
        part = 1 if state is None else state.turn + 1
        self._filled(rows).withColumn("part", F.lit(part).cast("bigint")).write.mode("overwrite").parquet(self._part(group_id, part))
        return part

    def commit_processed(self, group_id: str, messages: DataFrame, partitions: DataFrame | None = None,
                         storage: str | None = None, entry: str | None = None) -> DataFrame:
        """Commit behind the last of the processed messages, of all partitions or of the given ones."""
        return self.commit(group_id, offsets.processed(_chosen(messages, partitions)), storage, entry)

    def commit_message(self, group_id: str, messages: DataFrame, partitions: DataFrame | None = None,
                       storage: str | None = None, entry: str | None = None) -> DataFrame:
        """Commit a message itself (of several, the last of each partition): a restart reads it again."""
        return self.commit(group_id, offsets.up_to_message(_chosen(messages, partitions)), storage, entry)

    def advance(self, group_id: str, partitions: DataFrame, marks: DataFrame, storage: str | None = None,
                entry: str | None = None) -> DataFrame:
        """Commit the end of each partition; returns ``topic, partition, error`` of those that could not be."""
        return self._to_mark(group_id, partitions, marks, "highmark", storage, entry)

    def rewind(self, group_id: str, partitions: DataFrame, marks: DataFrame, storage: str | None = None,
               entry: str | None = None) -> DataFrame:
        """Commit the start of each partition; returns ``topic, partition, error`` of those that could not be."""
        return self._to_mark(group_id, partitions, marks, "lowmark", storage, entry)

    def _to_mark(self, group_id, partitions, marks, mark, storage, entry) -> DataFrame:
        at_mark = offsets.advanced if mark == "highmark" else offsets.rewound
        self.commit(group_id, at_mark(partitions, marks), storage, entry)
        return offsets.uncommittable(partitions, marks, mark)


def _counting(state: Row | None) -> list[int]:
    """The parts that count."""
    return [] if state is None else [*([state.snapshot] if state.snapshot else []), *(e.part for e in state.pending)]


def _next_seq(loads: Row, state: Row | None, without_entry: str | None = None) -> int:
    behind = [] if state is None else [state.top, *(e.seq for e in state.pending if e.entry != without_entry)]
    return max([loads.top, *behind]) + 1


def _chosen(messages: DataFrame, partitions: DataFrame | None) -> DataFrame:
    return messages if partitions is None else messages.join(partitions.select("topic", "partition"), ["topic", "partition"], "left_semi")


def commit_rows(group_id: str, offsets: DataFrame, storages: list[str], seq: int) -> DataFrame:
    """One ledger row per partition and storage."""
    return offsets.select(
        F.lit(group_id).alias("group_id"), "topic", "partition", "offset",
        F.lit(None).cast("string").alias("metadata"),
        F.explode(F.array(*[F.lit(s) for s in storages])).alias("storage"),
        F.lit(seq).cast("bigint").alias("commit_seq"),
        F.current_timestamp().alias("committed_at"),
    )
