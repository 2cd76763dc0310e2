"""The manifest of a log: which directory holds which offsets of which partition.

An append adds its extents, a small file. Every ``FOLD`` appends these are merged with the base, a table in few files clustered by topic, partition
and offset, and the pointer is switched to the new base. A merge of appends into a generation goes the same way: the generation's extents take
the place of those of the appends in the next base, so readers see either all the appends or the generation. Files that a switch left
behind stay for one more such turn, for readers that began before it.
"""

from __future__ import annotations

import functools
import math
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from topiclog.session import exists, pinned, remove
from topiclog.sources.pointer import Pointer, read_or_none

_KEYS = ["topic", "partition"]
_EXTENTS = "topic string, partition int, first_offset bigint, last_offset bigint, messages bigint"
# A generation has no append, an append no generation.
_BASE = f"{_EXTENTS}, append string, generation bigint"
COLUMNS = ["append", "generation", *_KEYS, "first_offset", "last_offset", "messages"]
# Appends whose extents are read one by one before they are merged into the base.
FOLD = 32
_ROWS_PER_FILE = 1_000_000


class Manifest:
    """The manifest below the folder of a log."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._extents = os.path.join(path, "_extents")
        self._folder = os.path.join(path, "_manifest")

    @property
    def _pointer(self) -> Pointer:
        return Pointer(self._spark, os.path.join(self._folder, "pointer"))

    def _base(self, number: int) -> str:
        return os.path.join(self._folder, f"base={number}")

    def _of_append(self, append_id: str) -> str:
        return os.path.join(self._extents, f"append={append_id}")

    def state(self) -> Row | None:
        """What counts now; None before the first extents, or for a log of an older layout."""
        return self._pointer.read()

    def extents(self) -> DataFrame | None:
        """One row per append or generation and partition that has messages; None if nothing is kept."""
        return self._extents_of(self.state())

    def _extents_of(self, state: Row | None) -> DataFrame | None:
        small = read_or_none(self._spark, f"{_EXTENTS}, append string", self._extents)
        if small is not None:
            small = small.withColumn("generation", F.lit(None).cast("bigint")).select(*COLUMNS)
        if state is None:
            return small
        parts = [] if small is None else [small.where(F.col("append").isin(list(state.pending)))]
        if state.base:
            base = self._spark.read.schema(_BASE).parquet(self._base(state.base))
            # An append repeated since is in both.
            parts.append(base.where(F.col("generation").isNotNull() | ~F.col("append").isin(list(state.pending))).select(*COLUMNS))
        return functools.reduce(DataFrame.unionByName, parts) if parts else None

    def keep(self, extents: DataFrame, append_id: str) -> None:
        """What one append put where; the same append again replaces it."""
        state = self.state()
        if state is None:
            state = self._taken_over()
        (extents.select(*_KEYS, "first_offset", "last_offset", "messages").coalesce(1)
         .write.mode("overwrite").parquet(self._of_append(append_id)))
        pending = [*([] if state is None else [a for a in state.pending if a != append_id]), append_id]
        self._write(state, pending=pending)
        if len(pending) >= FOLD:
            self.fold()

    def _taken_over(self) -> Row | None:
        """The first pointer of a log whose extents were kept without one."""
        kept = self._extents_of(None)
        if kept is None:
            return None
        self._write(None, pending=[r.append for r in kept.select("append").distinct().collect()])
        return self.state()

    def keep_all(self, extents: DataFrame) -> None:
        """The extents of appends that were made before any were kept."""
        if exists(self._spark, self._extents):
            return
        extents.select(*_KEYS, "first_offset", "last_offset", "messages", "append").write.mode("overwrite").partitionBy("append").parquet(self._extents)

    def fold(self) -> None:
        """Merge the extents of single appends into the base."""
        state = self.state() or self._taken_over()
        if state is not None:
            self._switch(state, self._extents_of(state), list(state.generations), list(state.replaced))

    def replace(self, appends: Sequence[str], generation: int, extents: DataFrame) -> None:
        """Let a generation with its ``extents`` (topic, partition, first_offset, last_offset, messages) stand for ``appends`` from now on."""
        state = self.state() or self._taken_over()
        kept = self._extents_of(state).where(F.col("append").isNull() | ~F.col("append").isin(list(appends)))
        new = extents.withColumn("append", F.lit(None).cast("string")).withColumn("generation", F.lit(generation).cast("bigint")).select(*COLUMNS)
        self._switch(state, kept.unionByName(new), [*state.generations, generation], [*state.replaced, *appends])

    def forget(self, appends: Sequence[str]) -> None:
        """Stop listing appends that were replaced and whose files are gone."""
        state = self.state()
        self._write(state, replaced=[a for a in state.replaced if a not in set(appends)])

    def _switch(self, state: Row, extents: DataFrame, generations: list[int], replaced: list[str]) -> None:
        number = state.turn + 1
        clustered = pinned(extents.select(*COLUMNS))
        files = max(1, math.ceil(clustered.count() / _ROWS_PER_FILE))
        order = [*_KEYS, "first_offset"]
        clustered.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(self._base(number))
        old = [r for r in state.retired if r.at <= state.base]
        left = [*([self._base(state.base)] if state.base else []), *map(self._of_append, state.pending)]
        kept = [r.asDict() for r in state.retired if r.at > state.base] + [{"path": p, "at": number} for p in left]
        self._write(state, base=number, pending=[], generations=generations, replaced=replaced, retired=kept)
        remove(self._spark, [r.path for r in old])

    def _write(self, state: Row | None, **changed) -> None:
        record = {"base": 0, "pending": [], "generations": [], "replaced": [], "retired": []}
        if state is not None:
            record = {name: [r.asDict() for r in state.retired] if name == "retired" else state[name] for name in record}
        self._pointer.write(state, **{**record, **changed})
