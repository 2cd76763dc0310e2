"""The head table of a log: where each partition ends.

An append publishes that it begins, writes its messages, and then publishes that it is done. ``_marks/step=<n>`` holds the next
offset of every partition after such a step and is never written again, so a DataFrame of marks stays readable; ``_last`` names
the last step. So the ends of a log are read from a few small files however many appends it
has, and an append that was begun but never finished is noticed. Steps long past are removed.
"""

from __future__ import annotations

import os
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclog.session import remove
from topiclog.sources.pointer import Pointer

_KEYS = ["topic", "partition"]
_MARKS = "topic string, partition int, next_offset bigint, before bigint"
# Steps whose marks stay readable.
KEPT_STEPS = 64


class Step(NamedTuple):
    """The last published step."""

    seq: int
    append: str
    done: bool


# Stands for a step that the caller has not read.
UNREAD = Step(-1, "", False)


class Marks:
    """The head table below the folder of a log."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        # Names starting with an underscore are no data to Spark's file listing.
        self._marks = os.path.join(path, "_marks")
        self._pointer = Pointer(spark, os.path.join(path, "_last"))

    def last(self) -> Step | None:
        """None for a log without a head table: nothing was appended, or not by this version."""
        row = self._pointer.read()
        return None if row is None else Step(row.turn, row.append, row.done)

    def ends(self, step: Step) -> DataFrame:
        """``topic, partition, next_offset, before``: the ends after the step, and before its append."""
        return self._spark.read.schema(_MARKS).parquet(self._step(step.seq))

    def _step(self, seq: int) -> str:
        return os.path.join(self._marks, f"step={seq}")

    def publish(self, ends: DataFrame, append_id: str, done: bool, last: Step | None = UNREAD) -> Step:
        """The step after ``last``; ``ends`` has one row (topic, partition, next_offset, before) per partition."""
        last = self.last() if last is UNREAD else last
        step = Step(1 if last is None else last.seq + 1, append_id, done)
        ends.select(*_KEYS, "next_offset", "before").coalesce(1).write.mode("overwrite").parquet(self._step(step.seq))
        self._pointer.write_turn(step.seq, append=append_id, done=done)
        if step.seq > KEPT_STEPS:
            remove(self._spark, [self._step(step.seq - KEPT_STEPS)])
        return step
