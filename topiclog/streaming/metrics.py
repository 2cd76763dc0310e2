"""Reporting client metrics of running queries to a pluggable reporter."""

from __future__ import annotations

import contextlib
import datetime
import threading
from abc import ABC, abstractmethod
from collections.abc import Iterable, Iterator, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from topiclog import schemas
from topiclog.functions.measures import FAILURE_COUNTERS, SEND_FAILURES, TIMERS

class Reporter(ABC):
    """Where metrics go; handles are whatever the reporter likes."""

    @abstractmethod
    def counter(self, name: str, dimensions: Mapping[str, str]) -> Any:
        """Handle for a counter."""

    @abstractmethod
    def timer(self, name: str, dimensions: Mapping[str, str]) -> Any:
        """Handle for a timer."""

    @abstractmethod
    def record(self, handle: Any, value: float, timestamp: datetime.datetime | None = None) -> None:
        """Record one value."""


class TableReporter(Reporter):
    """Collects samples and appends them to a Parquet table of metric samples on :meth:`flush`.

    Samples come a few per micro-batch and are flushed by the caller, so the list stays short.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._path = path
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def counter(self, name, dimensions):
        return name, "counter", dict(dimensions)

    def timer(self, name, dimensions):
        return name, "timer", dict(dimensions)

    def record(self, handle, value, timestamp=None):
        name, kind, dimensions = handle
        row = (name, kind, float(value), dimensions, timestamp or datetime.datetime.now())
        with self._lock:
            self._rows.append(row)

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            frame = self._spark.createDataFrame(rows, schemas.METRIC_SAMPLES)
            frame.coalesce(1).write.mode("append").parquet(self._path)


class ClientMetrics:
    """Turns raw samples into reports: timers in milliseconds, counters by one, unknown names dropped."""

    def __init__(self, reporter: Reporter, prefix: str, dimensions: Mapping[str, str]):
        if not isinstance(reporter, Reporter):
            raise TypeError("reporter must be a Reporter")
        self._reporter = reporter
        self._prefix, self._dimensions = prefix, dimensions
        self._phases: dict[str, Any] = {}
        self._counts: dict[str, Any] = {}
        self._timers = {n: reporter.timer(f"{prefix}.{n}", dimensions) for n in TIMERS}
        self._counters = {n: reporter.counter(f"{prefix}.{n}", dimensions) for n in [*FAILURE_COUNTERS, SEND_FAILURES]}

    def sample(self, name: str, value: float) -> bool:
        """Report one raw sample; False if the name is unknown."""
        if name in self._timers:
            self._reporter.record(self._timers[name], value * 1000)
        elif name in self._counters:
            self._reporter.record(self._counters[name], 1)
        else:
            return False
        return True

    def count(self, name: str, value: float) -> None:
        """Report how many there were of something, under its own name."""
        if name not in self._counts:
            self._counts[name] = self._reporter.counter(f"{self._prefix}.{name}", self._dimensions)
        self._reporter.record(self._counts[name], value)

    def phase(self, name: str, milliseconds: float) -> None:
        """Report how long a phase of a micro-batch took, under Spark's own name for it."""
        if name not in self._phases:
            self._phases[name] = self._reporter.timer(f"{self._prefix}.micro_batch.{name}", self._dimensions)
        self._reporter.record(self._phases[name], milliseconds)

    @contextlib.contextmanager
    def sending(self) -> Iterator[None]:
        """Count an append that fails inside, and raise its error again."""
        try:
            yield
        except Exception:
            self.sample(SEND_FAILURES, 1)
            raise


class MetricsListener(StreamingQueryListener):
    """Reports the phases of micro-batches as timers, observed counts as counters, and appending queries that failed as failed sends.

    Register it with ``spark.streams.addListener``; it only reports queries whose name is in ``queries`` or ``senders``, and counts as sends
    only those in ``senders``. Counts come with the run itself (:func:`observed`), no second job makes them.
    """

    def __init__(self, metrics: ClientMetrics, queries: set[str] = frozenset(), senders: set[str] = frozenset()):
        self._metrics = metrics
        self._names, self._senders = set(queries) | set(senders), set(senders)
        self._ids: set[str] = set()
        self._sending: set[str] = set()

    def onQueryStarted(self, event):
        if event.name in self._names:
            self._ids.add(str(event.id))
        if event.name in self._senders:
            self._sending.add(str(event.id))

    def onQueryProgress(self, event):
        if str(event.progress.id) in self._ids:
            for phase, milliseconds in event.progress.durationMs.items():
                self._metrics.phase(phase, milliseconds)
            for row in event.progress.observedMetrics.values():
                for name, count in row.asDict().items():
                    self._metrics.count(name, count)

    def onQueryTerminated(self, event):
        if str(event.id) in self._sending and event.exception is not None:
            self._metrics.sample(SEND_FAILURES, 1)

    def onQueryIdle(self, event):
        pass


def observed(messages: DataFrame, name: str, partitions: Iterable[tuple[str, int]] = ()) -> DataFrame:
    """``messages``, of which a query reports how many passed in each micro-batch: in all as ``messages``, and of each of the given (topic,
    partition) as ``messages.<topic>-<partition>``. The counts are made in the tasks that process the messages, each time they do: a
    ``foreachBatch`` function that reads its batch twice, without persisting it, counts twice."""
    counts = [
        F.count_if((F.col("topic") == topic) & (F.col("partition") == partition)).alias(f"messages.{topic}-{partition}")
        for topic, partition in partitions]
    return messages.observe(name, F.count(F.lit(1)).alias("messages"), *counts)
