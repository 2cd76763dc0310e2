"""A small record in a shared folder that is replaced as a whole: which files of a table count now.

Files that a record names are written before it and never changed, so a reader sees the state before a change or the state after it. A
record is one line of JSON, written beside the others and then renamed, in whatever file system Spark uses; no job is needed to
read or write it. One writer per pointer is assumed.
"""

from __future__ import annotations

import json
import os
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from topiclog.session import file_system

# Records kept: a reader may have listed one that is no longer the last.
_KEPT = 4
# A reader whose records were removed since it listed them looks again.
_TRIES = 5


def read_or_none(spark: SparkSession, schema: str, *paths: str, deep: bool = False) -> DataFrame | None:
    """The table at ``paths``; None if one of them is not there. ``deep``: of all files below, folder names being no columns."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", str(deep).lower()).parquet(*paths)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _as_row(value: Any) -> Any:
    if isinstance(value, dict):
        return Row(**{name: _as_row(v) for name, v in value.items()})
    return [_as_row(v) for v in value] if isinstance(value, list) else value


class Pointer:
    """The record below ``path``: files ``turn-<n>.json``, of which the one with the highest number counts."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self.path = path

    def _file(self, turn: int) -> str:
        return os.path.join(self.path, f"turn-{turn:012d}.json")

    def read(self) -> Row | None:
        """The last record, with its ``turn``; None before the first."""
        for attempt in range(_TRIES):
            fs, folder = file_system(self._spark, self.path)
            if not fs.exists(folder):
                return None
            files = [status.getPath() for status in fs.listStatus(folder)]
            last = max((f for f in files if f.getName().startswith("turn-")), key=lambda f: f.getName(), default=None)
            if last is None:
                return None
            try:
                stream = fs.open(last)
                try:
                    return _as_row(json.loads(bytes(stream.readAllBytes())))
                finally:
                    stream.close()
            except Py4JJavaError:
                if attempt + 1 == _TRIES:
                    raise
        return None

    def write(self, last: Row | None, **values: Any) -> None:
        """Replace ``last``, as it was read, by ``values``."""
        self.write_turn(1 if last is None else last.turn + 1, **values)

    def write_turn(self, turn: int, **values: Any) -> None:
        """Store ``values`` under a ``turn`` one higher than the last."""
        fs, new = file_system(self._spark, os.path.join(self.path, f".turn-{turn}"))
        stream = fs.create(new, True)
        stream.write(bytearray(json.dumps({**values, "turn": turn}).encode() + b"\n"))
        stream.close()
        _, place = file_system(self._spark, self._file(turn))
        # What a writer left behind that stopped before its caller knew.
        fs.delete(place, False)
        if not fs.rename(new, place):
            raise OSError(f"cannot write {place.toString()}")
        fs.delete(file_system(self._spark, self._file(turn - _KEPT))[1], False)
