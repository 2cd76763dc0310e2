"""Where shared files go, and how a small side earns a broadcast."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a side may have, counted, before it is broadcast (a few tens of MB of offset rows).
BROADCAST_ROWS = 200_000
# Most bytes of a file that one task reads where it holds its rows for a shuffle or a sort.
SPLIT_BYTES = 16 << 20
_SPLIT, _OPENING = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="topiclog-")
        spark.conf.set("spark.checkpoint.dir", path)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


def new_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call gets."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def pinned(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that using it twice does not compute it twice."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path in it): the one that Spark itself would use for ``path``."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(context._jsc.hadoopConfiguration()), found


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders; those that are not there are passed over."""
    for path in paths:
        fs, folder = file_system(spark, path)
        fs.delete(folder, True)


def make_dir(spark: SparkSession, path: str) -> None:
    """Make a folder, and those above it, where there is none."""
    fs, folder = file_system(spark, path)
    fs.mkdirs(folder)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there."""
    fs, found = file_system(spark, path)
    return fs.exists(found)


def _bytes(text: str) -> int:
    """A size as Spark's settings give it, such as 16m or 134217728b."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@contextlib.contextmanager
def small_scans(spark: SparkSession, files_apart: bool = False) -> Iterator[None]:
    """Jobs that run meanwhile scan files in splits of at most ``SPLIT_BYTES``; with ``files_apart`` no two files share a task.

    A task that sorts, or buffers for a shuffle, what it scans then holds the same however large the input is.
    """
    kept = {name: spark.conf.get(name) for name in (_SPLIT, _OPENING)}
    split = min(SPLIT_BYTES, _bytes(kept[_SPLIT]))
    spark.conf.set(_SPLIT, str(split))
    if files_apart:
        # Opening a file counts as much as a full split.
        spark.conf.set(_OPENING, str(split))
    try:
        yield
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only after counting it; larger sides take a shuffled join.

    ``df`` should be a stored table or :func:`pinned`: it is read once for the count and once for the join.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
