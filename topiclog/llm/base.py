"""What the operators share: stored intermediate tables, output columns, and objects kept per worker process."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclog.session import new_dir

# What separates words, and the words between: the same six ASCII characters everywhere.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACES = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back; later readers take only their columns."""
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, of which Python workers get Arrow batches of at most 8 MB of text or vectors.

    Batches are cut by rows and by bytes; Spark's own limit of 64 MB, held twice by each of an executor's tasks, is a lot next to
    the memory that a core has. A session that sets another limit keeps it.
    """
    name, default = "spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20)
    conf = df.sparkSession.conf
    if conf.get(name).rstrip("b") == default:
        conf.set(name, "8m")
    return df


def others(df: DataFrame, taken: Iterable[str]) -> list[Column]:
    """The columns of ``df`` that do not clash with names an operator returns."""
    names = {name.lower() for name in taken}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until ``df`` has no such column, in either case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc32_of_id(column: str) -> Column:
    """crc32 of the id written as text; 0 without an id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(0).cast("long"))


def per_process(name: str, make: Callable, version: str | None = None):
    """An object that a worker process builds once; of several versions, as models of several calls, it keeps the last one used.

    Functions are shipped by value and come anew with each task, so their globals cannot hold it.
    """
    store = sys.modules.setdefault("topiclog_llm_worker", types.ModuleType("topiclog_llm_worker"))
    if name not in vars(store) or getattr(store, name)[0] != version:
        # The version before goes before the next one is built.
        vars(store).pop(name, None)
        setattr(store, name, (version, make()))
    return getattr(store, name)[1]
