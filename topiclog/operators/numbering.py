"""Dense 0, 1, 2, … numbering that does not put a hot group into one task: a parallel prefix sum.

A plain ``row_number()`` window sends every row of a group to one task, and one topic-partition may hold a third of a log. So the rows are
dealt by ranges of (group, order) to parts of about ``rows_per_piece`` rows, sorted in each and stored once with their place in the part.
A row's number in its group is then its place, less the first place of the group in the part, plus the rows of the group in earlier parts.
The last two come from one row per group and part, which is counted from the stored places. A hot group is cut like any other, no group or
part is looked at on the driver, and because the parts are stored, a task that is run again finds the same numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topiclog.session import broadcast_if_small, new_dir, pinned, small_scans

ROWS_PER_PIECE = 250_000
_LEAST_ROWS = 10_000
# ``monotonically_increasing_id`` has the task in the upper bits and the row within it in the lower 33.
_ROW_BITS = 33


def dense_index(
    rows: DataFrame,
    order_by: Sequence[str],
    within: Sequence[str] = (),
    into: str = "index",
    rows_per_piece: int = ROWS_PER_PIECE,
    total: int | None = None,
) -> DataFrame:
    """Add ``into``: the 0-based place of each row of a ``within`` group in ascending ``order_by`` order.

    ``within`` columns must not be NULL. Ties in ``order_by`` are numbered in any order. ``total`` is the number of rows, for a caller
    that has counted them. The rows are shuffled and stored once, in a new folder of the shared one.
    """
    path = new_dir(rows.sparkSession, "numbered")
    store_in_order(rows, order_by, within, path, rows_per_piece, total)
    return indexed(rows, within, into, path)


def pieces(rows: DataFrame, rows_per_piece: int = ROWS_PER_PIECE, total: int | None = None) -> int:
    """How many parts of about ``rows_per_piece`` rows ``rows`` make."""
    total = rows.count() if total is None else total
    # Few rows are shared among the cores that are there, too, as long as a part is worth a task.
    spread = min(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(total / _LEAST_ROWS))
    return max(1, spread, math.ceil(total / rows_per_piece))


def store_in_order(
    rows: DataFrame, order_by: Sequence[str], within: Sequence[str], path: str, rows_per_piece: int = ROWS_PER_PIECE, total: int | None = None,
    tie: Column | None = None, keep: Sequence[str] | None = None,
) -> None:
    """Write ``rows`` to ``path`` in parts that follow each other in the order of ``within`` and ``order_by``, with their places.

    ``tie`` orders rows that agree in these; it is not shuffled but made again behind the shuffle. ``keep`` names the columns to store,
    all by default: those that only give the order need not be.
    """
    keys = [*within, *order_by]
    parts = rows.repartitionByRange(pieces(rows, rows_per_piece, total), *keys, *([] if tie is None else [tie]))
    if tie is not None:
        parts = parts.withColumn("_tie", tie)
    with small_scans(rows.sparkSession):
        (
            parts.sortWithinPartitions(*keys, *([] if tie is None else ["_tie"]))
            # Numbers the sorted rows of a task as they are written.
            .withColumn("_place", F.monotonically_increasing_id())
            .select(*(rows.columns if keep is None else keep), "_place")
            .write.mode("overwrite").option("compression", "zstd").parquet(path)
        )


def part_of(place: str) -> Column:
    """The number of the part that a stored place is in."""
    return F.shiftright(place, _ROW_BITS)


def indexed(rows: DataFrame, within: Sequence[str], into: str, path: str) -> DataFrame:
    """The rows that :func:`store_in_order` wrote to ``path``, with their numbers; ``rows`` tells their columns."""
    within = list(within)
    spark = rows.sparkSession
    stored = (
        spark.read.schema(rows.withColumn("_place", F.lit(0).cast("bigint")).schema).parquet(path)
        .withColumn("_part", part_of("_place")))
    # One row per group and part: at most as many as parts and groups together.
    counts = stored.groupBy(*within, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pinned(counts.select(*within, "_part", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")))
    return stored.join(broadcast_if_small(starts), [*within, "_part"]).withColumn(into, F.col("_place") + F.col("_shift")).select(*rows.columns, into)
