"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source and ranked; the rank r of n becomes the fraction (2r + 1) / 2n, and the
rows of all sources are put in order of that fraction. Any stretch of this order holds every source in the
proportion of the whole, so cutting it into equal parts gives shards that all match the mixture.

Both orders are numbered in slices: counts per slice come first, a running sum gives each slice its first number, and rows
are sorted only within a slice, so neither a large source nor the whole table is ever in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topiclog.llm.base import others, stored

# Rows a slice has on average, until there are MOST_SLICES.
SLICE_ROWS = 256
MOST_SLICES = 1 << 18


def _slices(rows: int) -> int:
    slices = 1
    while slices * SLICE_ROWS < rows and slices < MOST_SLICES:
        slices *= 2
    return slices


def _shard_of(place: Column, rows: int, shards: int) -> tuple[Column, Column]:
    """(shard, slot) of a place among ``rows``: the first rows % shards shards have one row more."""
    small, larger = divmod(rows, shards)
    edge = larger * (small + 1)
    early = place < edge
    shard = F.when(early, F.floor(place / (small + 1))).otherwise(larger + F.floor((place - edge) / max(1, small)))
    slot = F.when(early, place % (small + 1)).otherwise((place - edge) % max(1, small))
    return shard.cast("int"), slot.cast("long")


def sharded(rows: DataFrame, shards: int = 16, source_col: str = "source", key_cols: tuple[str, ...] = ("doc_id", "text"),
            seed: int = 0) -> DataFrame:
    """``rows`` with shard (0 to ``shards`` - 1) and slot (its place in the shard, gapless from 0).

    Shards differ by at most one row, and each holds its part of every source, to within a few rows. The shuffle is by a hash of
    ``key_cols`` and ``seed``, so reruns agree; rows alike in all of them follow each other. A null source is a source of its
    own; nulls in other columns are values like any. Columns named shard or slot are replaced. An empty
    table gives no rows.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    total = rows.count()
    slices = _slices(total)
    keys = [F.col(c).cast("string") for c in key_cols]
    source = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    base = rows.select(
        *others(rows, ("shard", "slot")), source.alias("__source"), F.xxhash64(F.lit(seed), *keys).alias("__number"),
        F.xxhash64(F.lit(seed + 1), *keys).alias("__tie"))
    base = base.withColumn("__slice", F.pmod(F.shiftrightunsigned("__number", 1), F.lit(slices)))
    in_source = Window.partitionBy("__source")
    first = stored(
        base.groupBy("__source", "__slice").agg(F.count(F.lit(1)).alias("__n"))
        .select("__source", "__slice", F.sum("__n").over(in_source).alias("__all"),
                (F.sum("__n").over(in_source.orderBy("__slice")) - F.col("__n")).alias("__before")), "ranks")
    rank = F.row_number().over(Window.partitionBy("__source", "__slice").orderBy("__number", "__tie")) - 1
    ranked = base.withColumn("__rank", rank).join(first, ["__source", "__slice"])
    ranked = ranked.withColumn("__part", (2 * (F.col("__before") + F.col("__rank")) + 1) / (2 * F.col("__all")))
    ranked = ranked.withColumn("__stretch", F.least(F.floor(F.col("__part") * slices), F.lit(slices - 1)))
    counted = ranked.groupBy("__stretch").agg(F.count(F.lit(1)).alias("__n"))
    # At most MOST_SLICES rows: summed in one task and broadcast.
    start = stored(counted.select("__stretch", (F.sum("__n").over(Window.orderBy("__stretch")) - F.col("__n")).alias("__start")), "starts")
    nth = F.row_number().over(Window.partitionBy("__stretch").orderBy("__part", "__source")) - 1
    placed = ranked.withColumn("__nth", nth).join(F.broadcast(start), "__stretch").withColumn("__place", F.col("__start") + F.col("__nth"))
    shard, slot = _shard_of(F.col("__place"), total, shards)
    return placed.select(*others(rows, ("shard", "slot")), shard.alias("shard"), slot.alias("slot"))


def write_shards(placed: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write the result of :func:`sharded` as Parquet, a folder for each shard, files in order of the slots."""
    part = F.floor(F.col("slot") / rows_per_file)
    (placed.withColumn("__part", part).repartition("shard", "__part").sortWithinPartitions("shard", "slot")
     .drop("__part").write.partitionBy("shard").parquet(path))
