"""A blocked Bloom filter as a table (block, word): each key sets a few bits of one 64-bit word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The filter never has more blocks than this (2^20 rows of 16 bytes), so a broadcast of it is bounded.
MAX_BLOCKS = 1 << 20
BITS_SET = 5


def _hash(key: Column, seed: int) -> Column:
    return F.xxhash64(key, F.lit(seed))


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(_hash(key, 11), F.lit(blocks))


def mask_of(key: Column) -> Column:
    """The bits a key sets in its word: six bits of a second hash choose each."""
    h = _hash(key, 23)
    mask = F.lit(0).cast("long")
    for i in range(BITS_SET):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def blocks_for(keys: int, bits_per_key: int = 16) -> int:
    """A power of two of blocks; at most MAX_BLOCKS, beyond which more keys pass the filter (never fewer)."""
    blocks = 64
    while blocks * 64 < keys * bits_per_key and blocks < MAX_BLOCKS:
        blocks *= 2
    return blocks


def built(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter of all values of ``key``: at most ``blocks`` rows (block, word); words without bits are absent."""
    if not 0 < blocks <= MAX_BLOCKS:
        raise ValueError(f"a filter has 1 to {MAX_BLOCKS} blocks, not {blocks}")
    return (
        keys.select(block_of(F.col(key), blocks).alias("__block"), mask_of(F.col(key)).alias("__mask"))
        .groupBy("__block").agg(F.bit_or("__mask").alias("__word"))
    )


def possible(df: DataFrame, key: str, words: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key the filter may hold; the filter is broadcast, its size bounded by its blocks."""
    mask = mask_of(F.col(key))
    return (
        df.withColumn("__block", block_of(F.col(key), blocks))
        .join(F.broadcast(words), "__block")
        .where(F.col("__word").bitwiseAND(mask) == mask)
        .drop("__block", "__word")
    )


def marked(df: DataFrame, key: str, words: DataFrame, blocks: int, name: str) -> DataFrame:
    """All rows, with a boolean ``name``: whether the filter may hold the key. A null key is not held."""
    mask = mask_of(F.col(key))
    held = F.col("__word").isNotNull() & (F.col("__word").bitwiseAND(mask) == mask) & F.col(key).isNotNull()
    return (
        df.withColumn("__block", block_of(F.col(key), blocks))
        .join(F.broadcast(words), "__block", "left")
        .withColumn(name, held)
        .drop("__block", "__word")
    )
