"""Exact duplicates with a path of their own for very frequent texts.

A frequent-items sketch (Spark's ``approx_top_k``, which keeps a bounded set of counters and lowers all of them when it is
full, after Misra and Gries) proposes digests that may be frequent. Their exact counts verify them, and the
verified ones are broadcast, so that their copies are removed where they are read. Only the other rows are
shuffled by digest; none of their groups is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topiclog.llm.base import SPACES, others, stored, unused

# Digests are dealt to ranges by hash, each with its own sketch: at most RANGES * COUNTERS candidates in all.
RANGES, COUNTERS = 32, 64
# Copies from which a verified text counts as frequent. Both paths give the same result.
LEAST = 100
COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def digest(text: Column) -> Column:
    """SHA-256 (binary) of the text with each run of white space as one space; null is empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "), 256))


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, digest, number) of every row, stored; the numbers tell rows apart."""
    return stored(docs.select(F.col(id_col).alias("id"), digest(F.col(text_col)).alias("digest"),
                              F.monotonically_increasing_id().alias("number")), "digests")


def _copies() -> tuple[Column, Column]:
    return F.min(F.struct(F.col("id").isNull().alias("without"), "id", "number")).alias("least"), F.count(F.lit(1)).alias("rows")


def winners(digests: DataFrame, least: int = LEAST) -> DataFrame:
    """(digest, least, rows) of texts with at least ``least`` rows that the sketches found; least is (without id?, id, number).

    ``digests`` is that of :func:`numbered` and is read twice. A digest that is more than 1 in COUNTERS of its range's rows
    is always found. Bounded by RANGES * COUNTERS rows (64-bit hashes of digests that collide are told apart).
    """
    key = F.xxhash64("digest")
    keyed = digests.select("id", "number", "digest", key.alias("key"))
    found = (
        keyed.groupBy(F.pmod("key", F.lit(RANGES)).alias("range"))
        .agg(F.expr(f"approx_top_k(key, {COUNTERS}, {COUNTERS})").alias("items"))
        .select(F.explode("items.item").alias("key"))
    )
    return (
        keyed.join(F.broadcast(found), "key")
        .groupBy("digest").agg(*_copies())
        .where(F.col("rows") >= least)
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are after replacing each run of ASCII white space by one space; null counts as empty. Of equal
    texts the row with the smallest doc_id stays. Rows without doc_id come last; keep_id is null if
    no row of the group has one. Of rows with the same doc_id and equal texts one stays. An empty table gives no rows.

    The row that stays is the least (id, number) of its text, with numbers that the stored digests hold; so copies are summed where
    they are read, also those that the sketches missed, rows without id and rows repeated under one id.
    """
    digests = numbered(docs, id_col, text_col)
    frequent = stored(winners(digests, least), "frequent")
    marked = digests.join(F.broadcast(frequent), "digest", "left")
    rare = marked.where("rows is null").drop("least", "rows")
    groups = rare.groupBy("digest").agg(*_copies())
    return rare.join(groups, "digest").unionByName(marked.where("rows is not null")).select(
        F.col("id").alias("doc_id"), F.col("least.id").alias("keep_id"), F.col("rows").alias("group_size"),
        (F.col("number") == F.col("least.number")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def without_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_groups` keeps, with all their columns.

    Copies of frequent texts go where they are read; the other rows are shuffled once, by digest. Rows that agree in
    id and normalised text are ordered by their raw text.
    """
    digests = numbered(docs, id_col, text_col)
    key, keep, nth = (unused(docs, name) for name in ("__digest", "__keep_id", "__nth"))
    frequent = stored(winners(digests, least), "frequent").select(F.col("digest").alias(key), F.col("least.id").alias(keep))
    marked = docs.withColumn(key, digest(F.col(text_col))).join(F.broadcast(frequent), key, "left")
    left = marked.where(F.col(keep).isNull() | F.col(id_col).eqNullSafe(F.col(keep)))
    order = Window.partitionBy(key).orderBy(F.col(id_col).asc_nulls_last(), F.col(text_col).asc_nulls_last())
    return left.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).select(*others(docs, ()))


ORACLE = r"""
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
WINDOW g AS (PARTITION BY text_sha256)
"""
