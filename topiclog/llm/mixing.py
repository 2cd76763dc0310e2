"""Mixing sources to target weights by Pareto order sampling.

Every document of a source is wanted ``target / source_size`` times. The whole part of that is taken for certain; the rest is
the inclusion probability p of one more copy. With a uniform number u for each document, the documents with the
least order u / (1 - u) / (p / (1 - p)) get that copy, as many as the words still wanted. Fixing what is taken,
instead of tossing a coin for each document, keeps the sum at its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topiclog.llm.base import WORD, others, stored
from topiclog.session import broadcast_if_small

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2.0
# Slices of the order; only the slice in which a source's words run out is sorted.
SLICES = 1 << 16
# Sources up to which their rows are broadcast, after counting them.
SMALL = 10_000
COLUMNS = ("doc_id", "size", "source_size", "target", "taken")


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size), one row per source.

    Sources weigh ``weights`` in turn, by code point, null last, and share ``share`` of all words by weight. A target stops at
    ``cap`` times its source; the excess goes to the others by weight until none is above. In the order of room (the
    cap per weight) the capped sources are a prefix: each is capped if, with all before it capped, its part of
    what is left reaches its cap; what the first open one gets per weight holds for all open ones. One
    row per source is sorted in one task; documents are not.
    """
    turn = F.get(F.array(*map(F.lit, map(float, weights))), F.pmod(F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))))
    every = Window.partitionBy()
    order = Window.orderBy("room", F.col("source").asc_nulls_last())
    capped_words = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    judged = (
        sizes.withColumn("weight", turn).withColumn("most", F.col("source_size") * F.lit(float(cap)))
        .withColumn("room", F.col("most") / F.col("weight"))
        .withColumn("level", (F.sum("source_size").over(every) * F.lit(float(share)) - capped_words) / open_weight)
        .withColumn("capped", F.col("level") >= F.col("room"))
        .withColumn("level", F.max(F.when(~F.col("capped"), F.col("level"))).over(every))
    )
    target = F.when(F.col("capped"), F.col("most")).otherwise(F.col("weight") * F.col("level"))
    return judged.select("source", "source_size", "weight", target.alias("target"))


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _numbers(id_col: str, text_col: str, source_col: str, seed: int) -> list[Column]:
    number = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col)), 12)
    return [_source_key(F.col(source_col)).alias("__source"), words(F.col(text_col)).alias("__size"),
            ((number + 0.5) / float(1 << 52)).alias("__u")]


def _order(p: Column) -> Column:
    """Random odds over inclusion odds; null where no further copy is to be drawn."""
    return F.when(p > 0, F.col("__u") / (1 - F.col("__u")) / (p / (1 - p)))


def _plan(drawn: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """One row per source: size, target, whole copies, p, and the last (order, id) that gets one copy more."""
    sizes = drawn.groupBy("__source", "source").agg(F.sum("__size").alias("source_size"))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    planned = stored(
        targets(sizes.select("source", "source_size"), weights, share, cap)
        .select(_source_key(F.col("source")).alias("__source"), "source_size", "target", F.floor(each).alias("__whole"),
                (each - F.floor(each)).alias("__p"),
                (F.col("target") - F.floor(each) * F.col("source_size")).alias("__more")), "targets")
    ordered = (
        drawn.join(broadcast_if_small(planned, SMALL), "__source").withColumn("__order", _order(F.col("__p")))
        .where("__order is not null")
        .withColumn("__slice", F.least(F.floor(F.col("__order") / (1 + F.col("__order")) * SLICES), F.lit(SLICES - 1)))
    )
    slices = Window.partitionBy("__source").orderBy("__slice")
    ends = stored(
        ordered.groupBy("__source", "__slice").agg(F.sum("__size").alias("__words"), F.first("__more").alias("__more"))
        .withColumn("__before", F.sum("__words").over(slices) - F.col("__words"))
        .where((F.col("__before") < F.col("__more")) & (F.col("__before") + F.col("__words") >= F.col("__more")))
        .groupBy("__source").agg(F.min(F.struct("__slice", "__before")).alias("__end"))
        .select("__source", F.col("__end.__slice").alias("__slice"), F.col("__end.__before").alias("__before")), "ends")
    in_order = Window.partitionBy("__source").orderBy("__order", "id")
    middle = F.col("__before") + F.sum("__size").over(in_order) - F.col("__size") / 2
    last = (
        ordered.join(broadcast_if_small(ends, SMALL), ["__source", "__slice"])
        .withColumn("__middle", middle)
        .groupBy("__source", "__slice")
        .agg(F.max(F.when(F.col("__middle") <= F.col("__more"), F.struct("__order", "id"))).alias("__last"))
    )
    # The last whole slice ends before slice / SLICES; a slice that takes none of its rows ends there.
    edge = F.struct((F.col("__slice") / (SLICES - F.col("__slice"))).alias("__order"), F.lit(None).cast("long").alias("id"))
    last = last.select("__source", F.coalesce("__last", edge).alias("__last"))
    return stored(planned.join(last, "__source", "left"), "plan")


def _copies(drawn: DataFrame, plan: DataFrame, id_col: str) -> DataFrame:
    more = (F.col("__order") < F.col("__last.__order")) | (F.col("__order") == F.col("__last.__order")) & (
        F.col(id_col).isNull() | F.coalesce(F.col(id_col) <= F.col("__last.id"), F.lit(False)))
    # Without an end, all words of the source are wanted once more.
    extra = F.when(F.col("__order").isNull(), 0).when(F.col("__last").isNull() | more, 1).otherwise(0)
    return (
        drawn.join(broadcast_if_small(plan, SMALL), "__source").withColumn("__order", _order(F.col("__p")))
        .withColumn("__copies", (F.col("__whole") + extra).cast("int"))
    )


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           seed: int = 0, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies.

    The uniform number of a document is a hash of its id, text and ``seed``, so reruns agree; rows alike in both are
    taken alike. The document at the end of a source's sample is taken if more than half of it is still wanted. A null
    text has no words; a null source is a source of its own; documents of a source without words are not
    taken. An empty table gives no rows.

    The words of each (source, slice of the order) are summed where they are read; whole slices are in or out by that sum,
    and only the slice where a source's words run out is sorted. So no source is in one task, however large. The texts
    are read once, for id, size and number.
    """
    narrow = stored(docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"), *_numbers(id_col, text_col, source_col, seed)), "sizes")
    taken = _copies(narrow, _plan(narrow, weights, share, cap), "id")
    return taken.select(F.col("id").alias("doc_id"), "source", F.col("__size").alias("size"), "source_size", "target",
                        F.col("__copies").alias("copies"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            seed: int = 0, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The mixed table: every row of ``docs``, with its own columns, as often as :func:`copies` says."""
    row = F.struct(*others(docs, ())).alias("row")
    named = [F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source")]
    drawn = docs.select(row, *named, *_numbers(id_col, text_col, source_col, seed))
    narrow = stored(docs.select(*named, *_numbers(id_col, text_col, source_col, seed)), "sizes")
    plan = _plan(narrow, weights, share, cap).select("__source", "__whole", "__p", "__last")
    taken = _copies(drawn, plan, "id").where("__copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "__copies"))).select("row.*")
