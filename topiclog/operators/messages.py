"""Reading messages: projection, bounded polls, order, delivery checks, per-message user code."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topiclog.errors import ProcessingError
from topiclog.operators.numbering import ROWS_PER_PIECE, part_of, pieces, store_in_order
from topiclog.session import new_dir

KEYS = ["topic", "partition"]
# Offsets per stretch when a partition's offsets are compared with their neighbours.
STRETCH = 1_000_000


def without_topic(messages: DataFrame) -> DataFrame:
    """The four-field message of a reader of one topic."""
    return messages.select("partition", "offset", "key", "value")


def first_messages(messages: DataFrame, count: int) -> DataFrame:
    """The ``count`` lowest-offset messages of each partition.

    Spark cuts to ``count`` rows per partition before the shuffle, so a hot partition sends ``count`` rows per task.
    """
    place = F.row_number().over(Window.partitionBy(*KEYS).orderBy("offset"))
    return messages.withColumn("_place", place).where(F.col("_place") <= count).drop("_place")


def delivery_audit(messages: DataFrame) -> DataFrame:
    """Per partition: messages, distinct offsets, span of offsets, and whether each arrived exactly once.

    A bitmap per bucket of 32,768 offsets marks those that came. Tasks mark what they see, so a bitmap for each bucket and task is shuffled
    instead of every offset, and a hot partition is spread over its buckets.
    """
    buckets = messages.groupBy(*KEYS, F.bitmap_bucket_number("offset").alias("_bucket")).agg(
        F.count("*").alias("messages"), F.min("offset").alias("_least"), F.max("offset").alias("_most"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("offset"))).alias("offsets"))
    counted = buckets.groupBy(*KEYS).agg(
        F.sum("messages").alias("messages"), F.sum("offsets").alias("offsets"), (F.max("_most") - F.min("_least") + 1).alias("span"))
    return counted.withColumn(
        "exactly_once", (F.col("messages") == F.col("offsets")) & (F.col("offsets") == F.col("span")))


def offset_gaps(messages: DataFrame, stretch: int = STRETCH, rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """Where the offsets of a partition do not follow each other by one.

    ``previous, offset, step, times``: a hole has step > 1, an offset seen again has step 0 and says how many
    ``times`` again. A window per partition would put a hot partition into one task. So repeats are counted
    first, neighbours are compared inside stretches of offsets, and the ends of stretches with each other. The messages
    are counted, and shuffled once, by stretch; both comparisons use that layout. Stretches are dealt to tasks of about
    ``rows_per_piece`` messages, so a task holds no more of a longer log.
    """
    tasks = max(messages.sparkSession.sparkContext.defaultParallelism, pieces(messages, rows_per_piece))
    offsets = (
        messages.select(*KEYS, "offset", F.expr(f"offset div {int(stretch)}").alias("_stretch"))
        .repartition(tasks, *KEYS, "_stretch")
    )
    inside = offsets.groupBy(*KEYS, "_stretch", "offset").agg(F.count("*").alias("_copies")).withColumn(
        "previous", F.lag("offset").over(Window.partitionBy(*KEYS, "_stretch").orderBy("offset")))
    ends = offsets.groupBy(*KEYS, "_stretch").agg(F.min("offset").alias("offset"), F.max("offset").alias("_last"))
    between = ends.withColumn(
        "previous", F.lag("_last").over(Window.partitionBy(*KEYS).orderBy("_stretch"))).withColumn("_copies", F.lit(1).cast("bigint"))
    once = F.struct(F.col("previous"), F.lit(1).cast("bigint").alias("times"))
    again = F.struct(F.col("offset").alias("previous"), (F.col("_copies") - 1).alias("times"))
    step = F.col("offset") - F.col("found.previous")
    return (
        inside.unionByName(between.select(*inside.columns))
        .select(*KEYS, "offset", F.explode(F.array(once, again)).alias("found"))
        .where((step > 1) | ((step == 0) & (F.col("found.times") > 0)))
        .select(*KEYS, "found.previous", "offset", step.alias("step"), "found.times")
    )


def in_offset_order(messages: DataFrame, whole_partitions: bool = False, rows_per_range: int = ROWS_PER_PIECE) -> DataFrame:
    """Messages laid out so that each task sees the offsets of a partition in ascending order.

    The layout is by ranges of (topic, partition, offset): a hot partition is cut into consecutive ranges that
    run side by side. They are of about ``rows_per_range`` messages, which are counted for it, so that none outgrows
    its task. ``whole_partitions`` keeps each partition in one task, for code that carries state from message to
    message; use it on bounded input such as a micro-batch.
    """
    by = (messages.repartition(*KEYS) if whole_partitions
          else messages.repartitionByRange(pieces(messages, rows_per_range), *KEYS, "offset"))
    return by.sortWithinPartitions(*KEYS, "offset")


def process_messages(
    messages: DataFrame, process: Callable[[pd.DataFrame], pd.DataFrame], schema: str, whole_partitions: bool = False,
) -> DataFrame:
    """Results of user code that gets batches of messages in offset order.

    A failure stops the job and names the message: the batch is gone through again one message at a time, and
    if none fails alone, the error names the first and last message of the batch.
    """
    def failing(batch: pd.DataFrame) -> str:
        for i in range(len(batch)):
            try:
                process(batch.iloc[i:i + 1])
            except Exception:
                one = batch.iloc[i]
                return f"at {one.topic}-{one.partition} offset {one.offset}"
        first, last = batch.iloc[0], batch.iloc[-1]
        return f"between {first.topic}-{first.partition} offset {first.offset} and {last.topic}-{last.partition} offset {last.offset}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            try:
                yield process(batch)
            except Exception as cause:
                raise ProcessingError(f"processing failed {failing(batch)}: {cause!r}") from cause

    return in_offset_order(messages, whole_partitions).mapInPandas(run, schema)


def process_in_order(
    messages: DataFrame,
    summarise: Callable[[pd.DataFrame], tuple],
    merge: Callable[[tuple, tuple], tuple],
    process: Callable[[pd.DataFrame, tuple | None], pd.DataFrame],
    state_schema: str,
    schema: str,
    rows_per_range: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Results of user code that carries a state from message to message of a partition, without a partition being one task.

    The log is cut into ranges of (topic, partition, offset) of about ``rows_per_range`` messages, in which offsets ascend. ``summarise`` gives the state
    that the messages of a range leave behind, as a tuple of ``state_schema``; ``merge(earlier, later)`` joins the states of neighbouring ranges
    and must be associative; ``process(batch, state)`` makes the results of a range, given the state before it, None at the start of a
    partition. If summarising two ranges and merging gives what summarising both at once does, the results are those of whole
    partitions in order. The states of a partition, one per range, are merged in one task; the messages never are.
    """
    spark = messages.sparkSession
    path = new_dir(spark, "ranges")
    store_in_order(messages, ["offset"], KEYS, path, rows_per_range)
    # An offset that came twice may lie at the end of one part and the start of the next; parts keep their order all the same.
    ranges = spark.read.schema(messages.withColumn("_place", F.lit(0).cast("bigint")).schema).parquet(path).withColumn("_part", part_of("_place"))
    fields = [f.name for f in spark.createDataFrame([], state_schema).schema]
    keys = "topic string, partition int, _part bigint"

    def ordered(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.sort_values("_place", kind="stable").drop(columns=["_place", "_part"])

    def summary(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(rows["topic"].iloc[0], rows["partition"].iloc[0], rows["_part"].iloc[0], *summarise(ordered(rows)))],
                            columns=[*KEYS, "_part", *fields])

    def before(states: pd.DataFrame) -> pd.DataFrame:
        states = states.sort_values("_part")
        found, so_far = [], None
        for row in states.itertuples(index=False, name=None):
            found.append((*row[:3], so_far is not None, *(so_far if so_far is not None else row[3:])))
            so_far = row[3:] if so_far is None else merge(so_far, row[3:])
        return pd.DataFrame(found, columns=[*KEYS, "_part", "_known", *fields])

    def results(key: tuple, rows: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        known = states.iloc[0]["_known"]
        return process(ordered(rows), tuple(states.iloc[0][f] for f in fields) if known else None)

    states = ranges.groupBy(*KEYS, "_part").applyInPandas(summary, f"{keys}, {state_schema}")
    entering = states.groupBy(*KEYS).applyInPandas(before, f"{keys}, _known boolean, {state_schema}")
    return ranges.groupBy(*KEYS, "_part").cogroup(entering.groupBy(*KEYS, "_part")).applyInPandas(results, schema)
