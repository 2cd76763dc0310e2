"""Distributing topic-partitions over the members of groups, and what changes between two states.

Units are ``group_id, topic, partition`` rows, members ``group_id, member_id`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclog.errors import NoPartitionsError
from topiclog.functions.names import unit_name
from topiclog.operators.numbering import ROWS_PER_PIECE, dense_index
from topiclog.session import broadcast_if_small, pinned


def subscribed_units(subscriptions: DataFrame, catalog: DataFrame, required: bool = False) -> DataFrame:
    """Units of every group from ``group_id, topic`` subscriptions; missing topics have none.

    ``required`` raises when some group is left without any unit.
    """
    wanted = subscriptions.select("group_id", "topic").distinct()
    units = wanted.join(catalog.select("topic", "partition").distinct(), "topic").select(
        "group_id", "topic", "partition")
    if required:
        idle = wanted.select("group_id").distinct().join(units, "group_id", "left_anti").first()
        if idle is not None:
            raise NoPartitionsError(f"no partitions found for the topics of group {idle.group_id!r}")
    return units


def missing_topics(subscriptions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Subscribed topics that the catalog does not have."""
    return subscriptions.select("group_id", "topic").distinct().join(catalog, "topic", "left_anti").select(
        "group_id", "topic")


def assign(units: DataFrame, members: DataFrame, rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """``group_id, member_id, topic, partition``: units dealt in turn to the sorted members of their group.

    Each unit goes to exactly one member; a group without members has no rows, and members left over have none. The units of a seat are
    cut into blocks of ``rows_per_piece``, and the seat is there once for each of its blocks: one member with all units of a
    large group is met in as many tasks as it has blocks.
    """
    # Both sides are read several times for their numbers.
    members = pinned(members.select("group_id", "member_id").distinct())
    named = units.select("group_id", "topic", "partition", unit_name(F.col("topic"), F.col("partition")).alias("_unit"))
    dealt = dense_index(named, ["_unit"], ["group_id"], "_turn", rows_per_piece)
    seated = dense_index(members, ["member_id"], ["group_id"], "_seat", rows_per_piece)
    seats = members.groupBy("group_id").agg(F.count("*").alias("_members"))
    turns = dealt.groupBy("group_id").agg(F.count("*").alias("_units"))
    sizes = broadcast_if_small(pinned(seats.join(turns, "group_id")))
    size = int(rows_per_piece)
    # Seat s has every m-th of n units, from the s-th on.
    own = F.expr("(_units - _seat + _members - 1) div _members")
    blocks = F.expr(f"(_own + {size - 1}) div {size}")
    placed = (
        seated.join(sizes, "group_id").withColumn("_own", own).where("_own > 0")
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))))
    return (
        dealt.join(sizes, "group_id").withColumn("_seat", F.pmod("_turn", "_members"))
        .withColumn("_block", F.expr(f"_turn div _members div {size}"))
        .join(placed.select("group_id", "_seat", "_block", "member_id"), ["group_id", "_seat", "_block"])
        .select("group_id", "member_id", "topic", "partition")
    )


def acquired_lists(assignment: DataFrame) -> DataFrame:
    """Topic to sorted partitions, per member."""
    return assignment.groupBy("group_id", "member_id", "topic").agg(
        F.array_sort(F.collect_list("partition")).alias("partitions"))


def changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and ``change`` ('added', 'removed' or 'kept') between two snapshots."""
    old = before.select(*keys).distinct().withColumn("_old", F.lit(True))
    new = after.select(*keys).distinct().withColumn("_new", F.lit(True))
    change = (
        F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("kept"))
    return old.join(new, list(keys), "full").select(*keys, change.alias("change"))
