"""Metric names, units and dimensions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metric names as the clients emit them, spelling included.
SEND_FAILURES = "produce_exception_count"
TIMERS = [
    "metadata_request_timer",
    "produce_request_timer",
    "fetch_request_timer",
    "offset_request_timer",
    "offset_commit_request_timer",
    "offset_fetch_request_timer",
    "offset_fetch_request_timer_kafka",
    "consumer_metadata_request_timer",
    "offset_commit_request_timer_kafka",
]
FAILURE_COUNTERS = [
    "failed_paylads_count",
    "out_of_range_counts",
    "not_leader_for_partition_count",
    "request_timed_out_count",
]


def to_milliseconds(seconds: Column) -> Column:
    return seconds * 1000


def to_seconds(milliseconds: Column) -> Column:
    return milliseconds / 1000


def qualified(prefix: str, name: Column) -> Column:
    """``<prefix>.<name>``."""
    return F.concat(F.lit(prefix + "."), name)


def fixed_dimensions(**values: Column | str) -> Column:
    """Map of the dimensions a client always reports."""
    entries: list[Column] = []
    for key, value in values.items():
        entries += [F.lit(key), value if isinstance(value, Column) else F.lit(value)]
    return F.create_map(*entries)


def merged_dimensions(own: Column, fixed: Column) -> Column:
    """User dimensions plus the fixed ones; the fixed ones win."""
    kept = F.map_filter(F.coalesce(own, F.create_map().cast("map<string,string>")),
                        lambda key, _: ~F.array_contains(F.map_keys(fixed), key))
    return F.map_concat(kept, fixed)
