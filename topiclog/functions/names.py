"""Topic names, topic-partition units and group keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from topiclog.errors import TopicNameError

# Fixed value: the first token of every well-formed topic name.
TOPIC_PREFIX = "scribe"


def make_topic(datacenter: Column, stream: Column) -> Column:
    """``scribe.<datacenter>.<stream>``."""
    return F.concat(F.lit(TOPIC_PREFIX + "."), datacenter, F.lit("."), stream)


def _tokens(topic: Column) -> Column:
    # Two cuts at most: a stream name may contain dots itself.
    return F.split(topic, r"\.", 3)


def is_well_formed(topic: Column) -> Column:
    tokens = _tokens(topic)
    return (F.size(tokens) == 3) & (tokens[0] == TOPIC_PREFIX)


def topic_datacenter(topic: Column) -> Column:
    """Second token of a well-formed name, NULL otherwise."""
    return F.when(is_well_formed(topic), _tokens(topic)[1])


def topic_stream(topic: Column) -> Column:
    """Everything after the second dot of a well-formed name, NULL otherwise."""
    return F.when(is_well_formed(topic), _tokens(topic)[2])


def split_topic(topic: str) -> tuple[str, str]:
    """(datacenter, stream) of one name; raises for a malformed one."""
    tokens = topic.split(".", 2)
    if len(tokens) != 3 or tokens[0] != TOPIC_PREFIX:
        raise TopicNameError(f"not a well-formed topic name: {topic!r}")
    return tokens[1], tokens[2]


def unit_name(topic: Column, partition: Column) -> Column:
    """``<topic>-<partition>``."""
    return F.concat(topic, F.lit("-"), partition.cast("string"))


def unit_topic(unit: Column) -> Column:
    """Part before the last dash; topics may contain dashes."""
    return F.regexp_extract(unit, r"(?s)^(.*)-(\d+)$", 1)


def unit_partition(unit: Column) -> Column:
    """Number after the last dash."""
    return F.regexp_extract(unit, r"(?s)^(.*)-(\d+)$", 2).cast("int")


def group_path(group_id: Column, topics: Column, base: str = "/groups", by_topics: bool = True) -> Column:
    """Identity of a consumer group, by default also of the set of topics it subscribes to.

    The hash is taken over the sorted topics written as a Python 3 list of strings
    (``['t1', 't2']``). Topic names have no quotes or backslashes, so nothing needs escaping.
    """
    path = F.concat(F.lit(base + "/"), group_id)
    if not by_topics:
        return path
    listing = F.concat(
        F.lit("["),
        F.array_join(F.transform(F.array_sort(topics), lambda t: F.concat(F.lit("'"), t, F.lit("'"))), ", "),
        F.lit("]"),
    )
    return F.concat(path, F.lit("/"), F.sha1(listing))


def as_text(payload: Column) -> Column:
    """UTF-8 bytes to text, without copying them."""
    return payload.cast("string")


def as_bytes(text: Column) -> Column:
    """Text to UTF-8 bytes, without copying them."""
    return text.cast("binary")
