"""Options for Spark's own Kafka source, for deployments that have the connector.

Its rows have the columns of :data:`topiclog.schemas.MESSAGE_COLUMNS`; every operator that takes messages
takes them as they are.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from topiclog.functions.positions import LARGEST, SMALLEST


def source_options(
    brokers: Sequence[str],
    topics: Sequence[str] | Mapping[str, Sequence[int]] | None = None,
    pattern: str | None = None,
    starting: Mapping[str, Mapping[int, int]] | str = LARGEST,
) -> dict[str, str]:
    """``format("kafka")`` options: a list subscribes, a dict assigns partitions, a pattern matches names."""
    if (topics is None) == (pattern is None):
        raise ValueError("give either topics or a pattern")
    options = {"kafka.bootstrap.servers": ",".join(b for b in brokers if b)}
    if pattern is not None:
        # The connector wants the whole name to match; names are matched from the start only here.
        options["subscribePattern"] = f"(?:{pattern}).*"
    elif isinstance(topics, Mapping):
        options["assign"] = json.dumps({t: list(p) for t, p in topics.items()})
    else:
        options["subscribe"] = ",".join(topics)
    named = {SMALLEST: "earliest", LARGEST: "latest"}
    if isinstance(starting, str):
        options["startingOffsets"] = named[starting]
    else:
        options["startingOffsets"] = json.dumps({t: {str(p): o for p, o in ps.items()} for t, ps in starting.items()})
    return options
