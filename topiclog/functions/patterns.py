"""The three ways names are matched; all rules live here."""

from __future__ import annotations

from pyspark.sql import Column


def starts_matching(name: Column, pattern: str) -> Column:
    """The pattern must match from the first character on, but need not reach the end."""
    return name.rlike(f"^(?:{pattern})")


def contains_matching(name: Column, pattern: str) -> Column:
    """The pattern may match anywhere."""
    return name.rlike(pattern)


def ends_with_stream(name: Column, stream: str) -> Column:
    """The literal stream name stands at the end; no character of it is special."""
    return name.endswith(stream)
