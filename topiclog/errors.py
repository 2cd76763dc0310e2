"""Exceptions raised by the operators, always before a lazy result is returned."""

from __future__ import annotations


class TopicLogError(Exception):
    """Base class of all errors of this package."""


class UnknownTopicError(TopicLogError):
    """A requested topic is not in the catalog."""


class UnknownPartitionError(TopicLogError):
    """A requested partition is not in the catalog."""


class AppendError(TopicLogError):
    """An append did not store what it was given."""


class TopicNameError(TopicLogError, ValueError):
    """A topic name does not have the form that its parts are read from."""


class NoPartitionsError(TopicLogError):
    """None of the subscribed topics has a partition."""


class InvalidStorageError(TopicLogError):
    """The named offset storage does not exist."""


class DiscoveryError(TopicLogError):
    """A catalog search had to find something and found nothing."""


class TopologyError(TopicLogError):
    """A topology document is incomplete or names a cluster it does not list."""


class ProcessingError(TopicLogError):
    """User code failed on a message or a micro-batch."""
