"""Partitioned message logs as Spark tables and streams."""

import sys

from pyspark import cloudpickle

from topiclog.sources.ledger import CommitLedger
from topiclog.sources.log import TopicLog

__all__ = ["CommitLedger", "TopicLog"]

# The few functions that run in Python workers travel with the task, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
