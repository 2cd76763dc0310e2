"""Client metric samples: ``name, kind, value, dimensions, ts`` rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclog.functions.measures import FAILURE_COUNTERS, SEND_FAILURES, TIMERS, qualified, to_milliseconds


def timer_samples(samples: DataFrame, prefix: str) -> DataFrame:
    """Samples of known timers, in milliseconds, under their full name."""
    return (
        samples.where(F.col("name").isin(TIMERS))
        .withColumn("value", to_milliseconds(F.col("value")))
        .withColumn("name", qualified(prefix, F.col("name")))
        .withColumn("kind", F.lit("timer"))
    )


def counter_samples(samples: DataFrame, prefix: str, names: list[str] = FAILURE_COUNTERS) -> DataFrame:
    """Samples of known failure counters; each counts one, whatever its value. A producer counts SEND_FAILURES."""
    return (
        samples.where(F.col("name").isin(names))
        .withColumn("value", F.lit(1.0))
        .withColumn("name", qualified(prefix, F.col("name")))
        .withColumn("kind", F.lit("counter"))
    )


def unknown_samples(samples: DataFrame) -> DataFrame:
    """Names that are neither timer nor counter, with how often they were dropped."""
    known = [*TIMERS, *FAILURE_COUNTERS, SEND_FAILURES]
    return samples.where(~F.col("name").isin(known)).groupBy("name").agg(F.count("*").alias("samples"))


def summary(samples: DataFrame, dimensions: list[str]) -> DataFrame:
    """Count, total and largest value per name and the listed dimensions."""
    by = [F.col("dimensions")[d].alias(d) for d in dimensions]
    return samples.groupBy("name", "kind", *by).agg(
        F.count("*").alias("samples"), F.sum("value").alias("total"), F.max("value").alias("largest"))
