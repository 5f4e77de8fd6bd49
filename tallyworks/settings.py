"""Session settings that fit an input size; the caller applies them to its own session."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

MEGABYTE = 1024 * 1024


@contextmanager
def applied(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """The settings hold within the block; what the session had before holds again after it."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def bounded_settings(input_bytes: int, cores: int, partition_bytes: int = 16 * MEGABYTE, scan_bytes: int = 8 * MEGABYTE) -> dict[str, str]:
    """Settings under which no task sorts more than fits into a small share of an executor, whatever the size of the input.

    Rows that lie in a megabyte of a file or shuffle take many times as much while they are sorted. The parts of a shuffle
    follow the input alone; Spark merges small ones up to ``partition_bytes`` and splits skewed ones.
    """
    return {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(scan_bytes),
        "spark.sql.shuffle.partitions": str(max(cores, math.ceil(4 * input_bytes / partition_bytes))),
    }


def session_settings(
    input_bytes: int, cores: int, partition_bytes: int = 128 * MEGABYTE, scan_bytes: int = 128 * MEGABYTE
) -> dict[str, str]:
    """Settings under which a shuffle of the whole input makes partitions of about that size, and scans tasks of ``scan_bytes``.

    The number of partitions follows the input alone, so their size is the same at any scale.
    Spark merges small partitions at run time and splits skewed ones, so the count only has
    to be high enough. Joins are rebalanced even where this costs another shuffle, since a
    hot key would otherwise stay in one task.
    """
    partitions = max(cores, math.ceil(input_bytes / partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.files.maxPartitionBytes": str(scan_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
    }
