"""The few file operations that Spark itself does not offer, on whatever file system a path names."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _located(spark, path)
    return system.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    system, place = _located(spark, path)
    return [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    system, place = _located(spark, path)
    system.delete(place, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    system, place = _located(spark, path)
    return system.getContentSummary(place).getLength()


def state_of_tables(spark: SparkSession, paths: Iterable[str]) -> str:
    """A digest of the names, sizes and times of the files right below each path: changed tables give another one."""
    known = hashlib.sha256()
    for path in paths:
        system, place = _located(spark, path)
        listed = [status.toString() for status in system.listStatus(place)] if system.exists(place) else []
        known.update(re.sub(r"access_time=\d+", "", f"{path}: {sorted(listed)}").encode())
    return known.hexdigest()


def state_of_inputs(df: DataFrame) -> str | None:
    """A digest of what a frame reads and how: its plan, and the sizes and times of its files.

    The files are listed by tasks and their digests added up there. Frames that do not come from
    files alone have no state that can be told, hence ``None``.
    """
    files = df.inputFiles()
    plan = df._jdf.queryExecution().analyzed().toString()
    if not files or "LocalRelation" in plan or "LogicalRDD" in plan:
        return None
    listed = df.sparkSession.read.format("binaryFile").load(files)
    one = F.xxhash64("path", "length", "modificationTime")
    count, size, mixed = listed.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(one)).first()
    text = f"{re.sub(r'#[0-9]+L?', '', plan)}|{df.schema.json()}|{count}|{size}|{mixed}"
    return hashlib.sha256(text.encode()).hexdigest()
