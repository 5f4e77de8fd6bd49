"""Working folders on storage that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder; on a cluster that
    would be a different disk on every machine, so there the setting is required.
    """
    named = spark.conf.get(SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors can reach")
    return tempfile.mkdtemp(prefix="tallyworks-")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that no other run uses; Spark creates it on write."""
    return f"{shared_folder(spark)}/tallyworks/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"
