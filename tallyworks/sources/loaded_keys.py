"""The keys of all rows that batches have loaded, bucketed so that a new batch finds its own among them cheaply.

The keys lie in a fixed number of buckets by key. To leave out rows that are loaded already, only the batch is
shuffled, into as many parts as there are buckets; the loaded keys are read where they lie, however many there are.
The number of buckets is to follow the rows, as a task sorts a bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyworks.schemas import BATCH_COLUMN
from tallyworks.sources import hadoop, tables
from tallyworks.sources.targets import other_batches, overwrite_batch


class LoadedKeys:
    """A catalog table over a folder; a new session finds the keys of earlier ones in the folder."""

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str] = ("OrderID", "ProductID"), buckets: int = 64) -> None:
        self.spark, self.folder, self.keys, self.buckets = spark, folder.rstrip("/"), tuple(keys), buckets
        self.table = f"loaded_keys_{hashlib.sha256(self.folder.encode()).hexdigest()[:16]}"
        if not tables.table_exists(spark, self.table):
            columns = ", ".join(f"`{k}` string" for k in (*self.keys, BATCH_COLUMN))
            by = ", ".join(f"`{k}`" for k in self.keys)
            spark.sql(
                f"CREATE TABLE {self.table} ({columns}) USING parquet PARTITIONED BY ({BATCH_COLUMN}) "
                f"CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{self.folder}'"
            )
            if hadoop.exists(spark, self.folder):
                spark.sql(f"MSCK REPAIR TABLE {self.table}")

    def new_rows(self, df: DataFrame, batch: str) -> DataFrame:
        """The rows whose key no other batch has loaded; what the batch itself has loaded will be replaced."""
        others = [p.partition for p in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect() if p.partition.split("=", 1)[1] != batch]
        if not others:
            return df
        loaded = other_batches(self.spark.table(self.table), batch).select(*self.keys)
        # Merged by key: the loaded side may be of any size, and is read in its buckets.
        return df.join(loaded.hint("merge"), list(self.keys), "left_anti").select(*df.columns)

    def in_buckets(self, df: DataFrame, folder: str) -> DataFrame:
        """The rows from files in the buckets of the keys: to leave out loaded ones among them moves no row, however often."""
        table = f"rows_{hashlib.sha256(folder.encode()).hexdigest()[:16]}"
        rows = df.repartition(self.buckets, *self.keys).write.mode("overwrite").bucketBy(self.buckets, *self.keys)
        rows.option("path", folder).saveAsTable(table)
        return self.spark.table(table)

    def add(self, df: DataFrame, batch: str) -> None:
        """Note the keys of a batch in the place of those it had; a bucket of a batch is one file."""
        rows = df.select(*self.keys).repartition(self.buckets, *self.keys)
        overwrite_batch(self.spark, self.table, rows, batch)
