"""Profile of the inputs, and exact distinct counts in parts that can be merged.

The values of each column are counted by a scan of that column alone: a column is read once and no row is
repeated for another one. To merge profiles of batches without their values, values get codes in a
dictionary that only grows, and a batch keeps the set of its codes as bitmaps: an eighth of a byte
for each value there is. The union of two sets is the OR of their bitmaps.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.sources.files import write_and_read
from tallyworks.sources.versions import VersionedTable

VALUES_SCHEMA = "Metric string, Value string, n bigint"
CODES_SCHEMA = "Metric string, Value string, Code bigint"
PART_SCHEMA = "Metric string, Bucket bigint, Bits binary, Total bigint"


def column_values(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """(Metric, Value, n): every distinct value of each column as text, null included, and its rows."""
    counted = [
        df.groupBy(F.col(column).cast("string").alias("Value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(metric).alias("Metric"), "Value", "n")
        for column, metric in columns.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def extend_codes(codes: DataFrame, values: DataFrame) -> DataFrame:
    """The codes of values that have none yet: whole numbers from 0 on in each metric, without gaps.

    Values are dealt to shares by hash; numbers run within a share and on from the share before,
    so that no metric's values meet in one task. ``values`` must give the same rows each time.
    """
    keys = [values["Metric"] == codes["Metric"], values["Value"].eqNullSafe(codes["Value"])]
    new = values.join(codes, keys, "left_anti").select("Metric", "Value")
    shares = F.lit(max(1, int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = new.withColumn("_share", F.pmod(F.xxhash64("Value"), shares))
    sizes = dealt.groupBy("Metric", "_share").agg(F.count(F.lit(1)).alias("_rows"))
    so_far = Window.partitionBy("Metric").orderBy("_share").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = sizes.select("Metric", "_share", (F.sum("_rows").over(so_far) - F.col("_rows")).alias("_before"))
    used = codes.groupBy("Metric").agg((F.max("Code") + 1).alias("_used"))
    place = F.row_number().over(Window.partitionBy("Metric", "_share").orderBy("Value")) - 1
    # Both have a line per metric, or per metric and share.
    known = F.broadcast(starts.join(used, "Metric", "left").select("Metric", "_share", (F.col("_before") + F.coalesce("_used", F.lit(0))).alias("_from")))
    placed = dealt.withColumn("_place", place).join(known, ["Metric", "_share"])
    return placed.select("Metric", "Value", (F.col("_from") + F.col("_place")).cast("bigint").alias("Code"))


def profile_part(counts: DataFrame, values: DataFrame, codes: DataFrame) -> DataFrame:
    """(Metric, Bucket, Bits, Total) of a batch: its plain counts (Metric, Value), and the codes of its values as bitmaps."""
    keys = [values["Metric"] == codes["Metric"], values["Value"].eqNullSafe(codes["Value"])]
    coded = values.join(codes, keys).select(values["Metric"], "Code")
    sets = coded.groupBy("Metric", F.bitmap_bucket_number("Code").alias("Bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("Code")).alias("Bits")
    )
    plain = counts.select("Metric", F.lit(None).cast("bigint").alias("Bucket"), F.lit(None).cast("binary").alias("Bits"), F.col("Value").cast("bigint").alias("Total"))
    return plain.unionByName(sets.withColumn("Total", F.lit(None).cast("bigint")))


def merge_parts(parts: DataFrame) -> DataFrame:
    """One part out of several: totals added, bitmaps united."""
    merged = parts.groupBy("Metric", "Bucket").agg(F.bitmap_or_agg("Bits").alias("Bits"), F.sum("Total").alias("Total"))
    return merged.withColumn("Bits", F.when(F.col("Bucket").isNotNull(), F.col("Bits")))


def profile_lines(part: DataFrame) -> DataFrame:
    """(Metric, Value) of a part."""
    value = F.sum(F.coalesce("Total", F.bitmap_count("Bits"))).alias("Value")
    return part.groupBy("Metric").agg(value)


class ProfileStore:
    """Parts of batches and the dictionary they share, in a folder of shared storage.

    A batch that is added again replaces its part. The dictionary only grows, so parts stay valid.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.codes = VersionedTable(spark, f"{self.folder}/codes", CODES_SCHEMA)

    def add(self, batch: str, counts: DataFrame, values: DataFrame) -> None:
        kept = write_and_read(values.select("Metric", "Value"), f"{self.folder}/values/{batch}")
        known = self.codes.read()
        new = extend_codes(known, kept)
        codes = self.codes.replace(known.unionByName(new)) if not new.isEmpty() else known
        profile_part(counts, kept, codes).write.mode("overwrite").parquet(f"{self.folder}/parts/{batch}")

    def profile(self, batches: Sequence[str]) -> DataFrame:
        """The profile of all these batches together, from their parts."""
        paths = [f"{self.folder}/parts/{batch}" for batch in batches]
        return profile_lines(merge_parts(self.spark.read.schema(PART_SCHEMA).parquet(*paths)))
