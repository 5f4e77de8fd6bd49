"""Small tables that are replaced as a whole: a new version beside the old one, then the old one goes."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyworks.sources import hadoop
from tallyworks.sources.files import read_written

VERSION = re.compile(r"v(\d{9})")


@dataclass(frozen=True)
class VersionedTable:
    """A table of which readers see one finished version; a version that was not finished is never seen.

    One writer at a time: of two that start from the same version, the later one wins.
    """

    spark: SparkSession
    folder: str
    schema: str
    keep: int = 2

    def versions(self) -> list[int]:
        """Numbers of the finished versions, in order."""
        named = [VERSION.fullmatch(name) for name in hadoop.children(self.spark, self.folder)]
        numbers = sorted(int(m[1]) for m in named if m)
        return [n for n in numbers if hadoop.exists(self.spark, f"{self.path(n)}/_SUCCESS")]

    def path(self, version: int) -> str:
        return f"{self.folder}/v{version:09d}"

    def read(self) -> DataFrame:
        """The latest version, or no rows."""
        found = self.versions()
        return read_written(self.spark, self.path(found[-1]), self.schema) if found else self.spark.createDataFrame([], self.schema)

    def replace(self, df: DataFrame, files: int | None = None) -> DataFrame:
        """Write the next version, which may be derived from the present one, and remove the oldest."""
        found = self.versions()
        target = self.path(found[-1] + 1 if found else 1)
        (df.coalesce(files) if files else df).write.mode("overwrite").parquet(target)
        for old in found[: -self.keep + 1 or None]:
            hadoop.delete(self.spark, self.path(old))
        return self.read()
