"""What the operators of this subpackage share: input, learning folds, written tables."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.sources import scratch

# Fixed value: one part in so many of the documents is held out from all learning.
FOLDS = 5

# White space as the contracts define it: space and the characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python workers can import it."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="tallyworks-code-")) / "tallyworks_code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(application)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the held-out fold; one without an id does."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def words(text: Column) -> Column:
    """The words of a text, split at white space; none for an empty text."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows from a table in the shared folder, so that no later step repeats this work."""
    spark = df.sparkSession
    path = scratch.new_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
