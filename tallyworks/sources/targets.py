"""The three target tables where they are kept: rows by batch and month, batches that replace themselves.

A table is partitioned by the batch that loaded a row and the month of its date. Rows are brought together by
month before they are written, so a month of a batch is a few files of an even size and not
one from every task; large months are split. Reports over recent days read the months they need and no
other. A batch that is loaded again, with whatever rows, takes the place of what it loaded before.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions.dates import timestamp_literal
from tallyworks.schemas import BATCH_COLUMN, DEFAULTS, ID_COLUMNS, MONTHS, ddl
from tallyworks.sources import files, hadoop, tables

# The batch of a table that is refreshed in full.
FULL = "full"
BATCH_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
ROWS = "rows"


def columns_of(name: str) -> list[tuple[str, str]]:
    """The columns of a stored table without those it is partitioned by."""
    own = [(ID_COLUMNS[name], "bigint")] if name in ID_COLUMNS else []
    return own + list(tables.LAYOUTS[name])


def stored_schema(name: str) -> str:
    return ddl([*columns_of(name), (BATCH_COLUMN, "string"), (MONTHS[name][0], "date")])


def month_of(moment: Column) -> Column:
    """The first day of the month."""
    return F.trunc(moment, "MM")


def since(df: DataFrame, moment: str, start: datetime) -> DataFrame:
    """The rows from a moment on; of a table partitioned by month, only the months from then on are read."""
    begin = timestamp_literal(start)
    recent = F.col(moment) >= begin
    for month, source in MONTHS.values():
        if source == moment and month in df.columns:
            recent = recent & (F.col(month) >= F.lit(start.date().replace(day=1)))
    return df.filter(recent)


@dataclass(frozen=True)
class Loaded:
    """A stored table after a load, and what was measured on the rows of the load."""

    table: DataFrame
    measured: dict[str, Any]


@dataclass(frozen=True)
class FolderTarget:
    """Parquet tables in a folder of shared storage."""

    folder: str

    def place(self, spark: SparkSession, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return files.read_written(spark, self.place(spark, name), stored_schema(name))

    def exists(self, spark: SparkSession, name: str) -> bool:
        return hadoop.exists(spark, self.place(spark, name))

    def prepare(self, spark: SparkSession, name: str, refresh: bool) -> None:
        """Folders come with the first write."""

    def settle(self, spark: SparkSession, name: str) -> None:
        """Readers list the folder."""

    def load(
        self, df: DataFrame, name: str, batch: str | None = None, measures: Mapping[str, Column] | None = None, one_month: bool = False
    ) -> Loaded:
        """Replace the whole table, or with ``batch`` what that batch has loaded before, and no other.

        ``measures`` are aggregates over the rows of ``df``, which may have more columns than the table. They
        are taken in the tasks that write, where a repeated task counts once. Rows that are all of ``one_month`` need
        not be brought together.
        """
        spark, (month, moment) = df.sparkSession, MONTHS[name]
        self.prepare(spark, name, batch is None)
        columns = columns_of(name)
        wanted = {c for c, _ in columns}
        present = set(df.columns)
        stored = [(F.col(c) if c in present else F.lit(None)).cast(kind).alias(c) for c, kind in columns]
        others = [F.col(c) for c in df.columns if c not in wanted]
        rows = df.select(*stored, *others, month_of(F.col(moment)).alias(month))
        rows = rows if one_month else rows.hint("rebalance", month)
        seen = Observation(f"load of {name}")
        measured = {ROWS: F.count(F.lit(1)), **(measures or {})}
        rows = rows.observe(seen, *[m.alias(label) for label, m in measured.items()]).select(*[c for c, _ in columns], month)
        place = f"{self.place(spark, name)}/{BATCH_COLUMN}={checked_batch(batch)}" if batch else self.place(spark, name)
        by = [month] if batch else [BATCH_COLUMN, month]
        rows = rows if batch else rows.withColumn(BATCH_COLUMN, F.lit(FULL))
        rows.write.mode("overwrite").partitionBy(*by).parquet(place)
        counts = dict(seen.get)
        if not counts.pop(ROWS):
            # Readers without a schema find one in an empty file.
            below = f"{place}/{month}={NO_MONTH}" if batch else f"{place}/{BATCH_COLUMN}={FULL}/{month}={NO_MONTH}"
            spark.createDataFrame([], ddl(columns)).write.mode("overwrite").parquet(below)
        self.settle(spark, name)
        return Loaded(self.read(spark, name), counts)


@dataclass(frozen=True)
class CatalogTarget(FolderTarget):
    """Tables of a database in the catalog: ``folder`` is the name of the database.

    Rows are written where the table lies, then the catalog takes in the partitions that came and drops those that went.
    """

    def table(self, name: str) -> str:
        return f"{self.folder}.{name}"

    def place(self, spark: SparkSession, name: str) -> str:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {self.table(name)}")
        return described.filter("col_name = 'Location'").first()["data_type"].rstrip("/")

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(self.table(name))

    def exists(self, spark: SparkSession, name: str) -> bool:
        return tables.table_exists(spark, self.table(name))

    def prepare(self, spark: SparkSession, name: str, refresh: bool) -> None:
        """A full refresh drops and creates the table; a batch needs one to be there."""
        if refresh:
            tables.drop_table(spark, self.table(name))
        if refresh or not tables.table_exists(spark, self.table(name)):
            layout = [*columns_of(name), (BATCH_COLUMN, "string"), (MONTHS[name][0], "date")]
            tables.create_table(spark, self.table(name), layout, DEFAULTS.get(name), (BATCH_COLUMN, MONTHS[name][0]))

    def settle(self, spark: SparkSession, name: str) -> None:
        spark.sql(f"MSCK REPAIR TABLE {self.table(name)} SYNC PARTITIONS")


def checked_batch(batch: str) -> str:
    if not BATCH_NAME.fullmatch(batch):
        raise ValueError(f"a batch is named by letters, digits, dots, dashes and underscores, not {batch!r}")
    return batch


def overwrite_batch(spark: SparkSession, table: str, rows: DataFrame, batch: str) -> None:
    """Put the rows in the place of a batch of a table that has no other partitions."""
    partition = f"PARTITION ({BATCH_COLUMN} = '{checked_batch(batch)}')"
    spark.sql(f"INSERT OVERWRITE TABLE {table} {partition} SELECT * FROM {{rows}}", rows=rows)


def other_batches(df: DataFrame, batch: str) -> DataFrame:
    """What other batches have loaded."""
    return df.filter(F.col(BATCH_COLUMN) != batch)


def last_id(df: DataFrame, name: str) -> int:
    """The greatest identifier of a stored table, 0 if it has none."""
    return df.agg(F.max(ID_COLUMNS[name])).first()[0] or 0
