"""Target tables: typed projections, catalog tables, appends, counts and parameterised SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.schemas import CONVERSION_LOG_TABLE, DEFAULTS, ERROR_TABLE, SALES_TABLE, ddl

LAYOUTS = {"SalesData": SALES_TABLE, "ErrorLogging": ERROR_TABLE, "CurrencyConversionLog": CONVERSION_LOG_TABLE}
WRITE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def sales_table(enriched: DataFrame) -> DataFrame:
    """Finalised rows in the layout of SalesData; missing values and absent columns are null."""
    present = set(enriched.columns)
    return enriched.select(
        *[(F.col(name) if name in present else F.lit(None)).cast(kind).alias(name) for name, kind in SALES_TABLE]
    )


def error_table(rejected: DataFrame) -> DataFrame:
    """Rejects in the layout of ErrorLogging."""
    stamped = rejected.withColumnRenamed("RejectionTimestamp", "ErrorTimestamp")
    return stamped.select(*[F.col(name).cast(kind).alias(name) for name, kind in ERROR_TABLE])


def rejection_rows(rejected: DataFrame) -> DataFrame:
    """Rejects as they are exported: the columns of ErrorLogging without identifiers, with the time of the rejection."""
    names = ["RejectionTimestamp" if name == "ErrorTimestamp" else name for name, _ in ERROR_TABLE]
    return rejected.select(*names)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def view_exists(spark: SparkSession, name: str) -> bool:
    return table_exists(spark, name) and spark.catalog.getTable(name).tableType in ("VIEW", "TEMPORARY")


def create_table(
    spark: SparkSession,
    name: str,
    layout: Sequence[tuple[str, str]],
    defaults: Mapping[str, str] | None = None,
    partitions: Sequence[str] = (),
) -> None:
    """An empty parquet table with the given columns; ``defaults`` are expressions for columns that an insert leaves out."""
    parts = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE {name} ({ddl(layout, defaults)}) USING parquet{parts}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def create_target_tables(spark: SparkSession, layouts: Mapping[str, Sequence[tuple[str, str]]] = LAYOUTS) -> None:
    """Drop and recreate the three target tables."""
    for name, layout in layouts.items():
        drop_table(spark, name)
        create_table(spark, name, layout, DEFAULTS.get(name))


def load_table(df: DataFrame, name: str, if_exists: str = "append") -> None:
    """Write a frame to a catalog table; ``if_exists`` is fail, replace or append."""
    df.write.format("parquet").mode(WRITE_MODES[if_exists]).saveAsTable(name)


@dataclass(frozen=True)
class Split:
    """How a read from a database is dealt to tasks: a number, date or timestamp column, its bounds, the connections.

    The bounds only place the cuts; rows outside of them, or without a value, are read as well.
    """

    column: str
    lower: str
    upper: str
    connections: int


def jdbc_write_options(url: str, name: str, batch_rows: int, connections: int) -> dict[str, str]:
    return {"url": url, "dbtable": name, "batchsize": str(batch_rows), "numPartitions": str(connections)}


def load_jdbc(
    df: DataFrame, url: str, name: str, if_exists: str = "append", batch_rows: int = 1000, connections: int = 16
) -> None:
    """Write a frame to an external database in batches, from the executors, over at most ``connections`` connections."""
    options = jdbc_write_options(url, name, batch_rows, connections)
    df.write.format("jdbc").options(**options).mode(WRITE_MODES[if_exists]).save()


# The column by which a database tells rows of a repeated task from others, in staging tables only.
LOAD_ROW = "LoadRow"


def staging_name(name: str, batch: str) -> str:
    return f"{name}_staging_{batch}"


def swap_statements(name: str, columns: Sequence[str], batch_column: str, batch: str) -> list[str]:
    """SQL that puts a staged batch in the place of what the batch loaded before, in one transaction.

    A task that was repeated after it had sent its rows has them in the staging table twice; of each such row
    one is taken.
    """
    listed = ", ".join(columns)
    rows = (
        f"SELECT {listed}, ROW_NUMBER() OVER (PARTITION BY {LOAD_ROW} ORDER BY {LOAD_ROW}) AS CopyNumber FROM {staging_name(name, batch)}"
    )
    return [
        "BEGIN TRANSACTION",
        f"DELETE FROM {name} WHERE {batch_column} = '{batch}'",
        f"INSERT INTO {name} ({listed}) SELECT {listed} FROM ({rows}) staged WHERE CopyNumber = 1",
        "COMMIT",
        f"DROP TABLE {staging_name(name, batch)}",
    ]


def load_jdbc_batch(
    df: DataFrame,
    url: str,
    name: str,
    batch_column: str,
    batch: str,
    execute: Callable[[Sequence[str]], None],
    batch_rows: int = 1000,
    connections: int = 16,
) -> None:
    """Load a batch into an external table so that neither a repeated task nor a repeated load adds rows twice.

    The rows go to a staging table first, numbered; ``execute`` then runs the statements of the swap
    over the caller's own connection. ``df`` must give the same rows in the same tasks each time, as a written table does.
    """
    rows = df.withColumn(batch_column, F.lit(batch))
    staged = rows.withColumn(LOAD_ROW, F.monotonically_increasing_id())
    load_jdbc(staged, url, staging_name(name, batch), "replace", batch_rows, connections)
    execute(swap_statements(name, rows.columns, batch_column, batch))


def jdbc_read_options(url: str, query: str, split: Split | None = None, one_task: bool = False) -> dict[str, str]:
    """Options of a read; one that is not split must be asked for, as a single task reads the whole result."""
    source = {"url": url, "dbtable": f"({query}) q"}
    if split is None:
        if not one_task:
            raise ValueError("name a column to split the read by, or ask for one task")
        return source
    return source | {
        "partitionColumn": split.column,
        "lowerBound": split.lower,
        "upperBound": split.upper,
        "numPartitions": str(split.connections),
    }


def read_jdbc(spark: SparkSession, url: str, query: str, split: Split | None = None, one_task: bool = False) -> DataFrame:
    """Result of a query that the external database runs, once for each part of the split."""
    return spark.read.format("jdbc").options(**jdbc_read_options(url, query, split, one_task)).load()


def run_sql(spark: SparkSession, sql: str, params: Mapping[str, Any] | None = None, **tables: DataFrame) -> DataFrame:
    """Parameterised SQL: ``:name`` for values, ``{name}`` for frames passed by keyword."""
    return spark.sql(sql, dict(params or {}), **tables)


def table_schema(spark: SparkSession, name: str) -> DataFrame:
    """Column name, type, nullability and default in order."""
    fields = [
        (f.name, f.dataType.simpleString(), f.nullable, f.metadata.get("CURRENT_DEFAULT")) for f in spark.table(name).schema
    ]
    return spark.createDataFrame(fields, "COLUMN_NAME string, DATA_TYPE string, IS_NULLABLE boolean, COLUMN_DEFAULT string")


def row_count(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.lit(label).alias("TableName"), F.count(F.lit(1)).alias("RowCount"))


def loading_summary(sales: DataFrame, errors: DataFrame, logs: DataFrame) -> DataFrame:
    """Row counts of the three target tables."""
    counts = row_count(sales, "SalesData")
    return counts.unionByName(row_count(errors, "ErrorLogging")).unionByName(row_count(logs, "CurrencyConversionLog"))


def preview(df: DataFrame, order: Sequence[str | Column], rows: int = 5) -> DataFrame:
    """The first rows in a given order."""
    return df.orderBy(*order).limit(rows)
