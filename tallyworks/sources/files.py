"""CSV inputs and outputs and parquet tables on shared storage."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyworks.schemas import (
    CORRUPT_COLUMN,
    PRODUCT_COLUMNS,
    PRODUCT_SCHEMA,
    SALES_COLUMNS,
    SALES_SCHEMA,
)


class SchemaMismatch(ValueError):
    """An input lacks expected columns."""


def _reader(spark: SparkSession, schema: T.StructType) -> DataFrameReader:
    """Header CSV of text columns.

    The header must name the columns in order; Spark raises otherwise, where binding by
    position would swap columns silently. A missing path raises as well.
    """
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)


def read_marked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows, with the line as ``_corrupt_record`` where it has too few or too many fields.

    Whole lines are parsed: with column pruning Spark would not see a wrong field count
    when a query needs only some of the columns.
    """
    declared = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
    marked = _reader(spark, declared).option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return marked.option("columnPruning", False).csv(path)


def read_sales(spark: SparkSession, path: str, on_malformed: str = "keep") -> DataFrame:
    """Rows of a wrong length are cut or padded with nulls (``keep``), or marked for rejection (``reject``).

    No row is left out: marked rows carry their line, and tagging turns them into rejects.
    """
    return _read(spark, path, SALES_SCHEMA, on_malformed)


def _read(spark: SparkSession, path: str, schema: T.StructType, on_malformed: str) -> DataFrame:
    if on_malformed == "keep":
        return _reader(spark, schema).csv(path)
    if on_malformed == "reject":
        return read_marked(spark, path, schema)
    raise ValueError(f"on_malformed must be 'keep' or 'reject', not {on_malformed!r}")


def read_products(spark: SparkSession, path: str, on_malformed: str = "keep") -> DataFrame:
    """Product rows; those of a wrong length are cut or padded with nulls, or marked for rejection (``reject``)."""
    return _read(spark, path, PRODUCT_SCHEMA, on_malformed)


def malformed_rows(rows: DataFrame) -> DataFrame:
    """First field and text of the rows that do not fit the schema, from a frame of ``read_marked``."""
    return rows.filter(F.col(CORRUPT_COLUMN).isNotNull()).select(rows.columns[0], F.col(CORRUPT_COLUMN).alias("RawLine"))


def missing_columns(df: DataFrame, expected: tuple[str, ...]) -> list[str]:
    return [c for c in expected if c not in df.columns]


def check_inputs(sales: DataFrame, products: DataFrame) -> None:
    """Raise if either input lacks a column; reads metadata only."""
    errors = []
    for name, df, expected in (("sales", sales, SALES_COLUMNS), ("products", products, PRODUCT_COLUMNS)):
        absent = missing_columns(df, expected)
        if absent:
            errors.append(f"{name}: missing required columns {absent}")
    if errors:
        raise SchemaMismatch("; ".join(errors))


def read_written(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Parquet of a known schema, read without a job to find the schema out."""
    return spark.read.schema(schema).parquet(path)


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """The frame from parquet files on shared storage: computed once, lineage cut."""
    df.write.mode("overwrite").parquet(path)
    return read_written(df.sparkSession, path, df.schema)


def write_csv(df: DataFrame, path: str) -> None:
    """Directory of CSV parts with a header, replacing what was there."""
    df.write.csv(path, header=True, mode="overwrite")


def few_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of some rows that the driver holds, handed over as they are, so that reading it starts no Python worker."""
    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrow = to_arrow_schema(fields)
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, fields)


def write_json_summary(metrics: DataFrame, path: str) -> None:
    """A few metric lines as one JSON file."""
    metrics.coalesce(1).write.json(path, mode="overwrite")
