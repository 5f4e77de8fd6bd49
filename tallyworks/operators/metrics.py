"""Data profile, stage counts, the rejection-rate gate and pipeline metrics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.casts import safe_double
from tallyworks.functions.dates import timestamp_literal
from tallyworks.operators.clean import CHECK
from tallyworks.operators.enrich import is_converted
from tallyworks.schemas import CONVERSION_LOG_TABLE, CORRUPT_COLUMN

RATE = "decimal(18,4)"
CHECK_METRICS = {
    "required": "missing_required_fields",
    "date": "invalid_dates",
    "enum": "invalid_enums",
    "range": "invalid_numeric",
}
PROFILED = ("OrderID", "ProductID", "SaleAmount", "OrderDate", "Region", "Currency")
DISTINCT = {"Region": "unique_regions", "Currency": "unique_currencies", "ProductID": "unique_products"}


class RejectionRateExceeded(ValueError):
    """More rows were rejected than the run allows."""


def percentage(part: Column, whole: Column) -> Column:
    """Part of the whole in percent, 0 where the whole is 0."""
    wide = "decimal(20,0)"
    share = F.try_divide(part.cast(wide) * 100, whole.cast(wide))
    return F.coalesce(share, F.lit(0)).cast(RATE)


def as_lines(one_row: DataFrame, names: Sequence[str], key: str = "Metric", value: str = "Value") -> DataFrame:
    """A one-row frame of counts as (metric, value) lines."""
    lines = [F.struct(F.lit(name).alias(key), F.col(name).alias(value)) for name in names]
    return one_row.select(F.inline(F.array(*lines)))


def _null_counts(*columns: str) -> dict[str, Column]:
    """An amount that is not a number counts as a null."""
    values = {c: safe_double(F.col(c)) if c == "SaleAmount" else F.col(c) for c in columns}
    return {f"null_{c}": F.count_if(value.isNull()) for c, value in values.items()}


def data_profile(sales: DataFrame, products: DataFrame, approximate: bool = False) -> DataFrame:
    """Row, null and distinct counts of the inputs; a null counts as one distinct value.

    Each column whose values are counted has an aggregate of its own, over that column and those
    whose nulls it counts: every column is read once, groups are counted where they meet, and no
    row is repeated for another column.
    """
    plain = [c for c in PROFILED if c not in DISTINCT]
    total = F.coalesce(F.sum("sales_records"), F.lit(0)).alias("sales_records")
    product_count = products.agg(F.count(F.lit(1)).alias("product_records"))
    lines = as_lines(product_count, ["product_records"])
    for position, (column, name) in enumerate(DISTINCT.items()):
        first = position == 0
        counts = {"sales_records": F.count(F.lit(1))} if first else {}
        counts |= _null_counts(*(plain if first else []), column)
        if approximate:
            distinct = F.approx_count_distinct(column) + F.coalesce(F.max(F.col(column).isNull().cast("bigint")), F.lit(0))
            profile = sales.agg(*[m.alias(c) for c, m in counts.items()], distinct.alias(name))
        else:
            groups = sales.groupBy(column).agg(*[m.alias(c) for c, m in counts.items()])
            sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts if c != "sales_records"]
            profile = groups.agg(*([total] if first else []), *sums, F.count(F.lit(1)).alias(name))
        lines = lines.unionByName(as_lines(profile, [*counts, name]))
    return lines


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def stage_counts(columns: Sequence[str] = ()) -> dict[str, Column]:
    """Aggregates over tagged rows: all, per check and rejected; malformed ones where the reader marks them."""
    counts = {"initial_records": F.count(F.lit(1))}
    if CORRUPT_COLUMN in columns:
        counts["malformed_rows"] = F.count_if(F.col(CHECK) == "malformed")
    counts.update({name: F.count_if(F.col(CHECK) == code) for code, name in CHECK_METRICS.items()})
    counts["rejected_records"] = F.count_if(F.col(CHECK).isNotNull())
    return counts


def clean_metrics(
    tagged: DataFrame, keys: Sequence[str] = ("OrderID", "ProductID"), remove_duplicates: bool = True
) -> DataFrame:
    """One row of cleaning counts, in one pass; only distinct keys are shuffled, and none if duplicates stay."""
    valid_key = F.when(F.col(CHECK).isNull(), F.struct(*keys))
    valid = F.count_if(F.col(CHECK).isNull())
    final = F.count_distinct(valid_key) if remove_duplicates else valid
    return tagged.agg(
        *[measure.alias(name) for name, measure in stage_counts(tagged.columns).items()],
        (valid - final).alias("duplicates_removed"),
        final.alias("final_records"),
        percentage(F.count_if(F.col(CHECK).isNotNull()), F.count(F.lit(1))).alias("rejection_rate"),
    )


def rejection_rate(tagged: DataFrame, max_rejection_rate: float) -> DataFrame:
    """One row: rejected share in percent and whether the run may go on."""
    total, failed = F.count(F.lit(1)), F.count_if(F.col(CHECK).isNotNull())
    return tagged.agg(total.alias("TotalRecords"), failed.alias("RejectedRecords")).select(
        "TotalRecords",
        "RejectedRecords",
        percentage(F.col("RejectedRecords"), F.col("TotalRecords")).alias("RejectionRate"),
        (~rate_exceeded(F.col("RejectedRecords"), F.col("TotalRecords"), max_rejection_rate)).alias("WithinLimit"),
    )


def rate_exceeded(failed: Column, total: Column, max_rejection_rate: float) -> Column:
    rate = F.coalesce(F.try_divide(failed.cast("double"), total.cast("double")) * 100, F.lit(0.0))
    return rate > max_rejection_rate * 100


def within_limit(failed: int, total: int, max_rejection_rate: float) -> bool:
    """Whether the rejected share is at most the limit."""
    return (failed / total * 100 if total else 0.0) <= max_rejection_rate * 100


def enforce_rejection_rate(failed: int, total: int, max_rejection_rate: float) -> None:
    """Raise when the rejected share lies above the limit; exactly at the limit passes."""
    rate = failed / total * 100 if total else 0.0
    limit = max_rejection_rate * 100
    if not within_limit(failed, total, max_rejection_rate):
        raise RejectionRateExceeded(f"rejection rate {rate:.2f}% exceeds the limit of {limit:.2f}%")


def enrich_counts(columns: Sequence[str]) -> dict[str, Column]:
    """Aggregates over enriched rows before final formatting, for the steps that have run."""
    counts = {}
    if "ProductName" in columns:
        counts["product_enriched_records"] = F.count_if(F.col("ProductName").isNotNull())
    if "OriginalCurrency" in columns:
        counts["currency_converted_records"] = F.count_if(is_converted())
    counts["final_records"] = F.count(F.lit(1))
    return counts


def enrich_metrics(cleaned: DataFrame, enriched: DataFrame) -> DataFrame:
    """(metric, value) lines: rows before, with a product, converted and after."""
    initial = cleaned.agg(F.count(F.lit(1)).alias("initial_records"))
    counts = enrich_counts(enriched.columns)
    final = enriched.agg(*[measure.alias(name) for name, measure in counts.items()])
    return as_lines(initial, ["initial_records"]).unionByName(as_lines(final, list(counts)))


def conversion_log(enriched: DataFrame, run_ts: datetime) -> DataFrame:
    """Converted rows per pair, rate and source; currencies converted without a rate are left out."""
    counted = (
        enriched.filter(is_converted() & F.col("RateSource").isNotNull())
        .groupBy(
            F.col("OriginalCurrency").alias("FromCurrency"),
            F.col("Currency").alias("ToCurrency"),
            "ExchangeRate",
            F.col("RateSource").alias("Source"),
        )
        .agg(F.count(F.lit(1)).alias("RecordCount"))
    )
    stamped = counted.withColumn("ConversionTimestamp", timestamp_literal(run_ts))
    return conversion_log_table(stamped)


def conversion_log_table(logs: DataFrame) -> DataFrame:
    """Logs in the layout of the target table; absent columns are null, unreadable timestamps too."""
    columns = []
    for name, kind in CONVERSION_LOG_TABLE:
        value = F.col(name).try_cast(kind) if name in logs.columns else F.lit(None).cast(kind)
        columns.append(value.alias(name))
    return logs.select(*columns)
