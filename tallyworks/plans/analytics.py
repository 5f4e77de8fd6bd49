"""Fifteen business questions over the loaded tables.

Each function takes the tables as frames, so Spark reads only the columns it needs. Counts
that a report stacks line by line are computed in one pass and then laid out as lines.
Orders carry tie-breaking keys, so a rerun lists rows alike.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.operators.metrics import as_lines
from tallyworks.schemas import TARGET_CURRENCY, UNKNOWN_CUSTOMER
from tallyworks.sources.targets import since

TOTAL = "decimal(38,2)"
REPORT_VALUE = "decimal(22,2)"
RATIO = "decimal(18,4)"


def _orders(name: str = "TotalOrders") -> Column:
    return F.count(F.lit(1)).alias(name)


def _sum(column: str, name: str = "TotalSales") -> Column:
    return F.sum(column).cast(TOTAL).alias(name)


def _average(column: str = "SaleAmount", name: str = "AverageOrderValue") -> Column:
    return F.avg(column).alias(name)


def _day(column: Column, name: str) -> Column:
    """Order dates carry no time of day."""
    return F.to_date(column).alias(name)


def with_amount(sales: DataFrame) -> DataFrame:
    return sales.filter(F.col("SaleAmount").isNotNull())


def known_customer() -> Column:
    return F.col("CustomerID").isNotNull() & (F.col("CustomerID") != UNKNOWN_CUSTOMER)


def region_category(sales: DataFrame) -> DataFrame:
    """Q1: sales by region and category."""
    return (
        with_amount(sales)
        .groupBy("Region", "Category")
        .agg(
            _orders(),
            _sum("SaleAmount"),
            _average(),
            _day(F.min("OrderDate"), "FirstOrderDate"),
            _day(F.max("OrderDate"), "LastOrderDate"),
        )
        .orderBy(F.desc("TotalSales"), "Region", "Category")
    )


def monthly(sales: DataFrame) -> DataFrame:
    """Q2: sales by calendar month."""
    return (
        with_amount(sales)
        .groupBy(F.year("OrderDate").alias("Year"), F.month("OrderDate").alias("Month"))
        .agg(_orders(), _sum("SaleAmount"), _average())
        .orderBy("Year", "Month")
    )


def products(sales: DataFrame, top: int | None = None) -> DataFrame:
    """Q3: products by sales, all of them unless ``top`` is given."""
    ranked = (
        with_amount(sales)
        .filter(F.col("ProductName").isNotNull())
        .groupBy("ProductID", "ProductName", "Category")
        .agg(_orders(), _sum("SaleAmount"), _average())
        .orderBy(F.desc("TotalSales"), "ProductID", "ProductName", "Category")
    )
    return ranked if top is None else ranked.limit(top)


def currency_analysis(sales: DataFrame) -> DataFrame:
    """Q4: rates and amounts by original currency, other than the target currency."""
    return (
        sales.filter(F.col("OriginalCurrency").isNotNull() & (F.col("OriginalCurrency") != TARGET_CURRENCY))
        .groupBy("OriginalCurrency")
        .agg(
            _orders("RecordsConverted"),
            _average("ExchangeRate", "AverageExchangeRate"),
            F.min("ExchangeRate").alias("MinExchangeRate"),
            F.max("ExchangeRate").alias("MaxExchangeRate"),
            _sum("OriginalSaleAmount", "TotalOriginalAmount"),
            _sum("SaleAmount", "TotalConvertedAmount"),
        )
        .orderBy(F.desc("RecordsConverted"), "OriginalCurrency")
    )


def errors_by_stage(errors: DataFrame) -> DataFrame:
    """Q5: rejects by stage and type."""
    return (
        errors.groupBy("ProcessingStage", "ErrorType")
        .agg(
            _orders("ErrorCount"),
            F.min("ErrorTimestamp").alias("FirstError"),
            F.max("ErrorTimestamp").alias("LastError"),
        )
        .orderBy(F.desc("ErrorCount"), "ProcessingStage", "ErrorType")
    )


def quality(sales: DataFrame) -> DataFrame:
    """Q6: how many records hold an amount, a product and a customer."""
    measures = {
        "Total Records": F.count(F.lit(1)),
        "Records with SaleAmount": F.count("SaleAmount"),
        "Records with Product Info": F.count("ProductName"),
        "Records with Customer Info": F.count_if(known_customer()),
    }
    return as_lines(sales.agg(*[m.alias(name) for name, m in measures.items()]), list(measures))


def region_share(sales: DataFrame) -> DataFrame:
    """Q7: sales by region.

    SalesPercentage is region sales over the order count of all regions, times 100;
    SalesShare is the region's share of all sales in percent. The window without
    partitions runs over one row per region, a closed set.
    """
    everything = Window.partitionBy()
    regions = with_amount(sales).groupBy("Region").agg(_orders(), _sum("SaleAmount"), _average())
    per_order = F.col("TotalSales").cast("decimal(28,2)") * 100 / F.sum("TotalOrders").over(everything)
    share = F.try_divide(F.col("TotalSales").cast("decimal(28,2)") * 100, F.sum("TotalSales").over(everything))
    return regions.select(
        "*", per_order.cast(RATIO).alias("SalesPercentage"), share.cast(RATIO).alias("SalesShare")
    ).orderBy(F.desc("TotalSales"), "Region")


def discount_buckets(sales: DataFrame) -> DataFrame:
    """Q8: sales by discount bucket."""
    bucket = (
        F.when(F.col("Discount") == 0, "No Discount")
        .when(F.col("Discount") <= F.lit("0.10").cast("decimal(3,2)"), "Low Discount (0-10%)")
        .when(F.col("Discount") <= F.lit("0.20").cast("decimal(3,2)"), "Medium Discount (10-20%)")
        .otherwise("High Discount (>20%)")
    )
    return (
        with_amount(sales)
        .filter(F.col("Discount").isNotNull())
        .groupBy(bucket.alias("DiscountCategory"))
        .agg(_orders("OrderCount"), _sum("SaleAmount"), _average(), _average("Discount", "AverageDiscount"))
        .orderBy(F.desc("TotalSales"), "DiscountCategory")
    )


def customers(sales: DataFrame) -> DataFrame:
    """Q9: customers with more than one order."""
    first, last = F.min("OrderDate"), F.max("OrderDate")
    return (
        with_amount(sales)
        .filter(known_customer())
        .groupBy("CustomerID")
        .agg(
            _orders("OrderCount"),
            _sum("SaleAmount", "TotalSpent"),
            _average(),
            _day(first, "FirstOrder"),
            _day(last, "LastOrder"),
            F.datediff(last, first).alias("CustomerLifetime"),
        )
        .filter(F.col("OrderCount") > 1)
        .orderBy(F.desc("TotalSpent"), "CustomerID")
    )


def timeline(sales: DataFrame) -> DataFrame:
    """Q10: records by processing day."""
    return (
        sales.groupBy(F.to_date("ProcessingTimestamp").alias("ProcessingDate"))
        .agg(
            _orders("RecordsProcessed"),
            F.min("ProcessingTimestamp").alias("FirstProcessed"),
            F.max("ProcessingTimestamp").alias("LastProcessed"),
        )
        .orderBy(F.desc("ProcessingDate"))
    )


def conversions(logs: DataFrame) -> DataFrame:
    """Q11: logged conversions by currency pair."""
    return (
        logs.groupBy("FromCurrency", "ToCurrency")
        .agg(
            _orders("ConversionCount"),
            _average("ExchangeRate", "AverageRate"),
            F.min("ConversionTimestamp").alias("FirstConversion"),
            F.max("ConversionTimestamp").alias("LastConversion"),
        )
        .orderBy(F.desc("ConversionCount"), "FromCurrency", "ToCurrency")
    )


def _activity(df: DataFrame, label: str, moment: str, start: datetime, total: Column) -> DataFrame:
    recent = since(df, moment, start)
    return recent.agg(F.lit(label).alias("ActivityType"), F.count(F.lit(1)).alias("Count"), total.alias("TotalValue"))


def validation_summary(sales: DataFrame, errors: DataFrame, logs: DataFrame) -> DataFrame:
    """Q12: records, errors, errors over loaded records in percent, and logged conversions.

    The error rate is null when nothing was loaded.
    """

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.lit(name).alias("Table"), F.count(F.lit(1)).alias("Rows"))

    counts = counted(sales, "sales").unionByName(counted(errors, "errors")).unionByName(counted(logs, "logs"))

    def rows(name: str) -> Column:
        return F.max(F.when(F.col("Table") == name, F.col("Rows"))).cast("decimal(20,0)")

    rate = F.try_divide(rows("errors") * 100, rows("sales"))
    measures = {
        "Total Records Processed": rows("sales"),
        "Records with Errors": rows("errors"),
        "Error Rate (%)": rate,
        "Currency Conversions": rows("logs"),
    }
    summary = counts.agg(*[m.cast(REPORT_VALUE).alias(name) for name, m in measures.items()])
    return as_lines(summary, list(measures))


def recent_activity(
    sales: DataFrame, errors: DataFrame, logs: DataFrame, as_of: datetime, days: int = 7
) -> DataFrame:
    """Q13: sales, errors and conversions of the last days before ``as_of``; older months are not read."""
    start = as_of - timedelta(days=days)
    nothing = F.lit(0).cast(TOTAL)
    sold = _activity(sales, "Recent Sales", "OrderDate", start, F.sum("SaleAmount").cast(TOTAL))
    failed = _activity(errors, "Recent Errors", "ErrorTimestamp", start, nothing)
    converted = _activity(logs, "Recent Conversions", "ConversionTimestamp", start, nothing)
    return sold.unionByName(failed).unionByName(converted)


def category_performance(sales: DataFrame) -> DataFrame:
    """Q14: orders, sales, customers and regions by category.

    A first grouping by category, customer and region shrinks the data, so the two
    distinct counts expand the groups and not the rows.
    """
    groups = (
        with_amount(sales)
        .filter(F.col("Category").isNotNull())
        .groupBy("Category", "CustomerID", "Region")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("SaleAmount").alias("amount"))
    )
    totals = groups.groupBy("Category").agg(
        F.sum("n").alias("TotalOrders"),
        F.sum("amount").cast(TOTAL).alias("TotalSales"),
        F.count_distinct("CustomerID").alias("UniqueCustomers"),
        F.count_distinct("Region").alias("RegionsServed"),
    )
    average = (F.col("TotalSales").cast("decimal(28,2)") / F.col("TotalOrders")).cast("decimal(22,6)")
    return totals.select(
        "Category", "TotalOrders", "TotalSales", average.alias("AverageOrderValue"), "UniqueCustomers", "RegionsServed"
    ).orderBy(F.desc("TotalSales"), "Category")


def completeness(sales: DataFrame) -> DataFrame:
    """Q15: complete, partial and incomplete records."""
    has_amount, has_product = F.col("SaleAmount").isNotNull(), F.col("ProductName").isNotNull()
    whole = has_product & known_customer()
    measures = {
        "Complete Records": F.count_if(has_amount & whole),
        "Partial Records": F.count_if(has_amount & ~F.coalesce(whole, F.lit(False))),
        "Incomplete Records": F.count_if(~has_amount),
    }
    counts = sales.agg(*[m.alias(name) for name, m in measures.items()])
    return as_lines(counts, list(measures), "Completeness", "RecordCount")


