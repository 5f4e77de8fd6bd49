"""Sales, product and rate inputs derived from the order, part and event tables.

The mapping gives the raw input its usual faults at fixed places: missing amounts, dates
and customers, negative amounts, unknown products, three date layouts and a wrong one,
and values outside the accepted regions and currencies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The tables that the inputs are derived from.
TABLES = ("customer", "events", "lineitem", "nation", "orders", "part", "region")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw order line per lineitem row, all columns text.

    Lines and orders both grow with the data, so they are always sorted and merged;
    the customer side is broadcast only while the planner finds it small enough.
    """
    places = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "n_nationkey", "r_name")
    )
    headers = (
        table(spark, sf_dir, "orders")
        .join(places, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_custkey", "o_orderdate", "n_nationkey", "r_name")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    joined = lines.join(headers.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))

    key, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    money = "decimal(12,2)"
    price = F.col("l_extendedprice").cast(money)
    quantity = F.col("l_quantity").cast(money)
    slot = (key + line) % 20

    def dated(pattern: str):
        return F.date_format("o_orderdate", pattern)

    region = F.when(line == 6, "east").otherwise("East")
    for name, mapped in (("AFRICA", "South"), ("AMERICA", "West"), ("ASIA", "East"), ("EUROPE", "North")):
        region = F.when(F.col("r_name") == name, mapped).otherwise(region)
    return joined.select(
        key.cast("string").alias("OrderID"),
        F.when(part % 50 == 7, F.concat(F.lit("PX"), part.cast("string")))
        .otherwise(part.cast("string"))
        .alias("ProductID"),
        F.when(part % 41 == 0, None)
        .when(part % 43 == 0, (-price).cast("string"))
        .when(part % 37 == 0, (-quantity).cast("string"))
        .otherwise(price.cast("string"))
        .alias("SaleAmount"),
        F.when(slot == 0, None)
        .when(slot == 1, dated("yyyy/MM/dd"))
        .when(slot < 9, dated("dd/MM/yyyy"))
        .when(slot < 15, dated("dd-MM-yyyy"))
        .otherwise(dated("yyyy-dd-MM"))
        .alias("OrderDate"),
        region.alias("Region"),
        F.when(F.col("o_custkey") % 29 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("CustomerID"),
        F.when(part % 31 == 0, None)
        .otherwise(F.abs("l_discount").cast("decimal(3,2)").cast("string"))
        .alias("Discount"),
        F.when(F.col("n_nationkey") % 4 == 1, "EUR")
        .when(F.col("n_nationkey") % 4 == 2, "GBP")
        .when((F.col("n_nationkey") % 4 == 3) & (line == 7), "JPY")
        .otherwise("USD")
        .alias("Currency"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.col("p_type").alias("Category"),
    )


def rate_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One exchange-rate quote per event: pair, rate (0 where the event is an error), source and time."""
    user, event, kind = F.col("user_id") % 5, F.col("event_id") % 4, F.col("event_type")
    origin = F.when(user == 0, "EUR").when(user == 1, "GBP").when(user == 2, "USD").when(user == 3, "EUR").otherwise("JPY")
    target = F.when(event == 3, "GBP").otherwise("USD")
    rate = (F.col("value").cast("decimal(10,2)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,6)")
    return table(spark, sf_dir, "events").select(
        origin.alias("from_currency"),
        target.alias("to_currency"),
        F.when((kind == "error") | ((user == 2) & (event == 3)), F.lit(0).cast("decimal(10,6)")).otherwise(rate).alias("rate"),
        F.when(kind == "purchase", "cache").when(kind.isin("click", "view"), "API").otherwise("fallback").alias("source"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
    )
