"""Product lookup, exchange-rate resolution, currency conversion and final formatting."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.functions.dates import timestamp_literal
from tallyworks.functions.text import decimal_text
from tallyworks.schemas import EXPORT_COLUMNS, RATE_TYPE, SALES_AMOUNT_LIMIT, TARGET_CURRENCY

# Where a rate may come from, best first.
RATE_SOURCES = ("cache", "API", "fallback")

# What ``resolve_rates`` returns, for reading it back from files.
RATES_SCHEMA = "from_currency string, to_currency string, rate decimal(10,6), source string, ts timestamp_ntz"


def product_lookup(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Left join of the product columns; unmatched rows keep nulls, repeated IDs repeat rows.

    No broadcast hint: the product table may grow with the data, so the planner
    broadcasts it only while its size is within ``spark.sql.autoBroadcastJoinThreshold``
    and otherwise sorts and merges, splitting hot products at run time.
    """
    return sales.join(products.select("ProductID", "ProductName", "Category"), "ProductID", "left").select(
        *[sales[c] for c in sales.columns], "ProductName", "Category"
    )


# Widths of a quote packed into one number: source, time in microseconds, rate, each in decimal digits.
TIME_DIGITS, RATE_DIGITS = 18, 10
_BEFORE_1970 = 719162  # days from the first day of year 1


def pack_quote(rank: Column, ts: Column, rate: Column) -> Column:
    """A quote as one decimal number that is greater the better it is: by rank, then later, then of a lower rate.

    A quote without a time comes before all others of its rank. Such a number has a fixed width, so a
    greatest one per pair is kept by hashing, where a struct would be sorted.
    """
    seconds = (F.hour(ts) * 60 + F.minute(ts)) * 60
    micros = (F.extract(F.lit("SECOND"), ts).cast("decimal(8,6)") * F.lit(1_000_000)).cast("bigint")
    moment = (F.unix_date(ts.cast("date")) + F.lit(_BEFORE_1970)).cast("bigint") * 86_400_000_000 + seconds.cast("bigint") * 1_000_000 + micros
    unscaled = (rate.cast(RATE_TYPE) * F.lit(Decimal(1_000_000))).cast("bigint")
    parts = [
        (rank.cast("decimal(1,0)"), TIME_DIGITS + RATE_DIGITS),
        (F.coalesce(moment + 1, F.lit(0)).cast(f"decimal({TIME_DIGITS},0)"), RATE_DIGITS),
        ((F.lit(10**RATE_DIGITS - 1) - unscaled).cast(f"decimal({RATE_DIGITS},0)"), 0),
    ]
    return sum((value * F.lit(Decimal(10**digits)) for value, digits in parts[:-1]), parts[-1][0]).cast("decimal(38,0)")


def unpack_quote(packed: Column) -> tuple[Column, Column, Column]:
    """(rank, time, rate) of a packed quote."""
    text = F.lpad(packed.cast("string"), 1 + TIME_DIGITS + RATE_DIGITS, "0")
    moment = F.substring(text, 2, TIME_DIGITS).cast("bigint") - 1
    rest = F.pmod(moment, F.lit(86_400_000_000))
    days = (moment - rest) / F.lit(86_400_000_000)
    clock = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (rest.cast("decimal(18,0)") * F.lit(Decimal("0.000001"))).cast("decimal(18,6)"))
    ts = F.date_from_unix_date((days - _BEFORE_1970).cast("int")).cast("timestamp_ntz") + clock
    unscaled = F.lit(10**RATE_DIGITS - 1) - F.substring(text, 2 + TIME_DIGITS, RATE_DIGITS).cast("bigint")
    rate = (unscaled.cast(f"decimal({RATE_DIGITS},0)") * F.lit(Decimal("0.000001"))).cast(RATE_TYPE)
    return F.substring(text, 1, 1).cast("int"), F.when(moment >= 0, ts), rate


def resolve_rates(
    quotes: DataFrame,
    as_of: datetime,
    ttl: timedelta = timedelta(hours=1),
    target: str | None = None,
    currencies: Sequence[str] | None = None,
) -> DataFrame:
    """The rate to use per currency pair out of all quotes known at ``as_of``.

    A cached quote younger than ``ttl`` beats an API quote, which beats a fallback; the
    latest wins within a source, the lower rate among equals. Null and zero rates and
    stale cache entries do not count. The aggregate keeps one row per pair and task, so
    a pair that holds most quotes is no burden.
    """
    now = timestamp_literal(as_of)
    known = quotes.filter(
        (F.col("rate") > 0)
        & (F.col("from_currency") != F.col("to_currency"))
        & F.col("source").isin(*RATE_SOURCES)
        & F.coalesce(F.col("ts") <= now, F.lit(True))
        & ((F.col("source") != "cache") | (F.col("ts") > now - F.expr(f"INTERVAL '{int(ttl.total_seconds())}' SECOND")))
    )
    if target is not None:
        known = known.filter(F.col("to_currency") == target)
    if currencies is not None:
        known = known.filter(F.col("from_currency").isin(*currencies))
    best_first = F.array(*[F.lit(source) for source in RATE_SOURCES])
    rank = F.lit(len(RATE_SOURCES)) - F.array_position(best_first, F.col("source"))
    packed = F.max(pack_quote(rank, F.col("ts").cast("timestamp_ntz"), F.col("rate")))
    rank, ts, rate = unpack_quote(F.col("best"))
    return known.groupBy("from_currency", "to_currency").agg(packed.alias("best")).select(
        "from_currency",
        "to_currency",
        rate.alias("rate"),
        F.element_at(best_first, len(RATE_SOURCES) - rank).alias("source"),
        ts.cast(quotes.schema["ts"].dataType).alias("ts"),
    )


def _with_rate(df: DataFrame, rates: DataFrame, target: str) -> DataFrame:
    """``_rate`` and ``_source`` by currency; null where no rate is known.

    Any currency with a known rate counts. The rates are brought to one row per currency here, the
    latest quote where several are given: no row of the data is repeated, and the broadcast
    holds at most one row per currency that exists, however many quotes there are.
    """
    latest = F.max_by(F.struct("rate", "source"), F.struct("ts", -F.col("rate")))
    known = rates.filter(F.col("to_currency") == target).groupBy(F.col("from_currency").alias("_from")).agg(latest.alias("_best"))
    known = known.select("_from", F.col("_best.rate").alias("_rate"), F.col("_best.source").alias("_source"))
    return df.join(F.broadcast(known), F.col("Currency") == F.col("_from"), "left").drop("_from")


def convert_currency(
    df: DataFrame,
    rates: DataFrame,
    target: str = TARGET_CURRENCY,
) -> DataFrame:
    """Amounts in the target currency; ``rates`` as given by ``resolve_rates``.

    Keeps the amount and currency as they were, the rate used and its source. A currency
    without a rate converts at 1, a missing amount stays missing.
    """
    is_target = F.col("Currency") == target
    one = F.lit(1).cast(RATE_TYPE)
    df = _with_rate(df, rates, target)
    kept = [c for c in df.columns if c not in ("SaleAmount", "Currency", "_rate", "_source")]
    rate = F.when(is_target, one).otherwise(F.coalesce("_rate", one))
    df = df.select(
        *kept,
        (F.col("SaleAmount") * rate).alias("SaleAmount"),
        F.lit(target).alias("Currency"),
        F.col("SaleAmount").alias("OriginalSaleAmount"),
        F.col("Currency").alias("OriginalCurrency"),
        rate.alias("ExchangeRate"),
        F.when(~is_target, F.col("_source")).alias("RateSource"),
    )
    return df


def convert_strict(
    df: DataFrame,
    rates: DataFrame,
    target: str = TARGET_CURRENCY,
) -> DataFrame:
    """``ConvertedAmount`` in the target currency, null where the amount or the rate is missing."""
    df = _with_rate(df, rates, target)
    rate = F.when(F.col("Currency") == target, F.lit(1).cast(RATE_TYPE)).otherwise(F.col("_rate"))
    return df.withColumn("ConvertedAmount", F.col("SaleAmount") * rate).drop("_rate", "_source")


def check_amounts_fit(rates: DataFrame, amount_bound: float) -> None:
    """Raise if an amount within the bound could leave the amount column of SalesData at the highest rate."""
    highest = rates.agg(F.max("rate")).first()[0]
    if highest is not None and amount_bound * float(highest) >= SALES_AMOUNT_LIMIT:
        raise ValueError(f"amounts up to {amount_bound:g} at rate {highest} do not fit the amount column of SalesData")


def is_converted() -> Column:
    """True for rows whose amount was given in another currency."""
    return F.coalesce((F.col("OriginalCurrency") != F.col("Currency")) & F.col("SaleAmount").isNotNull(), F.lit(False))


def add_processing_timestamp(df: DataFrame, run_ts: datetime) -> DataFrame:
    return df.withColumn("ProcessingTimestamp", timestamp_literal(run_ts))


def _zero_for_missing(df: DataFrame, name: str, value: Column) -> Column:
    kind = df.schema[name].dataType
    if kind.typeName() in ("double", "float"):
        value = F.nanvl(value, F.lit(0.0))
    return F.abs(F.coalesce(value, F.lit(0)))


def finalize(df: DataFrame, for_csv: bool = False) -> DataFrame:
    """Non-negative amounts without nulls, sale amount to one decimal place (half up).

    With ``for_csv`` the dates become ``yyyy-MM-dd`` text. Applying it twice changes nothing.
    """
    changes = {"SaleAmount": _zero_for_missing(df, "SaleAmount", F.round("SaleAmount", 1))}
    if "OriginalSaleAmount" in df.columns:
        changes["OriginalSaleAmount"] = _zero_for_missing(df, "OriginalSaleAmount", F.col("OriginalSaleAmount"))
    if for_csv:
        for name in ("OrderDate", "ProcessingTimestamp"):
            if name in df.columns:
                changes[name] = F.date_format(name, "yyyy-MM-dd")
    return df.withColumns(changes)


def export_rows(df: DataFrame) -> DataFrame:
    """Enriched rows as they are written to CSV: numbers as text with all their digits, dates as text."""
    final = finalize(df, for_csv=True)
    numbers = ("SaleAmount", "OriginalSaleAmount", "ExchangeRate", "Discount")
    present = [c for c in EXPORT_COLUMNS if c in final.columns]

    def text(name: str) -> Column:
        exact = isinstance(final.schema[name].dataType, T.DecimalType) and final.schema[name].dataType.scale > 0
        return (decimal_text(F.col(name)) if exact else F.col(name).cast("double").cast("string")).alias(name)

    return final.select(*[text(c) if c in numbers else F.col(c) for c in present])


def enrich(
    cleaned: DataFrame,
    products: DataFrame | None,
    rates: DataFrame | None,
    run_ts: datetime,
) -> DataFrame:
    """Cleaned rows with product columns and converted amounts, before final formatting.

    ``None`` for the products or the rates switches that step off.
    """
    df = cleaned
    if products is not None:
        df = product_lookup(df, products)
    if rates is not None:
        df = convert_currency(df, rates)
    return add_processing_timestamp(df, run_ts)
