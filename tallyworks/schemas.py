"""Column layouts, closed value sets and cleaning parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Accepted regions, currencies and product categories.
REGIONS = ("East", "West", "North", "South")
CURRENCIES = ("USD", "EUR", "GBP")
CATEGORIES = ("Electronics", "Accessories", "Office Supplies")
TARGET_CURRENCY = "USD"
UNKNOWN_CUSTOMER = "UNKNOWN"

# Input column order of the two files.
SALES_COLUMNS = ("OrderID", "ProductID", "SaleAmount", "OrderDate", "Region", "CustomerID", "Discount", "Currency")
PRODUCT_COLUMNS = ("ProductID", "ProductName", "Category")

CORRUPT_COLUMN = "_corrupt_record"

# Amounts stay exact through the conversion: 27 + 10 + 1 digits is the widest product
# of an amount and a rate that DecimalType holds without dropping a digit.
AMOUNT_TYPE = T.DecimalType(27, 12)
RATE_TYPE = T.DecimalType(10, 6)
AMOUNT_LIMIT = 1e15
# Amounts in SalesData have sixteen digits before the point.
SALES_AMOUNT_LIMIT = 1e16


def string_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in columns])


SALES_SCHEMA = string_schema(SALES_COLUMNS)
PRODUCT_SCHEMA = string_schema(PRODUCT_COLUMNS)

# The target tables, in column order.
SALES_TABLE = (
    ("OrderID", "string"),
    ("ProductID", "string"),
    ("ProductName", "string"),
    ("Category", "string"),
    ("SaleAmount", "decimal(18,2)"),
    ("OriginalSaleAmount", "decimal(18,2)"),
    ("OriginalCurrency", "string"),
    ("ExchangeRate", "decimal(10,6)"),
    ("OrderDate", "timestamp_ntz"),
    ("Region", "string"),
    ("CustomerID", "string"),
    ("Discount", "decimal(3,2)"),
    ("Currency", "string"),
    ("ProcessingTimestamp", "timestamp_ntz"),
)
ERROR_TABLE = (
    ("OrderID", "string"),
    ("ProductID", "string"),
    ("ErrorType", "string"),
    ("ErrorMessage", "string"),
    ("ProcessingStage", "string"),
    ("ErrorTimestamp", "timestamp_ntz"),
    ("RawData", "string"),
)
CONVERSION_LOG_TABLE = (
    ("FromCurrency", "string"),
    ("ToCurrency", "string"),
    ("ExchangeRate", "decimal(10,6)"),
    ("ConversionTimestamp", "timestamp_ntz"),
    ("Source", "string"),
    ("RecordCount", "bigint"),
)

# Identifiers that the tables give their rows, and defaults of columns that a load may leave out.
ID_COLUMNS = {"ErrorLogging": "ErrorID", "CurrencyConversionLog": "LogID"}
DEFAULTS = {"ErrorLogging": {"ErrorTimestamp": "localtimestamp()"}}

# How the stored tables are laid out: by the batch that loaded a row, then by the month of its date.
BATCH_COLUMN = "BatchID"
MONTHS = {
    "SalesData": ("OrderMonth", "OrderDate"),
    "ErrorLogging": ("ErrorMonth", "ErrorTimestamp"),
    "CurrencyConversionLog": ("ConversionMonth", "ConversionTimestamp"),
}


def ddl(layout, defaults=None) -> str:
    """The columns of a table as schema text, with their defaults where a table is created."""
    defaults = defaults or {}
    return ", ".join(f"`{name}` {kind}" + (f" DEFAULT {defaults[name]}" if name in defaults else "") for name, kind in layout)


# Column order of the enriched CSV export.
EXPORT_COLUMNS = SALES_COLUMNS + (
    "ProductName",
    "Category",
    "OriginalSaleAmount",
    "OriginalCurrency",
    "ExchangeRate",
    "ProcessingTimestamp",
)


@dataclass(frozen=True)
class CleaningSpec:
    """Parameters of the cleaning stage; the defaults are the ones in force by default."""

    required: tuple[str, ...] = ("OrderID", "ProductID", "OrderDate", "Region", "Currency", "CustomerID")
    date_formats: tuple[str, ...] = ("%d/%m/%Y", "%d-%m-%Y", "%Y-%d-%m")
    regions: tuple[str, ...] = REGIONS
    currencies: tuple[str, ...] = CURRENCIES
    amount_min: float = -1000.0
    amount_max: float = 10000.0
    discount_min: float = 0.0
    discount_max: float = 1.0
    max_rejection_rate: float = 0.15
    remove_duplicates: bool = True
    duplicate_keys: tuple[str, ...] = ("OrderID", "ProductID")

    def __post_init__(self):
        if max(abs(self.amount_min), abs(self.amount_max)) >= AMOUNT_LIMIT:
            raise ValueError(f"amount bounds must stay below {AMOUNT_LIMIT:g} to be held exactly")
