"""Validation in one tagging pass, rejects, duplicate removal, defaults and text cleaning.

Checks run in a fixed order and a row is rejected once, by the first check it fails.
All checks see the text as it was read: trimming and capitalising come last.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.functions.casts import exact_amount, safe_double
from tallyworks.functions.dates import parse_date, timestamp_literal
from tallyworks.functions.rules import Rule, missing, violated
from tallyworks.functions.text import joined, number_text
from tallyworks.schemas import AMOUNT_TYPE, CORRUPT_COLUMN, PRODUCT_COLUMNS, SALES_COLUMNS, TARGET_CURRENCY, UNKNOWN_CUSTOMER, CleaningSpec, ddl

CHECK = "_check"
PARSED_DATE = "_date"
AMOUNT = "_amount"
DISCOUNT = "_discount"

# What ``tag_rows`` returns, for reading it back from files.
TAGGED_SCHEMA = f"{ddl((c, 'string') for c in SALES_COLUMNS)}, {PARSED_DATE} date, {CHECK} string"

# What ``clean`` returns, likewise.
_TYPED = {"SaleAmount": AMOUNT_TYPE.simpleString(), "OrderDate": "timestamp_ntz", "Discount": AMOUNT_TYPE.simpleString()}
CLEANED_SCHEMA = ddl((c, _TYPED.get(c, "string")) for c in SALES_COLUMNS)


@dataclass(frozen=True)
class Check:
    """A validation step: the rows it rejects and how a rejection is described."""

    code: str
    error_type: str
    stage: str
    broken: Column
    message: Callable[[], Column]


def _required_check(spec: CleaningSpec) -> Check:
    broken = F.lit(False)
    for field in spec.required:
        broken = broken | violated(Rule(field, "required", mandatory=True))

    def message() -> Column:
        names = [F.when(missing(field), F.lit(f"'{field}'")) for field in spec.required]
        return F.concat(F.lit("Missing required fields: ["), joined(names, ", "), F.lit("]"))

    return Check("required", "Missing Required Fields", "Required Field Validation", broken, message)


def _date_check(spec: CleaningSpec) -> Check:
    def message() -> Column:
        return F.concat(F.lit("Invalid date format: "), F.coalesce(F.col("OrderDate"), F.lit("None")))

    return Check("date", "Invalid Date Format", "Date Validation", F.col(PARSED_DATE).isNull(), message)


def _enum_check(spec: CleaningSpec) -> Check:
    accepted_values = {"Region": spec.regions, "Currency": spec.currencies}

    def message() -> Column:
        errors = [
            F.when((F.col(field) != "") & ~F.col(field).isin(*values), F.concat(F.lit(f"Invalid {field.lower()}: "), field))
            for field, values in accepted_values.items()
        ]
        return F.concat(F.lit("Invalid enum values: "), joined(errors, "; "))

    region, currency = [violated(Rule(field, "enum", values)) for field, values in accepted_values.items()]
    return Check("enum", "Invalid Enum Values", "Enum Validation", region | currency, message)


def _range_check(spec: CleaningSpec) -> Check:
    limits = {
        "SaleAmount": (AMOUNT, spec.amount_min, spec.amount_max),
        "Discount": (DISCOUNT, spec.discount_min, spec.discount_max),
    }

    def message() -> Column:
        errors = []
        for field, (column, low, high) in limits.items():
            number = F.col(column)
            # NaN is rejected, yet no comparison names it as the cause.
            outside = ((number < low) | (number > high)) & ~F.isnan(number)
            errors.append(F.when(outside, F.concat(F.lit(f"{field} out of range: "), number_text(number))))
        return F.concat(F.lit("Invalid numeric ranges: "), joined(errors, "; "))

    amount, discount = [violated(Rule(column, "range", (low, high))) for column, low, high in limits.values()]
    return Check("range", "Invalid Numeric Range", "Numeric Validation", amount | discount, message)


def _malformed_check() -> Check:
    def message() -> Column:
        return F.concat(F.lit("Wrong number of fields: "), F.col(CORRUPT_COLUMN))

    return Check("malformed", "Malformed Row", "File Ingestion", F.col(CORRUPT_COLUMN).isNotNull(), message)


def checks(spec: CleaningSpec = CleaningSpec()) -> list[Check]:
    """The four checks in the order in which they are applied."""
    return [_required_check(spec), _date_check(spec), _enum_check(spec), _range_check(spec)]


def _steps(df: DataFrame, spec: CleaningSpec) -> list[Check]:
    """The checks of a frame: rows that the reader has marked as malformed fail before all others."""
    marked = [_malformed_check()] if CORRUPT_COLUMN in df.columns else []
    return marked + checks(spec)


def with_numbers(df: DataFrame) -> DataFrame:
    """Adds the double values that the range check looks at."""
    return df.withColumns({AMOUNT: safe_double(F.col("SaleAmount")), DISCOUNT: safe_double(F.col("Discount"))})


def with_parsed_date(df: DataFrame, spec: CleaningSpec = CleaningSpec()) -> DataFrame:
    """Adds the date that the date check looks at."""
    return df.withColumn(PARSED_DATE, parse_date(F.col("OrderDate"), spec.date_formats))


def tag_rows(raw: DataFrame, spec: CleaningSpec = CleaningSpec()) -> DataFrame:
    """Raw columns as text, the parsed date and the code of the first failed check (null if none).

    The line of malformed rows is kept where the reader has marked them.
    """
    kept = [c for c in (*SALES_COLUMNS, CORRUPT_COLUMN) if c in raw.columns or c in SALES_COLUMNS]
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in kept])
    df = with_numbers(with_parsed_date(text, spec))
    first_failed = F.coalesce(*[F.when(check.broken, F.lit(check.code)) for check in _steps(df, spec)])
    return df.select(*kept, PARSED_DATE, first_failed.alias(CHECK))


def flag_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows with ``ErrorMessage``, null where the check passes."""
    return df.withColumn("ErrorMessage", F.when(check.broken, check.message()))


def _split(df: DataFrame, check: Check) -> tuple[DataFrame, DataFrame]:
    flagged = flag_rows(df, check)
    failed = F.col("ErrorMessage").isNotNull()
    return flagged.filter(~failed).drop("ErrorMessage"), flagged.filter(failed)


def validate_required_fields(df: DataFrame, spec: CleaningSpec = CleaningSpec()) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) by the required-field check."""
    return _split(df, _required_check(spec))


def validate_date_formats(df: DataFrame, spec: CleaningSpec = CleaningSpec()) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) by the date check; valid rows carry the parsed date as a timestamp."""
    valid, invalid = _split(with_parsed_date(df, spec), _date_check(spec))
    valid = valid.withColumn("OrderDate", F.col(PARSED_DATE).cast("timestamp_ntz"))
    return valid.drop(PARSED_DATE), invalid.drop(PARSED_DATE)


def validate_enum_values(df: DataFrame, spec: CleaningSpec = CleaningSpec()) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) by the accepted regions and currencies."""
    return _split(df, _enum_check(spec))


def validate_numeric_ranges(df: DataFrame, spec: CleaningSpec = CleaningSpec()) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) by the amount and discount bounds."""
    valid, invalid = _split(with_numbers(df), _range_check(spec))
    return valid.drop(AMOUNT, DISCOUNT), invalid.drop(AMOUNT, DISCOUNT)


def rejects(
    tagged: DataFrame, run_ts: datetime, spec: CleaningSpec = CleaningSpec(), keep: Sequence[str] = ()
) -> DataFrame:
    """Rejected rows with the reason and the whole row as JSON; ``keep`` names further columns to hand on."""
    steps = _steps(tagged, spec)

    def per_check(value) -> Column:
        chosen = F.when(F.col(CHECK) == steps[0].code, value(steps[0]))
        for check in steps[1:]:
            chosen = chosen.when(F.col(CHECK) == check.code, value(check))
        return chosen

    numbers = {"SaleAmount": AMOUNT, "Discount": DISCOUNT}
    row = [F.col(numbers.get(c, c)).alias(c) for c in SALES_COLUMNS]
    return with_numbers(tagged.filter(F.col(CHECK).isNotNull())).select(
        "OrderID",
        "ProductID",
        per_check(lambda check: F.lit(check.error_type)).alias("ErrorType"),
        per_check(lambda check: check.message()).alias("ErrorMessage"),
        per_check(lambda check: F.lit(check.stage)).alias("ProcessingStage"),
        timestamp_literal(run_ts).alias("RejectionTimestamp"),
        F.to_json(F.struct(*row), {"ignoreNullFields": "false"}).alias("RawData"),
        *keep,
    )


def product_rejects(products: DataFrame, run_ts: datetime, keep: Sequence[str] = ()) -> DataFrame:
    """Product lines that the reader has marked as malformed, in the layout of ``rejects``; they belong to no order."""
    check = _malformed_check()
    row = F.struct(*PRODUCT_COLUMNS)
    return products.filter(check.broken).select(
        F.lit(None).cast("string").alias("OrderID"),
        "ProductID",
        F.lit(check.error_type).alias("ErrorType"),
        check.message().alias("ErrorMessage"),
        F.lit(check.stage).alias("ProcessingStage"),
        timestamp_literal(run_ts).alias("RejectionTimestamp"),
        F.to_json(row, {"ignoreNullFields": "false"}).alias("RawData"),
        *keep,
    )


def sound_products(products: DataFrame) -> DataFrame:
    """The product rows without those that the reader has marked as malformed."""
    if CORRUPT_COLUMN not in products.columns:
        return products
    return products.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)


def accepted(tagged: DataFrame) -> DataFrame:
    """Rows that passed every check, with typed amount, date and discount."""
    typed = {
        "SaleAmount": exact_amount(F.col("SaleAmount")),
        "OrderDate": F.col(PARSED_DATE).cast("timestamp_ntz"),
        "Discount": exact_amount(F.col("Discount")),
    }
    columns = [typed.get(c, F.col(c)).alias(c) for c in SALES_COLUMNS]
    return tagged.filter(F.col(CHECK).isNull()).select(*columns)


def remove_duplicates(
    df: DataFrame,
    keys: Sequence[str] = ("OrderID", "ProductID"),
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per key: the first by ``order``, which defaults to all other columns.

    With an explicit order a rerun keeps the same row. Spark keeps one row per key and
    task before the shuffle, so many copies of one key never meet in a single task.
    """
    if order is None:
        order = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def handle_nulls(df: DataFrame) -> DataFrame:
    """Defaults for customer, discount and currency; a missing amount stays null."""
    return df.withColumns(
        {
            "CustomerID": F.when(missing("CustomerID"), UNKNOWN_CUSTOMER).otherwise(F.col("CustomerID")),
            "Discount": F.coalesce("Discount", F.lit(0).cast(df.schema["Discount"].dataType)),
            "Currency": F.coalesce("Currency", F.lit(TARGET_CURRENCY)),
        }
    )


def clean_text(df: DataFrame) -> DataFrame:
    """Blanks trimmed off the identifiers and codes; region in initial capitals."""
    trimmed = {c: F.trim(c) for c in ("OrderID", "ProductID", "CustomerID", "Currency")}
    return df.withColumns({**trimmed, "Region": F.initcap(F.trim("Region"))})


def clean(tagged: DataFrame, spec: CleaningSpec = CleaningSpec()) -> DataFrame:
    """Tagged rows to cleaned rows: accepted, deduplicated, defaults filled, text cleaned."""
    df = accepted(tagged)
    if spec.remove_duplicates:
        df = remove_duplicates(df, spec.duplicate_keys)
    return clean_text(handle_nulls(df))
