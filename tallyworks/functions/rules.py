"""Declarative validation rules compiled to boolean columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.casts import safe_double
from tallyworks.functions.dates import parse_date
from tallyworks.schemas import CATEGORIES, CURRENCIES, REGIONS


@dataclass(frozen=True)
class Rule:
    """A check on one field.

    ``kind`` is ``required``, ``range`` (value: (low, high), both inclusive), ``enum``
    (value: accepted values) or ``date_format`` (value: formats in order). A null passes
    the last three unless ``mandatory`` is set.
    """

    field: str
    kind: str
    value: Any = None
    message: str = ""
    mandatory: bool = False


def missing(field: str) -> Column:
    """True where the field is null or empty; blanks count as content."""
    column = F.col(field)
    return column.isNull() | (column.cast("string") == "")


def violated(rule: Rule) -> Column:
    """Two-valued column: true where the row breaks the rule."""
    column = F.col(rule.field)
    if rule.kind == "required":
        return missing(rule.field)
    if rule.kind == "range":
        low, high = rule.value
        number = safe_double(column)
        broken, absent = ~number.between(low, high), number.isNull()
    elif rule.kind == "enum":
        broken, absent = ~column.isin(*rule.value), column.isNull()
    elif rule.kind == "date_format":
        broken, absent = parse_date(column, rule.value).isNull(), column.isNull()
    else:
        raise ValueError(f"unknown rule kind: {rule.kind!r}")
    return F.when(absent, F.lit(rule.mandatory)).otherwise(broken)


# The predefined rules and their messages.
DEFAULT_RULES = (
    Rule("OrderID", "required", message="OrderID is required", mandatory=True),
    Rule("ProductID", "required", message="ProductID is required", mandatory=True),
    Rule("SaleAmount", "range", (-1000, 10000), "SaleAmount must be between -1000 and 10000"),
    Rule("OrderDate", "date_format", ("%d/%m/%Y", "%d-%m-%Y", "%Y-%d-%m"), "OrderDate must be in valid date format"),
    Rule("Region", "enum", REGIONS, "Region must be one of: East, West, North, South"),
    Rule("Currency", "enum", CURRENCIES, "Currency must be one of: USD, EUR, GBP"),
    Rule("Discount", "range", (0, 1), "Discount must be between 0 and 1"),
)

CATEGORY_RULE = Rule("Category", "enum", CATEGORIES, "Category must be a known category", mandatory=True)


def rule_report(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Rows checked and rows broken per rule, in one pass over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("Checked"),
        *[F.count_if(violated(rule)).alias(f"v{i}") for i, rule in enumerate(rules)],
    )
    lines = [
        F.struct(
            F.lit(rule.field).alias("FieldName"),
            F.lit(rule.kind).alias("RuleType"),
            F.lit(rule.message).alias("ErrorMessage"),
            F.col("Checked").alias("CheckedCount"),
            F.col(f"v{i}").alias("ViolationCount"),
        )
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))


def _outside(field: str, low: float, high: float) -> Column:
    """True where a number lies outside the bounds; null and NaN do not count."""
    number = safe_double(F.col(field))
    return F.coalesce(((number < low) | (number > high)) & ~F.isnan(number), F.lit(False))


def raw_contract(amount_min: float = -1000.0, amount_max: float = 10000.0) -> dict[str, Column]:
    """What a raw sales record must hold: violation column per field."""
    return {
        "OrderID": F.col("OrderID").isNull(),
        "ProductID": F.col("ProductID").isNull(),
        "SaleAmount": _outside("SaleAmount", amount_min, amount_max),
        "Discount": _outside("Discount", 0, 1),
        "Currency": violated(Rule("Currency", "enum", CURRENCIES)),
        "Region": violated(Rule("Region", "enum", REGIONS)),
    }


def cleaned_contract(amount_min: float = -1000.0, amount_max: float = 10000.0) -> dict[str, Column]:
    """What a cleaned and enriched record must hold: violation column per field."""
    return {
        "OrderID": F.col("OrderID").isNull(),
        "ProductID": F.col("ProductID").isNull(),
        "SaleAmount": F.col("SaleAmount").isNull() | _outside("SaleAmount", amount_min, amount_max),
        "OrderDate": F.col("OrderDate").isNull(),
        "Region": F.col("Region").isNull(),
        "Discount": _outside("Discount", 0, 1),
    }


def contract_violations(df: DataFrame, name: str, contract: dict[str, Column]) -> DataFrame:
    """Violations per field of a record contract, in one pass."""
    counts = df.agg(*[F.count_if(broken).alias(field) for field, broken in contract.items()])
    lines = [
        F.struct(F.lit(name).alias("Contract"), F.lit(field).alias("FieldName"), F.col(field).alias("ViolationCount"))
        for field in contract
    ]
    return counts.select(F.inline(F.array(*lines)))
