"""Text helpers for messages and cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_text(value: Column) -> Column:
    """Shortest text of a double: plain digits from 1e-4 up to 1e16, else ``d.de+XX``, inf or nan."""
    size, text = F.abs(value), value.cast("string")
    digits = F.rtrim(value.try_cast("decimal(38,22)").cast("string"), F.lit("0"))
    plain = F.regexp_replace(digits, r"\.$", ".0")
    power = F.regexp_replace(F.regexp_replace(text, r"(\.0)?E(?=[0-9])", "e+"), r"(\.0)?E-", "e-")
    padded = F.regexp_replace(power, r"e-(?=[0-9]$)", "e-0")
    return (
        F.when((size == 0) | size.between(1e-3, 9.999e6), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.lower(F.replace(padded, F.lit("Infinity"), F.lit("inf"))))
    )


def decimal_text(value: Column) -> Column:
    """All digits of a decimal with places, without trailing zeros beyond the first place and without an exponent."""
    return F.regexp_replace(F.rtrim(value.cast("string"), F.lit("0")), r"\.$", ".0")


def joined(parts: list[Column], separator: str) -> Column:
    """The non-null parts joined by the separator."""
    return F.concat_ws(separator, *parts)
