"""Text to number conversions that give null for text that is not a number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyworks.schemas import AMOUNT_TYPE


def safe_double(text: Column) -> Column:
    """Double value of the text; null for null, empty or unreadable text."""
    return text.try_cast("double")


def exact_amount(text: Column) -> Column:
    """Decimal value of text whose double value has already passed a range check.

    The text is read directly, so no digit is lost to binary fractions; the double is
    only used for spellings that a decimal cast does not read (a trailing ``d``).
    """
    return F.coalesce(text.try_cast(AMOUNT_TYPE), safe_double(text).try_cast(AMOUNT_TYPE))
