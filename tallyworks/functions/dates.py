"""Day, month and year text in several formats, read with built-in functions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text accepted for each directive. A day may be one digit, two digits, or
# a blank and one digit; a year has four digits.
DIRECTIVES = {
    "%d": r"(?: [1-9]|3[01]|[12][0-9]|0?[1-9])",
    "%m": r"(?:1[0-2]|0?[1-9])",
    "%Y": r"(?!0000)[0-9]{4}",
}
SHAPE = re.compile(r"(%[dmY])([^%A-Za-z0-9 ]+)(%[dmY])([^%A-Za-z0-9 ]+)(%[dmY])")


def read_format(text: Column, fmt: str) -> Column:
    """Date of text in one format such as ``%d/%m/%Y``, null for any other text.

    The pattern lets through only text of the right shape; its parts, put in the order of
    an ISO date, are then cast, which finds days that the month does not have. This costs
    less per row than a datetime parser, and nothing is thrown for text of another format.
    """
    found = SHAPE.fullmatch(fmt)
    if not found or len({found[1], found[3], found[5]}) != 3:
        raise ValueError(f"a format takes %d, %m and %Y once each, with separators: {fmt!r}")
    first, before, second, after, third = found.groups()
    guard = "".join(DIRECTIVES.get(part, re.escape(part)) for part in found.groups())
    parts = {
        first: F.substring_index(text, before, 1),
        second: F.substring_index(F.substring_index(text, after, 2 if after == before else 1), before, -1),
        third: F.substring_index(text, after, -1),
    }
    iso = F.concat_ws("-", parts["%Y"], parts["%m"], F.ltrim(parts["%d"]))
    return F.when(text.contains(before) & text.rlike(rf"^{guard}\z"), iso.try_cast("date"))


def parse_date(text: Column, formats: Sequence[str]) -> Column:
    """Date by the first format that reads the whole text, null if none does."""
    return F.coalesce(*[read_format(text, fmt) for fmt in formats])


def timestamp_literal(moment: datetime) -> Column:
    """A wall-clock timestamp, the same under every session time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
