from __future__ import annotations

import math
import random
import struct
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyworks.functions.casts import exact_amount, safe_double
from tallyworks.functions.dates import parse_date, read_format, timestamp_literal
from tallyworks.functions.rules import CATEGORY_RULE, DEFAULT_RULES, Rule, rule_report, violated
from tallyworks.functions.text import number_text
from tallyworks.schemas import CleaningSpec

FORMATS = CleaningSpec().date_formats


def evaluate(spark, texts, column):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(column).collect()]


READ = {
    "01/05/2023": date(2023, 5, 1),
    "1/5/2023": date(2023, 5, 1),
    " 1/05/2023": date(2023, 5, 1),
    "01-06-2023": date(2023, 6, 1),
    "1-2-2023": date(2023, 2, 1),
    "2023-13-01": date(2023, 1, 13),
    "2023-05-01": date(2023, 1, 5),
    "2023-1-5": date(2023, 5, 1),
    "2023- 5-01": date(2023, 1, 5),
    "29/02/2024": date(2024, 2, 29),
    "31/12/9999": date(9999, 12, 31),
}
UNREAD = [
    "29/02/2023", "31/04/2023", "32/01/2023", "00/01/2023", "01/13/2023", "2023-01-13", "01/05/23", "01/05/12023",
    "01/05/0000", "01/05/+2023", "01/05/-2023", "001/05/2023", "01/005/2023", " 01/05/2023", "01/05/2023 ",
    "01/05/2023\n", "01/ 5/2023", "01.05.2023", "01/05-2023", "2023/05/01", "", "abc", None,
]


def test_dates_by_first_matching_format(spark):
    got = evaluate(spark, list(READ) + UNREAD, parse_date(F.col("t"), FORMATS))
    assert got == list(READ.values()) + [None] * len(UNREAD)


def test_every_day_reads_back(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1995-12-25', DATE'2005-03-05')) AS d")
    for layout in ("dd/MM/yyyy", "d/M/yyyy", "dd-MM-yyyy", "yyyy-dd-MM", "yyyy-d-M"):
        wrong = days.filter(~parse_date(F.date_format("d", layout), FORMATS).eqNullSafe(F.col("d")))
        assert wrong.count() == 0, layout


def test_unsupported_formats_raise(spark):
    for fmt in ("%H:%M", "%d%m%Y", "on %d/%m/%Y", "%d/%m", "%d/%d/%Y", "%d %m %Y"):
        with pytest.raises(ValueError):
            read_format(F.col("t"), fmt)


def test_separators_may_differ(spark):
    texts = ["1.2/2023", "1/2.2023", "1.2.2023", "31..12::1999"]
    read = F.coalesce(read_format(F.col("t"), "%d.%m/%Y"), read_format(F.col("t"), "%d..%m::%Y"))
    assert evaluate(spark, texts, read) == [date(2023, 2, 1), None, None, date(1999, 12, 31)]


def test_timestamp_literal_ignores_the_time_zone(spark):
    moment = datetime(2024, 3, 10, 2, 30, 1, 5)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert spark.range(1).select(timestamp_literal(moment)).first()[0] == moment
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_safe_double(spark):
    got = evaluate(spark, ["abc", "", None, "1e3", "-2.50", " 7 ", "NaN", "Infinity"], safe_double(F.col("t")))
    assert got[:6] == [None, None, None, 1000.0, -2.5, 7.0]
    assert math.isnan(got[6]) and math.isinf(got[7])


def test_exact_amount_keeps_every_digit(spark):
    texts = ["1.249", "0.0499999999", "1e3", "12.5d", "999999999999.123456789012", "abc", "", None]
    got = evaluate(spark, texts, exact_amount(F.col("t")).cast("string"))
    assert got == [
        "1.249000000000",
        "0.049999999900",
        "1000.000000000000",
        "12.500000000000",
        "999999999999.123456789012",
        None,
        None,
        None,
    ]


def test_number_text_is_the_shortest_spelling(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 1.0, -10000.01, 12345678.9, 1e7, 9999999999999998.0, 1e16, 1.5e22, 1e-4, 0.00012345, 1e-5]
    values += [-2.5e-7, 1e100, 2.3e-300, 1.7976931348623157e308, math.inf, -math.inf, math.nan, -0.0001]
    values += [round(rng.uniform(-1e9, 1e9), 2) for _ in range(500)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-8, 20) for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(number_text(F.col("v"))).collect()]
    # Two spellings may be equally short, so compare the value and the layout.
    for value, text in zip(values, got):
        same = struct.pack("d", float(text)) == struct.pack("d", value) or math.isnan(value)
        assert same and ("e" in text, "." in text) == ("e" in repr(value), "." in repr(value)), (value, text)


def test_amount_bounds_must_be_exact():
    with pytest.raises(ValueError):
        CleaningSpec(amount_max=1e15)


def test_rules_are_two_valued(spark):
    df = spark.createDataFrame(
        [("1", "5", "East"), (None, None, None), ("", "", ""), ("  ", "NaN", "east"), ("x", "11", " East")],
        "a string, n string, e string",
    )
    rules = [
        Rule("a", "required", mandatory=True),
        Rule("n", "range", (0, 10)),
        Rule("n", "range", (0, 10), mandatory=True),
        Rule("e", "enum", ("East",)),
        Rule("e", "enum", ("East",), mandatory=True),
        Rule("e", "date_format", FORMATS),
    ]
    rows = df.select(*[violated(r).alias(str(i)) for i, r in enumerate(rules)]).collect()
    assert [tuple(r) for r in rows] == [
        (False, False, False, False, False, True),
        (True, False, True, False, True, False),
        (True, False, True, True, True, True),
        (False, True, True, True, True, True),
        (False, True, True, True, True, True),
    ]
    with pytest.raises(ValueError):
        violated(Rule("a", "unique"))


def test_rule_report_counts_each_rule(sales):
    df = sales({}, {"OrderID": "", "SaleAmount": "10000.01"}, {"Region": "east", "Discount": "-0.1", "OrderDate": None})
    got = {r["FieldName"]: (r["CheckedCount"], r["ViolationCount"]) for r in rule_report(df).collect()}
    assert got == {
        "OrderID": (3, 1),
        "ProductID": (3, 0),
        "SaleAmount": (3, 1),
        "OrderDate": (3, 0),
        "Region": (3, 1),
        "Currency": (3, 0),
        "Discount": (3, 1),
    }
    assert [r.kind for r in DEFAULT_RULES] == ["required", "required", "range", "date_format", "enum", "enum", "range"]


def test_category_rule(products):
    df = products(("1", "a", "Electronics"), ("2", "b", "Toys"), ("3", "c", None), ("4", "d", "Office Supplies"))
    got = [r[0] for r in df.orderBy("ProductID").select(violated(CATEGORY_RULE)).collect()]
    assert got == [False, True, True, False]
