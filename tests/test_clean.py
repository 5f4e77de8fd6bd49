from __future__ import annotations

import json
import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import clean as C
from tallyworks.operators import metrics as M
from tallyworks.schemas import CleaningSpec

from .conftest import RUN_TS


def codes(df, spec=CleaningSpec()):
    return {r["OrderID"]: r[C.CHECK] for r in C.tag_rows(df, spec).collect()}


def messages(df, spec=CleaningSpec()):
    rows = C.rejects(C.tag_rows(df, spec), RUN_TS, spec).collect()
    return {r["OrderID"]: r["ErrorMessage"] for r in rows}


def test_required_fields(sales):
    df = sales(
        {"OrderID": "1"},
        {"OrderID": "2", "CustomerID": None, "OrderDate": ""},
        {"OrderID": "3", "CustomerID": "  "},
        {"OrderID": "4", "SaleAmount": None, "Discount": None},
        {"OrderID": None},
    )
    assert codes(df) == {"1": None, "2": "required", "3": None, "4": None, None: "required"}
    assert messages(df)["2"] == "Missing required fields: ['OrderDate', 'CustomerID']"
    valid, invalid = C.validate_required_fields(df)
    assert valid.count() == 3 and invalid.count() == 2
    assert valid.columns == df.columns


def test_enums_see_the_text_as_read(sales):
    rows = [
        {"OrderID": "1", "Region": "east"},
        {"OrderID": "2", "Region": " East"},
        {"OrderID": "3", "Currency": "JPY", "Region": "Up"},
        {"OrderID": "4", "Region": "South", "Currency": "GBP"},
    ]
    assert codes(sales(*rows)) == {"1": "enum", "2": "enum", "3": "enum", "4": None}
    got = messages(sales(*rows))
    assert got["2"] == "Invalid enum values: Invalid region:  East"
    assert got["3"] == "Invalid enum values: Invalid region: Up; Invalid currency: JPY"
    loose = CleaningSpec(required=("OrderID",))
    df = sales({"OrderID": "1", "Region": None}, {"OrderID": "2", "Currency": ""})
    assert codes(df, loose) == {"1": None, "2": "enum"}
    assert messages(df, loose) == {"2": "Invalid enum values: "}
    valid, invalid = C.validate_enum_values(df)
    assert (valid.count(), invalid.count()) == (1, 1)


def test_ranges_are_inclusive_and_reject_nan(sales):
    amounts = {
        "-1000": None, "10000": None, "10000.00": None, "-1000.01": "range", "10000.01": "range", "NaN": "range",
        "Infinity": "range", "99999999999999.99": "range", "abc": None, "": None, None: None,
    }
    rows = [{"OrderID": str(i), "SaleAmount": a} for i, a in enumerate(amounts)]
    assert list(codes(sales(*rows)).values()) == list(amounts.values())
    got = messages(sales(*rows, {"OrderID": "d", "SaleAmount": "-2000", "Discount": "1.5"}))
    assert got["3"] == "Invalid numeric ranges: SaleAmount out of range: -1000.01"
    assert got["5"] == "Invalid numeric ranges: "
    assert got["7"] == "Invalid numeric ranges: SaleAmount out of range: 99999999999999.98"
    assert got["d"] == "Invalid numeric ranges: SaleAmount out of range: -2000.0; Discount out of range: 1.5"
    discounts = {"0": None, "1": None, "1.0001": "range", "-0.1": "range", "-0.0": None, None: None}
    rows = [{"OrderID": str(i), "Discount": d} for i, d in enumerate(discounts)]
    assert list(codes(sales(*rows)).values()) == list(discounts.values())
    valid, invalid = C.validate_numeric_ranges(sales(*rows))
    assert (valid.count(), invalid.count()) == (4, 2)


def test_dates(sales):
    df = sales({"OrderID": "1", "OrderDate": "2023-13-01"}, {"OrderID": "2", "OrderDate": "2023-01-13"})
    assert codes(df) == {"1": None, "2": "date"}
    assert messages(df) == {"2": "Invalid date format: 2023-01-13"}
    valid, invalid = C.validate_date_formats(df)
    assert valid.first()["OrderDate"] == datetime(2023, 1, 13)
    assert invalid.first()["OrderDate"] == "2023-01-13" and C.PARSED_DATE not in invalid.columns
    loose = CleaningSpec(required=("OrderID",))
    assert messages(sales({"OrderDate": None}), loose) == {"1": "Invalid date format: None"}


def test_first_failing_check_wins(sales):
    bad = {"OrderID": "1", "CustomerID": "", "OrderDate": "x", "Region": "x", "SaleAmount": "1e9"}
    df = sales(bad, {**bad, "OrderID": "2", "CustomerID": "C"}, {**bad, "OrderID": "3", "CustomerID": "C", "OrderDate": "1/1/2023"})
    assert codes(df) == {"1": "required", "2": "date", "3": "enum"}


def test_reject_holds_the_whole_row(sales):
    df = sales({"OrderID": "9", "SaleAmount": "150", "OrderDate": None, "Discount": "bad"})
    row = C.rejects(C.tag_rows(df), RUN_TS).first()
    assert row["ErrorType"] == "Missing Required Fields"
    assert row["ProcessingStage"] == "Required Field Validation"
    assert row["RejectionTimestamp"] == RUN_TS
    assert json.loads(row["RawData"]) == {
        "OrderID": "9", "ProductID": "A", "SaleAmount": 150.0, "OrderDate": None, "Region": "East",
        "CustomerID": "C1", "Discount": None, "Currency": "USD",
    }


def test_accepted_rows_are_typed_and_exact(sales):
    row = C.accepted(C.tag_rows(sales({"SaleAmount": "0.1", "Discount": "0.333333"}))).first()
    assert row["SaleAmount"] == Decimal("0.1") and row["Discount"] == Decimal("0.333333")
    assert row["OrderDate"] == datetime(2023, 5, 1)


def test_duplicates_keep_the_first_in_order(sales):
    df = sales(
        {"SaleAmount": "20"},
        {"SaleAmount": "3"},
        {"SaleAmount": None},
        {"ProductID": "B", "SaleAmount": "3", "Region": "West"},
        {"ProductID": "B", "SaleAmount": "3", "Region": "East"},
        {"OrderID": " 1"},
    )
    kept = C.remove_duplicates(C.accepted(C.tag_rows(df)))
    rows = {(r["OrderID"], r["ProductID"]): (r["SaleAmount"], r["Region"]) for r in kept.collect()}
    assert rows == {("1", "A"): (None, "East"), ("1", "B"): (Decimal(3), "East"), (" 1", "A"): (Decimal(10), "East")}
    latest = C.remove_duplicates(C.accepted(C.tag_rows(df)), order=[F.desc("SaleAmount")])
    assert {r["SaleAmount"] for r in latest.filter("OrderID = '1'").collect()} == {Decimal(20), Decimal(3)}
    assert C.clean(C.tag_rows(df), CleaningSpec(remove_duplicates=False)).count() == 6


def test_defaults_come_before_trimming(sales):
    df = C.clean(C.tag_rows(sales({"OrderID": " 7 ", "CustomerID": "  ", "Discount": None, "SaleAmount": None})))
    row = df.first()
    assert (row["OrderID"], row["CustomerID"], row["Discount"], row["SaleAmount"]) == ("7", "", Decimal(0), None)
    loose = C.handle_nulls(sales({"CustomerID": "", "Currency": None}, {"CustomerID": None}))
    assert [(r["CustomerID"], r["Currency"]) for r in loose.collect()] == [("UNKNOWN", "USD")] * 2


def test_text_cleaning(sales):
    row = C.clean_text(sales({"Region": "  nORTH ", "Currency": " EUR"}, {"Region": None})).collect()
    assert (row[0]["Region"], row[0]["Currency"], row[1]["Region"]) == ("North", "EUR", None)


def test_random_rows_against_plain_python(sales):
    """Every row is accepted or rejected once, and the counts agree with a row-by-row check."""
    rng = random.Random(11)
    pick = {
        "OrderID": ["1", "2", "3", None],
        "ProductID": ["A", "B", ""],
        "SaleAmount": ["1.5", "-3", None, "x", "20000"],
        "OrderDate": ["01/02/2023", "2023-13-01", "13/13/2023", None],
        "Region": ["East", "West", "east"],
        "CustomerID": ["C1", "C2", None],
        "Discount": ["0.1", None, "2"],
        "Currency": ["USD", "EUR", "JPY"],
    }
    rows = [{name: rng.choice(values) for name, values in pick.items()} for _ in range(600)]

    def expected(row):
        if any(not row[f] for f in CleaningSpec().required):
            return "required"
        if row["OrderDate"] == "13/13/2023":
            return "date"
        if row["Region"] == "east" or row["Currency"] == "JPY":
            return "enum"
        return "range" if row["SaleAmount"] == "20000" or row["Discount"] == "2" else None

    want = [expected(r) for r in rows]
    good = [r for r, code in zip(rows, want) if code is None]
    keys = {(r["OrderID"], r["ProductID"]) for r in good}
    tagged = C.tag_rows(sales(*rows)).cache()
    got = M.clean_metrics(tagged).first()
    assert got["initial_records"] == 600
    assert got["missing_required_fields"] == want.count("required")
    assert got["invalid_dates"] == want.count("date")
    assert got["invalid_enums"] == want.count("enum")
    assert got["invalid_numeric"] == want.count("range")
    assert got["rejected_records"] == 600 - len(good) == C.rejects(tagged, RUN_TS).count()
    assert got["final_records"] == len(keys) == C.clean(tagged).count()
    assert got["duplicates_removed"] == len(good) - len(keys)
    assert float(got["rejection_rate"]) == pytest.approx(100 * (600 - len(good)) / 600, abs=1e-4)
    tagged.unpersist()
