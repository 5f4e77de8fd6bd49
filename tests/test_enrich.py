from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import clean as C
from tallyworks.operators import enrich as E
from tallyworks.operators import metrics as M

from .conftest import RUN_TS


def cleaned(df):
    return C.clean(C.tag_rows(df))


@pytest.fixture
def rates(quotes):
    def build(*rows):
        return E.resolve_rates(quotes(*rows), RUN_TS)

    return build


API = [("EUR", "USD", "1.10", "API", datetime(2024, 1, 1)), ("GBP", "USD", "1.25", "API", datetime(2024, 1, 1))]


def test_lookup_keeps_unmatched_and_repeats_for_repeated_ids(sales, products):
    df = cleaned(sales({"OrderID": "1"}, {"OrderID": "2", "ProductID": "B"}, {"OrderID": "3", "ProductID": "?"}))
    got = E.product_lookup(df, products(("A", "Ant", "x"), ("B", "Bee", "y"), ("B", "Bug", "z")))
    rows = sorted((r["OrderID"], str(r["ProductName"]), str(r["Category"])) for r in got.collect())
    assert rows == [("1", "Ant", "x"), ("2", "Bee", "y"), ("2", "Bug", "z"), ("3", "None", "None")]
    assert got.columns == df.columns + ["ProductName", "Category"]


def test_rate_precedence(quotes):
    hour = timedelta(hours=1)
    got = E.resolve_rates(
        quotes(
            ("EUR", "USD", "1.1", "cache", RUN_TS - hour / 2),
            ("EUR", "USD", "1.2", "API", RUN_TS),
            ("EUR", "USD", "1.3", "fallback", RUN_TS),
            ("GBP", "USD", "2.1", "cache", RUN_TS - hour),
            ("GBP", "USD", "2.2", "API", RUN_TS - 9 * hour),
            ("GBP", "USD", "2.3", "API", RUN_TS - 8 * hour),
            ("GBP", "USD", "2.4", "fallback", RUN_TS),
            ("CHF", "USD", "0", "cache", RUN_TS),
            ("CHF", "USD", None, "API", RUN_TS),
            ("CHF", "USD", "3.4", "fallback", None),
            ("CHF", "USD", "3.5", "rumour", RUN_TS),
            ("JPY", "USD", "0", "API", RUN_TS),
            ("USD", "USD", "9", "API", RUN_TS),
            ("EUR", "GBP", "0.8", "API", RUN_TS + hour),
            ("CAD", "USD", "4.2", "API", RUN_TS),
            ("CAD", "USD", "4.1", "API", RUN_TS),
        ),
        RUN_TS,
    )
    rows = {(r["from_currency"], r["to_currency"]): (r["rate"], r["source"]) for r in got.collect()}
    assert rows == {
        ("EUR", "USD"): (Decimal("1.1"), "cache"),
        ("GBP", "USD"): (Decimal("2.3"), "API"),
        ("CHF", "USD"): (Decimal("3.4"), "fallback"),
        ("CAD", "USD"): (Decimal("4.1"), "API"),
    }


def test_lenient_conversion(sales, rates):
    df = cleaned(
        sales(
            {"OrderID": "1", "SaleAmount": "175.5", "Currency": "EUR"},
            {"OrderID": "2", "SaleAmount": "10", "Currency": "GBP"},
            {"OrderID": "3", "SaleAmount": None, "Currency": "EUR"},
            {"OrderID": "4", "SaleAmount": "-7.25"},
        )
    ).unionByName(cleaned(sales({"OrderID": "5"})).withColumn("Currency", F.lit(None).cast("string")))
    got = E.convert_currency(df, rates(API[0]))
    rows = {
        r["OrderID"]: (r["SaleAmount"], r["ExchangeRate"], r["OriginalCurrency"], r["RateSource"], r["Currency"])
        for r in got.collect()
    }
    assert rows == {
        "1": (Decimal("193.05"), Decimal("1.1"), "EUR", "API", "USD"),
        "2": (Decimal("10"), Decimal("1"), "GBP", None, "USD"),
        "3": (None, Decimal("1.1"), "EUR", "API", "USD"),
        "4": (Decimal("-7.25"), Decimal("1"), "USD", None, "USD"),
        "5": (Decimal("10"), Decimal("1"), None, None, "USD"),
    }
    assert got.filter(E.is_converted()).count() == 2
    log = {r["FromCurrency"]: (r["RecordCount"], r["Source"]) for r in M.conversion_log(got, RUN_TS).collect()}
    assert log == {"EUR": (1, "API")}


def test_strict_conversion(sales, rates):
    df = cleaned(
        sales(
            {"OrderID": "1", "SaleAmount": "10", "Currency": "EUR"},
            {"OrderID": "2", "SaleAmount": "10", "Currency": "GBP"},
            {"OrderID": "3", "SaleAmount": None, "Currency": "EUR"},
            {"OrderID": "4", "SaleAmount": "10", "Currency": "USD"},
        )
    )
    got = E.convert_strict(df, rates(API[0]))
    assert {r["OrderID"]: r["ConvertedAmount"] for r in got.collect()} == {
        "1": Decimal(11),
        "2": None,
        "3": None,
        "4": Decimal(10),
    }


def test_rounding_is_half_up_on_exact_products(sales, rates):
    amounts = ["0.25", "-0.25", "2.45", "1.05", "1.249", "0.0499999999", "999999.95"]
    df = cleaned(sales(*[{"OrderID": str(i), "SaleAmount": a} for i, a in enumerate(amounts)]))
    got = E.finalize(E.convert_currency(df, rates(*API)))
    values = [str(r["SaleAmount"]) for r in got.orderBy("OrderID").collect()]
    assert values == ["0.3", "0.3", "2.5", "1.1", "1.2", "0.0"]  # the last amount is out of range


def test_finalize_is_idempotent_and_formats_dates(sales, products, rates):
    df = cleaned(sales({"SaleAmount": None, "Currency": "EUR"}, {"OrderID": "2", "SaleAmount": "-8.888"}))
    enriched = E.enrich(df, products(("A", "Ant", "x")), rates(*API), RUN_TS)
    once = E.finalize(enriched)
    assert sorted(E.finalize(once).collect()) == sorted(once.collect())
    row = E.export_rows(enriched).orderBy("OrderID").collect()
    assert (row[0]["SaleAmount"], row[0]["OriginalSaleAmount"], row[0]["ExchangeRate"]) == ("0.0", "0.0", "1.1")
    assert (row[1]["SaleAmount"], row[1]["OriginalSaleAmount"]) == ("8.9", "8.888")
    assert (row[0]["OrderDate"], row[0]["ProcessingTimestamp"]) == ("2023-05-01", "2024-01-01")


def test_export_keeps_all_digits(sales, products, rates):
    df = cleaned(sales({"SaleAmount": "1"}))
    large = df.withColumn("SaleAmount", F.lit("123456789012345.67").cast(df.schema["SaleAmount"].dataType))
    row = E.export_rows(E.enrich(large, products(("A", "Ant", "x")), rates(*API), RUN_TS)).first()
    assert (row["SaleAmount"], row["OriginalSaleAmount"], row["ExchangeRate"]) == ("123456789012345.7", "123456789012345.67", "1.0")


def test_amounts_that_could_leave_the_table_are_refused(rates):
    E.check_amounts_fit(rates(*API), 1e15 - 1)
    E.check_amounts_fit(rates(), 1e15 - 1)
    with pytest.raises(ValueError, match="do not fit"):
        E.check_amounts_fit(rates(("EUR", "USD", "50", "API", datetime(2024, 1, 1))), 9.9e14)


def test_finalize_doubles_replaces_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (-1.25,)], "SaleAmount double")
    assert [r[0] for r in E.finalize(df).collect()] == [0.0, 0.0, 1.3]


def test_steps_can_be_switched_off(sales, products):
    df = cleaned(sales({}))
    plain = E.finalize(E.enrich(df, None, None, RUN_TS))
    assert "ProductName" not in plain.columns and "OriginalSaleAmount" not in plain.columns
    assert plain.first()["SaleAmount"] == Decimal(10)
    assert "ProductName" in E.enrich(df, products(("A", "Ant", "x")), None, RUN_TS).columns


def test_enrich_metrics(sales, products, rates):
    df = cleaned(sales({"Currency": "EUR"}, {"OrderID": "2", "ProductID": "?"}, {"OrderID": "3", "Currency": "GBP", "SaleAmount": ""}))
    enriched = E.enrich(df, products(("A", "Ant", "x"), ("A", "Axe", "x")), rates(*API), RUN_TS)
    got = {r["Metric"]: r["Value"] for r in M.enrich_metrics(df, enriched).collect()}
    assert got == {
        "initial_records": 3,
        "product_enriched_records": 4,
        "currency_converted_records": 2,
        "final_records": 5,
    }
