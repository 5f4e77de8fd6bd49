from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyworks.functions import rules
from tallyworks.operators import clean as C
from tallyworks.operators import metrics as M


def test_profile_counts_null_as_one_value(sales, products):
    df = sales({}, {"Region": None, "ProductID": "B"}, {"Region": None, "Currency": "EUR", "SaleAmount": None})
    goods = products(("A", "Ant", "x"), ("A", "Axe", "x"))
    got = {r["Metric"]: r["Value"] for r in M.data_profile(df, goods).collect()}
    assert got == {
        "sales_records": 3, "product_records": 2, "null_OrderID": 0, "null_ProductID": 0, "null_SaleAmount": 1,
        "null_OrderDate": 0, "null_Region": 2, "null_Currency": 0, "unique_regions": 2, "unique_currencies": 2,
        "unique_products": 2,
    }
    rough = {r["Metric"]: r["Value"] for r in M.data_profile(df, goods, approximate=True).collect()}
    assert rough == got
    empty = {r["Metric"]: r["Value"] for r in M.data_profile(df.limit(0), goods.limit(0)).collect()}
    assert set(empty.values()) == {0}


def test_rejection_rate(sales):
    df = C.tag_rows(sales(*[{}] * 17, *[{"Region": "x"}] * 3))
    row = M.rejection_rate(df, 0.15).first()
    assert (row["TotalRecords"], row["RejectedRecords"], row["RejectionRate"]) == (20, 3, Decimal("15.0000"))
    assert row["WithinLimit"] and not M.rejection_rate(df, 0.149).first()["WithinLimit"]
    none = M.rejection_rate(df.limit(0), 0.15).first()
    assert (none["RejectionRate"], none["WithinLimit"]) == (Decimal(0), True)


def test_gate_is_strict():
    M.enforce_rejection_rate(3, 20, 0.15)
    M.enforce_rejection_rate(0, 0, 0.15)
    with pytest.raises(M.RejectionRateExceeded, match="20.00% exceeds the limit of 15.00%"):
        M.enforce_rejection_rate(4, 20, 0.15)


def test_log_table_fills_absent_columns(spark):
    rows = spark.createDataFrame([("EUR", "USD", "soon")], "FromCurrency string, ToCurrency string, ConversionTimestamp string")
    row = M.conversion_log_table(rows).first()
    assert row["FromCurrency"] == "EUR"
    assert row["ConversionTimestamp"] is None and row["Source"] is None and row["RecordCount"] is None


def test_distinct_values(sales):
    df = sales({}, {"Currency": None}, {"Currency": "EUR"}, {"Currency": None})
    assert {r[0] for r in M.distinct_values(df, "Currency").collect()} == {"USD", "EUR", None}


def test_contracts(sales):
    df = sales({}, {"SaleAmount": "NaN"}, {"SaleAmount": "-1001", "Region": "x"}, {"OrderID": None, "Currency": None})
    got = {r["FieldName"]: r["ViolationCount"] for r in rules.contract_violations(df, "raw", rules.raw_contract()).collect()}
    assert got == {"OrderID": 1, "ProductID": 0, "SaleAmount": 1, "Discount": 0, "Currency": 0, "Region": 1}
    done = df.withColumn("SaleAmount", F.lit(None).cast("decimal(18,2)"))
    got = rules.contract_violations(done, "cleaned", rules.cleaned_contract()).collect()
    assert {r["FieldName"]: r["ViolationCount"] for r in got}["SaleAmount"] == 4
