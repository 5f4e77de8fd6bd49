from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from tallyworks.operators import enrich as enrichment
from tallyworks.operators.metrics import RejectionRateExceeded, conversion_log
from tallyworks.plans import analytics as A
from tallyworks.plans import pipeline
from tallyworks.schemas import SALES_COLUMNS, CleaningSpec

from .conftest import RUN_TS

LINES = """\
1,A,100.00,01/03/2024,North,C1,0.1,USD
1,A,100.00,01/03/2024,North,C1,0.1,USD
2,B,20.05,2024-05-03,South,C1,0,EUR
3,B,,03-03-2024,South,C2,,EUR
4,C,-40,04/04/2024,East,C3,0.2,GBP
5,A,7.77,05/04/2024,West,C3,0.25,GBP
6,Z,1,06/04/2024,West,C4,0.05,USD
7,A,5,,West,C4,0.05,USD
8,A,5,08/04/2024,west,C4,0.05,USD
9,A,50000,08/04/2024,West,C4,0.05,USD
"""
PRODUCTS = "ProductID,ProductName,Category\nA,Ant,Small\nB,Bear,Large\nC,Cow,Large\n"


@pytest.fixture
def files_in(tmp_path):
    def write(lines=LINES, products=PRODUCTS):
        (tmp_path / "sales.csv").write_text(",".join(SALES_COLUMNS) + "\n" + lines)
        (tmp_path / "products.csv").write_text(products)
        return str(tmp_path / "sales.csv"), str(tmp_path / "products.csv"), str(tmp_path / "out")

    return write


@pytest.fixture
def run(spark, files_in, quotes):
    def go(spec=CleaningSpec(max_rejection_rate=0.3), lines=LINES, products=PRODUCTS, **options):
        sales_path, products_path, out = files_in(lines, products)
        rates = quotes(
            ("EUR", "USD", "1.1", "API", datetime(2024, 1, 1)), ("GBP", "USD", "1.25", "fallback", datetime(2024, 1, 1))
        )
        return pipeline.run_files(spark, sales_path, products_path, rates, out, pipeline.Options(RUN_TS, spec, **options))

    return go


def values(result):
    return {(stage, metric): value for stage, metric, value in result.lines}


def test_whole_run(spark, run):
    result = run()
    got = values(result)
    assert got[("ingestion", "records_processed")] == 10 and got[("ingestion", "product_records")] == 3
    assert got[("cleaning", "rejected_records")] == 3 and got[("cleaning", "rejection_rate")] == 30
    assert got[("cleaning", "missing_required_fields")] == got[("cleaning", "invalid_enums")] == 1
    assert got[("cleaning", "invalid_numeric")] == 1 and got[("cleaning", "invalid_dates")] == 0
    assert got[("cleaning", "duplicates_removed")] == 1 and got[("cleaning", "final_records")] == 6
    assert got[("enrichment", "product_enriched_records")] == 5
    assert got[("enrichment", "currency_converted_records")] == 3
    assert got[("loading", "sales_records_loaded")] == 6 and got[("loading", "error_records_loaded")] == 3
    assert got[("loading", "conversion_logs_loaded")] == 2 and got[("pipeline", "overall_success")] == 1
    assert {s for s, m in got if m == "duration_seconds"} == {"ingestion", "cleaning", "enrichment", "loading", "pipeline"}
    assert got[("pipeline", "final_records")] == 6
    assert got[("pipeline", "start_time")] < got[("pipeline", "end_time")]

    sales = spark.read.parquet(result.path("SalesData")).cache()
    rows = {r["OrderID"]: (r["SaleAmount"], r["OriginalSaleAmount"], r["ExchangeRate"], r["ProductName"]) for r in sales.collect()}
    assert rows == {
        "1": (Decimal("100.00"), Decimal("100.00"), Decimal(1), "Ant"),
        "2": (Decimal("22.10"), Decimal("20.05"), Decimal("1.1"), "Bear"),
        "3": (Decimal("0.00"), Decimal("0.00"), Decimal("1.1"), "Bear"),
        "4": (Decimal("50.00"), Decimal("40.00"), Decimal("1.25"), "Cow"),
        "5": (Decimal("9.70"), Decimal("7.77"), Decimal("1.25"), "Ant"),
        "6": (Decimal("1.00"), Decimal("1.00"), Decimal(1), None),
    }
    log = spark.read.parquet(result.path("CurrencyConversionLog")).orderBy("FromCurrency").collect()
    assert [(r["FromCurrency"], r["ExchangeRate"], r["Source"], r["RecordCount"]) for r in log] == [
        ("EUR", Decimal("1.1"), "API", 1),
        ("GBP", Decimal("1.25"), "fallback", 2),
    ]
    errors = spark.read.parquet(result.path("ErrorLogging"))
    exported = spark.read.csv(result.path("cleaned_sales_csv"), header=True).orderBy("OrderID").collect()
    assert [(r["OrderID"], r["SaleAmount"], r["OrderDate"]) for r in exported][1] == ("2", "22.1", "2024-03-05")
    assert spark.read.json(result.path("metrics")).count() == len(result.lines)
    refused = spark.read.csv(result.path("rejected_records_csv"), header=True)
    assert refused.count() == 3 and "RejectionTimestamp" in refused.columns
    profile = {r["Metric"]: r["Value"] for r in spark.read.json(result.path("raw_data_summary")).collect()}
    assert (profile["sales_records"], profile["null_SaleAmount"], profile["unique_regions"]) == (10, 1, 5)
    assert spark.read.json(result.path("enrichment_summary")).filter("metric = 'final_records'").first()["value"] == 6

    reports = {
        A.region_category: [("North", "Small", 1), ("East", "Large", 1), ("South", "Large", 2), ("West", "Small", 1), ("West", None, 1)],
        A.monthly: [(2024, 3, 3), (2024, 4, 3)],
        A.products: [("A", "Ant", "Small"), ("C", "Cow", "Large"), ("B", "Bear", "Large")],
        A.currency_analysis: [("EUR", 2, Decimal("1.1")), ("GBP", 2, Decimal("1.25"))],
        A.quality: [
            ("Total Records", 6),
            ("Records with SaleAmount", 6),
            ("Records with Product Info", 5),
            ("Records with Customer Info", 6),
        ],
        A.customers: [("C1", 2, Decimal("122.10")), ("C3", 2, Decimal("59.70"))],
        A.timeline: [(RUN_TS.date(), 6, RUN_TS)],
        A.category_performance: [("Small", 2, Decimal("109.70")), ("Large", 3, Decimal("72.10"))],
        A.completeness: [("Complete Records", 5), ("Partial Records", 1), ("Incomplete Records", 0)],
    }
    for report, want in reports.items():
        assert [tuple(r)[: len(want[0])] for r in report(sales).collect()] == want, report.__name__
    shares = {r["Region"]: (r["SalesPercentage"], r["SalesShare"]) for r in A.region_share(sales).collect()}
    assert shares["North"] == (Decimal("1666.6667"), Decimal("54.7046"))
    buckets = {r["DiscountCategory"]: r["OrderCount"] for r in A.discount_buckets(sales).collect()}
    assert buckets == {
        "No Discount": 2,
        "Low Discount (0-10%)": 2,
        "Medium Discount (10-20%)": 1,
        "High Discount (>20%)": 1,
    }
    assert [tuple(r)[:3] for r in A.errors_by_stage(errors).collect()] == [
        ("Enum Validation", "Invalid Enum Values", 1),
        ("Numeric Validation", "Invalid Numeric Range", 1),
        ("Required Field Validation", "Missing Required Fields", 1),
    ]
    logs = spark.read.parquet(result.path("CurrencyConversionLog"))
    assert [tuple(r)[:3] for r in A.conversions(logs).collect()] == [("EUR", "USD", 1), ("GBP", "USD", 1)]
    summary = {r["Metric"]: r["Value"] for r in A.validation_summary(sales, errors, logs).collect()}
    assert summary["Error Rate (%)"] == Decimal("50.00") and summary["Currency Conversions"] == 2
    nothing = {r["Metric"]: r["Value"] for r in A.validation_summary(sales.limit(0), errors, logs).collect()}
    assert nothing["Error Rate (%)"] is None and nothing["Records with Errors"] == 3
    recent = {r["ActivityType"]: (r["Count"], r["TotalValue"]) for r in A.recent_activity(sales, errors, logs, datetime(2024, 4, 11)).collect()}
    assert recent == {
        "Recent Sales": (3, Decimal("60.70")),
        "Recent Errors": (0, Decimal(0)),
        "Recent Conversions": (0, Decimal(0)),
    }
    sales.unpersist()


def test_gate_stops_the_run_after_the_rejects_are_written(spark, run, tmp_path):
    with pytest.raises(RejectionRateExceeded):
        run(CleaningSpec(max_rejection_rate=0.29))
    out = str(tmp_path / "out")
    assert spark.read.parquet(f"{out}/ErrorLogging").count() == 3
    assert not (tmp_path / "out" / "SalesData").exists()
    lines = spark.read.schema(pipeline.METRIC_SCHEMA).json(f"{out}/metrics").collect()
    metrics = {(r["stage"], r["metric"]): r["value"] for r in lines}
    assert metrics[("pipeline", "overall_success")] == metrics[("cleaning", "success")] == 0
    assert metrics[("ingestion", "success")] == 1 and metrics[("cleaning", "rejected_records")] == 3
    assert metrics[("cleaning", "duration_seconds")] > 0 and ("pipeline", "final_records") not in metrics
    assert [(r["stage"], r["error"]) for r in lines if r["error"]] == [
        ("cleaning", "RejectionRateExceeded: rejection rate 30.00% exceeds the limit of 29.00%")
    ]


@pytest.mark.parametrize("on_malformed", ["keep", "reject"])
def test_malformed_rows_of_a_run(spark, files_in, quotes, on_malformed):
    """Valid rows, duplicates and rejects add up to the lines read, and the rejects say what was wrong."""
    short, long = "20,A,5", "21,A,5,08/04/2024,West,C4,0.05,USD,more"
    sales_path, products_path, out = files_in(LINES + f"{short}\n{long}\n")
    options = pipeline.Options(RUN_TS, CleaningSpec(max_rejection_rate=0.5))
    result = pipeline.run_files(spark, sales_path, products_path, quotes(), out, options, on_malformed)
    got, rejecting = values(result), on_malformed == "reject"
    assert got[("ingestion", "records_processed")] == 12
    # Kept rows are padded, and so fail the required check, or cut, and so pass.
    assert got[("cleaning", "rejected_records")] == (5 if rejecting else 4)
    assert got.get(("cleaning", "malformed_rows")) == (2 if rejecting else None)
    assert got[("cleaning", "final_records")] == (6 if rejecting else 7)
    assert got[("cleaning", "rejection_rate")] == pytest.approx(100 * (5 if rejecting else 4) / 12)
    errors = spark.read.parquet(result.path("ErrorLogging")).filter("ProcessingStage = 'File Ingestion'")
    rows = [(r["OrderID"], r["ErrorType"], r["ErrorMessage"]) for r in errors.orderBy("OrderID").collect()]
    assert rows == (
        [("20", "Malformed Row", f"Wrong number of fields: {short}"), ("21", "Malformed Row", f"Wrong number of fields: {long}")]
        if rejecting
        else []
    )


def test_repeated_products_do_not_change_the_duplicate_count(run):
    got = values(run(products=PRODUCTS + "B,Bull,Large\n", export_csv=False))
    assert got[("cleaning", "final_records")] == 6 and got[("cleaning", "duplicates_removed")] == 1
    assert got[("enrichment", "initial_records")] == 6 and got[("enrichment", "final_records")] == 8


@pytest.mark.parametrize("lines", ["", "7,A,5,,West,C4,0.05,USD\n"])
def test_nothing_to_load(spark, run, lines):
    result = run(CleaningSpec(max_rejection_rate=1.0), lines=lines)
    assert values(result)[("loading", "sales_records_loaded")] == 0
    assert spark.read.parquet(result.path("SalesData")).count() == 0
    assert spark.read.parquet(result.path("CurrencyConversionLog")).count() == 0


def test_catalog_target(spark, run):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    try:
        for _ in range(2):  # a second run refreshes the tables
            run(database="shop", export_csv=False)
            assert spark.table("shop.SalesData").count() == 6
            assert spark.table("shop.ErrorLogging").count() == 3
    finally:
        spark.sql("DROP DATABASE shop CASCADE")


def test_steps_can_be_switched_off(spark, run):
    result = run(lookup_products=False, convert_amounts=False, export_csv=False)
    got = values(result)
    assert got[("enrichment", "final_records")] == 6
    assert got[("enrichment", "product_enrichment_enabled")] == got[("enrichment", "currency_conversion_enabled")] == 0
    assert got[("loading", "conversion_logs_loaded")] == 0
    row = spark.read.parquet(result.path("SalesData")).filter("OrderID = '2'").first()
    assert (row["ProductName"], row["ExchangeRate"], row["Currency"]) == (None, None, "EUR")
    assert row["SaleAmount"] == Decimal("20.10")


def test_stages_one_by_one(spark, files_in, quotes, tmp_path):
    """The lazy stages give what the whole run gives."""
    sales_path, products_path, _ = files_in()
    sales, products, profile = pipeline.ingest(spark, sales_path, products_path)
    assert {r["Metric"]: r["Value"] for r in profile.collect()}["product_records"] == 3
    cleaned, rejected, counts = pipeline.clean_sales(sales, RUN_TS)
    assert counts.first()["final_records"] == cleaned.count() == 6 and rejected.count() == 3
    rates = enrichment.resolve_rates(quotes(("EUR", "USD", "1.1", "API", datetime(2024, 1, 1))), RUN_TS)
    final, lines = pipeline.enrich_sales(cleaned, products, rates, RUN_TS)
    assert {r["Metric"]: r["Value"] for r in lines.collect()}["currency_converted_records"] == 3
    logs = conversion_log(enrichment.enrich(cleaned, products, rates, RUN_TS), RUN_TS)
    loaded = pipeline.load_all(final, rejected, logs, pipeline.Run(str(tmp_path / "tables")).refresh)
    assert {r["TableName"]: r["RowCount"] for r in loaded.collect()} == {
        "SalesData": 6,
        "ErrorLogging": 3,
        "CurrencyConversionLog": 1,
    }


def test_counts_hold_when_nothing_is_small_enough_to_broadcast(spark, run):
    """The product join then shuffles; each observed row still counts once."""
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in settings:
        spark.conf.set(name, "-1")
    try:
        got = values(run(export_csv=False))
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert got[("enrichment", "final_records")] == got[("loading", "sales_records_loaded")] == 6
    assert got[("enrichment", "product_enriched_records")] == 5
    assert got[("enrichment", "currency_converted_records")] == 3
